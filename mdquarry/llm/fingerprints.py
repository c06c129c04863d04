"""Bottom-k document fingerprints, with DataFrame functions only.

A fingerprint is the ``k`` smallest distinct 48-bit hashes of a text's shingles
(runs of five words; words are separated by white space). Fingerprints of parts
merge into the fingerprint of the whole, and estimate resemblance, containment
and the number of distinct shingles.

Edge cases: a null text counts as empty; a text without words has an empty
fingerprint; a text of one to four words has one shingle of all its words; two
empty fingerprints resemble each other by 1, an empty and another one by 0;
equal texts have equal fingerprints; a text with fewer than ``k`` shingles is
held exactly.

:func:`with_next` pairs each row with the following one in descending order of
its id without sorting everything in one task: ids are cut into ranges at
approximate quantiles, each range also receives the first row of the range that
follows, and the texts move once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_and_text, read

K = 128
WIDTH = 5
_BITS = 48
RANGE = 2048  # rows of a range, as long as there are fewer than MAX_RANGES ranges
MAX_RANGES = 1 << 15
_STEP = 256


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The fingerprint of a text as an ascending array of hashes."""
    w = words(text)
    n = F.size(w)

    def of(arr):
        places = F.sequence(F.lit(1), F.greatest(F.size(arr) - width + 1, F.lit(1)))
        return F.transform(places, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(arr, i, width)), 64 - _BITS))

    # the words are bound once by a transform over a one-element array
    hashes = F.element_at(F.transform(F.array(w), of), 1)
    return F.when(n > 0, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).otherwise(
        F.array().cast("array<bigint>"))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of two parts together (shingles that cross the parts aside)."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One fingerprint for each key from those of any number of parts; no group is gathered whole."""
    h = parts.select(*keys, F.explode(column).alias("_h")).groupBy(*keys, "_h").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_h")
    top = h.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    merged = top.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))
    # keys whose parts are all empty keep an empty fingerprint
    every = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    same = [every[c].eqNullSafe(merged[c]) for c in keys]
    return every.join(merged, same, "left").select(
        *(every[c] for c in keys), F.coalesce(merged[column], F.array().cast("array<bigint>")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    union = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    union = merge(a, b, k)
    mine = F.array_intersect(union, a)
    return F.when(F.size(a) == 0, F.lit(1.0)).when(F.size(mine) == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(mine, b)) / F.size(mine))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    last = F.element_at(a, k).cast("double")
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        F.lit(k - 1.0) * F.lit(float(1 << _BITS)) / last)


def as_text(a: Column) -> Column:
    """A fingerprint as a string: 12 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), _BITS // 4, "0")), "")


def _numbers(values: list[int]) -> Column:
    """A constant array; one literal to the parser, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values \
        else F.array().cast("array<bigint>")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds below the key: looked up among every 256th bound first."""
    if len(bounds) <= _STEP:
        below = F.size(F.filter(_numbers(bounds), lambda x: x < key))
    else:
        coarse = bounds[_STEP - 1::_STEP]
        c = F.size(F.filter(_numbers(coarse), lambda x: x < key))
        below = c * _STEP + F.size(F.filter(F.slice(_numbers(bounds), c * _STEP + 1, _STEP), lambda x: x < key))
    return F.when(key.isNull(), F.lit(0)).otherwise(below).cast("int")


def ranged(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt by ranges of their id, each range with a copy of the row that follows it.

    Adds _range, _wrap and _copy. Order within a range: _wrap, then the id from
    high to low, null ids last.
    """
    n, _ = rows.agg(F.count(key), F.lit(0)).first()
    parts = max(1, min(MAX_RANGES, -(-n // RANGE)))
    bounds: list[int] = []
    if parts > 1:
        shares = ", ".join(f"{i / parts}D" for i in range(1, parts))
        at = F.expr(f"percentile_approx({key}, array({shares}), {16 * parts})")
        bounds = sorted(set(rows.agg(at).first()[0]))
    r = rows.withColumn("_range", _range_of(F.col(key), bounds))
    # the highest id of each range: at most MAX_RANGES rows
    tops = {x["_range"]: x["top"] for x in r.groupBy("_range").agg(F.max(key).alias("top")).collect()}
    live = sorted(tops)
    if not live:
        return r.withColumn("_wrap", F.lit(0)).withColumn("_copy", F.lit(0))
    size = max(live) + 1
    before = {b: a for a, b in zip(live[1:], live)}  # the range of higher ids that this one follows
    first = [tops[i] if tops.get(i) is not None else -1 for i in range(size)]
    follows = [before.get(i, -1) for i in range(size)]
    here = F.col("_range") + 1
    is_top = (F.col(key) == F.element_at(_numbers(first), here)) & F.element_at(
        _numbers([int(tops.get(i) is not None) for i in range(size)]), here).cast("boolean")
    # if the lowest range has null ids only, any of its rows may follow the range above
    is_top = F.when(F.col(key).isNull(), F.lit(tops[live[0]] is None) & (F.col("_range") == live[0])).otherwise(is_top)
    prev = F.element_at(_numbers(follows), here).cast("int")
    place = lambda rng, wrap, copy: F.struct(
        rng.cast("int").alias("_range"), F.lit(wrap).alias("_wrap"), F.lit(copy).alias("_copy"))
    # the very first row also follows the last one
    targets = F.when(is_top & (prev >= 0), F.array(place(F.col("_range"), 0, 0), place(prev, 0, 1))) \
        .when(is_top, F.array(place(F.col("_range"), 0, 0), place(F.lit(live[0]), 1, 1))) \
        .otherwise(F.array(place(F.col("_range"), 0, 0)))
    return r.withColumn("_to", F.explode(targets)).drop("_range").select("*", "_to.*").drop("_to")


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch: every row beside the next one in descending order of doc_id.

    The last row is followed by the first. Rows of one id are ordered by a hash
    of their text, rows without an id come last.
    """
    r = ranged(id_and_text(docs), "doc_id").repartition("_range").withColumn("sketch", sketch(F.col("text"), k))
    w = Window.partitionBy("_range").orderBy("_wrap", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "_copy")
    r = r.withColumn("next_text", F.lead("text").over(w)).withColumn("next_sketch", F.lead("sketch").over(w))
    return r.where(F.col("_copy") == 0).drop("_range", "_wrap", "_copy")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_next(read(spark, sf_dir, "documents"))
    n = F.char_length("text")
    m = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - m), F.substring(F.col("next_text"), F.lit(1), m))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    d = d.withColumn("edited_sketch", sketch(F.col("edited")))
    return d.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
