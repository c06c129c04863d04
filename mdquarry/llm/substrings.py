"""Near-duplicate passages by compact windows.

The tokens of a document are its runs of five words. For each of ``HASHES`` hash
functions, the Cartesian tree of a document's token hashes groups all its
stretches of at least ``SPAN`` tokens by their min-hash: node c of the tree
stands for every stretch that lies in [l, r] and contains c, and all of them
have the hash of c as signature. Such a compact window is one row, and there
are about 2 n / SPAN of them for n tokens.

* Windows of different documents with the same signature overlap in a stretch
  that has the same min-hash on both sides. Of a signature's windows, each is
  linked to the first one (smallest document, then place), so a signature that
  many documents share costs one row for each, never pairs of them.
* Interval join: links between two documents whose places lie near one
  diagonal and follow each other form a candidate if at least ``ENOUGH`` hash
  functions support it.
* Sides: where the windows of a signature have different surroundings, each is
  also linked to the first window with the same ``SIDE`` tokens up to its
  centre or from it on, so earlier documents that hold other words around the signature
  take no link. Windows with equal surroundings are one class and looked up once.
* Exact runs: the windows of the first hash function hold every run of ``SPAN``
  tokens once. Where the windows of a signature have different surroundings,
  each run in them is linked to the first document that holds the same run (its
  hash); equal surroundings are looked up once. Such a link is a candidate by
  itself, so what another document shares of the signature hides none.
* Candidates are verified on the token sequences: the stretch between matching
  tokens must have ``MIN_WORDS`` words, and the token sets of both sides a
  similarity of ``THRESHOLD``.

A passage that two documents share with similarity s gets a link from each hash
function with probability s, so at 0.8 a candidate is missed with probability
0.0067, an exact repeat never. Where earlier documents hold parts of it, a
centre in a stretch of 41 equal tokens (an edit in every 46 words) has an equal
side of 21 tokens, and loses its link only to an earlier document with that very
side. Not covered are passages whose equal stretches are shorter (50 to 90 words
with an edit in the middle) where earlier documents hold other words around the
same signatures, and texts that repeat a token over and over: they keep one
window in ``SLACK`` places of such a run, so an exact run that lies in it can
lack its own link.

Edge cases: null texts and texts below ``MIN_WORDS`` words have no passage;
rows without an id take no part; rows with one id are one document, repeats
within a document are not reported; texts of any length are handled in
stretches of ``STRETCH`` tokens that overlap; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binary, groups, id_and_text, keep, read, unpack, unused
from .ragged import Prefix, expand, mix, shingles, word_rows

WIDTH = 5
MIN_WORDS = 50
SPAN = MIN_WORDS - WIDTH + 1
HASHES = 5
ENOUGH = 2
THRESHOLD = 0.8
STRETCH = 1 << 17
TILE = 64  # tokens of a stored piece of a sequence
GAPS = (2 * WIDTH + 2, WIDTH + 3, WIDTH + 1, 3, 1)  # steps between matching tokens of a passage, tried in turn
SIDE = 21  # tokens from a centre on, its own with them, that link two windows
SLACK = 24  # how far places may leave their diagonal
_SALTS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))


def compact_windows(values: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, left, right) of the Cartesian tree's nodes that span at least ``span`` values.

    ``values`` are distinct; zeros separate documents. Sliding minima by
    doubling find the centres, the same tables give how far each reaches.
    """
    n = len(values)
    if n < span:
        z = np.zeros(0, np.int64)
        return z, z, z
    tables = [values]
    while 2 << (len(tables) - 1) <= n:
        k = 1 << (len(tables) - 1)
        tables.append(np.minimum(tables[-1][:-k], tables[-1][k:]))
    p = span.bit_length() - 1
    low = np.minimum(tables[p][:n - span + 1], tables[p][span - (1 << p):n - (1 << p) + 1])
    low = np.unique(low)
    low = low[low > 0]
    order = np.argsort(values, kind="stable")
    centre = np.sort(order[np.searchsorted(values, low, sorter=order)])
    at = values[centre]
    left, right = centre.copy(), centre + 1
    for k in range(len(tables) - 1, -1, -1):
        t, size = tables[k], 1 << k
        to = left - size
        go = (to >= 0) & (t[np.maximum(to, 0)] > at)
        left = np.where(go, to, left)
        go = (right + size <= n) & (t[np.minimum(right, len(t) - 1)] > at)
        right = np.where(go, right + size, right)
    return centre, left, right - 1


def _windows_of(s: np.ndarray, off: np.ndarray):
    """(hash function, row, key, around, centre, left, right) of the windows of several token sequences.

    ``around`` is a hash of the tokens of a window less than ``SPAN`` from its
    centre and of the text's tokens on both sides; 32 bits but for the first
    hash function, on which the exact runs rest.
    """
    whole = Prefix(s)
    # long sequences in overlapping stretches; a passage that crosses an edge lies whole in one or long in both
    row, begin, end = [], [], []
    for i, (a, z) in enumerate(zip(off.tolist(), off[1:].tolist())):
        if z - a < SPAN:
            continue
        at = a
        while True:
            stop = min(z, at + STRETCH)
            row.append(i)
            begin.append(at)
            end.append(stop)
            if stop == z:
                break
            at = stop - 2 * SPAN
    if not row:
        return
    row, begin, end = (np.array(x, np.int64) for x in (row, begin, end))
    # groups of stretches that make about one STRETCH together
    part = np.cumsum(end - begin) // STRETCH
    for g in np.unique(part):
        r, b, n = row[part == g], begin[part == g], (end - begin)[part == g]
        place = expand(b, n)
        slot = np.arange(len(place)) + np.repeat(np.arange(1, len(n) + 1), n)
        own = s[place]
        size = len(place) + len(n) + 1
        bits = np.uint64(size.bit_length())
        piece = np.zeros(size, np.int64)
        piece[slot] = np.repeat(np.arange(len(n)), n)
        where = np.zeros(size, np.int64)
        where[slot] = place
        for i in range(HASHES):
            # the hash in the high bits, the place in the low ones: distinct, earlier places first
            x = mix(own + _SALTS[i])
            v = np.zeros(size, np.uint64)
            v[slot] = ((x >> (bits + np.uint64(1))) << bits) | slot.astype(np.uint64) | np.uint64(1 << 63)
            c, left, right = compact_windows(v, SPAN)
            # where a document repeats a token over and over, its windows end at the same place and lie in each
            # other: one in SLACK places stands for those that follow, near enough for the same diagonal
            token = s[where[c]]
            order = np.lexsort((c, token, right))
            run = np.ones(len(c), bool)
            run[1:] = (np.diff(right[order]) != 0) | (token[order][1:] != token[order][:-1])
            began = c[order][np.maximum.accumulate(np.where(run, np.arange(len(c)), 0))]
            step = (c[order] - began) // SLACK
            first = run.copy()
            first[1:] |= np.diff(step) != 0
            stay = np.sort(order[first])
            c, left, right = c[stay], left[stay], right[stay]
            mine = r[piece[c]]
            base = off[mine]
            c, left, right = where[c], where[left], where[right]
            low, high = np.maximum(left, c - SPAN + 1), np.minimum(right, c + SPAN - 1)
            near = mix(whole.slices(low, high + 1) + (c - low).astype(np.uint64))
            low, high = np.maximum(base, c - SIDE + 1), np.minimum(off[mine + 1], c + SIDE)
            near = mix(near ^ mix(whole.slices(low, high) + (c - low).astype(np.uint64)))
            if i:
                near >>= np.uint64(32)
            yield i, mine, mix(s[c] ^ _SALTS[i]), near, c - base, left - base, right - base


def windows(docs: DataFrame) -> DataFrame:
    """key, hash, around, doc_id, centre, left, right: the compact windows of every document."""
    def run(batches):
        for b in batches:
            for first, h, _, _, off in word_rows(b.column(1).to_pylist()):
                s, off = shingles(h, off, WIDTH)
                for i, row, key, near, *places in _windows_of(s, off):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(row), i, np.int8)),
                         pa.array(near.view(np.int64)), b.column(0).take(pa.array(first + row)),
                         *(pa.array(p.astype(np.int32)) for p in places)],
                        ["key", "hash", "around", "doc_id", "centre", "left", "right"])

    d = id_and_text(docs).where(F.col("doc_id").isNotNull())
    t = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"key long, hash byte, around long, doc_id {t}, centre int, left int, right int")


def tiles(docs: DataFrame) -> DataFrame:
    """doc_id, tile, data: the token sequences in pieces of ``TILE`` 32-bit hashes."""
    def run(batches):
        for b in batches:
            for first, h, _, _, off in word_rows(b.column(1).to_pylist()):
                s, off = shingles(h, off, WIDTH)
                n = np.diff(off)
                parts = np.where(n >= SPAN, -(-n // TILE), 0)
                row = np.repeat(np.arange(len(n)), parts)
                tile = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = off[row] + tile * TILE
                size = np.minimum(TILE, off[row + 1] - start)
                data = (s >> np.uint64(32)).astype("<u4")[expand(start, size)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(first + row)), pa.array(tile.astype(np.int32)),
                     binary(data, np.append(0, np.cumsum(size)))], ["doc_id", "tile", "data"])

    d = id_and_text(docs).where(F.col("doc_id").isNotNull())
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, tile int, data binary")


def _runs_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """run, side, doc_id, place, key, around, at, left, right, z: what the wanted windows are looked up by.

    ``side`` false: every run of ``SPAN`` tokens from ``low`` to ``high``,
    ``at`` from the centre. ``side`` true: both sides; ``run`` takes in the
    signature, and the window's left, right and z are handed on.
    """
    lists = wanted.groupBy("doc_id").agg(
        F.collect_list(F.struct("key", "around", "centre", "low", "high", "left", "right", "z")).alias("_wanted"))
    d = id_and_text(docs).join(lists, "doc_id").select("doc_id", "text", "_wanted")

    def run(batches):
        for b in batches:
            lists = b.column(2)
            each = lists.flatten()
            field = {k: each.field(k).to_numpy() for k in ("key", "around", "centre", "low", "high", "left", "right")}
            size = np.asarray(pa.compute.list_value_length(lists))
            begin = np.append(0, np.cumsum(size))
            for first, h, _, _, off in word_rows(b.column(1).to_pylist()):
                s, off = shingles(h, off, WIDTH)
                a, z = begin[first], begin[first + len(off) - 1]
                row = np.repeat(np.arange(len(off) - 1), size[first:first + len(off) - 1])
                key, near, centre, low, high = (field[k][a:z] for k in ("key", "around", "centre", "low", "high"))
                # rows that share an id with another text: a window may end after this text
                n = np.maximum(np.minimum(high, np.diff(off)[row] - 1) - low - SPAN + 2, 0).astype(np.int64)
                place = expand(low.astype(np.int64), n)
                start = place + np.repeat(off[row], n)
                whole = Prefix(s)
                got = whole.slices(start, start + SPAN)
                no = pa.nulls(len(got), pa.int32())
                yield rows(b, got, False, first + np.repeat(row, n), place, np.repeat(key, n), np.repeat(near, n),
                           place - np.repeat(centre, n), no, no, pa.nulls(len(got), each.field("z").type))
                at = off[row] + centre
                for side, begins in enumerate((at - SIDE + 1, at)):
                    ok = np.flatnonzero((begins >= off[row]) & (begins + SIDE <= off[row + 1]))
                    got = whole.slices(begins[ok], begins[ok] + SIDE)
                    got = mix(got ^ mix(key[ok].view(np.uint64) + np.uint64(side)))
                    yield rows(b, got, True, first + row[ok], centre[ok], key[ok], near[ok], np.zeros(len(ok)),
                               field["left"][a:z][ok], field["right"][a:z][ok], each.field("z").take(pa.array(a + ok)))

    def rows(b, run, side, row, place, key, near, at, left, right, z):
        return pa.RecordBatch.from_arrays(
            [pa.array(run.view(np.int64)), pa.array(np.full(len(run), side)), b.column(0).take(pa.array(row)),
             pa.array(place.astype(np.int32)), pa.array(key), pa.array(near), pa.array(at.astype(np.int32)),
             pa.array(left, pa.int32()), pa.array(right, pa.int32()), z],
            ["run", "side", "doc_id", "place", "key", "around", "at", "left", "right", "z"])

    t = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"run long, side boolean, doc_id {t}, place int, key long, around long, at int, "
                             f"left int, right int, z {t}")


def classes_of(w: DataFrame) -> DataFrame:
    """key, around, hash, first, a, z: windows with equal surroundings as one class, its first window stands for it."""
    return keep(w.groupBy("key", "around", "hash").agg(
        F.min(F.struct("doc_id", "centre", "left", "right")).alias("first"),
        F.min("doc_id").alias("a"), F.max("doc_id").alias("z")), "classes")


def looked_up(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The runs and sides of the first window of every class; runs only for the first hash function."""
    low, high = F.col("first.centre") - (SPAN - 1), F.col("first.centre") + (SPAN - 1)
    low = F.greatest("first.left", low)
    return keep(_runs_of(docs, classes.select(
        "key", "around", "first.doc_id", "first.centre", low.alias("low"),
        F.when(F.col("hash") == 0, F.least("first.right", high)).otherwise(low).alias("high"),
        "first.left", "first.right", "z")), "runs")


def side_links(runs: DataFrame, w: DataFrame) -> DataFrame:
    """hash, doc_id, src, centre, src_centre, back, on: windows, each to the first one with its signature and a side."""
    sides = runs.where("side")
    place = F.struct("doc_id", F.col("place").alias("centre"), "left", "right")
    src = sides.groupBy("run").agg(F.min(place).alias("src"), F.max("z").alias("last"))
    src = src.where(F.col("src.doc_id") != F.col("last")).drop("last")
    to = sides.select("run", "key", "around").join(src, "run").select("key", "around", "src").distinct()
    # the first window of the signature is linked already
    links = w.join(to, ["key", "around"]).where(
        (F.col("doc_id") > F.col("src.doc_id"))
        & ((F.col("src.doc_id") != F.col("first.doc_id")) | (F.col("src.centre") != F.col("first.centre"))))
    back = F.least(F.col("centre") - F.col("left"), F.col("src.centre") - F.col("src.left"))
    on = F.least(F.col("right") - F.col("centre"), F.col("src.right") - F.col("src.centre"))
    return links.where(back + on + 1 >= SPAN).select(
        "hash", "doc_id", F.col("src.doc_id").alias("src"), "centre", F.col("src.centre").alias("src_centre"),
        back.alias("back"), on.alias("on"))


def exact_links(classes: DataFrame, runs: DataFrame, w: DataFrame) -> DataFrame:
    """doc_id, src, centre, src_centre, back, on: exact runs of ``SPAN`` tokens, each to the first document with it.

    ``w`` are the windows of the first hash function whose signatures have
    several surroundings, ``classes`` their classes.
    """
    runs = runs.where("not side")
    first = runs.groupBy("run").agg(F.min(F.struct("doc_id", "place")).alias("src"), F.max("doc_id").alias("z"))
    first = first.where(F.col("src.doc_id") != F.col("z")).select("run", "src")
    many = runs.join(first, "run").groupBy(
        "key", "around", F.col("src.doc_id").alias("src"), (F.col("src.place") - F.col("at")).alias("src_centre")).agg(
        F.min("at").alias("from"), F.max("at").alias("to"))
    many = many.select("key", "around", "src", "src_centre", (-F.col("from")).alias("back"),
                       (F.col("to") + SPAN - 1).alias("on"))
    # a class that is spread over several documents is linked to its first one too
    own = classes.where(F.col("a") != F.col("z")).select(
        "key", "around", F.col("first.doc_id").alias("src"), F.col("first.centre").alias("src_centre"),
        F.least(F.col("first.centre") - F.col("first.left"), F.lit(SPAN - 1)).alias("back"),
        F.least(F.col("first.right") - F.col("first.centre"), F.lit(SPAN - 1)).alias("on"))
    to = own.unionAll(many).distinct()
    return w.select("key", "around", "doc_id", "centre").join(to, ["key", "around"]) \
        .where(F.col("doc_id") > F.col("src")).select("doc_id", "src", "centre", "src_centre", "back", "on")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, low, high, src, src_low, src_high: stretches that an exact run or enough hash functions link."""
    # every window beside the first one of its signature; a signature of one document links nothing
    same = Window.partitionBy("key")
    w = windows(docs).withColumns({
        "first": F.min(F.struct("doc_id", "centre", "left", "right")).over(same), "last": F.max("doc_id").over(same),
        "mixed": F.min("around").over(same) != F.max("around").over(same)})
    w = w.where(F.col("first.doc_id") != F.col("last")).drop("last")
    w = keep(w.where(F.col("mixed") | (F.col("doc_id") != F.col("first.doc_id"))), "windows")
    several = w.where("mixed")
    classes = classes_of(several)
    star = w.where(F.col("doc_id") != F.col("first.doc_id"))
    back = F.least(F.col("centre") - F.col("left"), F.col("first.centre") - F.col("first.left"))
    on = F.least(F.col("right") - F.col("centre"), F.col("first.right") - F.col("first.centre"))
    links = star.where(back + on + 1 >= SPAN).select(
        "hash", "doc_id", F.col("first.doc_id").alias("src"), "centre", F.col("first.centre").alias("src_centre"),
        back.alias("back"), on.alias("on"), ((F.col("hash") == 0) & ~F.col("mixed")).alias("exact"))
    looked = looked_up(docs, classes)
    sides = side_links(looked, several).withColumn("exact", F.lit(False))
    runs = exact_links(classes.where("hash = 0"), looked, several.where("hash = 0")).withColumns(
        {"hash": F.lit(0).cast("byte"), "exact": F.lit(True)})
    links = links.unionByName(sides).unionByName(runs)
    links = links.withColumn("diagonal", F.col("centre") - F.col("src_centre"))

    def cut(df, by, order, start, name):
        """Numbers the runs of rows whose ``start`` condition marks a new run."""
        win = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn("_new", F.coalesce(start(win), F.lit(False)).cast("int")).withColumn(
            name, F.sum("_new").over(win.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")

    pair = ["doc_id", "src"]
    order = ["diagonal", "centre", "hash"]
    links = cut(links, pair, order,
                lambda win: F.col("diagonal") - F.lag("diagonal").over(win) > SLACK, "band")
    order = ["centre", "diagonal", "hash"]
    links = cut(links, [*pair, "band"], order,
                lambda win: F.col("centre") - F.col("back") > F.lag(F.col("centre") + F.col("on")).over(win), "run")
    return links.groupBy(*pair, "band", "run").agg(
        F.size(F.collect_set("hash")).alias("n"), F.max("exact").alias("exact"),
        F.min(F.col("centre") - F.col("back")).alias("low"), F.max(F.col("centre") + F.col("on")).alias("high"),
        F.min(F.col("src_centre") - F.col("back")).alias("src_low"),
        F.max(F.col("src_centre") + F.col("on")).alias("src_high")).where(F.col("exact") | (F.col("n") >= ENOUGH)) \
        .select("doc_id", "low", "high", "src", "src_low", "src_high")


def _runs(places: np.ndarray, gap: int) -> list[np.ndarray]:
    """Ascending places in runs without a step over ``gap``."""
    return np.split(places, np.flatnonzero(np.diff(places) > gap) + 1)


def matches(a: np.ndarray, b: np.ndarray):
    """(first, last in a, first, last in b, similarity) of passages that two token sequences share.

    Matching tokens with small gaps make a passage; if it is not similar
    enough, its parts between smaller gaps are tried.
    """
    def tried(places, gaps):
        for run in _runs(places, gaps[0]):
            lo, hi = int(run[0]), int(run[-1])
            if hi - lo + WIDTH < MIN_WORDS:
                continue
            mine = np.unique(a[lo:hi + 1])
            there = max(_runs(np.flatnonzero(np.isin(b, mine)), GAPS[0]), key=lambda r: r[-1] - r[0])
            lo2, hi2 = int(there[0]), int(there[-1])
            other = np.unique(b[lo2:hi2 + 1])
            common = len(np.intersect1d(mine, other, assume_unique=True))
            likeness = common / (len(mine) + len(other) - common)
            if likeness >= THRESHOLD:
                yield lo, hi, lo2, hi2, likeness
            elif len(gaps) > 1:
                yield from tried(run, gaps[1:])

    hit = np.flatnonzero(np.isin(a, b))
    if len(hit):
        yield from tried(hit, GAPS)


def _verify(batches):
    """Sorted rows (candidate, side, tile, data, doc_id, src) to verified passages."""
    for b, off in groups(batches):
        side, tile = b.column(1).to_numpy(), b.column(2).to_numpy()
        flat, at = unpack(b.column(3), "<u4")
        out = []
        for a, z in zip(off.tolist(), off[1:].tolist()):
            parts = []
            for s in (0, 1):
                rows = np.flatnonzero(side[a:z] == s) + a
                # rows that repeat an id repeat its tiles
                rows = rows[np.append(True, np.diff(tile[rows]) > 0)] if len(rows) else rows
                if len(rows):
                    data = np.concatenate([flat[at[r]:at[r + 1]] for r in rows])
                    parts.append((int(tile[rows[0]]) * TILE, data))
            if len(parts) == 2:
                (p, x), (q, y) = parts
                for lo, hi, lo2, hi2, likeness in matches(x, y):
                    out.append((a, p + lo, p + hi + WIDTH, q + lo2, q + hi2 + WIDTH, likeness))
        if out:
            row, *rest = zip(*out)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(4).take(take), pa.array(rest[0], pa.int64()), pa.array(rest[1], pa.int64()),
                 b.column(5).take(take), pa.array(rest[2], pa.int64()), pa.array(rest[3], pa.int64()),
                 pa.array(rest[4], pa.float64())],
                ["doc_id", "start", "end", "src_doc_id", "src_start", "src_end", "similarity"])


def passages(docs: DataFrame) -> DataFrame:
    """doc_id, start, end, src_doc_id, src_start, src_end, similarity: passages that repeat an earlier document's.

    Places are numbers of words (white space separates them), ``end`` is the
    first word after the passage; src_doc_id is smaller than doc_id.
    """
    found = keep(candidates(docs), "candidates")
    c = keep(found.withColumn("candidate", F.monotonically_increasing_id()), "numbered")

    def side(n, doc, low, high):
        span = F.sequence(F.floor(F.greatest(F.col(low) - GAPS[0], F.lit(0)) / TILE).cast("int"),
                          F.floor((F.col(high) + GAPS[0]) / TILE).cast("int"))
        return c.select("candidate", F.lit(n).cast("byte").alias("side"), F.col(doc).alias("doc"),
                        F.explode(span).alias("tile"), "doc_id", "src")

    wanted = side(0, "doc_id", "low", "high").unionAll(side(1, "src", "src_low", "src_high"))
    t = tiles(docs).withColumnRenamed("doc_id", "doc")
    rows = wanted.join(t, ["doc", "tile"]).select("candidate", "side", "tile", "data", "doc_id", "src")
    rows = rows.repartition("candidate").sortWithinPartitions("candidate", "side", "tile")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_verify, f"doc_id {kind}, start long, end long, src_doc_id {kind}, src_start long, "
                                    "src_end long, similarity double").distinct()


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the passages that repeat an earlier document's; n_chars follows the text.

    A row of which no word is left goes; rows without a repeated passage stay
    as they are. A row is known by its id and its text, so places found in one
    text of an id are not cut out of another one; rows without an id keep their
    text. Equal rows are one document. Where no id has several texts, the id alone
    knows its row: it goes with every window, run and link, so its width counts.
    """
    names = docs.columns
    key_, spans_, mine_ = unused(names, "_key", "_spans", "_mine")
    known = docs.where(F.col("doc_id").isNotNull())
    texts = known.select("doc_id", F.xxhash64("text").alias("text")).groupBy("doc_id").agg(
        F.min("text").alias("low"), F.max("text").alias("high"))
    mine = F.col("doc_id")
    if not texts.where(F.col("low") != F.col("high")).isEmpty():
        mine = F.struct(mine.alias("id"), F.xxhash64("text").alias("text"))
    spans = passages(known.select(mine.alias("doc_id"), "text")).groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "end")).alias(spans_)).withColumnRenamed("doc_id", key_)
    at = names.index("text")
    j = docs.withColumn(mine_, mine).join(spans, F.col(mine_).eqNullSafe(F.col(key_)), "left").select(*names, spans_)
    schema = docs.schema

    def run(batches):
        for b in batches:
            spans = b.column(len(names))
            rows = np.flatnonzero(np.asarray(spans.is_valid()))
            if not len(rows):
                yield pa.RecordBatch.from_arrays(b.columns[:len(names)], names)
                continue
            take = pa.array(rows)
            texts, cuts = b.column(at).take(take).to_pylist(), spans.take(take).to_pylist()
            new, gone = {}, set()
            for first, h, start, end, off in word_rows(texts):
                for i in range(len(off) - 1):
                    row = int(rows[first + i])
                    a, z = int(off[i]), int(off[i + 1])
                    drop = np.zeros(z - a, bool)
                    for c in cuts[first + i]:
                        drop[c["start"]:c["end"]] = True
                    if drop.all():
                        gone.add(row)
                        continue
                    # what stays: from each kept run's first word to the first word of the next cut
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], drop, [True]]).astype(np.int8)))
                    text, s, e = texts[first + i], start[a:z], end[a:z]
                    out = [text[0 if x == 0 else int(s[x]):len(text) if y == z - a else int(e[y - 1])]
                           for x, y in zip(edges[::2], edges[1::2])]
                    new[row] = "\n".join(out)
            columns = dict(zip(names, b.columns))
            full = b.column(at).to_pylist()
            columns["text"] = pa.array([new.get(i, x) for i, x in enumerate(full)], b.column(at).type)
            if "n_chars" in columns:
                kind = columns["n_chars"].type
                old = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([len(new[i]) if i in new else x for i, x in enumerate(old)], kind)
            stay = np.ones(b.num_rows, bool)
            stay[list(gone)] = False
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names).filter(pa.array(stay))

    return j.mapInArrow(run, schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(read(spark, sf_dir, "documents"))
