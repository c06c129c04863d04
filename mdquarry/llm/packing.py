"""Best-fit packing by minimum bin slack.

A document's ids (ended by one end id) are cut only if they are longer than a
sequence: into pieces of the full length, the first piece taking the rest. The
number of pieces of each length is all that the packing needs: a histogram with
at most ``capacity`` entries, which is the only thing the driver sees.

* :func:`fullest` -- for one bin, the largest length still available is placed
  and a bitset subset-sum over the available lengths finds the fullest feasible
  combination for the room that is left.
* :func:`plan_bins` -- that combination is removed as often as the counts
  allow, then the next one is sought. Each round uses up a length, so there are
  few rounds whatever the number of pieces.
* :func:`assign` -- pieces are numbered within their length and look up their
  bin by arithmetic. The numbering adds up counts of hashed slices, so pieces of
  one frequent length are spread over many tasks.

Edge cases: an empty or null text is the end id alone; repeated rows are packed
as often as they occur; an empty table gives an empty result; lengths must be
between 1 and ``capacity``; other columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import bpe
from .common import binary, id_and_text, keep, read
from .tokens import vocabulary_path

CAPACITY = 1024
END_ID = 2
SLICE = 1 << 15  # pieces numbered together


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
        with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""
    def run(batches):
        enc = bpe.Encoder(bpe.Vocabulary.load(path))
        for b in batches:
            for first, ids, off in enc.encode(b.column(1).to_pylist()):
                n = len(off) - 1
                total = np.diff(off) + 1
                flat = np.insert(ids, off[1:], end_id).astype("<u4")
                ends = np.cumsum(total)
                parts = -(-total // capacity)
                row = np.repeat(np.arange(n), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                head = total - (parts - 1) * capacity
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                at = np.append((ends - total)[row] + start, ends[-1])
                data = memoryview(flat.tobytes())
                crc = np.fromiter((zlib.crc32(data[4 * a:4 * z]) for a, z in zip(at.tolist(), at[1:].tolist())),
                                  np.int64, len(row))
                columns = [b.column(0).take(pa.array(first + row)), pa.array(piece.astype(np.int32)),
                           pa.array(start), pa.array(length), pa.array(crc)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, binary(flat, at)], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    d = id_and_text(docs)
    t = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {t}, piece int, start long, length long, ids_crc32 long"
                        + (", ids binary" if with_ids else ""))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best; among equals longer ones are preferred."""
    sizes = sorted((n for n in counts if n <= room and counts[n] > 0), reverse=True)
    full = (1 << (room + 1)) - 1
    reach = [1]  # bit s: the sum s can be made of the lengths so far
    for n in sizes:
        bits, left, step = reach[-1], min(counts[n], room // n), 1
        while left > 0:  # 1, 2, 4 ... of this length at once
            step = min(step, left)
            bits |= (bits << (n * step)) & full
            left -= step
            step *= 2
        reach.append(bits)
        if bits >> room & 1:  # full without any shorter length
            break
    goal = reach[-1].bit_length() - 1
    out: dict[int, int] = {}
    for i in range(len(reach) - 1, 0, -1):
        n, use = sizes[i - 1], 0
        while goal >= n and use < counts[n] and reach[i - 1] >> goal & 1 == 0:
            goal -= n
            use += 1
        if use:
            out[n] = use
    return out


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(number of each length in a bin, bins filled so), for all pieces."""
    left, plan = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        largest = max(left)
        left[largest] -= 1
        bin_ = fullest(left, capacity - largest)
        left[largest] += 1
        bin_[largest] = bin_.get(largest, 0) + 1
        times = min(left[n] // c for n, c in bin_.items())
        plan.append((bin_, times))
        for n, c in bin_.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return plan


def _tables(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan by length: from which number on pieces go to which bins, and where in them."""
    rows, next_rank, base = [], {}, 0
    for bin_, times in plan:
        at = 0
        for n in sorted(bin_, reverse=True):
            rank = next_rank.get(n, 0)
            rows.append((n, rank, times, base, at))
            next_rank[n] = rank + bin_[n] * times
            at += n * bin_[n]
        base += times
    rows.sort()
    cols = np.array(rows or np.zeros((0, 5)), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "times", "base", "at"), cols))


def _numbered(pieces: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Adds ``rank``: the number of a piece among those of its length."""
    slices = max(1, -(-total // SLICE))
    p = pieces.withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(slices)))
    per = p.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_slice").orderBy(*keys)
    p = p.withColumn("_r", F.row_number().over(within))
    return p.join(per, ["length", "_slice"]).withColumn("rank", F.col("_before") + F.col("_r") - 1) \
        .drop("_slice", "_before", "_r")


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length``; no sequence is longer than ``capacity``."""
    keys = [f.name for f in pieces.schema if f.name not in ("length", "ids")]
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in histogram}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError("piece lengths must be between 1 and the capacity")
    t = _tables(plan_bins(counts, capacity))
    names = pieces.columns
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])

    def run(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                            for c in ("length", "rank"))
            # the last entry of this length that begins at or before the rank
            order = np.lexsort((rank, length))
            at = np.empty(len(rank), np.int64)
            s_len, s_rank = length[order], rank[order]
            for n in np.unique(s_len):
                lo, hi = np.searchsorted(s_len, [n, n + 1])
                e0, e1 = np.searchsorted(t["length"], [n, n + 1])
                at[order[lo:hi]] = e0 + np.searchsorted(t["rank"][e0:e1], s_rank[lo:hi], side="right") - 1
            j = rank - t["rank"][at]
            times = t["times"][at]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in names),
                 pa.array(t["base"][at] + j % times), pa.array(t["at"][at] + j // times * length)],
                [*names, "sequence_id", "offset"])

    return _numbered(pieces, keys, sum(counts.values())).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return assign(keep(cut(docs, path, capacity, end_id), "pieces"), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary_path())
