"""Exact inner-product top-k by norm buckets.

Vectors are grouped by length into buckets of bounded size. A first pass
scores every query against the vectors of the longest bucket and so gets a
lower bound of its k-th best score. A bucket is dropped for a block of queries
if even its longest vector cannot reach the bound (|q| |p| < bound). Else the
local cosine threshold c = bound / (|q| max|p|) chooses how the bucket is
pruned for a query:

* length pruning (c low): the bucket is sorted by length, and only vectors with
  |p| >= bound / |q| are looked at;
* coordinate pruning (c high): two unit vectors with cosine at least c differ by
  at most acos(c) in angle, so on the query's largest coordinates a candidate's
  coordinate must lie in a narrow interval around the query's.

What is left is verified with exact integer products. Bounds on floats leave
a margin, so no true result is pruned.

Queries and candidates travel as blocks (one binary matrix per row), each
bucket meets each block of queries once, and only k rows per query and bucket
come out.

Edge cases: vectors that are null or hold null or non-finite components take
no part, neither do vectors whose size differs from the query's; zero vectors
score 0; ties go to the smaller id; a row that is repeated is a candidate as
often as it occurs; a query never returns rows of its own id, of several query
rows with one id the smallest vector counts; fewer than k candidates give fewer
rows; other columns are not read. Finite components of any size take part:
products of large ones are summed in whole numbers without a bound. A component
or score outside 64 bits counts as the nearest 64-bit number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, read, unpack

K = 10
SCALE = 1024
BUCKET = 4096  # candidates of a bucket
BLOCK = 512  # queries of a block
HIGH_COSINE = 0.75
FOCUS = 4  # coordinates looked at


def to_integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """id, vector array<long>: floor(scale * x) of the valid vectors."""
    v = F.col("vector")
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    # floor of a double gives the nearest long where it is out of range
    return vectors.where(ok).select("id", F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("vector"))


def _blocks(rows: DataFrame, name: str, size: int, total: int) -> DataFrame:
    """Vectors of one dimension and neighbouring length gathered into rows: block, dim, n, ids, data, longest.

    Range partitioning by length keeps a block's vectors alike; equal lengths
    are dealt by id, so no length is too frequent.
    """
    parts = max(1, -(-total // size))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    d = rows.withColumn("norm", norm).withColumn("dim", F.size("vector"))
    d = d.repartitionByRange(parts, F.col("dim"), F.col("norm").desc(), F.xxhash64("id")) \
        .sortWithinPartitions("dim", F.col("norm").desc(), "id")

    def run(batches):
        held: list[tuple] = []
        dim = None

        def out():
            m = np.concatenate([x for _, x, _ in held]).astype("<i8")
            ids = np.concatenate([i for i, _, _ in held]).astype("<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes()]),
                 pa.array([m.tobytes()]), pa.array([max(float(n.max()) for _, _, n in held)])],
                ["dim", "n", "ids", "data", "longest"])

        for b in batches:
            ids, dims, norms = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                                for c in ("id", "dim", "norm"))
            flat = b.column(b.schema.get_field_index("vector")).flatten().to_numpy(zero_copy_only=False)
            begin = np.cumsum(dims) - dims
            at = 0
            while at < len(ids):
                if held and (dims[at] != dim or sum(len(i) for i, _, _ in held) >= size):
                    yield out()
                    held = []
                dim = int(dims[at])
                room = size - sum(len(i) for i, _, _ in held)
                stop = at + int(min(room, np.argmax(np.append(dims[at:], -1) != dim)))
                m = flat[begin[at]:begin[at] + dim * (stop - at)].reshape(-1, dim)
                held.append((ids[at:stop], m, norms[at:stop]))
                at = stop
        if held:
            yield out()

    d = d.select("id", "vector", "norm", "dim").mapInArrow(
        run, "dim int, n int, ids binary, data binary, longest double")
    return d.withColumn(name, F.xxhash64("ids", "data")) if name else d


def _prune(q: np.ndarray, q_norm: float, bound: float, unit: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Candidates of a bucket (sorted by length, longest first) that may reach ``bound`` with the query."""
    if bound <= 0 or q_norm == 0:
        return np.arange(len(norms))
    need = bound / q_norm * (1 - 1e-9)
    stop = int(np.searchsorted(-norms, -need, side="right"))
    if not stop:
        return np.zeros(0, np.int64)
    cosine = need / norms[0]
    if cosine < HIGH_COSINE:
        return np.arange(stop)
    # |u - v| <= 2 sin(angle / 2) for unit vectors, and so for each coordinate
    reach = np.sqrt(max(0.0, 2 - 2 * min(1.0, cosine))) + 1e-9
    u = q / q_norm
    left = np.arange(stop)
    for f in np.argsort(-np.abs(u))[:FOCUS]:
        left = left[np.abs(unit[left, f] - u[f]) <= reach]
    return left


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], ~scores[some]))[:k]]


def _products(m: np.ndarray, x: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Exact products of the rows of ``m`` with ``x``; ``reach`` bounds their size, the nearest long where out of range."""
    scores = m @ x
    wide = np.flatnonzero(reach >= 2.0**62)
    if len(wide):
        long = np.iinfo(np.int64)
        scores[wide] = [min(max(s, long.min), long.max) for s in m[wide].astype(object) @ x.astype(object)]
    return scores


_ROW = ["dim", "part", "side", "ids", "data", "bounds", "longest", "least"]


def _score(k: int):
    """Sorted rows of a part (its buckets, side 0, then blocks of queries with their bounds) to query_id, vec_id, score.

    A task holds the buckets of one part and one batch of queries.
    """
    def bucket(r):
        ids, m = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["data"], "<i8").reshape(-1, r["dim"])
        f = m.astype(np.float64)
        norms = np.sqrt((f * f).sum(1))
        order = np.argsort(-norms, kind="stable")
        ids, m, norms, f = ids[order], m[order], norms[order], f[order]
        return ids, m, norms, f, f / np.where(norms == 0, 1, norms)[:, None], float(np.abs(f).max(initial=0)), r["longest"]

    def found(r, ids, m, norms, f, unit, widest, longest):
        # no vector of the bucket reaches the lowest bound of the block
        if r["least"] is not None and r["longest"] * longest * (1 + 1e-9) < r["least"]:
            return
        q_ids, q = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["data"], "<i8").reshape(-1, r["dim"])
        bounds = np.frombuffer(r["bounds"], "<i8") if r["bounds"] else np.zeros(len(q_ids), np.int64)
        # integers below 2**53 make float products exact; larger ones take the integer path
        largest = float(np.abs(q.astype(np.float64)).max(initial=0))
        exact = m.size and widest * largest * r["dim"] < 2**52
        out = ([], [], [])
        for i, (key, x) in enumerate(zip(q_ids, q)):
            y = x.astype(np.float64)
            length = float(np.sqrt(y @ y))
            left = _prune(y, length, float(bounds[i]), unit, norms)
            left = left[ids[left] != key]
            if not len(left):
                continue
            scores = (f[left] @ y).astype(np.int64) if exact else _products(m[left], x, norms[left] * length)
            best = _top(ids[left], scores, k)
            best = best[scores[best] >= bounds[i]] if bounds[i] > 0 else best
            out[0].append(np.full(len(best), key))
            out[1].append(ids[left][best])
            out[2].append(scores[best])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out],
                                             ["query_id", "vec_id", "score"])

    def run(batches):
        key, held = None, []
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if (r["dim"], r["part"]) != key:
                    key, held = (r["dim"], r["part"]), []
                if r["side"] == 0:
                    held.append(bucket(r))
                else:
                    for h in held:
                        yield from found(r, *h)
    return run


def _meet(queries: DataFrame, candidates: DataFrame, parts: int, k: int) -> DataFrame:
    """The k highest products of every query with each bucket of its part.

    Both sides are dealt out by dimension and part and meet in their task, never in a join: the optimizer goes by the
    size of the written tables, takes the copies of a block for the table itself and would broadcast them all.
    """
    rows = candidates.select("dim", "part", F.lit(0).alias("side"), "ids", "data", F.lit(None).cast("binary").alias("bounds"),
                             "longest", F.lit(None).cast("long").alias("least"))
    rows = rows.unionByName(queries.withColumn("side", F.lit(1)).select(*_ROW))
    rows = rows.repartition(parts, "dim", "part").sortWithinPartitions("dim", "part", "side")
    return rows.mapInArrow(_score(k), _FOUND)


_FOUND = "query_id long, vec_id long, score long"


def _merge(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def search(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer products of every query.

    Both sides: id long, vector array<long>.
    """
    n, n_q = candidates.count(), queries.count()
    buckets, blocks = max(1, -(-n // BUCKET)), max(1, -(-n_q // BLOCK))
    q = keep(_blocks(queries.groupBy("id").agg(F.min("vector").alias("vector")), "q_block", BLOCK, n_q), "queries").select(
        "q_block", "dim", "ids", "data", "longest")
    c = keep(_blocks(candidates, "bucket", BUCKET, n), "candidates")
    # one bucket with the longest vectors of each dimension gives every query its first bound
    first = c.groupBy("dim").agg(F.max_by("bucket", F.struct("longest", "bucket")).alias("bucket"))
    first = c.join(F.broadcast(first), ["dim", "bucket"]).withColumn(  # a number for each dimension
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    seed = q.withColumns({"part": F.pmod("q_block", F.lit(blocks)), "bounds": F.lit(None).cast("binary"),
                          "least": F.lit(None).cast("long")})
    near = _merge(_meet(seed, first, blocks, k), k)
    bounds = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    q = keep(_with_bounds(q, bounds), "bounded")
    # a block of queries meets every bucket of its dimension that can still matter; the buckets are dealt
    # over as many parts as there are, and each part gets the blocks of queries one after another
    c = c.withColumn("part", F.pmod("bucket", F.lit(buckets)))
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    return _merge(_meet(q, c, buckets, k), k).select("query_id", "rank", "vec_id", "score")


def _with_bounds(q: DataFrame, bounds: DataFrame) -> DataFrame:
    """Adds ``bounds`` (one long for each query of the block, 0 where unknown) and ``least``, the lowest of them."""
    def ids(batches):
        for b in batches:
            blocks = b.column(0).to_pylist()
            flat, off = unpack(b.column(1), "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(blocks, np.int64), np.diff(off))),
                 pa.array(np.arange(len(flat)) - np.repeat(off[:-1], np.diff(off))), pa.array(flat)],
                ["q_block", "pos", "id"])

    # at most BLOCK rows come together for a block
    each = q.select("q_block", "ids").mapInArrow(ids, "q_block long, pos long, id long") \
        .join(bounds.hint("merge"), "id", "left").select("q_block", "pos", F.coalesce("bound", F.lit(0)).alias("bound"))
    per = each.groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("pos", "bound"))).alias("b"),
                                      F.min("bound").alias("least"))

    def packed(batches):
        for b in batches:
            out = [np.array([x["bound"] for x in r], "<i8").tobytes() for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), b.column(2)],
                                             ["q_block", "bounds", "least"])

    return q.join(per.mapInArrow(packed, "q_block long, bounds binary, least long").hint("merge"), "q_block")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    v = to_integers(e.where(F.col("id").isNotNull()))
    return search(v.where(F.pmod(F.col("id"), F.lit(100)) == 0), v)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
