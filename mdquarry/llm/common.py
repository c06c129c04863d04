"""Small helpers of the operators: columns, Arrow batches and written intermediates."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads; others stay out of the scan, a null text becomes empty."""
    return docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table into the shared checkpoint folder and read it back.

    It cuts the lineage, so a lost executor costs a re-read, not a re-run. zstd keeps it small on disk.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, f'llm-{uuid.uuid4().hex[:12]}')}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column (compared without case) has it."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def binary(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow binary column from one flat array: row i holds items offsets[i] to offsets[i+1]."""
    flat = np.ascontiguousarray(flat)
    at = (np.asarray(offsets) * flat.itemsize)
    if len(at) and at[-1] >= 2**31:
        raise ValueError("an Arrow batch over 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(at) - 1,
                                 [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(flat)])


def unpack(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of :func:`binary`; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    parts = [b if b is not None else b"" for b in column.to_pylist()]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) // np.dtype(dtype).itemsize for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), dtype), offsets


def groups(batches, key: int = 0):
    """(rows, offsets) of whole groups from batches that are sorted by the column ``key``.

    A group may go over several batches; the last group of a batch waits for
    the next one, so memory follows the largest group.
    """
    held: list[pa.RecordBatch] = []

    def ends(b: pa.RecordBatch) -> np.ndarray:
        k = b.column(key)
        if b.num_rows < 2:
            return np.zeros(0, np.int64)
        return np.flatnonzero(np.asarray(pa.compute.not_equal(k.slice(1), k.slice(0, b.num_rows - 1)))) + 1

    def join(parts):
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for b in batches:
        if not b.num_rows:
            continue
        if held and held[-1].column(key)[-1] != b.column(key)[0]:
            whole = join(held)
            yield whole, np.array([0, whole.num_rows])
            held = []
        cuts = ends(b)
        if not len(cuts):
            held.append(b)
            continue
        last = int(cuts[-1])
        whole = join([*held, b.slice(0, last)])
        before = whole.num_rows - last
        # the first cut also ends the group that was held
        yield whole, np.concatenate([[0], cuts + before])
        held = [b.slice(last)]
    if held:
        whole = join(held)
        yield whole, np.array([0, whole.num_rows])


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root: the smallest node of each connected component, from edges (a, b).

    Alternates large stars (a node's larger neighbours move to its smallest
    one) and small stars (its smaller neighbours do) until nothing changes;
    every round is a written table, and no component is gathered in one place.
    """
    e = keep(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    for _ in range(rounds):
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = keep(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            small.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components not stable after {rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root")))
