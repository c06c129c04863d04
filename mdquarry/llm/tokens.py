"""Token encoding, decoding and counting with a public byte-level BPE vocabulary.

* :func:`encode` / :func:`decode` -- speculate and verify (see :mod:`.bpe`);
* :func:`count` -- rank-synchronous merging of ragged arrays.

Each is one scan of the texts without a shuffle; a task holds one Arrow batch
and a bounded table of pre-tokens. Null and empty texts have no tokens; equal
rows give equal results, one per row; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import bpe
from .common import binary, id_and_text, read, unpack

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _little_endian(ids: np.ndarray) -> np.ndarray:
    return ids.astype("<u4")


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids: the ids as little-endian unsigned 32-bit integers, one after another."""
    def run(batches):
        enc = bpe.Encoder(bpe.Vocabulary.load(path), bpe.speculate)
        for b in batches:
            ids_of_key = b.column(0)
            for first, ids, off in enc.encode(b.column(1).to_pylist()):
                n = len(off) - 1
                yield pa.RecordBatch.from_arrays(
                    [ids_of_key.slice(first, n), pa.array(np.diff(off)), binary(_little_endian(ids), off)],
                    ["key", "n_tokens", "ids"])

    d = id_and_text(docs, key, text)
    t = d.schema[key].dataType.simpleString()
    return d.mapInArrow(run, f"key {t}, n_tokens long, ids binary").withColumnRenamed("key", key)


def decode(tokens: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for; bytes that are no UTF-8 become U+FFFD. Null ids give an empty text."""
    names = [c for c in tokens.columns if c != to]
    schema = StructType([*(f for f in tokens.schema.fields if f.name != to), StructField(to, StringType())])

    def run(batches):
        v = bpe.Vocabulary.load(path)
        for b in batches:
            column = b.column(names.index(ids))
            step = 1024
            for first in range(0, b.num_rows, step):
                flat, off = unpack(column.slice(first, step), "<u4")
                flat = flat.astype(np.int64)
                data = bpe.decode(v, flat)
                at = np.zeros(len(flat) + 1, np.int64)
                np.cumsum(v.length[flat], out=at[1:])
                ends = at[off].tolist()
                out = [data[a:z].decode("utf-8", "replace") for a, z in zip(ends, ends[1:])]
                part = b.slice(first, step)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*names, to])

    return tokens.select(*names).mapInArrow(run, schema)


def count(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes (UTF-8), n_tokens of every text."""
    def run(batches):
        enc = bpe.Encoder(bpe.Vocabulary.load(path), bpe.merge)
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(enc.counts(texts))], ["key", "n_bytes", "n_tokens"])

    d = id_and_text(docs, key, text)
    t = d.schema[key].dataType.simpleString()
    d = d.select(key, "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return d.mapInArrow(run, f"key {t}, n_bytes long, n_tokens long").withColumnRenamed("key", key)


def op4_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path()
    both = decode(encode(read(spark, sf_dir, "documents"), path), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = count(read(spark, sf_dir, "documents"), vocabulary_path())
    return n.withColumn("over_limit", F.col("n_tokens") > 512)
