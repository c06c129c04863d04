"""Corpus preparation: toxicity, near-duplicate documents, repeated passages, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``:

1. toxicity -- documents that the factorization machine rejects go;
2. near_duplicates -- of the documents that n-gram Jaccard links connect, the
   one with the smallest id stays;
3. repeated_passages -- passages that repeat an earlier document's are cut out;
4. packing -- the remaining texts become sequences of at most 1024 tokens.

Edge cases are those of the operators: null and empty texts pass the first
three stages and become one token in the last; empty tables stay empty; further
columns of the documents are handed on up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mdquarry.llm import ngram_join, packing, substrings, toxicity
from mdquarry.llm.common import read
from mdquarry.llm.tokens import vocabulary_path
from mdquarry.session import scratch_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_harmless(docs, read(spark, sf_dir, "labels"), read(spark, sf_dir, "documents"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("packing", pack),
]

#: Neither the model of the first stage nor the tokenizer of the last can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written to the shared checkpoint folder; returns the last one's rows."""
    docs = read(spark, sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
