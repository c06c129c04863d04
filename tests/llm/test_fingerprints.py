"""Fingerprints against a plain Python model of the same hashes."""

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mdquarry.llm import fingerprints as fp

from .conftest import ODD_TEXTS, SMALL

_ASCII_WHITE = " \t\n\x0b\f\r"


def _words(text):
    for c in _ASCII_WHITE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def _hash(words):
    h = 42
    for w in words:
        h = xxhash.xxh64(w.encode(), seed=h).intdigest()
    return h >> 16


def _sketch(text, k=fp.K):
    w = _words(text or "")
    return sorted({_hash(w[i:i + 5]) for i in range(max(1, len(w) - 4))})[:k] if w else []


def _near(a, b, k=fp.K):
    u = sorted({*a, *b})[:k]
    return len(set(u) & set(a) & set(b)) / len(u) if u else 1.0


def _model(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 3
        edited = text[:len(text) - m] + after[:m]
        s, e = _sketch(text), _sketch(edited)
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{h:012x}" for h in s),
                    "".join(f"{h:012x}" for h in e), _near(s, e), _near(s, _sketch(after))))
    return out


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                        "near_edited", "near_next").collect()]


@pytest.mark.parametrize("size", [2048, 3, 1])
def test_odd_texts_in_ranges(spark, docs_of, data_dir, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE", size)
    rows = [(7 * i * i - 40, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id at all")]
    got = _rows(fp.op3_fingerprints(spark, data_dir(documents=docs_of(rows))))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(_model(rows), key=key)


def test_real_documents_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE", 20)
    monkeypatch.setattr(fp, "_STEP", 4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(_rows(fp.op3_fingerprints(spark, SMALL))) == sorted(_model(rows))


def test_one_row_repeated_rows_and_none(spark, docs_of, tmp_path):
    for i, rows in enumerate(([(5, "one two three four five six")], [(5, "same words")] * 3, [(None, "a b"), (None, "a b")])):
        docs_of(rows).write.parquet(f"{tmp_path}/{i}/documents.parquet")
        assert sorted(map(str, _rows(fp.op3_fingerprints(spark, f"{tmp_path}/{i}")))) == sorted(map(str, _model(rows)))
    docs_of([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fp.op3_fingerprints(spark, f"{tmp_path}/none").count() == 0


def test_estimates_and_merging(spark):
    rng = np.random.default_rng(0)
    a = [f"w{i}" for i in rng.permutation(3000)]
    cut = 2000
    df = spark.createDataFrame([(1, " ".join(a[:cut])), (1, " ".join(a[cut - 4:])), (2, None), (2, "")],
                               "key int, text string").withColumn("sketch", fp.sketch(F.col("text")))
    merged = {r.key: r.sketch for r in fp.merge_parts(df, ["key"]).collect()}
    assert merged == {1: _sketch(" ".join(a)), 2: []}
    row = spark.createDataFrame([(" ".join(a), " ".join(a[:cut]))], "a string, b string").select(
        fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b")).select(
        fp.resemblance(F.col("a"), F.col("b")).alias("r"), fp.containment(F.col("b"), F.col("a")).alias("c"),
        fp.distinct_shingles(F.col("a")).alias("n")).first()
    assert abs(row.r - 1996 / 2996) < 0.15 and row.c == 1.0 and abs(row.n / 2996 - 1) < 0.3
