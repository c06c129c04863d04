"""The pipeline on planted rows: what goes, what stays, and what every stage returns."""

import numpy as np
import pytest

import corpus_pipeline as cp


def _prose(rng, n):
    return [f"w{x}" for x in rng.integers(0, 4000, n)]


@pytest.fixture
def planted(spark, docs_of, data_dir):
    rng = np.random.default_rng(8)
    clean = {i: " ".join(_prose(rng, int(rng.integers(5, 300)))) for i in range(40)}
    passage = " ".join(_prose(rng, 70))
    rows = dict(clean)
    rows[100] = clean[3]
    near = clean[max(clean, key=lambda i: len(clean[i]))].split()
    rows[101] = " ".join(["changed", *near[1:]])
    rows[102] = " ".join(_prose(rng, 80) + [passage] + _prose(rng, 80))
    rows[103] = " ".join(_prose(rng, 90) + [passage] + _prose(rng, 60))
    rows |= {200 + i: f"{' '.join(_prose(rng, 20))} moron {' '.join(_prose(rng, 20))}" for i in range(60)}
    rows |= {400: None, 401: "", 402: "tiny"}
    labels = [(i, 1, int(200 <= i < 300)) for i in rows if i < 400]
    sf = data_dir(documents=docs_of(list(rows.items())).withColumn("note", F_lit("kept")),
                  labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return sf, rows, passage


def F_lit(x):
    from pyspark.sql import functions as F
    return F.lit(x)


def test_stages(spark, planted, tmp_path):
    sf, rows, passage = planted
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for n, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/out/{n}")
        docs = spark.read.parquet(f"{tmp_path}/out/{n}")
        seen.append(docs)
        if n < 3:
            assert docs.columns == columns and {r.note for r in docs.collect()} == {"kept"}
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert ids[0] == {i for i in rows if not 200 <= i < 300}
    assert ids[0] - ids[1] == {100, 101}
    assert ids[2] == ids[1]
    texts = {r.doc_id: r.text for r in seen[2].collect()}
    assert passage in texts[102] and passage not in texts[103]
    assert len(texts[103].split()) == 150
    assert all(texts[i] == rows[i] for i in ids[2] - {103})
    assert ids[3] == ids[2] and seen[3].where("sequence_id is null").count() == 0
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "packing"]


def test_run_equals_its_stages(spark, planted):
    sf, rows, _ = planted
    got = cp.run(spark, sf)
    assert {r.doc_id for r in got.collect()} == {i for i in rows if not 200 <= i < 300} - {100, 101}


def test_empty_tables(spark, docs_of, data_dir):
    sf = data_dir(documents=docs_of([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert cp.run(spark, sf).count() == 0
