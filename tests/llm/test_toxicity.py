"""The factorization machine: held-out accuracy, interactions, and odd rows."""

import zlib

import numpy as np

from mdquarry.llm import toxicity as tox

from .conftest import ODD_TEXTS

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = tox.op6_toxicity(spark, DATA).collect()
    assert len(got) == 10000
    for r in got[:500]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7)
    rows = [r for r in got if r.held_out and r.doc_id in labels]
    toxic = [r.predicted for r in rows if labels[r.doc_id]]
    clean = [r.predicted for r in rows if not labels[r.doc_id]]
    # some labels of this table contradict their texts, on either side
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.01


def test_pairs_mean_more_than_their_parts():
    rng = np.random.default_rng(0)
    places, labels = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        filler = rng.choice(np.arange(10, 60), 5, replace=False)
        places.append(np.sort(np.concatenate([filler, [1] if a else [], [2] if b else []]).astype(np.int64)))
        labels.append(float(a != b))
    m = tox.fit(places, np.array(labels), l1=0.5)
    index = m.index()

    def score(p):
        at = index[np.array(p)]
        at = at[at >= 0]
        return m.scores(1, np.zeros(len(at), np.int64), at)[0]
    assert score([1, 12, 13]) > 0.7 and score([2, 12, 13]) > 0.7
    assert score([1, 2, 12, 13]) < 0.3 and score([12, 13]) < 0.3


def _data(spark, docs_of, data_dir, labels):
    rows = [*enumerate(ODD_TEXTS), (None, "moron"), (5, "twice")]
    rows += [(100 + i, f"plain words number {i} here") for i in range(60)]
    rows += [(200 + i, f"plain moron number {i} here") for i in range(60)]
    lab = [(i, 1, t) for i, t in labels]
    return rows, data_dir(documents=docs_of(rows),
                          labels=spark.createDataFrame(lab, "doc_id long, quality int, toxic int"))


def test_odd_rows(spark, docs_of, data_dir):
    labels = [(100 + i, 0) for i in range(60)] + [(200 + i, 1) for i in range(60)] + [(None, 1), (3, None), (0, 0)]
    rows, sf = _data(spark, docs_of, data_dir, labels)
    got = tox.op6_toxicity(spark, sf).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, (i for i, _ in rows)))
    assert all(0 <= r.score <= 1 for r in got)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = tox.keep_harmless(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert not [i for i in ids if i is not None and i >= 200] and len([i for i in ids if i and 100 <= i < 200]) == 60


def test_no_labels(spark, docs_of, data_dir):
    _, sf = _data(spark, docs_of, data_dir, [])
    assert {r.predicted for r in tox.op6_toxicity(spark, sf).collect()} == {0}


def test_empty_table(spark, docs_of, data_dir):
    sf = data_dir(documents=docs_of([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert tox.op6_toxicity(spark, sf).count() == 0
