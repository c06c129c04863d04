"""Exact top-k against brute force, with ties, zeros, odd vectors and small blocks."""

import duckdb
import numpy as np
import pytest

from mdquarry.llm import topk

from .conftest import SF


def _brute(rows, k=10):
    ok = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in ok if i % 100 == 0}):
        q = min(tuple(v) for j, v in ok if j == i)
        found = sorted((-int(np.dot(q, v)), j) for j, v in ok if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return out


def _got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("bucket,block", [(4096, 512), (16, 3)])
def test_brute_force(spark, data_dir, monkeypatch, bucket, block):
    monkeypatch.setattr(topk, "BUCKET", bucket)
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(bucket)
    rows = [(i, (rng.normal(size=8) * 2.0 ** rng.integers(-4, 4)).tolist()) for i in range(450)]
    rows += [(500, [0.0] * 8), (600, rows[0][1]), (601, rows[0][1]), (602, rows[0][1]), (700, [1.0, 2.0]),
             (701, [2.0, 1.0]), (800, None), (801, []), (802, [None] * 8), (803, [float("nan")] * 8),
             (900, [float("inf")] * 8), (None, rows[0][1]), (45, rows[45][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert _got(topk.op9_exact_top_k(spark, data_dir(embeddings=df))) == _brute(rows)


def test_pruning_drops_candidates_but_no_result():
    rng = np.random.default_rng(0)
    m = np.concatenate([rng.normal(size=(300, 8)), np.eye(8) * 3])
    norms = np.sqrt((m * m).sum(1))
    order = np.argsort(-norms, kind="stable")
    m, norms = m[order], norms[order]
    unit, dropped = m / norms[:, None], 0
    for q in m[::7]:
        scores = m @ q
        bound = np.sort(scores)[-5]
        left = topk._prune(q, float(np.sqrt(q @ q)), float(bound), unit, norms)
        assert set(np.flatnonzero(scores >= bound)) <= set(left)
        dropped += len(m) - len(left)
    assert dropped > 0


def test_empty_table(spark, data_dir):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.op9_exact_top_k(spark, data_dir(embeddings=df)).count() == 0


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({topk.OP9_SQL})").fetchall())
    assert _got(topk.op9_exact_top_k(spark, SF)) == want


def test_large_components_and_repeated_query_ids(spark, data_dir):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=4) * 2.0 ** rng.integers(0, 40)).tolist()) for i in range(320)]
    # sums that leave 64 bits, also ones whose parts cancel, and a query id with two vectors
    rows += [(400, [2.0**40, -2.0**40, 1.0, 0.0]), (401, [2.0**40, 2.0**40, 3.0, 0.0]), (402, [-2.0**40, 2.0**40, 0.0, 0.0]),
             (500, [1.0, 0.0, 0.0, 0.0]), (500, [0.0, 1.0, 0.0, 0.0]), (501, [1e300, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    lo, hi = -2**63, 2**63 - 1
    whole = [(i, [min(max(int(np.floor(1024 * x)), lo), hi) for x in v]) for i, v in rows]
    want = []
    for i in (0, 100, 200, 300, 400, 500):
        q = min(v for j, v in whole if j == i)
        found = sorted((-min(max(sum(a * b for a, b in zip(q, v)), lo), hi), j) for j, v in whole if j != i)
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:10])]
    assert _got(topk.op9_exact_top_k(spark, data_dir(embeddings=df))) == want


def test_no_copies_of_queries_or_buckets_are_broadcast(spark, data_dir, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "BLOCK", 3)
    made, met = [], topk._meet
    monkeypatch.setattr(topk, "_meet", lambda *a: made.append(met(*a)) or made[-1])
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist(), 0) for i in range(1300)],
                               "vec_id long, embedding array<float>, label int")
    found = topk.op9_exact_top_k(spark, data_dir(embeddings=df))
    for d in (found, made[1]):
        # each block of queries is copied for each bucket: these copies are shuffled, no join collects them in the driver
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "Generate" in plan
    assert found.count() == 13 * 10
