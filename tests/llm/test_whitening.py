import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mdquarry.llm import whitening
from mdquarry.llm.common import read
from mdquarry.llm.queries import QUERIES

from .conftest import SF


def _expected(vectors):
    """Deviations, eigenvalues and components of the covariance of the integer vectors, by plain numpy."""
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    centred = x - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return deviation, e[::-1], v[:, ::-1], centred


def test_query_equals_a_dense_decomposition(spark):
    rows = QUERIES["op11_embedding_whitening"](spark, SF).collect()
    source = read(spark, SF, "embeddings").orderBy("vec_id").collect()
    deviation, e, v, centred = _expected([r["embedding"] for r in source])
    white = centred @ v[:, :8] / np.sqrt(e[:8])
    got = np.zeros((len(source), 8))
    at = {r["vec_id"]: i for i, r in enumerate(source)}
    assert len(rows) == 8 * len(source)
    for r in rows:
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(source) and r["deviation"] == deviation[at[r["vec_id"]]]
        assert math.isclose(r["explained"], e[r["component"] - 1] / e.sum(), rel_tol=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < 1e-8


def test_spectrum_does_not_depend_on_the_partitions(spark):
    x = whitening.to_integers(read(spark, SF, "embeddings").select(F.col("vec_id").alias("id"),
                                                                   F.col("embedding").alias("vector")))
    one, many = whitening.spectrum(x.coalesce(1)), whitening.spectrum(x.repartition(40))
    assert one.n == many.n and one.sums == many.sums
    assert np.allclose(one.d, many.d, rtol=1e-9)
    scatter = [(s.q * s.d) @ s.q.T for s in (one, many)]
    assert np.abs(scatter[0] - scatter[1]).max() < 1e-9 * one.d[-1]


@pytest.mark.parametrize("dim", [1, 2, 7, 40])
def test_rank_one_updates(dim):
    rng = np.random.default_rng(dim)
    d, q, a = np.zeros(dim), np.eye(dim), np.zeros((dim, dim))
    vectors = [rng.normal(size=dim) * 10.0 ** rng.integers(-3, 4) for _ in range(30)]
    vectors += [np.eye(dim)[0], np.eye(dim)[0] * 1e-12, np.zeros(dim), vectors[0], np.ones(dim), 1e-9 * np.ones(dim)]
    for v in vectors:
        d, q = whitening.rank_one(d, q, v)
        a += np.outer(v, v)
        assert (np.diff(d) >= 0).all()
        assert np.abs(q.T @ q - np.eye(dim)).max() < 1e-12
        assert np.abs((q * d) @ q.T - a).max() < 1e-12 * max(1e-300, np.abs(a).max())


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, vector array<double>, n long, component string")


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0]), (2, [1.5, -1.0]), (2, [1.5, -1.0]), (None, [2.0, 7.25]), (5, [1e5, 0.0])]
    bad = [(6, None), (7, []), (8, [1.0, None]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [1.0]), (12, [1e300, 0.0])]
    out = whitening.whiten(_vectors(spark, [(i, v, 0, "x") for i, v in good + bad])).collect()
    deviation, e, _, _ = _expected([v for _, v in good])
    assert sorted((r["id"] is None, r["id"] or 0, r["component"], r["deviation"]) for r in out) == sorted(
        (i is None, i or 0, c, w) for (i, _), w in zip(good, deviation.tolist()) for c in (1, 2))
    assert {r["n"] for r in out} == {5}
    assert all(math.isclose(r["explained"], e[r["component"] - 1] / e.sum(), rel_tol=1e-6) for r in out
               if r["component"] == 1)


def test_entries_far_beyond_the_others(spark):
    rows = [(1, [0.5, 1e12]), (2, [1.5, 0.0]), (3, [2.5, 1e12]), (4, [1.0, 1.0])]
    x = [[math.floor(c * 1024) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    exact = {i: sum((4 * c - t) ** 2 for c, t in zip(v, s)) for (i, _), v in zip(rows, x)}
    out = whitening.whiten(_vectors(spark, [(i, v, 0, "") for i, v in rows])).collect()
    assert {r["id"]: r["deviation"] for r in out} == {i: d if d < 2**63 else None for i, d in exact.items()}
    assert {r["component"] for r in out} == {1} and all(abs(abs(r["whitened"]) - 1) < 1e-9 for r in out)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_without_variance_there_are_no_rows(spark, rows):
    out = whitening.whiten(_vectors(spark, [(i, v, 0, "") for i, v in rows]))
    assert out.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.collect() == []


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 3.0], 0, "") for i in range(20)]
    out = whitening.whiten(_vectors(spark, rows)).collect()
    assert {r["component"] for r in out} == {1} and len(out) == 20
    assert all(abs(r["explained"] - 1) < 1e-12 and r["identity_error"] < 1e-9 for r in out)
