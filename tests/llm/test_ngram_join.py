"""The n-gram join against brute force over all pairs."""

import numpy as np
import pytest

from mdquarry.llm import ngram_join as nj

from .conftest import ODD_TEXTS, SF


def _brute(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    index = {}
    for i, s in enumerate(sets):
        for g in s:
            index.setdefault(g, []).append(i)
    for i in range(n):
        for j in {j for g in sets[i] for j in index[g] if j > i}:
            common = len(sets[i] & sets[j])
            if common >= threshold * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        same = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, min(same) if same else None, links[i]))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=str)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _got(nj.op2_ngram_jaccard_join(spark, SF)) == _brute(rows)


def _variants(rng, base, n, edits):
    for _ in range(n):
        w = list(base)
        for p in rng.integers(0, len(w), edits):
            w[p] = f"x{rng.integers(1000)}"
        yield " ".join(w)


@pytest.fixture
def planted():
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(1, 120)))) for _ in range(40)]
    for size, n, edits in ((300, 60, 4), (150, 25, 3), (80, 12, 1), (200, 30, 8)):
        texts += _variants(rng, [f"w{x}" for x in rng.integers(0, 3000, size)], n, edits)
    texts += [texts[50]] * 20 + ODD_TEXTS
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]


def test_runs_for_the_target_recall():
    assert [nj.runs_for(d) for d in (1, 2, 3)] == [12, 19, 25]
    assert nj.runs_for(1, 0.9) == 3


def test_recall_where_buckets_are_split(spark, docs_of, monkeypatch):
    """Pairs near the threshold that share a very frequent passage: their buckets are split up to three times."""
    monkeypatch.setattr(nj, "SMALL", 8)
    rng = np.random.default_rng(4)
    common = [f"c{x}" for x in range(60)]
    rows = []
    for i in range(120):
        own = [f"w{x}" for x in rng.integers(0, 10**6, 60)]
        rows.append((2 * i, " ".join(common + own)))
        own[int(rng.integers(0, 60))] = "edit"
        own[int(rng.integers(0, 60))] = "edit"
        rows.append((2 * i + 1, " ".join(common + own)))
    want, got = _brute(rows), _got(nj.join(docs_of(rows)))
    linked = [w for w in want if w[2]]
    assert len(linked) > 150 and sum(w in got for w in linked) >= 0.99 * len(linked)
    assert all(g[2] <= w[2] for g, w in zip(got, want))


def test_edges_follow_the_nodes_of_a_large_group(spark, docs_of, monkeypatch):
    """One group of near copies over many blocks: every node is named about once in each run, not once a block."""
    monkeypatch.setattr(nj, "SMALL", 8)
    monkeypatch.setattr(nj, "BLOCK", 8)
    made = []
    plain = nj.keep
    monkeypatch.setattr(nj, "keep", lambda df, name: made.append((name, plain(df, name))) or made[-1][1])
    base = [f"w{x}" for x in range(300)]
    rng = np.random.default_rng(5)
    rows = list(enumerate(_variants(rng, base, 200, 1)))
    assert _got(nj.join(docs_of(rows))) == _brute(rows)
    links = [df.count() for name, df in made if name == "links"]
    assert len(links) == 2 and links[0] <= 200 and links[1] <= 200 + 25 * 24


def test_scratch_columns_with_the_names_of_the_table(spark, docs_of, planted):
    rows = planted[:60]
    d = docs_of(rows)
    plain = sorted(r.doc_id for r in nj.keep_one(d).collect())
    from pyspark.sql import functions as F
    clash = d.select("*", *(F.lit(c).alias(c) for c in ("_node", "_first", "_best", "node", "n", "root", "tokens")))
    got = nj.keep_one(clash)
    assert got.columns == clash.columns and sorted(r.doc_id for r in got.collect()) == plain
    assert {r._node for r in got.collect()} == {"_node"}


@pytest.mark.parametrize("small,block", [(256, 256), (4, 8)])
def test_planted_groups(spark, docs_of, planted, monkeypatch, small, block):
    monkeypatch.setattr(nj, "SMALL", small)
    monkeypatch.setattr(nj, "BLOCK", block)
    rows = [*planted, (None, planted[50][1]), (None, None), (3, planted[60][1]), (3, planted[60][1])]
    assert _got(nj.join(docs_of(rows))) == _brute(rows)


def test_one_of_each_class_stays(spark, docs_of, planted):
    rows = [*planted, planted[50], planted[50]]
    classes = {i: c for i, c, _ in _brute(rows)}
    wordless = [i for i, t in rows if not (t or "").split()]
    got = sorted(r.doc_id for r in nj.keep_one(docs_of(rows)).collect())
    assert got == sorted({*classes.values()} | set(wordless))


def test_empty_table(spark, docs_of):
    assert nj.join(docs_of([])).count() == 0 and nj.keep_one(docs_of([])).count() == 0
