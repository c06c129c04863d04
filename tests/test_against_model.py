"""Spark operators vs the brute-force Python model, on the whole sf0.001 derived corpus."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mdquarry.functions.stopwords import english_stop_words

from . import pymodel as pm


@pytest.fixture(scope="module")
def model(small_corpus):
    raw = {r["doc_id"]: (r["document_name"], r["raw"]) for r in small_corpus.docs_md.collect()}
    docs = {}
    for d, (name, text) in raw.items():
        meta, content, _ = pm.frontmatter(text)
        docs[d] = (name, meta, content, pm.sections(content))
    return docs


def test_frontmatter_and_sections(small_corpus, model):
    got = {r["doc_id"]: ([(e["key"], e["value"]) for e in r["metadata"]], r["content"])
           for r in small_corpus.docs.collect()}
    assert {d: (m, c) for d, (_, m, c, _) in model.items()} == got
    secs = defaultdict(list)
    for r in small_corpus.sections.orderBy("doc_id", "section_idx").collect():
        secs[r["doc_id"]].append((r["section"], r["title"], r["body"]))
    for d, (_, _, _, ss) in model.items():
        assert secs.get(d, []) == [(s, *pm.title_body(s)) for s in ss], d
    assert sum(len(v) for v in secs.values()) == 425  # FIXTURES, changes of round 3: seven blocks that do not parse stay as sections


def test_facts(small_corpus, model):
    got = defaultdict(list)
    for r in small_corpus.facts.orderBy("doc_id", "section_idx", "fact_number").collect():
        got[(r["doc_id"], r["section_idx"])].append(r["fact"])
    for d, (_, _, _, ss) in model.items():
        for i, s in enumerate(ss, 1):
            assert got.get((d, i), []) == pm.facts(pm.title_body(s)[1]), (d, i)


def test_section_neighbours(small_corpus, model):
    stop = set(english_stop_words())
    got = defaultdict(list)
    for r in small_corpus.section_neighbours.orderBy("doc_id", "section_idx", "rank").collect():
        got[(r["doc_id"], r["section_idx"])].append((r["nbr_idx"], round(r["sim"], 6)))
    n_rows = 0
    for d, (_, _, _, ss) in model.items():
        res = pm.knn(ss, ss, list(range(1, len(ss) + 1)), stop)
        for i, nbrs in enumerate(res, 1):
            assert got.get((d, i), []) == [(j, round(s, 6)) for j, s in nbrs], (d, i)
            n_rows += len(nbrs)
    assert n_rows == sum(len(v) for v in got.values())


def test_fact_neighbours(small_corpus, model):
    stop = set(english_stop_words())
    facts = defaultdict(list)
    for r in small_corpus.facts.orderBy("doc_id", "section_idx", "fact_number").collect():
        facts[r["doc_id"]].append((r["section_idx"], r["fact_number"], r["fact"]))
    got = defaultdict(list)
    for r in small_corpus.fact_neighbours.orderBy("doc_id", "section_idx", "fact_number", "rank").collect():
        got[(r["doc_id"], r["section_idx"], r["fact_number"])].append(r["nbr_idx"])
    for d, (_, _, _, ss) in model.items():
        fs = facts.get(d, [])
        res = pm.knn(ss, [f for _, _, f in fs], [s for s, _, _ in fs], stop)
        for (s, n, _), nbrs in zip(fs, res):
            assert got.get((d, s, n), []) == [j for j, _ in nbrs], (d, s, n)


def test_linked_list_option(spark):
    from mdquarry.operators import facts as fx
    body = "- top one item\n  - nested item here\n- second top item"
    d = spark.createDataFrame([(body,)], "body string")
    got = d.select(fx.candidate_facts(F.col("body"), link_parents=True).alias("f")).first()["f"]
    assert got == pm.facts(body, link_parents=True)


def test_partition_count_independence(spark, small_corpus):
    """Same sections and facts whatever the partitioning of the input."""
    from mdquarry.plans.corpus import Corpus
    c2 = Corpus(small_corpus.docs_md.repartition(3), persist="none")
    a = small_corpus.facts.select("doc_id", "section_idx", "fact_number", "fact")
    b = c2.facts.select("doc_id", "section_idx", "fact_number", "fact")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_multi_block_path_matches_model(spark, small_corpus, model):
    """Force tiny blocks so every document spans several (query, corpus) block pairs."""
    from mdquarry.plans.corpus import Corpus
    c = Corpus(small_corpus.docs_md, block_size=2, persist="none")
    stop = set(english_stop_words())
    got = defaultdict(list)
    for r in c.section_neighbours.orderBy("doc_id", "section_idx", "rank").collect():
        got[(r["doc_id"], r["section_idx"])].append(r["nbr_idx"])
    for d, (_, _, _, ss) in model.items():
        for i, nbrs in enumerate(pm.knn(ss, ss, list(range(1, len(ss) + 1)), stop), 1):
            assert got.get((d, i), []) == [j for j, _ in nbrs], (d, i)


def test_hot_document_default_blocks(spark):
    """One document of 1,500 sections (three blocks at the default size) vs brute force."""
    import duckdb

    from mdquarry.plans.corpus import Corpus
    lines = [r[0] for r in duckdb.sql(
        "SELECT unnest(string_split(text, chr(10))) AS l FROM read_parquet('/root/testdata/sf0.001/documents.parquet') "
        "ORDER BY doc_id LIMIT 1500").fetchall()]
    raw = "\n".join(f"# part {i}\n{ln}" for i, ln in enumerate(lines))
    docs = spark.createDataFrame([(7, "hot", raw)], "doc_id long, document_name string, raw string")
    c = Corpus(docs, persist="none")
    got = defaultdict(list)
    for r in c.section_neighbours.collect():
        got[r["section_idx"]].append((r["rank"], r["nbr_idx"]))
    _, content, _ = pm.frontmatter(raw)
    ss = pm.sections(content)
    assert len(ss) == 1500
    want = pm.knn(ss, ss, list(range(1, len(ss) + 1)), set(english_stop_words()))
    for i, nbrs in enumerate(want, 1):
        assert [j for _, j in sorted(got.get(i, []))] == [j for j, _ in nbrs], i


def _long_document():
    import duckdb
    lines = [r[0] for r in duckdb.sql(
        "SELECT unnest(string_split(text, chr(10))) AS l FROM read_parquet('/root/testdata/sf0.001/documents.parquet') "
        "ORDER BY doc_id LIMIT 600").fetchall()]
    return "\n".join(f"# part {i}\n" + "\n".join(lines[20 * i:20 * i + 20]) for i in range(30))


def test_reference_bounds_cut_and_the_default_does_not(spark):
    from mdquarry.plans.corpus import REFERENCE_BOUNDS, Bounds, Corpus
    raw = _long_document()
    ss = pm.sections(raw)
    assert max(map(len, ss)) > 2000 and len({t for s in ss for t in pm.tokens(s)}) > 500
    docs = spark.createDataFrame([(7, "long", raw)], "doc_id long, document_name string, raw string")
    seen = []
    for bounds in (Bounds(), REFERENCE_BOUNDS):
        c = Corpus(docs, bounds=bounds, persist="none")
        got = defaultdict(list)
        for r in c.section_neighbours.orderBy("section_idx", "rank").collect():
            got[r["section_idx"]].append((r["nbr_idx"], round(r["sim"], 6)))
        want = pm.knn(ss, ss, list(range(1, len(ss) + 1)), set(english_stop_words()),
                      max_chars=bounds.max_chars, max_terms=bounds.max_terms)
        assert [got.get(i, []) for i in range(1, len(ss) + 1)] == [[(j, round(s, 6)) for j, s in n] for n in want]
        seen.append(got)
    assert seen[0] != seen[1]


def test_a_section_with_very_many_facts(spark, monkeypatch):
    """20,000 facts of one section go through a block in slices; the slice size doesn't show."""
    from mdquarry.operators import neighbours as nb
    from mdquarry.plans.corpus import Corpus
    raw = "# a\nred green blue words\n# b\nblue yellow words\n# c\n" + "\n".join(
        f"- item {i} is {'red' if i % 2 else 'yellow'} and long" for i in range(20000))
    docs = spark.createDataFrame([(7, "facts", raw)], "doc_id long, document_name string, raw string")
    seen = []
    for rows, postings in ((1024, 1 << 22), (7, 50)):
        monkeypatch.setattr(nb, "SLICE_ROWS", rows)
        monkeypatch.setattr(nb, "SLICE_POSTINGS", postings)
        c = Corpus(docs, persist="none")
        seen.append(sorted(tuple(r) for r in c.fact_neighbours.where("section_idx = 3 AND rank = 1")
                           .select("fact_number", "nbr_idx").collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 20000
    assert all(n == (1 if f % 2 else 2) for f, n in seen[0])


def _themes(n, size):
    """Sections of ``n`` themes one after another, each with its own words, and one word that all share."""
    rng = np.random.default_rng(3)
    out = []
    for t in range(n):
        for i in range(size):
            words = " ".join(f"t{t}w{x}" for x in rng.integers(0, 40, 12))
            out.append(f"# s{t} {i}\ncommon {words}")
    return out


def test_blocks_that_cannot_reach_the_threshold_are_skipped(spark, monkeypatch):
    from mdquarry.operators import neighbours as nb
    from mdquarry.plans.corpus import Corpus
    ss = _themes(10, 50)
    docs = spark.createDataFrame([(7, "themes", "\n".join(ss)), (8, "one", "# a\nx y\n# b\nx z")],
                                 "doc_id long, document_name string, raw string")
    sent, plain = [], nb._scored

    def counted(corpus, queries):
        sent.append(queries.count())
        return plain(corpus, queries)

    monkeypatch.setattr(nb, "_scored", counted)
    c = Corpus(docs, block_size=25, persist="none")
    got = defaultdict(list)
    for r in c.section_neighbours.where("doc_id = 7").collect():
        got[r["section_idx"]].append((r["rank"], r["nbr_idx"], round(r["sim"], 6)))
    sections = pm.sections("\n".join(ss))
    want = pm.knn(sections, sections, list(range(1, len(ss) + 1)), set(english_stop_words()))
    assert [[(j, s) for _, j, s in sorted(got[i])] for i in range(1, len(ss) + 1)] == [
        [(j, round(s, 6)) for j, s in n] for n in want]
    one, bounds, home, rest = sent
    assert (one, bounds, home) == (2, 500, 500)
    assert rest < 500 * 19 / 4  # of 19 other blocks each, most share the common word only


def test_queries_without_any_neighbour_get_the_first_sections(spark):
    from mdquarry.plans.corpus import Corpus
    ss = [f"# h{i}\nown{i} word{i}" for i in range(12)]
    docs = spark.createDataFrame([(1, "apart", "\n".join(ss))], "doc_id long, document_name string, raw string")
    for size in (2, 5, 512):
        c = Corpus(docs, block_size=size, persist="none")
        got = sorted((r["section_idx"], r["rank"], r["nbr_idx"]) for r in c.section_neighbours.collect())
        assert got == sorted(
            (i, k, j) for i in range(1, 13)
            for k, j in enumerate([x for x in sorted(range(1, 13), key=lambda x: (x != i, x))[:3] if x != i], 1))
