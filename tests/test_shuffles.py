"""How often the response stages deal out their rows, and which of their tables are written."""

import re

from pyspark.sql import functions as F

from mdquarry.operators import requests as rq
from mdquarry.operators import responses as rs

REQUESTS = ("request_id string, doc_id long, document_name string, section_idx int, fact_number int, "
            "question_type string, difficulty string, is_summary boolean, unit_size int")
OK = '{"question": "q", "answer": "a"}'


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_responses_are_dealt_out_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        req = spark.createDataFrame([("r", 1, "d", 1, None, "INFERENCE", "medium", None, 1)], REQUESTS)
        resp = spark.createDataFrame([("r", 1, "no"), ("r", 1, OK), ("r", 2, OK), ("r", 2, None)], rs.RESPONSE_SCHEMA)
        grid = rs.answered(req, rs.parse(resp))
        assert len(re.findall("Exchange hashpartitioning", _plan(grid))) == 2  # responses and requests, each once
        found = {(r["attempt"], r["status"]) for r in grid.collect()}
        assert found == {(1, "no_json"), (2, "ok")}  # the smallest text of an attempt, a text before none
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_outcomes_are_found_by_hashing_and_looked_up_only_if_answers_miss(spark):
    def unit(texts):
        n = max(i for i, _ in texts) + 1
        req = spark.createDataFrame([(f"r{i}", 1, "d", 1, i, "FACT_BASED", "easy", None, n) for i in range(n)], REQUESTS)
        resp = spark.createDataFrame([(f"r{i}", 1, t) for i, t in texts if t != "missing"], rs.RESPONSE_SCHEMA)
        kept = []

        def keep(df, name="stage"):
            kept.append(name)
            return df

        out = rs.unit_outcomes(rs.answered(req, rs.parse(resp)), req, keep)
        assert "SortAggregate" not in _plan(rs.unit_outcomes(req.selectExpr("*", "1 attempt", "'ok' status"), req, keep))
        r = out.first()
        return kept[:2] if "outcomes" in kept[:2] else kept[:1], r["ok"], r["fact_number"], r["error"]

    assert unit([(0, OK), (1, OK)]) == (["units"], True, None, None)
    assert unit([(0, OK), (1, "no"), (2, None)]) == (["units"], False, 1, "no_json")
    assert unit([(0, OK), (1, "{no}"), (2, "no")]) == (["units"], False, 1, "bad_json")
    assert unit([(0, OK), (1, "missing"), (2, "no")]) == (["units", "outcomes"], False, 1, "no_response")
    assert unit([(0, "no"), (1, "missing"), (2, OK)]) == (["units", "outcomes"], False, 0, "no_json")


def test_grid_of_sections_needs_no_facts(spark):
    s = spark.createDataFrame([(1, "d", 1, 2, 2, "x"), (1, "d", 2, None, 0, "y")],
                              "doc_id long, document_name string, section_idx int, partner_idx int, n_facts int, own string")
    g = rq.grid(s, extra=("own",)).collect()
    assert sorted(r["fact_number"] for r in g if r["question_type"] == "FACT_BASED") == [0, 1]
    assert {r["unit_size"] for r in g if r["question_type"] == "FACT_BASED"} == {2}
    assert sum(r["section_idx"] == 1 for r in g) == 14 + 2 and sum(r["section_idx"] == 2 for r in g) == 12
    assert {(r["section_idx"], r["own"]) for r in g} == {(1, "x"), (2, "y")}
    assert len({r["request_id"] for r in g}) == len(g)


def test_only_tables_read_again_are_written(spark, tmp_path):
    from mdquarry.plans.queries import DerivedCorpus
    from mdquarry.sources.fixtures import md_documents

    docs = spark.createDataFrame([(5, "One line here.\nAnother line. And more.", "en", "src")],
                                 "doc_id long, text string, lang string, source string")
    c = DerivedCorpus(md_documents(docs))
    assert c.audit_records.count() > 0
    written, keep = [], c._keep
    c._memo.clear()
    c._keep = lambda df, name="stage": written.append(name) or keep(df, name)
    assert c.audit_records.count() > 0
    assert written == ["docs", "manifest", "section_facts", "answered", "units", "firsts", "qa"]
    assert set(c._memo["section_facts"].columns) >= {"title", "body", "n_facts"}
    c.unpersist()


def _settled(spark, unit_requests, texts):
    """Both ways to the same chain: by unit and joins, and by rows that are settled where responses meet requests."""
    req = spark.createDataFrame(unit_requests, REQUESTS)
    resp = spark.createDataFrame(texts, rs.RESPONSE_SCHEMA)
    answers = rs.answered(req, rs.parse(resp))
    out = rs.unit_outcomes(answers, req)
    firsts = rs.first_success(out)
    rows = rs.settled(req, resp)
    now = rs.settled_outcomes(rows, req, rs.parse(resp))
    pairs = rs.settled_pairs(rows)
    return rows, [
        (out, now.select(*out.columns)), (firsts, rs.settled_firsts(now)),
        (rs.failures(out, firsts), rs.settled_failures(now)),
        (rs.still_failing(out, firsts), rs.settled_still_failing(now)),
        (rs.qa_rows(answers, firsts).select(*pairs.columns), pairs)]


def test_settled_rows_tell_what_joins_by_unit_tell(spark):
    req = [("s1", 1, "d", 1, None, "SUMMARY", "easy", True, 1), ("s2", 1, "d", 2, None, "SUMMARY", "easy", True, 1),
           ("n1", None, "d", 1, None, "SUMMARY", "easy", True, 1), ("t1", 3, "d", 1, None, "SUMMARY", "easy", True, 1),
           ("t1", 3, "e", 1, None, "SUMMARY", "easy", True, 1),
           *((f"f{i}", 1, "d", 1, i, "FACT_BASED", "easy", None, 3) for i in range(3)),
           *((f"g{i}", 2, "d", 1, i, "FACT_BASED", "easy", None, 2) for i in range(2))]
    texts = [("s1", 1, "no"), ("s1", 2, OK), ("s1", 3, OK), ("s1", 2, OK), ("s2", 1, None), ("s2", 2, "{no}"),
             ("n1", 1, OK), ("t1", 1, OK), ("f0", 1, OK), ("f1", 1, OK), ("f2", 1, "no"), ("f0", 2, OK), ("f2", 2, OK),
             ("f0", 3, OK), ("f1", 3, OK), ("f2", 3, OK), ("g0", 1, OK), ("g1", 1, None), ("g0", 2, "no"), ("x", 1, OK)]
    rows, both = _settled(spark, req, texts)
    for want, got in both:
        assert sorted(map(repr, want.collect())) == sorted(map(repr, got.collect()))
    assert rows.where("is_pair").count() == 1 + 1 + 3  # with the unit without a document, which is no pair of a join


def test_answers_of_whole_sections_are_not_dealt_by_unit(spark):
    req = spark.createDataFrame([("s1", 1, "d", 1, None, "SUMMARY", "easy", True, 1)], REQUESTS)
    resp = spark.createDataFrame([("s1", 1, OK)], rs.RESPONSE_SCHEMA)
    rows = rs.settled(req, resp)
    for d in (rs.settled_pairs(rows), rs.settled_failures(rs.settled_outcomes(rows, req, rs.parse(resp), lambda d, n: d))):
        p = _plan(d)
        dealt = [x for x in p.splitlines() if "hashpartitioning(doc_id" in x]
        assert len(dealt) == 1 and "SortMergeJoin [doc_id" not in p  # the answers of facts, once


def test_settled_answers_keep_their_number_of_tasks_and_pack_ids(spark):
    ids = ["0123456789abcdef" * 2, "0" * 32, "0123456789ABCDEF" * 2, "0123456789abcdef" * 2 + "\n", "", "x" * 16, "é"]
    d = spark.createDataFrame([(x,) for x in ids], "i string").withColumn("p", rs.packed(F.col("i")))
    assert [r.i for r in d.select(rs.unpacked(F.col("p")).alias("i")).collect()] == ids
    assert [len(r.p) == 16 for r in d.collect()] == [True, True] + [False] * 5
    req = spark.createDataFrame([(x, 1, "d", 1, i, "T", "easy", None, len(ids)) for i, x in enumerate(ids)], REQUESTS)
    resp = spark.createDataFrame([(x, 1, OK) for x in ids], rs.RESPONSE_SCHEMA)
    rows = rs.settled(req, resp)
    n = rs.DEAL * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = re.findall(rf", {n}\), REPARTITION_BY_NUM", _plan(rows))
    assert len(dealt) >= 2 and "REPARTITION_BY_COL" not in _plan(rows)  # by request, by unit: never merged into few tasks
    assert sorted(r.request_id for r in rows.collect()) == sorted(ids)


def _sections(spark, texts):
    return spark.createDataFrame(
        [(d, f"d{d}", len(t), i, x) for d, t in texts.items() for i, x in enumerate(t, 1)],
        "doc_id long, document_name string, n_sections int, section_idx int, section string")


def test_sections_are_dealt_out_once_for_their_neighbours(spark):
    from mdquarry.operators.neighbours import Neighbours
    texts = {1: ["red green", "green blue", "blue blue red"], 2: ["one two", "the", "two one two"], 3: ["alone"]}
    s = _sections(spark, texts)
    for bounds in ({}, {"max_chars": 9, "max_terms": 2}):
        found = Neighbours(s, **bounds).of_sections()
        # sections by document, then their few nearest ones by query; no row for each term
        assert len(re.findall("Exchange hashpartitioning", _plan(found))) == 2
        got = {(r["doc_id"], r["section_idx"], r["rank"], r["nbr_idx"], round(r["sim"], 3)) for r in found.collect()}
        assert (2, 1, 1, 3, 1.0 if bounds else 0.949) in got and (2, 2, 1, 1, 0.0) in got and not any(g[0] == 3 for g in got)
        # of document 1 only two terms stay, red is counted once less than blue and green (cut after 9 characters)
        assert ((1, 1, 1, 2, 1.0) in got) == bool(bounds)


def test_sections_are_dealt_out_once_for_their_term_weights(spark, monkeypatch):
    from math import log, sqrt

    from mdquarry.operators import neighbours as nb
    texts = {d: ["red green red", None, "green blue", "the", "blue ab"][:2 + d % 4] for d in range(1, 9)}
    s = _sections(spark, texts)
    found = nb.Neighbours(s).term_weights()
    # sections by document, no row for each term is shuffled; documents of several blocks count terms by block
    assert len(re.findall("Exchange hashpartitioning", _plan(found))) == 1
    monkeypatch.setattr(nb, "WORD_BYTES", 30)

    def rows(d):
        return sorted((r.doc_id, r.section_idx, r.term, r.tf, round(r.idf, 9), round(r.weight, 9)) for r in d.collect())

    want = []
    for d, t in texts.items():
        words = [[w for w in (x or "").split() if w != "the"] for x in t]
        for i, ws in enumerate(words, 1):
            idf = {w: log((1 + len(t)) / (1 + sum(w in x for x in words))) + 1 for w in ws}
            norm = sqrt(sum((ws.count(w) * idf[w]) ** 2 for w in idf))
            want += [(d, i, w, ws.count(w), round(idf[w], 9), round(ws.count(w) * idf[w] / norm, 9)) for w in idf]
    assert rows(found) == rows(nb.Neighbours(s, block_size=2).term_weights()) == sorted(want)
    # document 3 has red, green and blue twice: ties by term
    few = rows(nb.Neighbours(s, max_terms=2, block_size=2).term_weights())
    assert few == rows(nb.Neighbours(s, max_terms=2).term_weights())
    assert {(d, w) for d, _, w, *_ in few if d == 3} == {(3, "blue"), (3, "green")}


def test_texts_of_neighbours_are_not_dealt_out_by_fact(spark):
    from mdquarry.operators import neighbours as nb
    from mdquarry.plans.corpus import Corpus

    words = ["red", "green", "blue", "old", "new", "iron"]
    raw = {d: "\n\n".join(f"# Title {i}\n\nThe {words[i % 6]} thing {words[i * d % 6]} is here. Another {words[(i + d) % 6]} fact, that is {i}."
                          for i in range(n)) for d, n in ((1, 1), (2, 3), (3, 7), (4, 4))}
    docs = [(d, f"doc {d}", raw[d]) for d in raw] + [(2, "doc 2", raw[2]), (4, "again", raw[3][:160])]  # ids that come twice
    md = spark.createDataFrame(docs, "doc_id long, document_name string, raw string")
    none = spark.createDataFrame([], "path string")
    found = []
    for block in (512, 5):
        c = Corpus(md, manifest_df=none, block_size=block)
        plan = c.requests._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        dealt = [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plan) if "fact_neighbour_text" in x]
        assert block < 512 or ("fact_neighbour_text" in plan and not dealt)
        rows = c.requests.collect()
        found.append(sorted((r.request_id, r.document_name, r.prompt, r.unit_size, r.batch_id) for r in rows))
        text = {tuple(r[:3]): r.neighbour_text for r in nb.neighbour_context(
            c.fact_neighbours, c.sections, ["doc_id", "section_idx", "fact_number"]).select(
            "doc_id", "section_idx", "fact_number", "neighbour_text").collect()}
        facts = [r for r in rows if r.question_type == "FACT_BASED"]
        assert len({(r.doc_id, r.section_idx, r.fact_number) for r in facts}) == 2 * (1 + 3 + 7 + 4)
        for r in facts:
            near = text.get((r.doc_id, r.section_idx, r.fact_number), "No additional relevant sections found")
            assert f"Related sections:\n{near}\n\nFact:\n" in r.prompt
        c.unpersist()
    assert found[0] == found[1] and len(found[0]) > len(set(found[0]))


def test_units_of_one_request_are_counted_in_one_window_and_sorted_once(spark):
    req = spark.createDataFrame([("s1", 1, "d", 1, None, "SUMMARY", "easy", True, 1)], REQUESTS)
    plan = _plan(rs.settled(req, spark.createDataFrame([("s1", 1, OK)], rs.RESPONSE_SCHEMA)))
    # the repeated requests' rows are numbered before the join; after it the answers are neither sorted nor dealt again
    assert len(re.findall(r"\bWindow \[", plan)) == 4 and len(re.findall(r"Window \[.*windowspecdefinition\(request_id#\d+, spec", plan)) == 1
    assert plan.count("Sort [doc_id") == 1


def test_texts_that_begin_as_no_object_are_not_parsed(spark):
    texts = {'{"question":"q","answer":"a","question_images":[]}': ("ok", [], True, True),
             '{"question":"q","answer":"a"}': ("ok", [], True, True), '{"question":null,"answer":"a"}': ("ok", [], True, True),
             '{"question":"q"}': ("ok", [], True, False), '{"Question":"q","answer":"a"}': ("ok", [], False, True),
             '{"question":"q","answer":"a","question_images":["x","y"],"z":"NaN"}': ("ok", ["x", "y"], True, True),
             '{"question":"q","answer":"a","question_images":[],"z":NaN}': ("ok", [], None, None),
             '{"question":"q","answer":"a","question_images":["x",nul]}': ("ok", [], None, None),
             "{'question':'q'}": ("bad_json", None, None, None), "{\x07}": ("bad_json", None, None, None),
             '{"question":"q","question":[nul],"answer":"a","question_images":["x"]}': ("ok", ["x"], None, None),
             '{"question":[nul],"question":"q","answer":"a","question_images":["x"]}': ("ok", ["x"], None, None),
             "{ \t\r\n}": ("ok", [], False, False), "{\x0b}": ("bad_json", None, None, None),
             "{}": ("ok", [], False, False), "none": ("no_json", None, None, None)}
    d = rs.parse(spark.createDataFrame([(t, 1, t) for t in texts], rs.RESPONSE_SCHEMA))
    assert {r.request_id: (r.status, r.question_images, r.has_question, r.has_answer) for r in d.collect()} == texts
    assert "RLIKE" in d._jdf.queryExecution().optimizedPlan().toString()  # what is no object is not parsed


def test_attempts_alone_are_settled_without_texts(spark):
    from mdquarry.plans.queries import DerivedCorpus
    from mdquarry.sources.fixtures import md_documents

    docs = spark.createDataFrame([(5, "One line here.\nAnother line. And more.", "en", "src"),
                                  (6, "A line.\nOther words. More of them.", "en", "src")],
                                 "doc_id long, text string, lang string, source string")
    found = []
    for pairs_first in (False, True):
        c, written = DerivedCorpus(md_documents(docs)), []
        keep = c._keep
        c._keep = lambda df, name="stage": written.append((name, df.columns)) or keep(df, name)
        if pairs_first:
            assert c.qa.count() > 0
        rows = [sorted(map(repr, d.collect())) for d in (c.firsts, c.failures, c.still_failing)]
        names = [n for n, _ in written]
        assert names == ["docs", "manifest", "section_facts", *(["answered"] if pairs_first else []), "units", "firsts",
                         *(["qa"] if pairs_first else [])]
        assert not {"question", "answer"} & set(dict(written)["units"])
        found.append((*rows, sorted(map(repr, c.qa.collect()))))
        c.unpersist()
    assert found[0] == found[1] and found[0][0] and found[0][1] and found[0][3]
