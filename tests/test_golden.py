"""Golden micro-cases (FIXTURES §3): one edge rule per case, run through the Spark operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from mdquarry.functions.text import drop_last_extension
from mdquarry.operators import facts as fx
from mdquarry.operators import responses as rs
from mdquarry.operators.frontmatter import split_frontmatter
from mdquarry.operators.sections import split_sections
from mdquarry.plans.corpus import Corpus


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_document_name(spark):
    assert one(spark, drop_last_extension(F.col("v")), "a.b.md") == "a.b"
    assert one(spark, drop_last_extension(F.col("v")), "plain") == "plain"


def _fm(spark, raw):
    d = spark.createDataFrame([(1, "d", raw)], "doc_id long, document_name string, raw string")
    r = split_frontmatter(d).first()
    return [(e["key"], e["value"]) for e in r["metadata"]], r["content"]


def test_frontmatter_marker_inside_value(spark):
    assert _fm(spark, "---\ntitle: A---B\n---\nbody") == ([("title", "A")], "B\n---\nbody")


def test_frontmatter_unclosed(spark):
    assert _fm(spark, "---\ntitle: A\nbody") == ([], "---\ntitle: A\nbody")


def test_frontmatter_repeated_key_and_quotes(spark):
    meta, content = _fm(spark, "---\ntitle: 'x'\nlang: en\ntitle: \"y\"\n---\n\n  text")
    assert meta == [("title", "y"), ("lang", "en")] and content == "text"


def test_frontmatter_unparsable_block_keeps_content(spark):
    raw = "---\njust some prose\n---\nbody"
    assert _fm(spark, raw) == ([], raw)


def _sections(spark, content):
    d = spark.createDataFrame([(1, "d", content)], "doc_id long, document_name string, content string")
    return [(r["section_idx"], r["section"], r["title"], r["body"])
            for r in split_sections(d).orderBy("section_idx").collect()]


def test_sections_split_filter_number(spark):
    got = _sections(spark, "intro\n# A\nx\n## B\nNO_CONTENT_HERE\n#no space\n# C\ny")
    assert [(i, s) for i, s, _, _ in got] == [(1, "intro"), (2, "# A\nx"), (3, "# C\ny")]


def test_title_and_body(spark):
    got = _sections(spark, "# T one\nx\n")
    assert got[0][2:] == ("T one", "x")
    got = _sections(spark, "plain")
    assert got[0][2:] == ("Section", "plain")


def test_list_items_and_continuation(spark):
    items = one(spark, fx.list_items(F.col("v")), "- alpha beta gamma\n  more words\n- short")
    assert items == ["alpha beta gamma more words", "short"]


def test_bare_marker_line_is_not_an_item(spark):
    assert one(spark, fx.list_items(F.col("v")), "1.\nfoo bar baz qux") == []


def test_sub_items_default_and_linked(spark):
    text = "2. Brew the tea\n   - Warm the pot"
    assert one(spark, fx.list_items(F.col("v")), text) == ["Brew the tea", "Warm the pot"]
    assert one(spark, fx.list_items_linked(F.col("v")), text) == ["Brew the tea", "Brew the tea - Warm the pot"]


def test_items_of_any_depth_name_their_nearest_parent(spark):
    text = "- Tea\n  - Leaf\n      - Green: fine\n      - Black\n   more\n    - Bag\n  - Pot\n- Coffee\n\t- Bean"
    assert one(spark, fx.list_items_linked(F.col("v")), text) == [
        "Tea", "Tea - Leaf", "Leaf - Green: fine", "Leaf - Black more", "Leaf - Bag", "Tea - Pot", "Coffee",
        "Coffee - Bean"]
    flat = "- one\n- two\n* three\n4. four"
    assert one(spark, fx.list_items_linked(F.col("v")), flat) == ["one", "two", "three", "four"]
    assert one(spark, fx.list_items_linked(F.col("v")), "  - first\n- second") == [" - first", "second"]


def test_sentences(spark):
    s = lambda t: one(spark, fx.sentences(F.col("v")), t)
    assert len(s("It is 12.5. Then go.")) == 1
    assert len(s("It is 1.25. Then go.")) == 2
    assert len(s("The U.S. Army left.")) == 1
    assert len(s("In the U.S.A. Army")) == 2
    assert len(s("Under Pa.C.S. Title 5.")) == 2
    assert s("One here. and more. Next") == ["One here. and more.", "Next"]


def test_fact_length_rule_and_fallback(spark):
    d = spark.createDataFrame([(1, "Abcdefghi. Bcdefghijk."), (2, "tiny")], "k int, body string")
    got = [r["facts"] for r in fx.with_fact_array(d).orderBy("k").collect()]
    assert got[0] == ["Bcdefghijk."]  # 10 characters dropped, 11 kept
    assert got[1] == ["tiny"]


def test_image_refs(spark):
    from mdquarry.operators.images import REF_PATTERN
    got = one(spark, F.regexp_extract_all(F.col("v"), F.lit(REF_PATTERN), 1), "Compare {{map-7}} with {{chart_b.4}}")
    assert got == ["map-7", "chart_b.4"]


def test_image_priority(spark):
    from mdquarry.operators import images as im
    refs = spark.createDataFrame([(1, "doc", 1, 1, "r")], "doc_id long, document_name string, section_idx int, "
                                                          "ref_pos int, ref string")
    man = spark.createDataFrame([("doc/r.jpg",), ("markdown_docs/doc/r.png",)], "path string")
    r = im.resolve(refs, man, ["doc_id", "document_name", "section_idx"]).first()
    assert r["image_path"] == "doc/r.jpg"


def _neighbour_counts(spark, texts):
    raw = "\n".join(f"# S{i}\n{t}" for i, t in enumerate(texts))
    c = Corpus(spark.createDataFrame([(1, "d", raw)], "doc_id long, document_name string, raw string"), persist=False)
    rows = c.section_neighbours.groupBy("section_idx").count().collect()
    return {r["section_idx"]: r["count"] for r in rows}


def test_neighbour_counts_by_n(spark):
    words = ["apple banana cherry", "delta echo foxtrot", "golf hotel india", "juliet kilo lima"]
    for n, expected in ((1, 0), (2, 0), (3, 1), (4, 2)):
        got = _neighbour_counts(spark, words[:n])
        assert all(v == expected for v in got.values()) and (expected == 0 or len(got) == n), (n, got)


def test_no_neighbour_fallback_text(spark):
    c = Corpus(spark.createDataFrame([(1, "d", "# only\nsection text here")],
                                     "doc_id long, document_name string, raw string"),
               manifest_df=spark.createDataFrame([], "path string"), persist="none")
    assert c.section_context.first()["neighbour_text"] == "No additional relevant sections found"


def _partners(spark, content):
    from mdquarry.operators.requests import partners
    d = spark.createDataFrame([(1, "d", content)], "doc_id long, document_name string, content string")
    return {r["section_idx"]: r["partner_idx"] for r in partners(split_sections(d)).collect()}


def test_identical_sections_have_no_partner(spark):
    assert _partners(spark, "# a\nsame\n# a\nsame") == {}
    got = _partners(spark, "# a\nsame\n# a\nsame\n# b\nother")
    assert got[1] == 3 and got[2] == 3 and got[3] in (1, 2)
    assert _partners(spark, "# only one") == {}


def test_json_substring(spark):
    assert one(spark, rs.json_substring(F.col("v")), 'ok {"a":{"b":1}} done') == '{"a":{"b":1}}'
    assert one(spark, rs.json_substring(F.col("v")), "} x {") == ""


def _status(spark, text):
    d = spark.createDataFrame([("r", 1, text)], rs.RESPONSE_SCHEMA)
    return rs.parse(d).first()["status"]


def test_strict_json(spark):
    assert _status(spark, '{"question": "q", "answer": "a"}') == "ok"
    for bad in ['{"a":1} x {"b":2}', "{'a':1}", '{"a":1,}', '{"a":"x\ny"}']:
        assert _status(spark, bad) == "bad_json", bad
    assert _status(spark, "no braces") == "no_json"


def test_sanitize(spark):
    assert one(spark, rs.sanitize(F.col("v")), "a\x00b\tc") == "ab\tc"


def test_all_or_nothing_facts(spark):
    req = spark.createDataFrame(
        [(f"r{i}", 1, "d", 1, i, "FACT_BASED", "easy", None, 3) for i in range(3)],
        "request_id string, doc_id long, document_name string, section_idx int, fact_number int, "
        "question_type string, difficulty string, is_summary boolean, unit_size int")
    ok = '{"question": "q", "answer": "a"}'
    resp = spark.createDataFrame([("r0", 1, ok), ("r1", 1, "nope"), ("r2", 1, ok)], rs.RESPONSE_SCHEMA)
    grid = rs.answered(req, rs.parse(resp))
    out = rs.unit_outcomes(grid, req)
    firsts = rs.first_success(out)
    assert rs.qa_rows(grid, firsts).count() == 0
    f = rs.failures(out, firsts).collect()
    assert len(f) == 1 and f[0]["fact_number"] == 1 and f[0]["error"] == "no_json"


def test_chat_record_images_and_quarantine(spark):
    from mdquarry.operators import dataset as ds
    qa = spark.createDataFrame(
        [("r1", 1, "d", 1, None, "INFERENCE", "medium", "q", "a", ["x", "y"], True, True),
         ("r2", 1, "d", 2, None, "SECTION_SUMMARY", "medium", "q", None, [], True, False)],
        "request_id string, doc_id long, document_name string, section_idx int, fact_number int, "
        "question_type string, difficulty string, question string, answer string, question_images array<string>, "
        "has_question boolean, has_answer boolean")
    rec, quar = ds.shape(qa)
    r = rec.first()
    import json
    j = json.loads(r["record"])
    parts = j["messages"][0]["content"]
    assert [p["type"] for p in parts] == ["text", "image_url", "image_url"]
    assert [p["image_url"] for p in parts[1:]] == [{"url": "x", "detail": "auto"}, {"url": "y", "detail": "auto"}]
    assert j["messages"][1] == {"role": "assistant", "content": "a"} and r["split"] == "train"
    q = quar.first()
    assert q["request_id"] == "r2" and q["reason"] == "missing_key"


def test_empty_dataset_verdict_is_true(spark):
    from mdquarry.operators import audit as au
    v = spark.createDataFrame([], "file string, n_invalid long, valid boolean")
    assert au.dataset_verdict(v).first()["all_valid"] is True


def test_missing_response_fails_unit_then_retry_succeeds(spark):
    req = spark.createDataFrame(
        [(f"r{i}", 1, "d", 1, i, "FACT_BASED", "easy", None, 3) for i in range(3)],
        "request_id string, doc_id long, document_name string, section_idx int, fact_number int, "
        "question_type string, difficulty string, is_summary boolean, unit_size int")
    ok = '{"question": "q", "answer": "a"}'
    resp = spark.createDataFrame([("r0", 1, ok), ("r2", 1, ok)] + [(f"r{i}", 2, ok) for i in range(3)]
                                 + [("r1", 2, ok), ("r2", 2, None)],  # delivered twice
                                 rs.RESPONSE_SCHEMA)
    grid = rs.answered(req, rs.parse(resp))
    out = rs.unit_outcomes(grid, req)
    firsts = rs.first_success(out)
    f = rs.failures(out, firsts).collect()
    assert [(r["attempt"], r["fact_number"], r["error"]) for r in f] == [(1, 1, "no_response")]
    qa = rs.qa_rows(grid, firsts).collect()
    assert sorted((r["fact_number"], r["attempt"]) for r in qa) == [(0, 2), (1, 2), (2, 2)]
    assert rs.pending(req, firsts).count() == 0


def test_block_lists_in_frontmatter(spark):
    raw = "---\ntitle: Bread\ntags:\n  - rye\n- wheat\nlang: en\n---\n# A\ntext"
    from mdquarry.operators.frontmatter import split_frontmatter
    row = split_frontmatter(spark.createDataFrame([(1, raw), (2, "---\ntitle: x\n- stray\n---\nrest")],
                                                  "doc_id long, raw string")).orderBy("doc_id").collect()
    assert [(m["key"], m["value"]) for m in row[0]["metadata"]] == [
        ("title", "Bread"), ("tags", "[rye, wheat]"), ("lang", "en")]
    assert row[0]["content"] == "# A\ntext"
    assert row[1]["fm_parsed"] is False and row[1]["content"].startswith("---")


def test_words_of_decomposed_letters(spark):
    from mdquarry.operators.neighbours import tokens
    assert one(spark, tokens(F.col("v")), "cafe\u0301 na_1 x") == ["cafe", "na_1"]


def test_many_equal_sections_and_linked_items_stay_fast(spark):
    import time
    from mdquarry.operators.sections import split_sections
    doc = spark.createDataFrame([(1, "d", "# same\nbody text\n" * 20000)],
                                "doc_id long, document_name string, content string")
    begin = time.time()
    assert split_sections(doc).where("partner_idx is null").count() == 20000
    items = "- parent one\n" + "  - child\n" * 2000
    assert len(one(spark, fx.list_items_linked(F.col("v")), items)) == 2001
    assert time.time() - begin < 60


BLOCKS = [  # block, its tree as JSON (None: does not parse)
    ("a: 1\nb:\n  c: x # why\n  d:\n    e: true", '{"a":1,"b":{"c":"x","d":{"e":true}}}'),
    ("a:\n- x\n- y\nb:\n  - |\n    lit: 1\n     in\n  - k: v\n    l: >-\n      f1\n      f2\n\n      f3",
     '{"a":["x","y"],"b":["lit: 1\\n in\\n",{"k":"v","l":"f1 f2\\nf3"}]}'),
    ("m:\n  - - a\n    - b\n  -\n    k: 1", '{"m":[["a","b"],{"k":1}]}'),
    ("x:\n  y: 1\nz: 0\nx:\n  w: 'a: b'\n  \"q r\": [1, 2.50, t]", '{"x":{"q r":[1,2.5,"t"],"w":"a: b"},"z":0}'),
    ("long: some text\n  goes on\nnone: ~\nvoid:\nword: '1'", '{"long":"some text goes on","none":null,"void":null,"word":"1"}'),
    ("keep: |+\n  a\n\nnext: 1", '{"keep":"a\\n\\n","next":1}'),
    ("# only a comment", "{}"), ("", "{}"),
    ("a: x\n  b: y", None), ("a:\n    b: 1\n  c: 2", None), ("a: b: c", None), ("a:\n\tb: 1", None),
    ("a: 'open", None), ("- a\n- b", None), ("a: 1\nprose", None), ("a:\n  b: 1\n  - c", None),
]


def test_frontmatter_tree(spark):
    import json
    rows = [(i, f"---\n{b}\n---\nrest") for i, (b, _) in enumerate(BLOCKS)] + [(len(BLOCKS), None)]
    got = split_frontmatter(spark.createDataFrame(rows, "doc_id long, raw string")).selectExpr(
        "doc_id", "to_json(metadata_tree) tree", "fm_parsed", "content").orderBy("doc_id").collect()
    for r, (block, want) in zip(got, BLOCKS):
        assert (r["tree"] and json.loads(r["tree"])) == (want and json.loads(want)), block
        assert r["fm_parsed"] is (want is not None)
        assert r["content"] == ("rest" if want is not None else f"---\n{block}\n---\nrest")
    assert got[-1]["tree"] is None and got[-1]["content"] is None


def test_long_blocks_that_are_no_metadata_stay_fast(spark):
    import time
    prose = "---\n" + "A line of prose: with: a colon.\n" * 16000 + "---\nrest"
    keys = "---\n" + "".join(f"k{i}:\n  v: {i}\n" for i in range(300)) + "---\nrest"
    begin = time.time()
    got = split_frontmatter(spark.createDataFrame([(1, prose), (2, keys)], "doc_id long, raw string"))
    assert [(r["fm_parsed"], len(r["metadata"])) for r in got.orderBy("doc_id").collect()] == [(False, 0), (True, 300)]
    assert time.time() - begin < 60
