"""File sources and sinks (A1, A5-A9, C10), the live responder loop and the streaming runner."""

from __future__ import annotations

import json
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from mdquarry.operators import audit as au
from mdquarry.operators import dataset as ds
from mdquarry.operators import images as im
from mdquarry.operators import requests as rq
from mdquarry.operators import responses as rs
from mdquarry.plans.corpus import Corpus
from mdquarry.sources.markdown import read_markdown_dir

A_MD = """---
title: Sourdough Baking Guide
description: How to bake with a starter
domain: baking
source: manual
version: 1.0
last_updated: 2024-01-01
audience: bakers
keywords: [starter, dough]
---

# Proofing time
The proofing time is the total rest of the dough. It is measured in hours.

- Short rests suit a warm kitchen and a young starter.
- Long rests give more flavour at the cost of waiting.

See {{crumb_1.1}} for an example.

# Steam
Steam keeps the crust soft while the loaf still rises. It is let out after twenty minutes.
"""


@pytest.fixture(scope="module")
def corpus_dir():
    root = tempfile.mkdtemp(prefix="mdq-corpus-")
    docs = os.path.join(root, "markdown_docs")
    os.makedirs(os.path.join(docs, "sub"))
    os.makedirs(os.path.join(root, "a"))
    with open(os.path.join(docs, "a.md"), "w") as f:
        f.write(A_MD)
    with open(os.path.join(docs, "b.c.md"), "w") as f:
        f.write("# Only\nA document without frontmatter. It has two sentences.\n")
    with open(os.path.join(docs, "skip.txt"), "w") as f:
        f.write("# not markdown\n")
    with open(os.path.join(docs, "sub", "d.md"), "w") as f:
        f.write("# nested\nnot read\n")
    with open(os.path.join(root, "a", "crumb_1.1.png"), "wb") as f:
        f.write(b"\x89PNG fake bytes")
    return root


def test_markdown_dir(spark, corpus_dir):
    d = read_markdown_dir(spark, os.path.join(corpus_dir, "markdown_docs"))
    rows = {r["document_name"]: r["raw"] for r in d.collect()}
    assert sorted(rows) == ["a", "b.c"]
    assert rows["a"].startswith("---\ntitle: Sourdough Baking Guide")


def test_end_to_end_on_files(spark, corpus_dir):
    docs = read_markdown_dir(spark, os.path.join(corpus_dir, "markdown_docs"))
    manifest = im.manifest_from_dir(spark, corpus_dir)
    assert [r["path"] for r in manifest.collect()] == ["a/crumb_1.1.png"]
    c = Corpus(docs, manifest_df=manifest, persist="none")
    meta = {e["key"]: e["value"] for e in c.docs.where("document_name = 'a'").first()["metadata"]}
    assert meta["title"] == "Sourdough Baking Guide" and meta["keywords"] == "[starter, dough]"
    imgs = c.section_images.collect()
    assert [r["image_paths"] for r in imgs] == [["a/crumb_1.1.png"]]
    # data URL of the attached image
    urls = im.data_urls(c.section_resolved.select("image_path"), corpus_dir).collect()
    assert urls[0]["data_url"].startswith("data:image/png;base64,")
    # requests: 2 sections in a -> all 15 types incl. pairs, 1 section in b.c -> no pair types
    req = c.requests
    per_doc = {r["document_name"]: r["n"] for r in
               req.where("question_type <> 'FACT_BASED'").groupBy("document_name").agg(F.count("*").alias("n")).collect()}
    assert per_doc == {"a": 2 * 14, "b.c": 12}
    p = req.where("document_name = 'a' AND section_idx = 1 AND question_type = 'INFERENCE'").first()
    assert "Sourdough Baking Guide" in p["prompt"] and "- image crumb_1.1: a/crumb_1.1.png" in p["prompt"]


def _fake_model(batches):
    """A deterministic responder: fails every first attempt, answers on the second."""
    for pdf in batches:
        ok = pdf["attempt"] >= 2
        text = ['{"question": "What is %s?", "question_images": [], "answer": "It is."}' % r if good else "busy"
                for r, good in zip(pdf["request_id"], ok)]
        yield pd.DataFrame({"request_id": pdf["request_id"], "attempt": pdf["attempt"].astype("int32"), "text": text})


def test_live_loop_and_dataset_files(spark, corpus_dir):
    docs = read_markdown_dir(spark, os.path.join(corpus_dir, "markdown_docs"))
    c = Corpus(docs, manifest_df=im.manifest_from_dir(spark, corpus_dir), persist="none")
    store = tempfile.mkdtemp(prefix="mdq-resp-") + "/responses"
    answers = rs.run_live(c.requests, _fake_model, store, max_retries=3)
    n_req = c.request_keys.count()
    assert answers.count() == 2 * n_req  # one failed pass, one good pass
    # a second run resumes: nothing left to ask
    again = rs.run_live(c.requests, _fake_model, store, max_retries=3)
    assert again.count() == 2 * n_req
    c2 = Corpus(docs, manifest_df=im.manifest_from_dir(spark, corpus_dir), persist="none", responses_df=answers)
    n_units = c.request_keys.select(*rs.UNIT).distinct().count()
    assert c2.records.count() == n_req and c2.failures.count() == n_units  # one failure row per unit
    out = tempfile.mkdtemp(prefix="mdq-out-")
    path = ds.write_dataset(c2.records, out, run_id="test")
    back = spark.read.json(path)
    assert back.count() == n_req
    splits = {r["split"] for r in back.select("split").distinct().collect()}
    assert splits == {"train", "eval"}
    # audit over the written files: no images referenced -> every file valid
    recs, files = au.read_dataset_dir(spark, path + "/*/*")
    assert recs.count() == n_req
    v = au.dataset_verdict(au.file_verdicts(recs, im.manifest_from_dir(spark, corpus_dir), files)).first()
    assert v["all_valid"] is True and v["n_files"] >= 3


def test_audit_reads_json_arrays(spark, corpus_dir):
    d = tempfile.mkdtemp(prefix="mdq-audit-")
    rec = {"messages": [{"role": "user", "content": [
        {"type": "text", "text": "q"},
        {"type": "image_url", "image_url": {"url": "a/crumb_1.1.png"}},
        {"type": "image_url", "image_url": {"url": "a/missing.png"}}]},
        {"role": "assistant", "content": "x" * 150}]}
    with open(os.path.join(d, "train-a.json"), "w") as f:
        json.dump([rec, rec], f, indent=2)
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("ignored")
    os.makedirs(os.path.join(d, "deeper"))
    with open(os.path.join(d, "deeper", "train-z.json"), "w") as f:
        f.write("not read")
    recs, files = au.read_dataset_dir(spark, d)
    bad = au.invalid_images(recs, im.manifest_from_dir(spark, corpus_dir)).collect()
    assert [b["image_url"] for b in bad] == ["a/missing.png", "a/missing.png"]
    assert bad[0]["context"] == "x" * 150 and bad[0]["preview"] == "x" * 100
    v, = au.file_verdicts(recs, im.manifest_from_dir(spark, corpus_dir), files).collect()
    assert v["n_invalid"] == 2 and v["valid"] is False


def test_streaming_incremental(spark, corpus_dir):
    from mdquarry.streaming.incremental import read_requests, start
    src = tempfile.mkdtemp(prefix="mdq-stream-src-")
    out = tempfile.mkdtemp(prefix="mdq-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="mdq-stream-ckpt-")
    with open(os.path.join(src, "a.md"), "w") as f:
        f.write(A_MD)
    images = spark.createDataFrame([], "path string")
    q = start(spark, src, out, ckpt, images)
    q.awaitTermination(300)
    first = read_requests(spark, out).count()
    assert first > 0
    with open(os.path.join(src, "b.md"), "w") as f:
        f.write("# Only\nA second document arrives later. It has two sentences.\n")
    q = start(spark, src, out, ckpt, images)  # restart: only the new file is processed
    q.awaitTermination(300)
    names = {r["document_name"] for r in read_requests(spark, out).select("document_name").distinct().collect()}
    assert names == {"a", "b"}
    assert read_requests(spark, out).where("document_name = 'a'").count() == first


def test_unreadable_dataset_files_are_not_valid(spark):
    d = tempfile.mkdtemp(prefix="mdq-audit-")
    good = {"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]},
                         {"role": "assistant", "content": "a"}]}
    text = {"messages": [{"role": "user", "content": "plain"}, {"role": "assistant", "content": "a"}]}
    for name, body in {"array": json.dumps([good]), "lines": "\n".join([json.dumps(good)] * 3), "empty": "[]",
                       "cut": json.dumps([good, good])[:-9], "cut_lines": json.dumps(good) + "\n" + json.dumps(good)[:-9],
                       "other": json.dumps([{"a": 1}]), "text": json.dumps([text])}.items():
        with open(os.path.join(d, name + ".json"), "w") as f:
            f.write(body)
    recs, files = au.read_dataset_dir(spark, d)
    v = au.file_verdicts(recs, spark.createDataFrame([], "path string"), files)
    valid = {os.path.basename(r["file"])[:-5]: r["valid"] for r in v.collect()}
    assert valid == {"array": True, "lines": True, "empty": True, "cut": False, "cut_lines": False, "other": False,
                     "text": False}
    assert au.dataset_verdict(v).first()["all_valid"] is False


def test_line_ends_are_normalised(spark):
    d = tempfile.mkdtemp(prefix="mdq-eol-")
    with open(os.path.join(d, "a.md"), "wb") as f:
        f.write(b"# One\r\ntext\r\n# Two\rmore")
    assert read_markdown_dir(spark, d).first()["raw"] == "# One\ntext\n# Two\nmore"


def test_inputs_that_are_not_given_are_an_error(spark, corpus_dir):
    c = Corpus(read_markdown_dir(spark, os.path.join(corpus_dir, "markdown_docs")), persist="none")
    with pytest.raises(ValueError):
        c.manifest
    with pytest.raises(ValueError):
        c.responses


def test_every_image_has_its_own_data_url(spark):
    from mdquarry.operators import requests as rq
    r = spark.createDataFrame([("r1", "p", ["a.png", "gone.png", "b.jpg"]), ("r2", "p", [])],
                              "request_id string, prompt string, images array<string>")
    urls = spark.createDataFrame([("a.png", "data:A"), ("b.jpg", "data:B")], "image_path string, data_url string")
    got = rq.with_data_urls(r, urls).select("request_id", rq.chat_request_json(
        F.col("prompt"), F.col("image_urls")).alias("j")).collect()
    parts = {g["request_id"]: json.loads(g["j"])[1]["content"] for g in got}
    assert [p["image_url"]["url"] for p in parts["r1"][1:]] == ["data:A", "data:B"] and len(parts["r2"]) == 1


def test_memory_frames_are_freed(spark, corpus_dir):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    c = Corpus(read_markdown_dir(spark, os.path.join(corpus_dir, "markdown_docs")),
               manifest_df=im.manifest_from_dir(spark, corpus_dir), persist="memory")
    c.requests.count()
    c.unpersist()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_a_sixteenth_question_type_without_editing_the_package(spark, corpus_dir):
    docs = read_markdown_dir(spark, os.path.join(corpus_dir, "markdown_docs"))
    c = Corpus(docs, manifest_df=im.manifest_from_dir(spark, corpus_dir), persist="none", batch_size=1,
               extra_types=(("ANALOGY", "medium", "Explain {title} by an analogy.{context}\n{body}\n"),))
    rows = c.requests.where("question_type = 'ANALOGY'").collect()
    assert len(rows) == c.sections.count() == c.request_keys.where("question_type = 'ANALOGY'").count()
    assert all(r["prompt"].startswith("Explain ") and r["ordinal"] == 16 for r in rows)
    assert {r["batch_id"] for r in rows} == {r["section_idx"] - 1 for r in rows}


def test_question_types_of_every_unit_from_a_table(spark, corpus_dir):
    schema = "question_type string, difficulty string, unit string, template string, note string"
    table = spark.createDataFrame([("A_FACT", "hard", "fact", "Doubt {fact}.", None), ("A_PAIR", "easy", "pair", "{title_a} or {title_b}?", "x"),
                                   ("A_SECTION", "easy", "section", "Retell {title}.", "x")], schema)
    c = Corpus(read_markdown_dir(spark, os.path.join(corpus_dir, "markdown_docs")), persist="none",
               manifest_df=im.manifest_from_dir(spark, corpus_dir), extra_types=rq.types_from_table(table))
    got = {}
    for r in c.requests.where("ordinal > 15").collect():
        got.setdefault(r["question_type"], []).append(r)
    assert len(got["A_FACT"]) == c.facts.count() and all(r["prompt"].startswith("Doubt ") for r in got["A_FACT"])
    assert len(got["A_PAIR"]) == c.sections.where("partner_idx is not null").count() > 0
    assert len(got["A_SECTION"]) == c.sections.count()
    keys = c.request_keys.where("ordinal > 15").select("request_id").collect()
    assert {k["request_id"] for k in keys} == {r["request_id"] for rows in got.values() for r in rows}
    assert rq.types_from_table(table.limit(0)) == ()
    for bad in [("FACT_BASED", "easy", "fact", "x"), ("B", "easy", "chapter", "x"), ("B", "easy", "fact", "{nothing}"), ("B", None, "fact", "x")]:
        with pytest.raises(ValueError):
            rq.types_from_table(spark.createDataFrame([(*bad, None)], schema))


def test_every_name_in_a_folder(spark, tmp_path):
    texts = {"_x": "# u", ".x": "# d", "sp ace": "# s\nsee {{pic 1}} and {{fig_1}}", "100%": "# p", "a+b": "# +", "a%20b": "# c",
             "empty": "", "a.b": "# ab", "é": "# e"}
    docs = tmp_path / "docs"
    docs.mkdir()
    for name, text in texts.items():
        (docs / f"{name}.md").write_text(text)
    (docs / "bad.md").write_bytes(b"# x\xff")
    (docs / "UPPER.MD").write_text("not read")
    (docs / ".md").write_text("# only an ending")
    (docs / "sub.md").mkdir()
    for root in (str(docs), f"file://{docs}", f"file:{docs}/"):
        rows = read_markdown_dir(spark, root).collect()
        got = {r["document_name"]: r["raw"] for r in rows}
        assert got == {**texts, "bad": "# x\ufffd", ".md": "# only an ending"}
        assert len({r["doc_id"] for r in rows}) == len(rows)
    (docs / "sp ace").mkdir()
    (docs / "sp ace" / "fig_1.png").write_bytes(b"png")
    (docs / "_under").mkdir()
    (docs / "_under" / ".hidden.jpg").write_bytes(b"")
    (docs / "top.jpeg").write_bytes(b"1")
    for root in (str(docs), os.path.relpath(docs), f"file://{docs}"):
        manifest = im.manifest_from_dir(spark, root)
        assert sorted(r["path"] for r in manifest.collect()) == ["_under/.hidden.jpg", "sp ace/fig_1.png", "top.jpeg"]
    c = Corpus(read_markdown_dir(spark, str(docs)), manifest_df=im.manifest_from_dir(spark, str(docs)), persist="none")
    assert [r["image_path"] for r in c.section_resolved.where("image_path is not null").collect()] == ["sp ace/fig_1.png"]
    assert c.sections.where("document_name = 'empty'").count() == 0


def test_batch_and_stream_agree_on_names_and_ids(spark, tmp_path):
    from mdquarry.sources.markdown import stream_markdown_dir
    (tmp_path / "in").mkdir()
    for name in ("sp ace", "100%", "a+b", "plain"):
        (tmp_path / "in" / f"{name}.md").write_text(f"# {name}")
    q = stream_markdown_dir(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("seen_names") \
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = sorted(map(tuple, read_markdown_dir(spark, str(tmp_path / "in")).collect()))
    assert sorted(map(tuple, spark.table("seen_names").collect())) == want and len(want) == 4


def test_a_folder_without_documents(spark, tmp_path):
    docs = read_markdown_dir(spark, str(tmp_path))
    assert docs.columns == ["doc_id", "document_name", "raw"] and docs.count() == 0
    assert im.manifest_from_dir(spark, str(tmp_path)).count() == 0


def test_only_the_bytes_of_needed_images_are_read(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x00\x01")
    (tmp_path / "sp ace.jpg").write_bytes(b"")
    os.mkfifo(tmp_path / "never.png")  # opening this one would wait for ever
    (tmp_path / "folder.png").mkdir()
    paths = spark.createDataFrame([("a.png",), ("a.png",), ("gone.png",), ("sp ace.jpg",), ("folder.png",), (None,)],
                                  "image_path string")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        got = {r["image_path"]: r["data_url"] for r in im.data_urls(paths, root).collect()}
        assert got == {"a.png": "data:image/png;base64,AAE=", "sp ace.jpg": "data:image/jpeg;base64,"}
