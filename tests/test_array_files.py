"""JSON array files: the committed sink (A7, G8) and the reader that splits arrays."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from mdquarry.operators import audit as au
from mdquarry.operators import dataset as ds
from mdquarry.plans.templates import QUESTION_TYPES
from mdquarry.sources import array_files as af

KINDS = {t: d for _, t, d in QUESTION_TYPES}


def _value(rnd, depth=0):
    kind = rnd.randint(0, 6 if depth < 3 else 3)
    if kind == 0:
        return rnd.choice([None, True, -1.5, 12])
    if kind <= 3:
        return "".join(rnd.choice('ab,"\\[]{}\n é日') for _ in range(rnd.randint(0, 12)))
    if kind <= 5:
        return {f'k"{i},': _value(rnd, depth + 1) for i in range(rnd.randint(0, 4))}
    return [_value(rnd, depth + 1) for _ in range(rnd.randint(0, 4))]


def _read(spark, path, split_bytes):
    elements, files = af.read_arrays(spark, path, split_bytes)
    found = {}
    for r in elements.collect():
        found.setdefault(os.path.basename(r["file"]), []).append((r["element"], r["entry"]))
    return ({k: [e for _, e in sorted(v)] for k, v in found.items()},
            {os.path.basename(r["file"]): (r["is_array"], r["complete"]) for r in files.collect()})


@pytest.mark.parametrize("split_bytes", [61, 1 << 20])
def test_arrays_are_cut_as_json_says(spark, tmp_path, split_bytes):
    rnd = random.Random(7)
    want = {}
    for i in range(5):
        want[f"f{i}.json"] = [_value(rnd) for _ in range(rnd.randint(1, 25))]
        with open(tmp_path / f"f{i}.json", "w", encoding="utf-8") as f:
            json.dump(want[f"f{i}.json"], f, indent=rnd.choice([None, 2]), ensure_ascii=rnd.random() < 0.5)
    elements, files = _read(spark, str(tmp_path), split_bytes)
    assert {k: [json.loads(e) for e in v] for k, v in elements.items()} == want
    assert set(files.values()) == {(True, True)} and len(files) == 5


def test_broken_arrays_are_not_complete(spark, tmp_path):
    good = json.dumps([{"a": "x, ]"}, {"b": [1, 2]}] * 5)
    texts = {"good": good, "tail": good[:-1], "cut": good[:-9], "in_string": good[:9], "beside": good + " x",
             "two": good + good, "comma": good + ",", "before": "[" + good, "closed_twice": good + "]", "empty": " [ ]\n",
             "lines": '{"a": 1}\n{"a": 2}', "word": "none"}
    for k, t in texts.items():
        (tmp_path / f"{k}.json").write_text(t)
    for split in (37, 1 << 20):
        _, files = _read(spark, str(tmp_path), split)
        assert {k for k, v in files.items() if v == (True, True)} == {"good.json", "empty.json"}
        assert {k for k, v in files.items() if not v[0]} == {"lines.json", "word.json"}


def test_one_large_array_feeds_many_tasks(spark, tmp_path):
    rec = json.dumps({"messages": [{"role": "user", "content": [{"type": "text", "text": "q, [\\\"{" * 20}]},
                                   {"role": "assistant", "content": "a" * 3000}]})
    n = 4000
    for name, tail in (("whole", "]"), ("tail", "")):
        with open(tmp_path / f"{name}.json", "w") as f:
            f.write("[" + ",\n".join([rec] * n) + tail)
    recs, files = au.read_dataset_dir(spark, str(tmp_path), split_bytes=1 << 20)
    got = {os.path.basename(r["file"]): r["n"] for r in recs.groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert got["whole.json"] == n and got["tail.json"] >= n - 1
    assert {os.path.basename(r["file"]): r["readable"] for r in files.collect()} == {"whole.json": True, "tail.json": False}
    elements, _ = af.read_arrays(spark, str(tmp_path), split_bytes=1 << 20)
    assert elements.where(F.col("entry").contains("whole")).count() == 0


def _records(spark, rows):
    return spark.createDataFrame(rows, "split string, document_name string, section_idx int, fact_number int, "
                                       "question_type string, difficulty string, record string")


def test_one_array_for_each_split_and_document(spark, tmp_path):
    rows = [("train", "a", i, None, "INFERENCE", KINDS["INFERENCE"], json.dumps({"messages": [], "i": i})) for i in range(25)]
    rows += [("eval", "b c", 1, None, "SECTION_SUMMARY", "medium", json.dumps({"messages": [], "s": "é\n"}))]
    run, stats = ds.write_array_files(_records(spark, rows), str(tmp_path), run_id="2024-01-02_03-04-05", sections_per_file=10)
    end = f"-synthetic-data-{run}"
    names = {f"train-a{end}.json", f"train-a{end}.part-1.json", f"train-a{end}.part-2.json", f"eval-a{end}.json",
             f"train-b c{end}.json", f"eval-b c{end}.json"}
    assert set(os.listdir(tmp_path)) == names
    read = {n: json.loads((tmp_path / n).read_text()) for n in names}
    order = [f"train-a{end}.json", f"train-a{end}.part-1.json", f"train-a{end}.part-2.json"]
    assert [r["i"] for n in order for r in read[n]] == list(range(25))
    assert read[f"eval-a{end}.json"] == [] and read[f"eval-b c{end}.json"] == [{"messages": [], "s": "é\n"}]
    assert stats["records"] == 26 and stats["train"] == 25 and stats["eval"] == 1 and stats["INFERENCE/" + KINDS["INFERENCE"]] == 25
    # the run again, with less: it takes the place of the first
    ds.write_array_files(_records(spark, rows[:5]), str(tmp_path), run_id=run, sections_per_file=10)
    assert set(os.listdir(tmp_path)) == {f"train-a{end}.json", f"eval-a{end}.json"}
    assert len(json.loads((tmp_path / f"train-a{end}.json").read_text())) == 5


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    rows = [("train", f"d{i}", 1, None, "INFERENCE", KINDS["INFERENCE"], "{}") for i in range(40)]
    bad = F.when(F.col("document_name") == "d7", F.raise_error(F.lit("lost"))).otherwise(F.col("record"))
    with pytest.raises(Exception, match="lost"):
        af.write_arrays(_records(spark, rows).repartition(4, "document_name").select(
            "split", "document_name", F.lit(0).alias("part"), bad.alias("record")), str(tmp_path), "run")
    assert [n for n in os.listdir(tmp_path) if not n.startswith("_staging")] == []
    good = _records(spark, rows).select("split", "document_name", F.lit(0).alias("part"), "record")
    af.write_arrays(good.repartition(4, "document_name").sortWithinPartitions("document_name"), str(tmp_path), "run")
    assert sorted(os.listdir(tmp_path)) == sorted(f"train-d{i}-synthetic-data-run.json" for i in range(40))


def test_statistics_of_the_writing_pass_equal_the_query(spark, small_corpus, tmp_path):
    from mdquarry.plans.queries import QUERIES

    from .conftest import SF_SMALL
    _, stats = ds.write_array_files(small_corpus.records, str(tmp_path), run_id="r")
    want = {(r["question_type"], r["difficulty"]): r["n_qa"] for r in QUERIES["type_stats"](spark, SF_SMALL).collect()}
    assert stats["records"] == want.pop((None, None)) and stats["other"] == 0
    assert {f"{t}/{d}": n for (t, d), n in want.items()} == {k: v for k, v in stats.items() if "/" in k}
    names = small_corpus.docs.select("document_name").count()
    assert len(os.listdir(tmp_path)) == 2 * names


def test_names_of_files_do_not_pass_the_driver(spark, tmp_path, monkeypatch):
    """The commit holds folders of tasks, the reader's plan has no scan of files that the driver lists."""
    monkeypatch.setattr(af, "NAMES", 3)
    told, commit = [], af.ArrayFilesWriter.commit
    w = af.ArrayFilesWriter({"path": str(tmp_path), "run": "r"})
    import pyarrow as pa
    rows = pa.RecordBatch.from_pylist([{"split": "train", "document_name": f"d{i}\n/é %", "part": 0, "record": "[1, 2]"} for i in range(20)])
    told = [w.write(iter([rows.slice(0, 10)])), w.write(iter([])), w.write(iter([rows.slice(10)]))]
    assert all(len(repr(vars(m))) < 300 for m in told) and told[1].folder is None
    commit(w, told)
    ends = "-synthetic-data-r.json"
    assert sorted(os.listdir(tmp_path)) == sorted(f"train-d{i}\n%2Fé %{ends}" for i in range(20))
    again = af.ArrayFilesWriter({"path": str(tmp_path), "run": "r"})
    commit(again, [again.write(iter([rows.slice(4, 9)]))])
    assert sorted(os.listdir(tmp_path)) == sorted(f"train-d{i}\n%2Fé %{ends}" for i in range(4, 13))
    for hidden in ("_x.json", ".y.json", "z.txt"):
        (tmp_path / hidden).write_text("[]")
    (tmp_path / "none.json").write_text("")
    (tmp_path / "folder.json").mkdir()
    elements, files = af.read_arrays(spark, str(tmp_path), 4)
    seen = {r.file for r in spark.read.option("pathGlobFilter", "*.json").text(str(tmp_path)).selectExpr("_metadata.file_path file").collect()}
    assert {r.file for r in files.collect()} == seen == {r.file for r in elements.collect()} and len(seen) == 9
    assert all(r.is_array and r.complete for r in files.collect())
    pieces = af._pieces(spark, str(tmp_path), 4)
    assert "Scan text" not in pieces._jdf.queryExecution().executedPlan().toString()
    assert pieces.where("block > 0").count() > 0
