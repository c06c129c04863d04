"""Chat-format dataset shaping, split, statistics and sinks.

A record is ``{"messages": [user, assistant], "question_type", "difficulty"}``
where the user content is a list of parts (the question text, then one
``image_url`` part per question image with ``detail: auto``) and the
assistant content is the answer string. The heterogeneous ``content`` is
built as JSON text; the sink stores it as a VARIANT so it round-trips as
list-or-string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.templates import QUESTION_TYPES, SUMMARY_TYPE
from ..sources.array_files import write_arrays


def chat_json(question: Column, answer: Column, images: Column, question_type: Column,
              difficulty: Column) -> Column:
    """The chat record as JSON text."""
    def img(u):
        return F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
                        F.struct(u.alias("url"), F.lit("auto").alias("detail")).alias("image_url"))
    text_part = F.struct(F.lit("text").alias("type"), question.alias("text"),
                         F.lit(None).cast("struct<url:string,detail:string>").alias("image_url"))
    parts = F.concat(F.array(text_part), F.transform(images, img))
    user = F.to_json(F.struct(F.lit("user").alias("role"), parts.alias("content")))
    asst = F.to_json(F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    tail = F.to_json(F.struct(question_type.alias("question_type"), difficulty.alias("difficulty")))
    return F.concat(F.lit('{"messages":['), user, F.lit(","), asst, F.lit("],"), F.substring(tail, 2, 1 << 30))


def shape(qa: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine).

    records: request_id, document_name, split, question_type, difficulty, record (JSON text).
    Pairs lacking ``question`` or ``answer`` go to quarantine with reason
    ``missing_key`` instead of failing the document (G4).
    """
    good = F.coalesce(F.col("has_question"), F.lit(False)) & F.coalesce(F.col("has_answer"), F.lit(False))
    qt = F.coalesce(F.col("question_type"), F.lit("UNKNOWN"))
    df = F.coalesce(F.col("difficulty"), F.lit("UNKNOWN"))
    imgs = F.coalesce(F.col("question_images"), F.array().cast("array<string>"))
    rec = qa.where(good).select(
        "request_id", "doc_id", "document_name", "section_idx", "fact_number",
        F.when(qt == SUMMARY_TYPE, F.lit("eval")).otherwise(F.lit("train")).alias("split"),
        qt.alias("question_type"), df.alias("difficulty"),
        chat_json(F.coalesce(F.col("question"), F.lit("")), F.coalesce(F.col("answer"), F.lit("")), imgs, qt, df)
        .alias("record"))
    quarantine = qa.where(~good).select(
        "request_id", "doc_id", "document_name", "section_idx", "fact_number", "question_type",
        F.lit("missing_key").alias("reason"))
    return rec, quarantine


def split_counts(records: DataFrame) -> DataFrame:
    """Per document: number of train and eval records."""
    return records.groupBy("document_name").agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "eval").alias("n_eval"))


def write_array_files(records: DataFrame, out_dir: str, run_id: str | None = None,
                      sections_per_file: int = 10_000) -> tuple[str, dict[str, int]]:
    """One JSON array for each split and document: ``<split>-<document>-synthetic-data-<run>.json``.

    Every document gets a train and an eval file; a split without records is an
    empty array. Documents of more sections than ``sections_per_file`` go on in
    files with ``.part-<n>`` in their name, so that no task writes a large
    document alone. Returns the run's id and the statistics (G8) that the pass
    over the records observed: the number of records, in all, for each split and
    for each type and difficulty.
    """
    run = run_id or records.sparkSession.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd_HH-mm-ss")).first()[0]
    seen = Observation()
    kinds = [(t, d) for _, t, d in QUESTION_TYPES]
    known = F.concat_ws("/", "question_type", "difficulty").isin(*(f"{t}/{d}" for t, d in kinds))
    r = records.observe(
        seen, F.count(F.lit(1)).alias("records"), *(F.count_if(F.col("split") == x).alias(x) for x in ("train", "eval")),
        *(F.count_if((F.col("question_type") == t) & (F.col("difficulty") == d)).alias(f"{t}/{d}") for t, d in kinds),
        F.count_if(~known).alias("other"))
    rows = r.select("split", "document_name", F.floor(F.col("section_idx") / sections_per_file).cast("int").alias("part"),
                    "record", "section_idx", "question_type", "fact_number")
    both = F.explode(F.array(F.lit("train"), F.lit("eval")))
    none = records.select("document_name").distinct().select(both.alias("split"), "document_name").select(
        "split", "document_name", F.lit(0).alias("part"), F.lit(None).cast("string").alias("record"),
        F.lit(-1).alias("section_idx"), F.lit(None).cast("string").alias("question_type"),
        F.lit(None).cast("int").alias("fact_number"))
    rows = rows.unionByName(none).repartition("split", "document_name", "part").sortWithinPartitions(
        "split", "document_name", "part", "section_idx", "question_type", "fact_number")
    write_arrays(rows.select("split", "document_name", "part", "record"), out_dir, run)
    return run, dict(seen.get)


def write_dataset(records: DataFrame, out_dir: str, run_id: str | None = None,
                  sections_per_file: int = 10_000) -> str:
    """JSON Lines per (split, document): ``out/run=<ts>/split=…/document_name=…/part-*.json``.

    The record goes out as a VARIANT so ``content`` keeps its list-or-string
    shape; partitioning by split and document keeps files the reference's
    one-file-per-(split, document) layout while writing in parallel (A7). Rows
    are dealt by split, document and run of ``sections_per_file`` sections, so the
    number of files follows the documents, not the tasks, and a large document is
    written by several tasks.
    """
    run = run_id or records.sparkSession.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd_HH-mm-ss")).first()[0]
    path = f"{out_dir.rstrip('/')}/run={run}"
    v = F.parse_json("record")
    part = F.floor(F.col("section_idx") / sections_per_file)
    (records.repartition("split", "document_name", part)
     .select("split", "document_name", F.variant_get(v, "$.messages", "variant").alias("messages"),
             "question_type", "difficulty")
     .write.mode("overwrite").partitionBy("split", "document_name").json(path))
    return path
