"""Model requests: question-type grid, sampling, partner sections, prompt
rendering and chat payloads (E1-E14).

Plan shape: every per-section input (metadata, neighbours, images, seed
fact, partner) is joined once at *section* grain; the 13 section-level
question types are then generated with ``explode`` over an array literal
(no cross join, no broadcast), and the fact-level type is one row per fact.
Prompts are a single ``CASE`` projection over the compiled templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import md5_bucket
from ..plans.templates import (COMMON_PARTS, DEFAULT_TITLE_A, DEFAULT_TITLE_B, QUESTION_TYPES, RECALL_TYPE,
                               SLOTS, SUMMARY_TYPE, SYSTEM_PROMPT, TEMPLATES, compile_template, unit_of)

BATCH_SIZE = 100
MAX_TYPES = 1000  # rows of a table of further question types


def question_types_df(spark: SparkSession) -> DataFrame:
    """Dimension table (ordinal, question_type, difficulty, unit)."""
    return spark.createDataFrame([(o, t, d, unit_of(t)) for o, t, d in QUESTION_TYPES],
                                 "ordinal int, question_type string, difficulty string, unit string")


def request_id(doc_id: Column, section_idx: Column, question_type: Column, fact_number: Column) -> Column:
    return F.md5(F.concat_ws("|", doc_id.cast("string"), section_idx.cast("string"), question_type,
                             fact_number.cast("string")))


def unit(question_type: tuple) -> str:
    """Unit of a type: its fourth field, or that of the catalogue."""
    return question_type[3] if len(question_type) > 3 else unit_of(question_type[1])


def _type_array(types) -> Column:
    return F.array(*[F.struct(F.lit(x[0]).alias("ordinal"), F.lit(x[1]).alias("question_type"),
                              F.lit(x[2]).alias("difficulty"), F.lit(unit(x)).alias("unit")) for x in types])


def types_from_table(table: DataFrame) -> tuple[tuple[str, str, str, str], ...]:
    """``Corpus(extra_types=...)`` from a table (question_type, difficulty, unit, template), in order of the type's name.

    The unit is ``section``, ``pair`` (sections with a partner) or ``fact``; the template is a task text
    with the slots of ``templates.SLOTS``. The table is a dimension that becomes part of the plan: more than
    ``MAX_TYPES`` rows, a name twice or of the catalogue, a null, another unit or another slot are errors.
    """
    rows = [tuple(r) for r in table.select("question_type", "difficulty", "template", "unit").limit(MAX_TYPES + 1).collect()]
    if len(rows) > MAX_TYPES:
        raise ValueError(f"more than {MAX_TYPES} question types")
    names = [r[0] for r in rows] + [t for _, t, _ in QUESTION_TYPES]
    if len(set(names)) < len(names):
        raise ValueError("question types must have different names, none of the catalogue's")
    for name, difficulty, template, unit in rows:
        if None in (name, difficulty, template) or unit not in ("section", "pair", "fact"):
            raise ValueError(f"question type {name}: difficulty, template and a unit (section, pair, fact) are needed")
        other = {slot for _, slot in compile_template(template) if slot} - set(SLOTS)
        if other:
            raise ValueError(f"question type {name}: unknown slots {sorted(other)}")
    return tuple(sorted(rows))


def seed_fact(section_facts: DataFrame) -> DataFrame:
    """(doc_id, section_idx, seed_fact): a hash-sampled fact, else the body."""
    key = F.concat_ws("|", F.col("doc_id").cast("string"), F.col("section_idx").cast("string"), F.lit(RECALL_TYPE))
    pick = F.try_element_at("facts", (md5_bucket(key) % F.greatest(F.size("facts"), F.lit(1)) + 1).cast("int"))
    return section_facts.select("doc_id", "section_idx", F.when(F.size("facts") > 0, pick).otherwise(
        F.col("body")).alias("seed_fact"))


def partners(sections: DataFrame) -> DataFrame:
    """(doc_id, section_idx, partner_idx) for sections that have a partner.

    The partner is chosen on the document row by
    :func:`mdquarry.operators.sections.partner_positions` and carried on each
    section, so this is a projection: no pair list, no join.
    """
    return sections.where(F.col("partner_idx").isNotNull()).select("doc_id", "section_idx", "partner_idx")


def common_instructions(doc_title: Column) -> Column:
    return F.concat(*[p for lit, slot in COMMON_PARTS
                      for p in ([F.lit(lit)] if lit else []) + ([doc_title] if slot else [])])


def render(slots: dict[str, Column], question_type: Column, templates: dict | None = None) -> Column:
    """One CASE over the compiled templates; every slot must be non-null."""
    expr = None
    for t, parts in (templates or TEMPLATES).items():
        pieces = []
        for lit, slot in parts:
            if lit:
                pieces.append(F.lit(lit))
            if slot:
                pieces.append(slots[slot])
        body = F.concat(*pieces)
        expr = F.when(question_type == t, body) if expr is None else expr.when(question_type == t, body)
    return expr


def section_requests(ctx: DataFrame, types=QUESTION_TYPES) -> DataFrame:
    """Section-level and pair-level requests from the section context table.

    ctx must hold: doc_id, document_name, section_idx, partner_idx (nullable)
    and the slot columns used by :func:`render`.
    """
    types = [t for t in types if unit(t) != "fact"]
    g = ctx.withColumn("qt", F.explode(_type_array(types)))
    g = g.where((F.col("qt.unit") != "pair") | F.col("partner_idx").isNotNull())
    return g.select("*", F.col("qt.question_type").alias("question_type"), F.col("qt.difficulty").alias("difficulty"),
                    F.col("qt.ordinal").alias("ordinal"), F.lit(None).cast("int").alias("fact_number")).drop("qt")


def fact_requests(facts_ctx: DataFrame, types=QUESTION_TYPES) -> DataFrame:
    """One request for each fact and fact-level type."""
    qt = F.explode(_type_array([t for t in types if unit(t) == "fact"])).alias("qt")
    return facts_ctx.select("*", qt).select("*", "qt.question_type", "qt.difficulty", "qt.ordinal").drop("qt")


def finish(req: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Adds request_id, is_summary, batch_id: runs of ``batch_size`` sections."""
    return req.withColumn(
        "request_id", request_id(F.col("doc_id"), F.col("section_idx"), F.col("question_type"), F.col("fact_number"))
    ).withColumn(
        "is_summary", F.when(F.col("question_type") == SUMMARY_TYPE, F.lit(True))
    ).withColumn("batch_id", F.floor((F.col("section_idx") - 1) / batch_size).cast("int"))


def grid(sections: DataFrame, types=QUESTION_TYPES, batch_size: int = BATCH_SIZE, extra: tuple = ()) -> DataFrame:
    """All requests of the sections, without prompts (E1-E3, E12, E13): generators over the section row, no join.

    ``sections`` holds doc_id, document_name, section_idx, partner_idx, n_facts and the ``extra`` columns, which
    ride along.
    """
    keys = ["doc_id", "document_name", "section_idx"]
    cols = [*keys, "fact_number", "question_type", "difficulty", "ordinal", "unit_size", *extra]
    s = sections.select(*keys, "partner_idx", F.lit(1).alias("unit_size"), *extra)
    f = sections.where(F.col("n_facts") > 0).select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("n_facts") - 1)).alias("fact_number"),
        F.col("n_facts").alias("unit_size"), *extra)
    return finish(section_requests(s, types).select(*cols).unionByName(fact_requests(f, types).select(*cols)), batch_size)


def payload(prompt: Column, images: Column) -> Column:
    """``{text, images?}`` request payload."""
    return F.struct(prompt.alias("text"), F.when(F.size(images) > 0, images).alias("images"))


def with_data_urls(requests: DataFrame, urls: DataFrame) -> DataFrame:
    """Adds ``image_urls``: the data URL of each of the request's images, in order; unreadable ones are left out.

    ``urls`` holds (image_path, data_url), see ``operators.images.data_urls``.
    """
    each = requests.select("request_id", F.posexplode("images").alias("pos", "image_path"))
    found = each.join(urls, "image_path").groupBy("request_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "data_url"))), lambda x: x["data_url"]).alias("image_urls"))
    return requests.join(found, "request_id", "left").withColumn(
        "image_urls", F.coalesce("image_urls", F.array().cast("array<string>")))


def chat_request_json(prompt: Column, images: Column, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """Chat request JSON: a system message, then the user's text part and one
    image part per entry of ``images`` -- paths, or the data URLs of
    :func:`with_data_urls` (E14).

    Null struct fields are omitted by ``to_json``, so one part type serves
    both text and image parts.
    """
    def img(p):
        return F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
                        F.struct(p.alias("url")).alias("image_url"))
    text_part = F.struct(F.lit("text").alias("type"), prompt.alias("text"),
                         F.lit(None).cast("struct<url:string>").alias("image_url"))
    user = F.concat(F.array(text_part), F.transform(images, img))
    sys_msg = F.to_json(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")))
    user_msg = F.to_json(F.struct(F.lit("user").alias("role"), user.alias("content")))
    return F.concat(F.lit("["), sys_msg, F.lit(","), user_msg, F.lit("]"))


__all__ = ["question_types_df", "seed_fact", "partners", "render", "section_requests", "fact_requests", "finish", "grid", "types_from_table",
           "payload", "chat_request_json", "common_instructions", "DEFAULT_TITLE_A", "DEFAULT_TITLE_B"]
