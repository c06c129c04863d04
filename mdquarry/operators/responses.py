"""Model responses: JSON extraction, strict parsing, all-or-nothing units,
retry bookkeeping and the pluggable responder (F1-F12).

Key idea: retries are *data*, not driver state. Every response row carries
its ``attempt`` number; a *unit* is ``(doc_id, section_idx, question_type)``
-- one request for section-level types, all facts of the section for
``FACT_BASED`` (which succeed or fail together). A unit's first attempt in
which every request parsed is its success; earlier attempts are its
failures. All of it is joins and group-bys keyed by unit; a unit's answers
are counted one after another, so however many facts it has, none is held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_RETRIES = 50
UNIT = ["doc_id", "section_idx", "question_type"]
PARSED_FIELDS = "array<struct<question:string,question_images:string,answer:string>>"
ERRORS = ["bad_json", "no_json", "no_response"]  # in order of their names: the first one of a fact counts
OBJECT = r'\A\{[ \t\n\r]*["}]'  # how JSON objects begin
CONTROL_CHARS = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]"


def json_substring(text: Column) -> Column:
    """First ``{`` to last ``}``; '' when there is none or they are reversed (F2)."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def sanitize(text: Column) -> Column:
    """Drop control characters except tab, LF, CR (F4; optional, off by default)."""
    return F.regexp_replace(text, CONTROL_CHARS, "")


def parse(responses: DataFrame, sanitize_text: bool = False) -> DataFrame:
    """(request_id, attempt, status, question, answer, question_images, has_question, has_answer).

    status: ``ok`` | ``no_response`` (null text) | ``no_json`` | ``bad_json``.
    Strict parsing: the object is wrapped in ``[...]`` so trailing data fails,
    single quotes are refused, and exactly one element must come back (F3).
    Step-wise projections keep each JSON parse to one evaluation per row
    (subexpression elimination does not reach into CASE branches).
    """
    return _parse(one_per_attempt(responses), sanitize_text)


def _parse(responses: DataFrame, sanitize_text: bool) -> DataFrame:
    """:func:`parse` of rows that come once for each attempt; their other columns stay beside the parsed ones."""
    text = sanitize(F.col("text")) if sanitize_text else F.col("text")
    more = [c for c in responses.columns if c not in ("request_id", "attempt", "text")]
    d = responses.select("request_id", "attempt", *more, F.col("text").isNull().alias("_null"), json_substring(text).alias("_js"))
    # what no JSON object begins with is not parsed: a parser's exception costs many times a row
    d = d.withColumn("_arr", F.when(F.col("_js").rlike(OBJECT), F.from_json(
        F.concat(F.lit("["), F.col("_js"), F.lit("]")), PARSED_FIELDS, {"allowSingleQuotes": "false"})))
    d = d.withColumn("status", F.when(F.col("_null"), F.lit("no_response"))
                     .when(F.col("_js") == "", F.lit("no_json"))
                     .when(F.col("_arr").isNull() | (F.size("_arr") != 1), F.lit("bad_json"))
                     .otherwise(F.lit("ok")))
    ok = F.col("status") == "ok"
    d = d.withColumn("_obj", F.when(ok, F.col("_arr")[0]))
    d = d.withColumn("_keys", F.when(ok, F.json_object_keys("_js")))
    raw_imgs, none = F.col("_obj.question_images"), F.array().cast("array<string>")
    imgs = (F.when(raw_imgs.isNull() | (raw_imgs == "[]"), none)
            .when(F.ltrim(raw_imgs).startswith("["), F.coalesce(F.from_json(raw_imgs, "array<string>"),
                                                                F.array(raw_imgs)))
            .otherwise(F.array(raw_imgs)))
    return d.select(
        "request_id", "attempt", "status",
        F.col("_obj.question").alias("question"),
        F.col("_obj.answer").alias("answer"),
        F.when(ok, imgs).alias("question_images"),
        F.array_contains("_keys", "question").alias("has_question"),
        F.array_contains("_keys", "answer").alias("has_answer"), *more,
    )


DEAL = 2  # tasks of the settled answers for each shuffle partition: a task holds several sorts of its wide rows
NO_MD5 = bytes(17)  # goes before the bytes of a packed id that is no MD5: longer than any MD5's 16 bytes


def packed(request_id: Column) -> Column:
    """An id as bytes, 16 for the hexadecimal digits of an MD5: it is most of a row that is dealt by request."""
    return F.when(request_id.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(request_id)).otherwise(
        F.concat(F.lit(NO_MD5), request_id.cast("binary")))


def unpacked(request_id: Column) -> Column:
    """The reverse of :func:`packed`."""
    return F.when(F.length(request_id) == 16, F.lower(F.hex(request_id))).otherwise(
        F.substring(request_id, len(NO_MD5) + 1, 1 << 30).cast("string"))


def one_per_attempt(responses: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per (request_id, attempt): responders may deliver an answer twice.

    Of different texts the smallest is kept, a text before none. Rows are dealt by
    request once, before they are sorted: the join with the requests needs no second shuffle.
    ``parts`` fixes the number of tasks, which adaptive execution lowers otherwise.
    """
    responses = responses.repartition(*([parts] if parts else []), "request_id")
    return responses.groupBy("request_id", F.col("attempt").cast("int").alias("attempt")).agg(F.min("text").alias("text"))


def answered(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """Parsed responses with the columns of their request; one join on the request id, no hot key.

    ``requests`` carry ``unit_size``, the number of requests of their unit.
    """
    return _with_request(requests, parsed)


def _with_request(requests: DataFrame, rows: DataFrame, *more: str) -> DataFrame:
    req = requests.select("request_id", *UNIT, "document_name", "fact_number", "difficulty", "is_summary", "unit_size", *more)
    return rows.join(req, "request_id")


def _first(error: Column) -> Column:
    """Fact number (none: first) and place of the error in one number that orders as they do: minima of numbers
    are found by hashing, those of texts by sorting every row."""
    return F.shiftleft(F.coalesce("fact_number", F.lit(-1)).cast("bigint") + 1, 2) + error.cast("bigint")


PAIR = ["document_name", "difficulty", "is_summary", "question", "answer", "question_images", "has_question", "has_answer"]


def settled(requests: DataFrame, responses: DataFrame, sanitize_text: bool = False) -> DataFrame:
    """Unit attempts (``is_attempt``: ok, short, first_bad, first_ok, last_attempt) and pairs of a unit's first
    successful attempt (``is_pair``: request_id, fact_number and the columns ``PAIR``); a row can be both.

    An attempt is ok if all ``unit_size`` requests of the unit parsed, short if answers are missing. A unit without
    fact numbers is one request: its attempts are counted where its responses met it, and no row moves again.
    Answers of facts are dealt by unit once; a unit's rows are sorted and counted there, those that do not fit
    into memory on disk. Answers that are no pair hold no text.

    Ids are packed on the way. The number of tasks is fixed: tasks that adaptive execution merges up to its advisory
    size hold several sorts of rows that take many times their shuffled bytes in memory, and spill them.
    """
    parts = DEAL * int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = packed(F.col("request_id"))
    responses = one_per_attempt(responses.withColumn("request_id", short), parts)
    requests = requests.withColumn("request_id", short)
    bad = F.when(F.col("status") != "ok", _first(F.array_position(F.lit(ERRORS), F.col("status"))))

    def told(rows: DataFrame) -> DataFrame:
        d = rows.withColumn("is_pair", F.coalesce(F.col("attempt") == F.col("first_ok"), F.lit(False)))
        return d.where(F.col("is_attempt") | F.col("is_pair")).select(
            unpacked(F.col("request_id")).alias("request_id"), *UNIT, "attempt", "fact_number", "is_attempt", "ok", "short", "first_bad", "first_ok",
            "last_attempt", "is_pair", *(F.when(F.col("is_pair"), F.col(c)).alias(c) for c in PAIR))

    # a unit of one request: rows that repeat it are counted among the requests, which are narrow; all of them meet the
    # same answers, so what their attempts come to is found by request, in the order that the join leaves
    same = Window.partitionBy("request_id", *UNIT).orderBy("fact_number")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    single = requests.where(F.col("fact_number").isNull()).repartition(parts, "request_id").withColumns({
        "_rows": F.count(F.lit(1)).over(whole), "_size": F.max("unit_size").over(whole), "_number": F.row_number().over(same)})
    d = _parse(_with_request(single, responses, "_rows", "_size", "_number"), sanitize_text)
    by_request, good = Window.partitionBy("request_id"), F.col("status") == "ok"
    d = d.withColumns({"_first": F.min(F.when(good, F.col("attempt"))).over(by_request),
                       "last_attempt": F.max("attempt").over(by_request)})
    d = d.withColumns({"is_attempt": F.col("_number") == 1, "ok": F.when(good, F.col("_rows")).otherwise(F.lit(0)) == F.col("_size"),
                       "short": F.col("_rows") < F.col("_size"), "first_bad": bad,
                       "first_ok": F.when(F.col("_rows") == F.col("_size"), F.col("_first"))})

    facts = _parse(_with_request(requests.where(F.col("fact_number").isNotNull()), responses), sanitize_text)
    attempt, unit = Window.partitionBy(*UNIT, "attempt").orderBy("fact_number"), Window.partitionBy(*UNIT)
    every = attempt.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    f = facts.repartition(parts, *UNIT).withColumns({
        "is_attempt": F.row_number().over(attempt) == 1,
        "ok": F.count_if(F.col("status") == "ok").over(every) == F.max("unit_size").over(every),
        "short": F.count(F.lit(1)).over(every) < F.max("unit_size").over(every), "first_bad": F.min(bad).over(every)})
    f = f.withColumns({"first_ok": F.min(F.when(F.col("ok"), F.col("attempt"))).over(unit),
                       "last_attempt": F.max("attempt").over(unit)})
    return told(d).unionByName(told(f))


def _outcomes(units: DataFrame, requests: DataFrame, answers: DataFrame, keep=None, *more: str) -> DataFrame:
    """Unit attempts with the fact number and the error of their first bad request.

    The first request without an answer is looked up for those attempts only in which
    answers are missing. ``keep`` writes what was looked up; with it ``units`` are written
    already, so that nothing is looked up (and no request shuffled) where no answer is missing.
    """
    def worded(d: DataFrame, worst: Column) -> DataFrame:
        fact = (F.shiftright(worst, 2) - 1).cast("int")
        return d.select(*UNIT, "attempt", "ok", F.when(fact >= 0, fact).alias("fact_number"),
                        F.get(F.lit(ERRORS), (worst.bitwiseAND(3) - 1).cast("int")).alias("error"), *more)

    if keep is not None and units.where("short").isEmpty():
        return worded(units, F.col("first_bad"))
    short = units.where("short").select(*UNIT, "attempt")
    expected = short.join(requests.select(*UNIT, "request_id", "fact_number"), UNIT)
    missing = expected.join(answers.select("request_id", "attempt"), ["request_id", "attempt"], "left_anti")
    missing = missing.groupBy(*UNIT, "attempt").agg(F.min(
        _first(F.lit(1 + ERRORS.index("no_response")))).alias("first_missing"))
    found = worded(units.join(missing, [*UNIT, "attempt"], "left"), F.least("first_bad", "first_missing"))
    return found if keep is None else keep(found, "outcomes")


def unit_outcomes(answers: DataFrame, requests: DataFrame, keep=None) -> DataFrame:
    """(unit…, attempt, ok, fact_number, error): one row per unit attempt.

    An attempt is ok if all ``unit_size`` requests of the unit parsed. ``keep`` writes the attempts.
    """
    # dealt by unit before they are counted: maps of whole input splits, mostly units of one request, would be spilled
    rows = answers.select(*UNIT, "attempt", "fact_number", "status", "unit_size").repartition(*UNIT)
    bad = F.when(F.col("status") != "ok", _first(F.array_position(F.lit(ERRORS), F.col("status"))))
    units = rows.groupBy(*UNIT, "attempt").agg(
        (F.count_if(F.col("status") == "ok") == F.max("unit_size")).alias("ok"),
        (F.count(F.lit(1)) < F.max("unit_size")).alias("short"), F.min(bad).alias("first_bad"))
    return _outcomes(units if keep is None else keep(units, "units"), requests, answers, keep)


def settled_outcomes(rows: DataFrame, requests: DataFrame, parsed: DataFrame, keep=None) -> DataFrame:
    """:func:`unit_outcomes` with their unit's first_ok and last_attempt, from the rows of :func:`settled`.

    ``keep`` writes the attempts.
    """
    units = rows.where("is_attempt").select(*UNIT, "attempt", "ok", "short", "first_bad", "first_ok", "last_attempt")
    return _outcomes(units if keep is None else keep(units, "units"), requests, parsed, keep, "first_ok", "last_attempt")


def settled_firsts(outcomes: DataFrame) -> DataFrame:
    """:func:`first_success` of settled outcomes: what the unit's last attempt tells, no grouping."""
    return outcomes.where(F.col("attempt").eqNullSafe(F.col("last_attempt"))).select(*UNIT, "first_ok", "last_attempt")


def _named(d: DataFrame) -> DataFrame:
    """Rows of units that have a whole key: only these meet their unit in a join."""
    for c in UNIT:
        d = d.where(F.col(c).isNotNull())
    return d


def settled_failures(outcomes: DataFrame) -> DataFrame:
    """:func:`failures` of settled outcomes: no join."""
    return _failed_before(_named(outcomes))


def settled_pairs(rows: DataFrame) -> DataFrame:
    """:func:`qa_rows` of the rows of :func:`settled`: no join."""
    return _named(rows.where("is_pair")).select("request_id", *UNIT, "attempt", "fact_number", *PAIR)


def settled_still_failing(outcomes: DataFrame) -> DataFrame:
    """:func:`still_failing` of settled outcomes: the last attempt of units without a success, no grouping."""
    last = _named(outcomes).where(F.col("first_ok").isNull() & F.col("attempt").eqNullSafe(F.col("last_attempt")))
    numbered = F.col("attempt").isNotNull()  # of attempts without a number none is the last
    return last.select(*UNIT, F.col("last_attempt").alias("attempts"), F.when(numbered, F.col("error")).alias("last_error"),
                       F.when(numbered, F.col("fact_number")).alias("fact_number"))


def first_success(outcomes: DataFrame) -> DataFrame:
    """(unit…, first_ok, attempts): earliest all-ok attempt per unit."""
    return outcomes.groupBy(*UNIT).agg(F.min(F.when(F.col("ok"), F.col("attempt"))).alias("first_ok"),
                                       F.max("attempt").alias("last_attempt"))


def failures(outcomes: DataFrame, firsts: DataFrame) -> DataFrame:
    """Failed unit attempts before the first success (all of them if none)."""
    return _failed_before(outcomes.join(firsts, UNIT))


def _failed_before(j: DataFrame) -> DataFrame:
    return j.where(~F.col("ok") & (F.col("first_ok").isNull() | (F.col("attempt") < F.col("first_ok")))) \
        .select(*UNIT, "attempt", "fact_number", "error")


def qa_rows(answers: DataFrame, firsts: DataFrame) -> DataFrame:
    """Parsed pairs of each unit's first successful attempt, request metadata merged."""
    j = answers.join(firsts.where(F.col("first_ok").isNotNull()), UNIT)
    return j.where(F.col("attempt") == F.col("first_ok")).drop("first_ok", "last_attempt", "status", "unit_size")


def still_failing(outcomes: DataFrame, firsts: DataFrame) -> DataFrame:
    """Units with no success within the cap, with their last error."""
    failed = outcomes.where(~F.coalesce("ok", F.lit(False)))  # all attempts of such a unit
    last = failed.groupBy(*UNIT).agg(F.max_by(F.struct("error", "fact_number"), "attempt").alias("l"))
    return firsts.where(F.col("first_ok").isNull()).join(last, UNIT).select(
        *UNIT, F.col("last_attempt").alias("attempts"), F.col("l.error").alias("last_error"),
        F.col("l.fact_number").alias("fact_number"))


def pending(requests: DataFrame, firsts: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Requests still to ask, with the attempt number to use (F9, F12 resume):
    units never answered (attempt 1) and failed units with attempts left."""
    j = requests.join(firsts, UNIT, "left")
    nxt = F.coalesce(F.col("last_attempt"), F.lit(0)) + 1
    return j.where(F.col("first_ok").isNull() & (nxt <= 1 + max_retries)).select(
        *requests.columns, nxt.cast("int").alias("next_attempt")).drop("first_ok", "last_attempt")


Responder = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
RESPONSE_SCHEMA = "request_id string, attempt int, text string"


def respond(pending_requests: DataFrame, responder: Responder) -> DataFrame:
    """Run a user responder over pending requests (F1).

    The responder is a ``mapInPandas`` function: it receives Arrow batches of
    ``(request_id, attempt, prompt, images)`` and yields
    ``(request_id, attempt, text)``. Model calls stay outside Spark's
    planner; batches are as large as ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    src = pending_requests.select("request_id", F.col("next_attempt").alias("attempt"), "prompt", "images")
    return src.mapInPandas(responder, RESPONSE_SCHEMA)


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def run_live(requests: DataFrame, responder: Responder, responses_path: str,
             max_retries: int = MAX_RETRIES) -> DataFrame:
    """Ask, parse and re-ask until every unit succeeds or the cap is reached.

    Each pass writes its answers to ``responses_path/pass=<n>`` *before* parsing,
    so a run that starts again with the same path asks nothing twice (F12). The
    answers on disk are parsed once at the start; then only those of the pass
    just made are, and the next pass asks the units it left open. The driver
    only loops over passes (at most ``1 + max_retries``) and makes one emptiness
    test for each; rows never leave the executors.
    """
    spark = requests.sparkSession
    base = responses_path.rstrip("/")

    def firsts(responses):
        answers = answered(requests, parse(responses))
        return first_success(unit_outcomes(answers, requests))

    done = 0
    todo = requests.withColumn("next_attempt", F.lit(1))
    if _exists(spark, base):
        # the number of a pass is part of its path; a pass that was cut short left no answers
        old = spark.read.schema(f"{RESPONSE_SCHEMA}, pass int").parquet(base)
        done = old.agg(F.coalesce(F.max("pass"), F.lit(0))).first()[0]
        todo = pending(requests, firsts(old), max_retries)
    while done <= max_retries:
        todo = todo.checkpoint()
        if todo.isEmpty():
            break
        done += 1
        path = f"{base}/pass={done}"
        respond(todo, responder).write.mode("overwrite").parquet(path)
        new = firsts(spark.read.schema(RESPONSE_SCHEMA).parquet(path))
        # units that this pass did not finish are asked once more
        open_ = todo.join(new.where(F.col("first_ok").isNotNull()).select(*UNIT), UNIT, "left_anti")
        todo = open_.where(F.col("next_attempt") <= max_retries).withColumn(
            "next_attempt", F.col("next_attempt") + 1)
    return spark.read.schema(RESPONSE_SCHEMA).parquet(base) if done else spark.createDataFrame([], RESPONSE_SCHEMA)
