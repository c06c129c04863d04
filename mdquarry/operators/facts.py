"""Fact extraction.

A section body is cut into paragraphs at blank lines. A paragraph that
starts with a list marker (``1.``, ``*``, ``-`` followed by whitespace) yields
one fact per list item, continuation lines joined with one space (text
before the first item line is dropped). Any other paragraph yields its
sentences. Facts of 10 characters or fewer are dropped; when nothing is left
and the body is not empty, the whole body is the one fact.

Everything is an array expression inside one row (``split`` / ``transform``
/ ``filter`` / ``flatten``), so facts are produced where the section lives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DIGIT, GUARD, JOIN, SEP, WS, lstrip_ws, strip_ws

# The patterns decide what a list, an item and a sentence is.
MARKER = f"({DIGIT}+\\.|\\*|-)"
LIST_PARAGRAPH = f"^{WS}*{MARKER}{WS}"
ITEM_LINE = f"^{MARKER}{WS}"
ITEM_PREFIX = f"^{MARKER}{WS}+"
MIN_FACT_CHARS = 10


def sentences(text: Column) -> Column:
    """Sentence split after ``.``/``!``/``?`` + whitespace, with ``x.y.``
    abbreviations and decimals protected, and a piece starting with a
    lower-case letter re-joined to the previous one with a single space."""
    t = F.regexp_replace(text, r"([\p{L}\p{N}_]\.[\p{L}\p{N}_]\.)", "$1" + GUARD)
    t = F.regexp_replace(t, f"({DIGIT}+\\.{DIGIT}+)", "$1" + GUARD)
    t = F.regexp_replace(t, r"([A-Za-z]\.[A-Za-z]\.)", "$1" + GUARD)
    t = F.regexp_replace(t, f"([.!?]){WS}+([a-z])", "$1" + JOIN + "$2")
    t = F.regexp_replace(t, f"([.!?]){WS}+", "$1" + SEP)
    t = F.replace(F.replace(t, F.lit(GUARD), F.lit("")), F.lit(JOIN), F.lit(" "))
    return F.filter(F.split(t, SEP, -1), lambda s: strip_ws(s) != "")


def _item_lines(paragraph: Column) -> Column:
    return F.filter(F.transform(F.split(paragraph, "\n", -1), strip_ws), lambda l: l != "")


def list_items(paragraph: Column) -> Column:
    """One fact per list item; continuation lines appended with a space."""
    lines = _item_lines(paragraph)
    marked = F.transform(lines, lambda l: F.when(
        l.rlike(ITEM_LINE), F.concat(F.lit(SEP), F.regexp_replace(l, ITEM_PREFIX, ""))).otherwise(l))
    chunks = F.split(F.array_join(marked, "\n"), SEP, -1)
    items = F.filter(chunks, lambda c, i: i > 0)  # text before the first item line is dropped
    return F.transform(items, lambda c: F.replace(F.regexp_replace(c, "\n$", ""), F.lit("\n"), F.lit(" ")))


def list_items_linked(paragraph: Column) -> Column:
    """Documented variant: an indented item becomes ``"parent - item"`` (option ``link_parents``).

    The parent is the first line of the nearest item before it that is indented
    less; a stack of the open items is carried through one ``aggregate``, so lists
    may be nested to any depth. An indented item without such an item before it
    has an empty parent.
    """
    raw = F.filter(F.split(paragraph, "\n", -1), lambda l: strip_ws(l) != "")
    marked = F.transform(raw, lambda l: F.when(
        strip_ws(l).rlike(ITEM_LINE),
        F.concat(F.lit(SEP), (F.length(l) - F.length(lstrip_ws(l))).cast("string"), F.lit(":"),
                 F.regexp_replace(strip_ws(l), ITEM_PREFIX, ""))).otherwise(strip_ws(l)))
    chunks = F.split(F.array_join(marked, "\n"), SEP, -1)
    items = F.transform(F.filter(chunks, lambda c, i: i > 0), lambda c: F.split(c, ":", 2))
    flat = F.transform(items, lambda c: F.struct(
        F.get(c, 0).cast("int").alias("indent"),
        F.regexp_extract(F.get(c, 1), r"^([^\n]*)", 1).alias("head"),
        F.replace(F.regexp_replace(F.get(c, 1), "\n$", ""), F.lit("\n"), F.lit(" ")).alias("text"),
    ))
    start = F.struct(F.array().cast("array<struct<indent:int,head:string>>").alias("open"),
                     F.array().cast("array<string>").alias("out"))

    def step(acc, it):
        shallower = F.filter(acc["open"], lambda p: p["indent"] < it["indent"])
        parent = F.coalesce(F.try_element_at(shallower, F.lit(-1))["head"], F.lit(""))
        return F.struct(
            F.concat(shallower, F.array(F.struct(it["indent"].alias("indent"), it["head"].alias("head")))).alias("open"),
            F.concat(acc["out"], F.array(F.when(it["indent"] > 0, F.concat(parent, F.lit(" - "), it["text"]))
                                         .otherwise(it["text"]))).alias("out"))
    return F.aggregate(flat, start, step)["out"]


def paragraphs(body: Column) -> Column:
    return F.filter(F.transform(F.split(body, f"\n{WS}*\n", -1), strip_ws), lambda p: p != "")


def candidate_facts(body: Column, link_parents: bool = False) -> Column:
    """List items and sentences of every paragraph, trimmed, longer than 10 characters."""
    items = list_items_linked if link_parents else list_items
    per_para = F.transform(paragraphs(body), lambda p: F.when(
        p.rlike(LIST_PARAGRAPH), items(p)).otherwise(sentences(p)))
    return F.filter(F.transform(F.flatten(per_para), strip_ws), lambda f: F.length(f) > MIN_FACT_CHARS)


def with_fact_array(sections: DataFrame, link_parents: bool = False) -> DataFrame:
    """Adds ``facts``. Two projections on purpose: the candidate array is used
    twice by the fallback rule and must be computed once (the optimizer does not
    inline an expensive expression into several references)."""
    s = sections.withColumn("_facts", candidate_facts(F.col("body"), link_parents))
    return s.withColumn("facts", F.when((F.size("_facts") == 0) & (F.col("body") != ""), F.array("body"))
                        .otherwise(F.col("_facts"))).drop("_facts")


def explode_facts(sections: DataFrame, link_parents: bool = False,
                  keep=("doc_id", "document_name", "section_idx")) -> DataFrame:
    """``(…keep, fact_number, fact)``, 0-based fact numbers in document order."""
    src = sections if "facts" in sections.columns else with_fact_array(sections, link_parents)
    return src.select(*keep, F.posexplode("facts").alias("fact_number", "fact")).withColumn(
        "fact_number", F.col("fact_number").cast("int"))
