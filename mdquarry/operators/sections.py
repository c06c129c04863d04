"""Section cutting (B1-B5) and the per-document facts every section carries.

A section starts before every line that begins with one or more ``#`` and a
space (any depth; code fences are not special). Blank sections and sections
containing ``NO_CONTENT_HERE`` are dropped, the rest trimmed and numbered
from 1 in document order.

Document-level values that later stages need per section -- the section
count and the partner section (E5) -- are computed on the document row
*before* the explode, where the whole document already is, and ride along
on every section row. No later stage has to join sections back to a
per-document table on ``doc_id`` alone (a hot-key join when one document is
huge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import header_body, header_title, md5_bucket, strip_ws

SKIP_MARKER = "NO_CONTENT_HERE"


def section_array(content):
    parts = F.split(content, r"(?md)(?=^#+ )", -1)
    kept = F.filter(parts, lambda p: (strip_ws(p) != "") & ~p.contains(SKIP_MARKER))
    return F.transform(kept, strip_ws)


def partner_positions(hashes: Column, doc_id: Column) -> Column:
    """Per section (1-based), another section of the document with different text.

    Candidate = a hash-chosen other position; if its text is the same, the
    first section when its text differs, else the first section whose text
    differs from the first one; null when every section has the same text.
    """
    n = F.size(hashes)
    h1 = F.try_element_at(hashes, F.lit(1))
    other = F.array_position(F.transform(hashes, lambda x: x != h1), True)

    def pick(h, i, m2):
        idx = i + 1
        key = F.concat_ws("|", doc_id.cast("string"), idx.cast("string"), F.lit("partner"))
        cand = ((idx + md5_bucket(key) % F.greatest(n - 1, F.lit(1))) % n + 1).cast("int")
        return (F.when(n < 2, F.lit(None))
                .when(F.try_element_at(hashes, cand) != h, cand)
                .when(h1 != h, F.lit(1))
                .when(m2 > 0, m2.cast("int")))
    # ``other`` scans the document once: it is bound before the sections are walked through
    return F.element_at(F.transform(F.array(other), lambda m: F.transform(hashes, lambda h, i: pick(h, i, m))), 1)


def split_sections(docs: DataFrame, content: str = "content", keep=("doc_id", "document_name")) -> DataFrame:
    """``(…keep, n_sections, section_idx, section, partner_idx, title, body)``, one row per kept section.

    The explode is a per-row generator: no shuffle; rows stay on the
    partition that read their document.
    """
    d = docs.select(*keep, section_array(F.col(content)).alias("section"))
    d = d.withColumn("_h", F.transform("section", F.md5))
    d = d.withColumn("partner", partner_positions(F.col("_h"), F.col("doc_id")))
    s = d.select(*keep, F.size("section").cast("int").alias("n_sections"),
                 F.posexplode(F.arrays_zip("section", "partner")).alias("pos", "z"))
    return s.select(
        *keep, "n_sections",
        (F.col("pos") + 1).cast("int").alias("section_idx"),
        F.col("z.section").alias("section"),
        F.col("z.partner").cast("int").alias("partner_idx"),
        header_title(F.col("z.section")).alias("title"),
        header_body(F.col("z.section")).alias("body"),
    )


def by_document(sections: DataFrame, name: str) -> DataFrame:
    """doc_id, ``name``: the rows of section i are element i of the array, itself an array (a document may come twice).

    For documents whose sections fit into a row.
    """
    rows = sections.repartition("doc_id").groupBy("doc_id").agg(F.collect_list(F.struct(
        "section_idx", *(c for c in sections.columns if c not in ("doc_id", "section_idx")))).alias("_all"))
    numbers = F.sequence(F.lit(1), F.array_max(F.transform("_all", lambda x: x["section_idx"])))
    return rows.select("doc_id", F.transform(numbers, lambda i: F.filter("_all", lambda x: x["section_idx"] == i)).alias(name))
