"""Deterministic markdown corpus derived from the driver's ``documents`` table.

The raw ``documents.text`` has no headers, lists, blank lines, image
references or frontmatter, so the pipeline would have nothing to cut. This
view rewrites every text into markdown with plain column expressions (the
same rules are expressed in the DuckDB oracle, see ``plans/oracle.py``):

line ``i`` (0-based) of the text becomes

* ``i % 4 == 0``: a header of depth ``1 + (i div 4) % 3`` carrying the first 60
  characters of the line, then the line; ``i % 28 == 4`` also appends the
  ``NO_CONTENT_HERE`` marker,
* ``i % 4 == 1``: a new paragraph,
* ``i % 4 == 2``: a bulleted list, one bullet per ``. `` sentence break; every
  bullet after the first is indented in documents with ``doc_id % 4 == 1``; in
  those with ``doc_id % 8 == 5`` every `` the `` ends an item and opens one of a
  third level,
* ``i % 4 == 3``: a continuation line of the last bullet; documents with
  ``doc_id % 5 == 0`` get an image reference ``{{FIGURE_<doc_id % 7>.<i>}}``.

Frontmatter by ``doc_id``: none (``% 3 == 0``), a ``---`` inside the title
value (``% 30 == 1``), never closed (``% 30 == 2``), a list of keywords
(``% 30 == 4``), nested keys and lists of mappings (``% 30 == 8``), folded and
literal values (``% 30 == 10``), a block that does not parse (``% 30 == 7``: a line
that is no mapping, a key below a value, or a key between two indentations), else
title/lang/source.

The manifest of existing image files and the model responses are derived
the same way, so every stage grows with the input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import md5_bucket
from .tables import spread, table


def md_documents(documents: DataFrame) -> DataFrame:
    """``(doc_id, document_name, raw)``: one markdown file per document row."""
    d = documents.select("doc_id", "text", "lang", "source")
    lines = F.split(F.col("text"), "\n", -1)

    def render(line, i):
        depth = (F.lit(1) + F.floor(i / 4) % 3).cast("int")
        header = F.concat(
            F.repeat(F.lit("#"), depth), F.lit(" "), F.substring(line, 1, 60), F.lit("\n"), line,
            F.when(i % 28 == 4, F.lit(" NO_CONTENT_HERE")).otherwise(F.lit("")),
        )
        para = F.concat(F.lit("\n"), line)
        items = F.replace(line, F.lit(". "), F.when(
            F.col("doc_id") % 4 == 1, F.lit(".\n  - ")).otherwise(F.lit(".\n- ")))
        bullets = F.concat(F.lit("\n- "), F.when(
            F.col("doc_id") % 8 == 5, F.replace(items, F.lit(" the "), F.lit(" the\n    - "))).otherwise(items))
        cont = F.concat(
            line,
            F.when(
                F.col("doc_id") % 5 == 0,
                F.concat(F.lit(" {{FIGURE_"), (F.col("doc_id") % 7).cast("string"), F.lit("."),
                         i.cast("string"), F.lit("}}")),
            ).otherwise(F.lit("")),
        )
        return (F.when(i % 4 == 0, header).when(i % 4 == 1, para)
                .when(i % 4 == 2, bullets).otherwise(cont))

    body = F.array_join(F.transform(lines, render), "\n")
    did = F.col("doc_id").cast("string")
    front = (
        F.when(F.col("doc_id") % 3 == 0, F.lit(""))
        .when(F.col("doc_id") % 30 == 1,
              F.concat(F.lit("---\ntitle: Doc --- "), did, F.lit("\nlang: "), F.col("lang"), F.lit("\n---\n")))
        .when(F.col("doc_id") % 30 == 2, F.concat(F.lit("---\ntitle: Doc "), did, F.lit("\n")))
        .when(F.col("doc_id") % 30 == 4, F.concat(F.lit("---\ntitle: Doc "), did, F.lit("\nkeywords:\n  - "),
                                                  F.col("lang"), F.lit("\n  - corpus\n---\n")))
        .when(F.col("doc_id") % 30 == 7, F.concat(F.lit("---\ntitle: Doc "), did, F.when(
            F.col("doc_id") % 90 == 7, F.lit("\nno mapping here")).when(
            F.col("doc_id") % 90 == 37, F.concat(F.lit("\n  lang: "), F.col("lang"))).otherwise(
            F.lit("\npart:\n    pages: 3\n  name: two")), F.lit("\n---\n")))
        .when(F.col("doc_id") % 30 == 8, F.concat(
            F.lit("---\ntitle: Doc "), did, F.lit("\norigin:\n  name: "), F.col("source"),
            F.lit("\n  languages:\n  - "), F.col("lang"), F.lit("\n  - xx\nlang: none\nparts:\n  - name: one\n    pages: "),
            (F.col("doc_id") % 50).cast("string"), F.lit("\n  - name: two # unread\nempty:\nlang: "), F.col("lang"),
            F.lit("\n---\n")))
        .when(F.col("doc_id") % 30 == 10, F.concat(
            F.lit("---\ntitle: Doc "), did, F.lit("\nsummary: >\n  written in\n  "), F.col("lang"),
            F.lit("\n\n  from: "), F.col("source"), F.lit("\nnote: |-\n  - a\n    b\nopen: true\n---\n")))
        .otherwise(F.concat(F.lit("---\ntitle: Doc "), did, F.lit("\nlang: "), F.col("lang"),
                            F.lit("\nsource: "), F.col("source"), F.lit("\n---\n")))
    )
    return d.select(
        "doc_id",
        F.concat(F.lit("doc_"), did).alias("document_name"),
        F.concat(front, body).alias("raw"),
    )


def load_md_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return md_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"),
                               "doc_id"))


def manifest_from_refs(refs: DataFrame, docs_root: str = "markdown_docs") -> DataFrame:
    """``manifest(path)``: which candidate image files exist.

    For each distinct (document_name, ref), by ``h(document_name || ref) % 4``:
    0 -> ``doc/ref.png``; 1 -> ``doc/ref.jpg`` and ``<root>/doc/ref.png``;
    2 -> ``<root>/doc/ref.jpeg``; 3 -> nothing (a missing image).
    """
    r = refs.select("document_name", "ref").distinct()
    b = md5_bucket(F.concat("document_name", "ref")) % 4
    local = F.concat_ws("/", "document_name", "ref")
    rooted = F.concat_ws("/", F.lit(docs_root), "document_name", "ref")
    paths = (
        F.when(b == 0, F.array(F.concat(local, F.lit(".png"))))
        .when(b == 1, F.array(F.concat(local, F.lit(".jpg")), F.concat(rooted, F.lit(".png"))))
        .when(b == 2, F.array(F.concat(rooted, F.lit(".jpeg"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return r.select(F.explode(paths).alias("path"))


def sections_to_answer(keys: DataFrame, sections: DataFrame, section_images: DataFrame) -> DataFrame:
    """The sections' keys with what their answers are made of: section_md5 and image_paths.

    ``sections`` holds (doc_id, section_idx, section_md5): each section text is
    hashed once, and joined before the section becomes requests. The rows are few
    and small, what they become is large: they are dealt over all shuffle partitions.
    """
    by = ["doc_id", "section_idx"]
    return spread(keys, *by).join(sections, by).join(section_images, by, "left")


def responses_from_requests(requests: DataFrame) -> DataFrame:
    """``responses(request_id, attempt, text)`` for attempts 1..3.

    ``requests`` carry the columns of :func:`sections_to_answer`.

    A good answer is ``{"question": "Q <type> <section_idx>", "question_images":
    [own images], "answer": "A <md5(section)>"}``. One request in 50 never gets
    a parsable answer; otherwise attempt 3 is always good and attempts 1-2 vary
    by ``h(request_id || attempt) % 10``: 0-4 good, 5 a valid object without
    ``answer`` (quarantined later), 6 fenced in prose, 7 single quotes, 8 prose without JSON (on attempt 1 no
    text at all), 9 two objects (trailing data). Form 7 holds a control
    character. Sections with ``h(doc_id | section_idx) % 7 == 0`` were not asked a
    third time.
    """
    images_json = F.to_json(F.coalesce("image_paths", F.array().cast("array<string>")))
    head = F.concat(F.lit('{"question": "Q '), F.col("question_type"), F.lit(" "), F.col("section_idx").cast("string"),
                    F.lit('", "question_images": '), images_json)
    good = F.concat(head, F.lit(', "answer": "A '), F.col("section_md5"), F.lit('"}'))
    twice = md5_bucket(F.concat_ws("|", "doc_id", "section_idx")) % 7 == 0
    never = md5_bucket("request_id") % 50 == 0
    attempts = requests.select("request_id", good.alias("good"), F.concat(head, F.lit("}")).alias("no_answer"), never.alias("never"),
                           F.explode(F.sequence(F.lit(1), F.when(twice, 2).otherwise(3))).alias("attempt"))
    form = (
        F.when(F.col("never"), F.lit(8))
        .when(F.col("attempt") == 3, F.lit(0))
        .otherwise(md5_bucket(F.concat(F.col("request_id"), F.col("attempt").cast("string"))) % 10)
    )
    g = F.col("good")
    text = (
        F.when(form <= 4, g)
        .when(form == 5, F.col("no_answer"))
        .when(form == 6, F.concat(F.lit("Sure. Here is the pair:\n```json\n"), g, F.lit("\n```\nHope it helps.")))
        .when(form == 7, F.concat(F.lit("{\u0007"), F.substring(F.translate(g, '"', "'"), 2, 1 << 30)))
        .when((form == 8) & (F.col("attempt") == 1), F.lit(None))
        .when(form == 8, F.lit("I am unable to produce a pair for this section."))
        .otherwise(F.concat(g, F.lit(" and "), g))
    )
    return attempts.select("request_id", F.col("attempt").cast("int").alias("attempt"), text.alias("text"))


def audit_images(question_images, request_id):
    """Audit fixture: every sixth image url (by ``h(url || request_id) % 6 == 0``) points nowhere."""
    return F.transform(question_images, lambda u: F.when(
        md5_bucket(F.concat(u, request_id)) % 6 == 0, F.concat(u, F.lit(".missing"))).otherwise(u))
