"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per SURVEY §7.3 name.

Every query reads the driver's tables (through the derived markdown view)
and runs over all of them; result columns carry the same names as the
oracle SQL in :mod:`mdquarry.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import images as im
from ..operators import neighbours as nb
from ..operators import requests as rq
from ..operators import responses as rs
from ..operators import dataset as ds
from ..operators import audit as au
from ..operators.frontmatter import metadata_leaf_rows, metadata_rows, missing_required_metadata
from ..session import scratch_path
from ..sources.array_files import read_arrays
from ..sources.fixtures import audit_images, load_md_documents, manifest_from_refs, responses_from_requests, sections_to_answer
from .corpus import REFERENCE_BOUNDS, Corpus

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


class DerivedCorpus(Corpus):
    """The corpus derived from the driver's ``documents`` (see ``sources.fixtures``): its image manifest,
    model responses and audited records are derived from it by rule, so every query grows with the table."""

    @property
    def manifest(self) -> DataFrame:
        return self._m("manifest", lambda: self._keep(manifest_from_refs(self.content_refs, self.docs_root), "manifest"))

    @property
    def responses(self) -> DataFrame:
        def build():
            images = self.section_images
            hashed = self.sections.select("doc_id", "section_idx", F.md5("section").alias("section_md5"))
            asked = sections_to_answer(self.section_keys, hashed, images)
            return responses_from_requests(rq.grid(asked, self.question_types, self.batch_size,
                                                   ("section_md5", "image_paths")))
        return self._m("responses", build)

    @property
    def audit_records(self) -> DataFrame:
        """Dataset records whose images partly point nowhere: file, rec_key, messages."""
        def build():
            qa = self.qa.withColumn("question_images", audit_images(
                F.coalesce("question_images", F.array().cast("array<string>")), F.col("request_id")))
            rec, _ = ds.shape(qa)
            return rec.select(F.concat_ws("-", "split", "document_name").alias("file"),
                              F.col("request_id").alias("rec_key"),
                              F.get_json_object("record", "$.messages").alias("messages"))
        return self._m("audit_records", build)

    def volumes(self, documents: int = 500) -> DataFrame:
        """Sections of volumes of so many documents, numbered through: documents of several blocks of sections."""
        volume = F.floor(F.col("doc_id") / documents)
        first = self.sections.where(F.col("section_idx") == 1).select("doc_id", "n_sections")
        w = Window.partitionBy(volume)
        before = F.sum("n_sections").over(w.orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1))
        first = first.select("doc_id", F.coalesce(before, F.lit(0)).alias("before"),
                             F.sum("n_sections").over(w).cast("int").alias("n"))
        s = self.sections.select("doc_id", "section_idx", "section").join(first, "doc_id")
        return s.select(volume.cast("long").alias("doc_id"), F.concat(F.lit("volume_"), volume).alias("document_name"),
                        F.col("n").alias("n_sections"),
                        (F.col("before") + F.col("section_idx")).cast("int").alias("section_idx"), "section")


_CORPORA: dict[tuple, Corpus] = {}


def _c(spark: SparkSession, sf_dir: str, **settings) -> Corpus:
    """One corpus plan per (session, data dir, settings), so registered queries share
    persisted intermediates instead of recomputing sections and neighbours."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        app = str(id(spark))
    key = (app, sf_dir, *sorted(settings.items()))
    if key not in _CORPORA:
        _CORPORA[key] = DerivedCorpus(load_md_documents(spark, sf_dir), **settings)
    return _CORPORA[key]


@query
def q_document_names(spark, sf_dir):
    d = _c(spark, sf_dir).docs_md
    return d.select("doc_id", "document_name", F.length("raw").cast("bigint").alias("raw_len"),
                    F.md5("raw").alias("raw_md5"))


@query
def q_frontmatter_split(spark, sf_dir):
    d = _c(spark, sf_dir).docs
    return d.select("doc_id", "has_frontmatter", "fm_parsed",
                    F.length("content").cast("bigint").alias("content_len"),
                    F.md5("content").alias("content_md5"))


@query
def q_frontmatter_metadata(spark, sf_dir):
    return metadata_rows(_c(spark, sf_dir).docs)


@query
def q_frontmatter_tree(spark, sf_dir):
    """A4: every value of the metadata tree at any depth, as written and as the VARIANT holds it."""
    return metadata_leaf_rows(_c(spark, sf_dir).docs)


@query
def q_metadata_check(spark, sf_dir):
    return missing_required_metadata(_c(spark, sf_dir).docs)


@query
def q_sections(spark, sf_dir):
    s = _c(spark, sf_dir).sections
    return s.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"), "title",
                    F.length("section").cast("bigint").alias("section_len"),
                    F.md5("section").alias("section_md5"), F.md5("body").alias("body_md5"))


@query
def q_facts(spark, sf_dir):
    f = _c(spark, sf_dir).facts
    return f.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("fact_number").cast("bigint").alias("fact_number"), "fact")


# --- images ------------------------------------------------------------------------
@query
def q_image_refs(spark, sf_dir):
    r = _c(spark, sf_dir).section_refs
    return r.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("ref_pos").cast("bigint").alias("ref_pos"), "ref")


@query
def q_image_resolution(spark, sf_dir):
    r = _c(spark, sf_dir).section_resolved
    return r.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("ref_pos").cast("bigint").alias("ref_pos"), "ref", "image_path")


@query
def q_missing_images(spark, sf_dir):
    c = _c(spark, sf_dir)
    resolved = c.section_resolved
    m = im.unresolved(c.section_refs, resolved, c.SKEYS)
    return m.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("ref_pos").cast("bigint").alias("ref_pos"), "ref")


@query
def q_image_preflight(spark, sf_dir):
    """Resolve the references of whole documents before the run."""
    c = _c(spark, sf_dir)
    keys = ["doc_id", "document_name"]
    res = im.resolve(c.content_refs, c.manifest, keys, c.docs_root)
    j = c.content_refs.join(res.select(*keys, "ref_pos", "image_path"), [*keys, "ref_pos"], "left")
    return j.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_refs"),
        F.count("image_path").alias("n_resolved"),
        F.count_if(F.col("image_path").isNull()).alias("n_missing"))


@query
def q_section_images(spark, sf_dir):
    s = _c(spark, sf_dir).section_images
    e = s.select("doc_id", "section_idx", F.posexplode("image_paths").alias("p", "image_path"))
    return e.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    (F.col("p") + 1).cast("bigint").alias("image_pos"), "image_path",
                    im.image_name(F.col("image_path")).alias("image_name"),
                    im.mime_type(F.col("image_path")).alias("mime_type"))


# --- neighbours --------------------------------------------------------------------
def _e6(c):
    return F.round(F.col(c) * 1e6).cast("bigint")


def _weights(w):
    return w.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"), "term",
                    F.col("tf").cast("bigint").alias("tf"),
                    _e6("idf").alias("idf_e6"), _e6("weight").alias("weight_e6"))


@query
def q_term_weights(spark, sf_dir):
    return _weights(_c(spark, sf_dir).nn.term_weights())


@query
def q_bounded_term_weights(spark, sf_dir):
    """The first 2,000 characters of each section, the 500 most frequent terms of each document."""
    return _weights(_c(spark, sf_dir, bounds=REFERENCE_BOUNDS).nn.term_weights())


def _section_neighbours(n, name="doc_id"):
    return n.select(F.col("doc_id").alias(name), F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("rank").cast("bigint").alias("rank"), F.col("nbr_idx").cast("bigint").alias("nbr_idx"),
                    _e6("sim").alias("sim_e6"))


@query
def q_section_neighbours(spark, sf_dir):
    return _section_neighbours(_c(spark, sf_dir).section_neighbours)


@query
def q_bounded_section_neighbours(spark, sf_dir):
    """Whole sections as queries against cut ones."""
    return _section_neighbours(_c(spark, sf_dir, bounds=REFERENCE_BOUNDS).section_neighbours)


@query
def q_volume_section_neighbours(spark, sf_dir):
    """D7 over documents of several blocks (volumes of 500 documents): blocks out of reach are skipped."""
    c = _c(spark, sf_dir)
    return _section_neighbours(nb.Neighbours(c.volumes(), c.block_size, keep=c._keep).of_sections(), "volume_id")


@query
def q_fact_neighbours(spark, sf_dir):
    n = _c(spark, sf_dir).fact_neighbours
    return n.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("fact_number").cast("bigint").alias("fact_number"),
                    F.col("rank").cast("bigint").alias("rank"), F.col("nbr_idx").cast("bigint").alias("nbr_idx"),
                    _e6("sim").alias("sim_e6"))


@query
def q_neighbour_context(spark, sf_dir):
    c = _c(spark, sf_dir)
    keys = ["doc_id", "section_idx"]
    images = c.truncated_images
    ctx = nb.neighbour_context(c.section_neighbours, c.sections, keys, images, c.bounds.max_chars)
    base = c.sections.select(*keys).join(c.section_images, keys, "left").select(
        *keys, F.coalesce("image_paths", F.array().cast("array<string>")).alias("own_images"))
    full = nb.with_neighbour_context(base, ctx, keys)
    allimg = F.concat("own_images", "neighbour_images")
    return full.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                       F.length("neighbour_text").cast("bigint").alias("neighbour_len"),
                       F.md5("neighbour_text").alias("neighbour_md5"),
                       F.array_join("neighbour_images", "|").alias("neighbour_images"),
                       F.array_join(allimg, "|").alias("all_images"),
                       F.size(allimg).cast("bigint").alias("n_images"))


# --- requests ------------------------------------------------------------------------
@query
def q_request_grid(spark, sf_dir):
    r = _c(spark, sf_dir).request_keys
    return r.select("request_id", "doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("fact_number").cast("bigint").alias("fact_number"), "question_type", "difficulty",
                    "is_summary", F.col("batch_id").cast("bigint").alias("batch_id"))


@query
def q_recall_seed_fact(spark, sf_dir):
    s = _c(spark, sf_dir).seeds
    return s.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"), "seed_fact")


@query
def q_partner_sections(spark, sf_dir):
    p = _c(spark, sf_dir).partners
    return p.select("doc_id", F.col("section_idx").cast("bigint").alias("section_idx"),
                    F.col("partner_idx").cast("bigint").alias("partner_idx"))


@query
def q_rendered_prompts(spark, sf_dir):
    r = _c(spark, sf_dir).requests
    return r.select("request_id", "question_type", F.length("prompt").cast("bigint").alias("prompt_len"),
                    F.md5("prompt").alias("prompt_md5"), F.size("images").cast("bigint").alias("n_images"))


@query
def q_chat_requests(spark, sf_dir):
    r = _c(spark, sf_dir).requests
    j = rq.chat_request_json(F.col("prompt"), F.col("images"))
    return r.select("request_id", F.length(j).cast("bigint").alias("chat_len"), F.md5(j).alias("chat_md5"))


# --- responses ---------------------------------------------------------------------
def _b(c):
    return F.col(c).cast("bigint").alias(c)


@query
def q_json_substring(spark, sf_dir):
    r = _c(spark, sf_dir).responses
    js = rs.json_substring(F.col("text"))
    clean = rs.json_substring(rs.sanitize(F.col("text")))
    return r.select("request_id", _b("attempt"), (js != "").alias("has_json"),
                    F.length(js).cast("bigint").alias("json_len"), F.md5(js).alias("json_md5"),
                    F.md5(clean).alias("sanitized_md5"))


@query
def q_parsed_responses(spark, sf_dir):
    p = _c(spark, sf_dir).parsed
    return p.select("request_id", _b("attempt"), "status", "question", "answer",
                    F.array_join("question_images", "|").alias("question_images"), "has_question", "has_answer")


@query
def q_failed_sections(spark, sf_dir):
    f = _c(spark, sf_dir).failures
    return f.select("doc_id", _b("section_idx"), "question_type", _b("attempt"), _b("fact_number"), "error")


@query
def q_retry_first_success(spark, sf_dir):
    f = _c(spark, sf_dir).firsts
    return f.where(F.col("first_ok").isNotNull()).select("doc_id", _b("section_idx"), "question_type",
                                                         _b("first_ok"))


@query
def q_still_failing(spark, sf_dir):
    c = _c(spark, sf_dir)
    s = c.still_failing
    return s.select("doc_id", _b("section_idx"), "question_type", _b("attempts"), "last_error", _b("fact_number"))


@query
def q_pending_requests(spark, sf_dir):
    c = _c(spark, sf_dir)
    firsts = c.firsts
    p = rs.pending(c.request_keys, firsts, c.max_retries)
    return p.select("request_id", _b("next_attempt"))


@query
def q_capped_pending_requests(spark, sf_dir):
    """with two retries, units that failed a third time are not asked again."""
    c = _c(spark, sf_dir)
    firsts = c.firsts
    return rs.pending(c.request_keys, firsts, 2).select("request_id", _b("next_attempt"))


@query
def q_request_batches(spark, sf_dir):
    """Batches of five sections."""
    return _c(spark, sf_dir, batch_size=5).request_keys.select("request_id", _b("batch_id"))


# --- dataset ------------------------------------------------------------------------
@query
def q_chat_records(spark, sf_dir):
    r = _c(spark, sf_dir).records
    return r.select("request_id", "split", "question_type", "difficulty",
                    F.length("record").cast("bigint").alias("record_len"), F.md5("record").alias("record_md5"))


@query
def q_quarantine(spark, sf_dir):
    q = _c(spark, sf_dir).quarantine
    return q.select("request_id", "doc_id", _b("section_idx"), _b("fact_number"), "question_type", "reason")


@query
def q_train_eval_counts(spark, sf_dir):
    return ds.split_counts(_c(spark, sf_dir).records).select("document_name", _b("n_train"), _b("n_eval"))


@query
def q_dataset_array_files(spark, sf_dir):
    """The dataset written as one JSON array for each split and document, and read back from these files."""
    folder = scratch_path(spark, f"dataset-{uuid.uuid4().hex[:12]}")
    run, _ = ds.write_array_files(_c(spark, sf_dir).records, folder)
    elements, files = read_arrays(spark, folder)
    name = F.regexp_extract(F.url_decode(F.regexp_extract("file", "([^/]*)$", 1)), f"^(.*)-synthetic-data-{run}", 1)
    entry = F.trim(F.translate("entry", "\n", ""))
    found = elements.where(entry != "").select("file", F.md5(entry).alias("m"))
    found = found.groupBy("file").agg(F.count(F.lit(1)).alias("n_records"),
                                      F.md5(F.array_join(F.sort_array(F.collect_list("m")), "")).alias("records_md5"))
    return files.join(found, "file", "left").groupBy(name.alias("name")).agg(
        F.bool_and("complete").alias("complete"), F.sum(F.coalesce("n_records", F.lit(0))).alias("n_records"),
        F.max("records_md5").alias("records_md5"))


@query
def q_type_stats(spark, sf_dir):
    """Per type/difficulty (and overall) requests, pairs, quarantined, failed attempts, still failing."""
    c = _c(spark, sf_dir)
    _ = c.records  # the pairs are settled with the attempts, not after them
    still = c.still_failing
    ev = (c.request_keys.select("question_type", "difficulty", F.lit(1).alias("req"), F.lit(0).alias("qa"),
                            F.lit(0).alias("quar"), F.lit(0).alias("fail"), F.lit(0).alias("still"))
          .unionByName(c.records.select("question_type", "difficulty", F.lit(0).alias("req"), F.lit(1).alias("qa"),
                                        F.lit(0).alias("quar"), F.lit(0).alias("fail"), F.lit(0).alias("still")))
          .unionByName(c.quarantine.join(c.request_keys.select("request_id", "difficulty"), "request_id")
                       .select("question_type", "difficulty", F.lit(0).alias("req"), F.lit(0).alias("qa"),
                               F.lit(1).alias("quar"), F.lit(0).alias("fail"), F.lit(0).alias("still")))
          .unionByName(c.failures.join(_types(spark), "question_type")
                       .select("question_type", "difficulty", F.lit(0).alias("req"), F.lit(0).alias("qa"),
                               F.lit(0).alias("quar"), F.lit(1).alias("fail"), F.lit(0).alias("still")))
          .unionByName(still.join(_types(spark), "question_type")
                       .select("question_type", "difficulty", F.lit(0).alias("req"), F.lit(0).alias("qa"),
                               F.lit(0).alias("quar"), F.lit(0).alias("fail"), F.lit(1).alias("still"))))
    agg = ev.rollup("question_type", "difficulty").agg(
        F.sum("req").alias("n_requests"), F.sum("qa").alias("n_qa"), F.sum("quar").alias("n_quarantined"),
        F.sum("fail").alias("n_failed_attempts"), F.sum("still").alias("n_still_failing"))
    agg = agg.where(F.col("question_type").isNull() | F.col("difficulty").isNotNull())
    return agg.select("question_type", "difficulty", *[_b(x) for x in
                      ("n_requests", "n_qa", "n_quarantined", "n_failed_attempts", "n_still_failing")])


def _types(spark):
    return F.broadcast(rq.question_types_df(spark).select("question_type", "difficulty"))  # fixed 15 rows


# --- audit --------------------------------------------------------------------------
@query
def q_invalid_images(spark, sf_dir):
    c = _c(spark, sf_dir)
    return au.invalid_images(c.audit_records, c.manifest).select(
        "file", F.col("rec_key").alias("request_id"), "image_url", "context", "preview")


@query
def q_file_verdicts(spark, sf_dir):
    c = _c(spark, sf_dir)
    return au.file_verdicts(c.audit_records, c.manifest)


@query
def q_dataset_verdict(spark, sf_dir):
    c = _c(spark, sf_dir)
    v = au.dataset_verdict(au.file_verdicts(c.audit_records, c.manifest))
    return v.select("all_valid", _b("n_files"))


# --- paragraph-level views of fact extraction ----------------------------------------
def _paragraph_rows(spark, sf_dir):
    from ..operators import facts as fx
    s = _c(spark, sf_dir).sections
    p = s.select("doc_id", "section_idx", F.posexplode(fx.paragraphs(F.col("body"))).alias("pos", "p"))
    return p.select("doc_id", "section_idx", (F.col("pos") + 1).alias("para_idx"), "p",
                    F.col("p").rlike(fx.LIST_PARAGRAPH).alias("is_list"))


def _list_query(spark, sf_dir, linked: bool):
    from ..operators import facts as fx
    p = _paragraph_rows(spark, sf_dir).where("is_list")
    fn = fx.list_items_linked if linked else fx.list_items
    e = p.select("doc_id", "section_idx", "para_idx", F.posexplode(fn(F.col("p"))).alias("pos", "item"))
    return e.select("doc_id", _b("section_idx"), _b("para_idx"), (F.col("pos") + 1).cast("bigint").alias("item_pos"),
                    "item")


@query
def q_list_items(spark, sf_dir):
    """List paragraphs -> one item per list entry, continuation lines joined."""
    return _list_query(spark, sf_dir, False)


@query
def q_list_items_linked(spark, sf_dir):
    """B10 documented option: indented items become 'parent - item'."""
    return _list_query(spark, sf_dir, True)


@query
def q_sentences(spark, sf_dir):
    """Prose paragraphs -> sentences."""
    from ..operators import facts as fx
    p = _paragraph_rows(spark, sf_dir).where(~F.col("is_list"))
    e = p.select("doc_id", "section_idx", "para_idx", F.posexplode(fx.sentences(F.col("p"))).alias("pos", "sentence"))
    return e.select("doc_id", _b("section_idx"), _b("para_idx"), (F.col("pos") + 1).cast("bigint").alias("sent_pos"),
                    "sentence")
