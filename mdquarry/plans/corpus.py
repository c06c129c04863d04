"""Corpus stages shared by all queries: documents -> frontmatter -> sections -> facts."""

from __future__ import annotations

from dataclasses import dataclass, field

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import header_body, header_title
from ..operators import frontmatter as fm
from ..operators import images as im
from ..operators import neighbours as nb
from ..operators import requests as rq
from ..operators import responses as rs
from ..operators import dataset as ds
from ..operators.facts import with_fact_array
from ..operators.frontmatter import split_frontmatter
from ..operators.neighbours import Neighbours
from ..operators.sections import by_document, split_sections
from ..session import scratch_path
from .templates import (DEFAULT_DOC_TITLE, DEFAULT_TITLE_A, DEFAULT_TITLE_B, NO_NEIGHBOURS, QUESTION_TYPES, TEMPLATES,
                        compile_template)


@dataclass(frozen=True)
class Bounds:
    """Limits of the neighbour search and the prompts; by default nothing is cut."""

    max_chars: int | None = None  # characters of a section that are compared and shown as a neighbour
    max_terms: int | None = None  # terms of a document's vocabulary
    k: int = 3  # neighbours before the own section is dropped


# The bounds that published datasets of this kind were made with.
REFERENCE_BOUNDS = Bounds(max_chars=2000, max_terms=500)


#: Slots of the prompts that are columns of the section context.
SECTION_SLOTS = {"metadata": "metadata_txt", "instructions": "instructions", "section": "section", "neighbours": "neighbour_text",
                 "images": "images_block", "title": "title", "body": "body", "title_a": "title_a", "title_b": "title_b",
                 "body2": "body2"}


@dataclass
class Corpus:
    """Lazily built DataFrames of one markdown corpus (nothing is collected)."""

    docs_md: DataFrame  # doc_id, document_name, raw
    docs_root: str = "markdown_docs"
    manifest_df: DataFrame | None = None  # path of every existing image
    block_size: int = 512
    responses_df: DataFrame | None = None  # request_id, attempt, text
    bounds: Bounds = Bounds()
    # further question types: (name, difficulty, task text with slots, see templates.compile_template) and the unit
    # "section" (default), "pair" or "fact"; requests.types_from_table reads them from a table
    extra_types: tuple[tuple[str, ...], ...] = ()
    batch_size: int = rq.BATCH_SIZE
    max_retries: int = rs.MAX_RETRIES
    # How reused stage outputs are kept: "table" writes them as parquet into the
    # session's shared checkpoint folder and reads them back (lineage cut, plans
    # stay small, survives executor loss); "memory" persists them; "none" recomputes.
    persist: str = "table"
    _memo: dict = field(default_factory=dict)
    _cached: list = field(default_factory=list)
    _run_dir: str | None = None
    _n_kept: int = 0

    def _m(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def _keep(self, df: DataFrame, name: str = "stage") -> DataFrame:
        """Materialise an intermediate that several branches read.

        Default: write it as a parquet table under ``spark.checkpoint.dir`` and
        read it back. This cuts the lineage (later plans start at a scan, so
        analysis and adaptive re-planning stay cheap), gives the optimizer real
        sizes, lets readers prune columns, and survives lost executors.
        """
        if self.persist == "none":
            return df
        if self.persist == "memory":
            self._cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return self._cached[-1]
        spark = df.sparkSession
        if self._run_dir is None:
            self._run_dir = scratch_path(spark, f"corpus-{uuid.uuid4().hex[:12]}")
        self._n_kept += 1
        path = f"{self._run_dir}/{self._n_kept:02d}-{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def unpersist(self) -> None:
        """Frees every frame that was persisted, also those that other stages hold, and deletes the written tables."""
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
        if self._run_dir is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._run_dir)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self._run_dir = None
        self._memo.clear()

    @property
    def spark(self) -> SparkSession:
        return self.docs_md.sparkSession

    @property
    def docs(self) -> DataFrame:
        """doc_id, document_name, has_frontmatter, fm_parsed, metadata, content."""
        return self._m("docs", lambda: self._keep(split_frontmatter(self.docs_md), "docs"))

    @property
    def section_facts(self) -> DataFrame:
        """Sections + ``facts`` array, persisted: every later stage starts here.

        The documents are written only if another stage reads them; title and body are parts of the section's
        text and cut out again where they are needed.
        """
        def build():
            docs = self._memo.get("docs")
            docs = split_frontmatter(self.docs_md) if docs is None else docs
            s = with_fact_array(split_sections(docs.select("doc_id", "document_name", "metadata", "content"),
                                               keep=("doc_id", "document_name", "metadata")))
            s = self._keep(s.drop("title", "body").withColumn("n_facts", F.size("facts")), "section_facts")
            section = F.col("section")
            return s.withColumn("title", header_title(section)).withColumn("body", header_body(section))
        return self._m("section_facts", build)

    @property
    def sections(self) -> DataFrame:
        """doc_id, document_name, section_idx, section, title, body."""
        return self._m("sections", lambda: self.section_facts.drop("facts", "n_facts", "metadata"))

    @property
    def facts(self) -> DataFrame:
        return self._m("facts", lambda: self.section_facts.select(
            "doc_id", "document_name", "n_sections", "section_idx", F.size("facts").alias("unit_size"),
            F.posexplode("facts").alias("fact_number", "fact"),
        ).withColumn("fact_number", F.col("fact_number").cast("int")))

    # --- images -------------------------------------------------------------
    SKEYS = ["doc_id", "document_name", "section_idx"]

    @property
    def content_refs(self) -> DataFrame:
        return self._m("content_refs", lambda: im.extract_refs(self.docs, "content", ["doc_id", "document_name"]))

    @property
    def manifest(self) -> DataFrame:
        """path of every existing image; must be given (see ``operators.images.manifest_from_dir``)."""
        if self.manifest_df is None:
            raise ValueError("no image manifest: give manifest_df (a table of existing paths, empty if there are none)")
        return self.manifest_df

    @property
    def section_refs(self) -> DataFrame:
        return self._m("section_refs", lambda: im.extract_refs(self.sections, "section", self.SKEYS))

    @property
    def section_resolved(self) -> DataFrame:
        def build():
            manifest = self.manifest  # a manifest that is made from the documents writes them before they are cut
            return im.resolve(self.section_refs, manifest, self.SKEYS, self.docs_root)
        return self._m("section_resolved", build)

    @property
    def section_images(self) -> DataFrame:
        """doc_id, section_idx, image_paths (resolved, in reference order)."""
        return self._m("section_images", lambda: im.attach(self.section_resolved, ["doc_id", "section_idx"]))

    @property
    def truncated_images(self) -> DataFrame:
        """Images of the part of each section that it contributes as a neighbour."""
        if self.bounds.max_chars is None:
            return self.section_images

        def build():
            manifest = self.manifest
            refs = im.extract_refs(self.sections, nb.prefix("section", self.bounds.max_chars), self.SKEYS)
            return im.attach(im.resolve(refs, manifest, self.SKEYS, self.docs_root), ["doc_id", "section_idx"])
        return self._m("truncated_images", build)

    # --- neighbours -----------------------------------------------------------
    @property
    def nn(self) -> Neighbours:
        return self._m("nn", lambda: Neighbours(
            self.sections, self.block_size, self.bounds.max_chars, self.bounds.max_terms, self.bounds.k, self._keep))

    @property
    def section_neighbours(self) -> DataFrame:
        return self._m("section_neighbours", lambda: self._keep(self.nn.of_sections(), "section_neighbours"))

    @property
    def fact_neighbours(self) -> DataFrame:
        return self._m("fact_neighbours", lambda: self._keep(self.nn.of_facts(self.facts), "fact_neighbours"))

    # --- requests -------------------------------------------------------------
    @property
    def question_types(self) -> tuple[tuple, ...]:
        first = max(o for o, _, _ in QUESTION_TYPES) + 1
        return (*QUESTION_TYPES, *((first + i, x[0], x[1], x[3] if len(x) > 3 else "section")
                                   for i, x in enumerate(self.extra_types)))

    @property
    def templates(self) -> dict:
        return {**TEMPLATES, **{x[0]: compile_template(x[2]) for x in self.extra_types}}

    @staticmethod
    def doc_context_columns() -> list:
        """doc_title, metadata_txt, instructions (E7-E9), from the ``metadata`` every section carries."""
        title = fm.document_title(F.col("metadata"), DEFAULT_DOC_TITLE)
        return [title.alias("doc_title"), fm.metadata_block(F.col("metadata")).alias("metadata_txt"),
                rq.common_instructions(title).alias("instructions")]

    @property
    def seeds(self) -> DataFrame:
        return self._m("seeds", lambda: rq.seed_fact(self.section_facts))

    @property
    def partners(self) -> DataFrame:
        return self._m("partners", lambda: rq.partners(self.sections))

    @property
    def section_context(self) -> DataFrame:
        """One row per section with every prompt slot (joins at section grain)."""
        def build():
            keys = ["doc_id", "section_idx"]
            images = self.truncated_images
            nctx = nb.neighbour_context(self.section_neighbours, self.sections, keys, images, self.bounds.max_chars)
            other = self.sections.select("doc_id", F.col("section_idx").alias("partner_idx"),
                                         F.col("section").alias("section_b"))
            base = self.section_facts.select("doc_id", "document_name", "section_idx", "section", "title", "body",
                                             "partner_idx", *self.doc_context_columns())
            s = (base.join(self.section_images, keys, "left")
                 .join(nctx, keys, "left")
                 .join(self.seeds, keys, "left")
                 .join(other, ["doc_id", "partner_idx"], "left"))
            own = F.coalesce("image_paths", F.array().cast("array<string>"))
            nimg = F.coalesce("neighbour_images", F.array().cast("array<string>"))
            return s.select(
                "doc_id", "document_name", "section_idx", "section", "title", "body", "doc_title",
                "metadata_txt", "instructions", "seed_fact", "partner_idx",
                own.alias("own_images"),
                F.coalesce("neighbour_text", F.lit(NO_NEIGHBOURS)).alias("neighbour_text"),
                F.concat(own, nimg).alias("all_images"),
                im.image_block(F.concat(own, nimg)).alias("images_block"),
                header_title(F.col("section"), DEFAULT_TITLE_A).alias("title_a"),
                F.coalesce(header_title(F.col("section_b"), DEFAULT_TITLE_B), F.lit("")).alias("title_b"),
                F.coalesce(header_body(F.col("section_b")), F.lit("")).alias("body2"),
            )
        return self._m("section_context", lambda: self._keep(build(), "section_context"))

    def _slots(self, fact_rows: bool) -> dict:
        e = F.lit("")
        return {
            **{slot: F.col(c) for slot, c in SECTION_SLOTS.items()},
            "seed_fact": e if fact_rows else F.coalesce("seed_fact", e),
            "fact": F.col("fact") if fact_rows else e,
            "fact_neighbours": F.col("fact_neighbour_text") if fact_rows else e,
        }

    def _fact_context(self, ctx: DataFrame, templates: dict) -> DataFrame:
        """Facts with their neighbours' text and the slots of their section that the templates use.

        A document's texts and slots are dealt out once, as one row, and meet its facts, which hold the numbers of their
        neighbours: no text is copied before it is where the prompt is made. Documents of several blocks would be too
        large for a row; their facts are joined section by section.
        """
        fkeys = ["doc_id", "section_idx", "fact_number"]
        used = {slot for parts in templates.values() for _, slot in parts if slot}
        slots = ["all_images", *(c for slot, c in SECTION_SLOTS.items() if slot in used)]
        ctx = ctx.select("doc_id", "section_idx", *slots)
        sections, facts, found = self.sections, self.facts, self.fact_neighbours
        large = sections.where(F.col("n_sections") > self.block_size)
        parts = []
        if not large.isEmpty():
            # all sections of a document go one way
            ids = large.select("doc_id").distinct()
            ctx_l, sections_l, facts_l, found_l = (d.join(ids, "doc_id", "left_semi") for d in (ctx, sections, facts, found))
            ctx, sections, facts, found = (d.join(ids, "doc_id", "left_anti") for d in (ctx, sections, facts, found))
            near = nb.neighbour_context(found_l, sections_l, fkeys, max_chars=self.bounds.max_chars)
            # the section's slots come last: they are the widest columns, and no later join deals them out
            parts.append(facts_l.join(near.select(*fkeys, F.col("neighbour_text").alias("fact_neighbour_text")), fkeys, "left")
                         .join(ctx_l, ["doc_id", "section_idx"]))
        f = nb.with_neighbour_text(facts.join(nb.neighbour_numbers(found, fkeys), fkeys, "left"), sections,
                                   "fact_neighbour_text", self.bounds.max_chars)
        f = f.join(by_document(ctx, "_slots"), "doc_id")
        f = f.withColumn("_slots", F.explode(F.get("_slots", F.col("section_idx") - 1)))
        parts.append(f.select("*", *(F.col("_slots")[c].alias(c) for c in slots)).drop("_slots"))
        f = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return f.withColumn("fact_neighbour_text", F.coalesce("fact_neighbour_text", F.lit(NO_NEIGHBOURS)))

    @property
    def requests(self) -> DataFrame:
        """request_id, doc_id, document_name, section_idx, fact_number, question_type, difficulty,
        ordinal, is_summary, batch_id, prompt, images (E1-E13)."""
        def build():
            ctx = self.section_context
            srq = rq.section_requests(ctx, self.question_types)
            srq = srq.withColumn("prompt", rq.render(self._slots(False), F.col("question_type"), self.templates)) \
                .withColumn("unit_size", F.lit(1))
            types = [t for t in self.question_types if rq.unit(t) == "fact"]
            templates = {t[1]: self.templates[t[1]] for t in types}
            frq = rq.fact_requests(self._fact_context(ctx, templates), types).withColumn(
                "prompt", rq.render(self._slots(True), F.col("question_type"), templates))
            cols = ["doc_id", "document_name", "section_idx", "fact_number", "question_type", "difficulty",
                    "ordinal", "unit_size", "prompt", F.col("all_images").alias("images")]
            return rq.finish(srq.select(*cols).unionByName(frq.select(*cols)), self.batch_size)
        return self._m("requests", build)

    # --- responses ----------------------------------------------------------------
    @property
    def responses(self) -> DataFrame:
        """request_id, attempt, text of the model's answers; must be given (see ``operators.responses.run_live``)."""
        if self.responses_df is None:
            raise ValueError("no responses: give responses_df (request_id, attempt, text)")
        return self.responses_df

    @property
    def parsed(self) -> DataFrame:
        return self._m("parsed", lambda: rs.parse(self.responses))

    @property
    def request_keys(self) -> DataFrame:
        """The request grid without prompts (E1-E3, E12, E13): what the response
        stages join on. Built from the keys of sections, their partners and numbers of
        facts only, so it does not depend on the neighbour search and needn't be written."""
        return self._m("request_keys", lambda: rq.grid(self.section_keys, self.question_types, self.batch_size))

    @property
    def section_keys(self) -> DataFrame:
        """What the request grid needs of each section."""
        return self.section_facts.select("doc_id", "document_name", "section_idx", "partner_idx", "n_facts")

    @property
    def answered(self) -> DataFrame:
        """Unit attempts and the pairs of first successes (see ``responses.settled``). The stages below only filter and
        project these rows, nothing is shuffled again; each is written narrow for its readers."""
        def build():
            responses = self.responses
            return self._keep(rs.settled(self.request_keys, responses), "answered")
        return self._m("answered", build)

    @property
    def outcomes(self) -> DataFrame:
        def build():
            rows = self._memo.get("answered")
            if rows is None and self.persist == "table":
                # nobody has asked for pairs so far: the attempts alone are settled, their texts neither dealt out nor written
                responses = self.responses
                rows = rs.settled(self.request_keys, responses)
            return rs.settled_outcomes(self.answered if rows is None else rows, self.request_keys, self.parsed,
                                       self._keep if self.persist == "table" else None)
        return self._m("outcomes", build)

    @property
    def firsts(self) -> DataFrame:
        return self._m("firsts", lambda: self._keep(rs.settled_firsts(self.outcomes), "firsts"))

    @property
    def qa(self) -> DataFrame:
        def build():
            _ = self.answered, self.firsts  # in this order the attempts are taken from what is written with the pairs
            return self._keep(rs.settled_pairs(self.answered), "qa")
        return self._m("qa", build)

    @property
    def failures(self) -> DataFrame:
        return self._m("failures", lambda: rs.settled_failures(self.outcomes))

    @property
    def still_failing(self) -> DataFrame:
        return self._m("still_failing", lambda: rs.settled_still_failing(self.outcomes))

    # --- dataset and audit -----------------------------------------------------------
    @property
    def shaped(self):
        """Records and quarantine: projections of the written pairs."""
        return self._m("shaped", lambda: ds.shape(self.qa))

    @property
    def records(self) -> DataFrame:
        return self.shaped[0]

    @property
    def quarantine(self) -> DataFrame:
        return self.shaped[1]
