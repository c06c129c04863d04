"""Incremental runs over a growing markdown folder (Structured Streaming).

A run over a large corpus can take hours; the reference restarts a file
from scratch after an interruption. Here new documents are picked up by a
file-source stream and each micro-batch runs the per-document pipeline
(frontmatter -> sections -> facts -> images -> neighbours -> requests).
Every stage is keyed by document, so a micro-batch of whole documents is
self-contained and needs no state across batches.

Exactly-once output: the checkpoint records which files were consumed, and
each epoch writes into its own ``epoch=<id>`` folder with overwrite, so a
replayed epoch replaces its output instead of duplicating it. Output and
checkpoint are explicit shared paths, so a run that starts again finds them;
``manifest`` lists the images that exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.corpus import Corpus
from ..sources.markdown import stream_markdown_dir

REQUEST_COLUMNS = ["request_id", "doc_id", "document_name", "section_idx", "fact_number", "question_type",
                   "difficulty", "is_summary", "batch_id", "prompt", "images"]


def _process(out_dir: str, manifest: DataFrame, docs_root: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        corpus = Corpus(batch, docs_root=docs_root, manifest_df=manifest, persist="memory")
        try:
            (corpus.requests.select(*REQUEST_COLUMNS)
             .write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch_id}"))
        finally:
            corpus.unpersist()
    return run


def start(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, manifest: DataFrame,
          docs_root: str = "markdown_docs",
          available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental request builder; returns the streaming query.

    ``available_now=True`` processes what is there and stops (a restartable
    batch job); ``False`` keeps watching the folder.
    """
    w = (stream_markdown_dir(spark, source_dir, max_files_per_trigger).writeStream
         .foreachBatch(_process(out_dir, manifest, docs_root)).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_requests(spark: SparkSession, out_dir: str) -> DataFrame:
    """All requests written so far (every epoch)."""
    return spark.read.parquet(out_dir)
