"""Markdown corpus source (A1, A2).

Every file directly inside a directory (not recursive) whose name ends in
``.md``, read whole as UTF-8 text with its line ends (CR LF, CR) read as LF; the
document name is the file name without its last extension. Names may begin with
a dot or an underscore and hold blanks or percent signs; a file without a byte is
an empty document, a folder without such files an empty table. ``doc_id`` is a
hash of the full path, stable across runs (resume-friendly) and the same in the
streaming variant. That one uses Spark's file stream, which leaves out names that
begin with a dot or an underscore and files without a byte.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_last_extension
from .files import folder_files

MARKDOWN_SCHEMA = "value string"


def _shape(df: DataFrame, uri: Column, name: Column, text: Column) -> DataFrame:
    uri = F.regexp_replace(uri, "^file:/+", "file:///")
    return df.select(F.xxhash64(uri).alias("doc_id"), drop_last_extension(name).alias("document_name"),
                     F.regexp_replace(text, "\r\n?", "\n").alias("raw"))


def decoded(uri: Column) -> Column:
    """A path of ``_metadata`` without percent codes."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def read_markdown_dir(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, document_name, raw)``, one row per top-level ``.md`` file.

    Files are read in runs of bounded size, so a directory of many files is read
    by many tasks; each file is one row.
    """
    root = path if "://" in path or path.startswith("file:") else f"file:{os.path.abspath(path)}"
    files = folder_files(spark, path, (".md",), content=True)
    text = F.make_valid_utf8(F.col("content").cast("string"))  # bytes that are no UTF-8 become U+FFFD
    return _shape(files, F.concat(F.lit(root.rstrip("/") + "/"), F.col("path")), F.col("path"), text)


def stream_markdown_dir(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming variant: new ``.md`` files of the directory as they arrive."""
    r = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.md")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _shape(r.schema(MARKDOWN_SCHEMA).load(path), decoded(F.col("_metadata.file_path")),
                  decoded(F.col("_metadata.file_name")), F.col("value"))
