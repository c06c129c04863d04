"""Image references.

``{{name}}`` references are extracted in order (duplicates kept). Each one
has six candidate files in priority order -- ``doc/name.png|.jpg|.jpeg`` and
the same under the corpus root -- and the first candidate that exists wins;
unresolved references are dropped (and reported).

Existence is an equi-join against a ``manifest(path)`` table (a folder's
listing, see :func:`manifest_from_dir`). The
manifest grows with the corpus, so it is *not* force-broadcast: Spark/AQE
broadcast it only when its measured size is under the threshold and fall
back to a shuffle join otherwise.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import basename, drop_last_extension
from ..sources.files import file_system, folder_files

# Fixed value: what a reference looks like.
REF_PATTERN = r"\{\{([^}]+)\}\}"
# Candidate suffixes in priority order (first under the
# document folder, then under the corpus root).
EXTENSIONS = (".png", ".jpg", ".jpeg")


def extract_refs(df: DataFrame, text: Column | str, keys: list[str]) -> DataFrame:
    """(keys…, ref_pos, ref): every ``{{name}}`` in order, 1-based position."""
    t = F.col(text) if isinstance(text, str) else text
    return df.select(*keys, F.posexplode(F.regexp_extract_all(t, F.lit(REF_PATTERN), 1)).alias("p", "ref")) \
        .select(*keys, (F.col("p") + 1).cast("int").alias("ref_pos"), "ref")


def candidates(refs: DataFrame, docs_root: str = "markdown_docs") -> DataFrame:
    """Six candidate paths per reference: a per-row generator, no join."""
    local = [F.concat(F.col("document_name"), F.lit("/"), F.col("ref"), F.lit(e)) for e in EXTENSIONS]
    rooted = [F.concat(F.lit(docs_root + "/"), F.col("document_name"), F.lit("/"), F.col("ref"), F.lit(e))
              for e in EXTENSIONS]
    arr = F.array(*[F.struct(F.lit(i + 1).alias("prio"), p.alias("path")) for i, p in enumerate(local + rooted)])
    return refs.select("*", F.inline(arr))


def resolve(refs: DataFrame, manifest: DataFrame, keys: list[str], docs_root: str = "markdown_docs") -> DataFrame:
    """(keys…, ref_pos, ref, image_path) for references with an existing file."""
    found = candidates(refs, docs_root).join(manifest.select("path").distinct(), "path")
    return found.groupBy(*keys, "ref_pos", "ref").agg(F.min_by("path", "prio").alias("image_path"))


def unresolved(refs: DataFrame, resolved: DataFrame, keys: list[str]) -> DataFrame:
    return refs.join(resolved.select(*keys, "ref_pos"), [*keys, "ref_pos"], "left_anti")


def attach(resolved: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, image_paths): resolved paths in reference order (bounded by one section)."""
    return resolved.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ref_pos", "image_path"))),
                    lambda s: s["image_path"]).alias("image_paths"))


def image_name(path: Column) -> Column:
    """Basename without extension."""
    return drop_last_extension(basename(path))


def mime_type(path: Column) -> Column:
    """MIME type from the extension, default ``application/octet-stream``."""
    ext = F.lower(F.regexp_extract(basename(path), r"\.([^.]*)$", 1))
    return (F.when(ext == "png", "image/png").when(ext.isin("jpg", "jpeg"), "image/jpeg")
            .otherwise("application/octet-stream"))


def image_block(paths: Column) -> Column:
    """Prompt block: one line per image; '' when there are none."""
    lines = F.array_join(F.transform(paths, lambda p: F.concat(F.lit("- image "), image_name(p), F.lit(": "), p)), "\n")
    return F.when(F.size(paths) > 0, F.concat(
        F.lit("Images attached to this request:\n"), lines,
        F.lit("\nRefer to an image only where it helps the question.\n\n"))).otherwise(F.lit(""))


IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg")


def manifest_from_dir(spark: SparkSession, root: str) -> DataFrame:
    """``manifest(path)``: paths within ``root`` of all its images, from a listing that the tasks share.

    ``root`` may be relative or of any scheme of ``sources.files``; no bytes are read.
    """
    return folder_files(spark, root, IMAGE_SUFFIXES, recursive=True).select("path")


def image_bytes(paths: DataFrame, root: str = "") -> DataFrame:
    """(image_path, content) of the images that can be read (A5).

    Tasks open just the given paths (relative to ``root``, or whole URIs), one
    at a time; one that isn't there or can't be read has no row.
    """
    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                try:
                    whole = path if not root or "://" in path else f"{root.rstrip('/')}/{path}"
                    system, at = file_system(whole)
                    with system.open_input_stream(at) as f:
                        data = f.read()
                except OSError:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([data], pa.binary())],
                                                 ["image_path", "content"])

    wanted = paths.where(F.col("image_path").isNotNull()).select("image_path").distinct()
    return wanted.mapInArrow(run, "image_path string, content binary")


def data_urls(paths: DataFrame, root: str = "") -> DataFrame:
    """(image_path, data_url) for readable images (C10); unreadable ones are dropped."""
    return image_bytes(paths, root).select(
        "image_path", F.concat(F.lit("data:"), mime_type(F.col("image_path")), F.lit(";base64,"),
                               F.base64("content")).alias("data_url"))
