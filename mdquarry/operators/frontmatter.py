"""Frontmatter split and metadata (A2-A4, E7, E8, metadata check).

Rules (reader of one markdown file):

* a file whose content starts with ``---`` has a frontmatter block that ends
  at the first later ``---`` *anywhere* (even inside a value); the rest of the
  file, left-trimmed, is the content;
* with no closing marker the metadata is empty and the content unchanged;
* the block is read as a tree (see ``metadata_tree``: nested keys, lists, block
  scalars). The flat view has the outermost keys in file order; values stay raw
  text (YAML would turn ``1.10`` into ``1.1``), a list of texts is ``[item, item]``
  and a deeper value is JSON. A block that does not parse leaves the metadata
  empty and the content keeps its frontmatter, as a YAML error does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lstrip_ws, strip_ws
from . import metadata_tree as mt

def split_frontmatter(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``has_frontmatter``, ``fm_parsed``, ``metadata`` (ordered key/value array of the outermost keys),
    ``metadata_tree`` (VARIANT), ``metadata_leaves`` (path and text of every value), ``content``; drops ``raw``."""
    r = F.col(raw)
    close = F.col("_close")
    # step-wise projections: each intermediate is computed once per row
    d = docs.withColumn("_close", F.when(r.startswith("---"), F.locate("---", r, 4)).otherwise(F.lit(0)))
    d = d.withColumn("_lines", mt.lines(F.when(close > 0, strip_ws(F.substring(r, F.lit(4), close - 4)))))
    d = d.withColumn("_tokens", F.when(mt.starts_as_mapping(F.col("_lines")), mt.tokens(F.col("_lines"))))
    d = d.withColumn("_found", F.when(mt.one_value_a_line(F.col("_tokens")), mt.nodes(F.col("_tokens"))))
    d = d.withColumn("_nodes", F.when(mt.valid_texts(F.col("_found")), F.col("_found")))
    keys = F.transform(F.filter("_nodes", lambda n: n["parent"] == 0), lambda n: n["key"])
    d = d.withColumn("_keys", F.array_distinct(keys))
    d = d.withColumn("_pieces", mt.pieces(mt.last_values(F.col("_nodes"))))
    ok = F.col("_nodes").isNotNull()
    none = F.array()
    return (
        d.withColumn("has_frontmatter", close > 0)
        .withColumn("fm_parsed", ok | (close == 0))
        .withColumn("metadata", F.coalesce(mt.flat(F.col("_pieces"), F.col("_keys")),
                                           none.cast("array<struct<key:string,value:string>>")))
        .withColumn("metadata_tree", mt.tree(F.col("_pieces")))
        .withColumn("metadata_leaves", F.coalesce(mt.leaves(F.col("_pieces")),
                                                  none.cast("array<struct<path:string,text:string>>")))
        .withColumn("content", F.when(ok, lstrip_ws(F.substring(r, close + 3, F.lit(2147483647)))).otherwise(r))
        .drop("_close", "_lines", "_tokens", "_found", "_nodes", "_keys", "_pieces", raw)
    )


def metadata_leaf_rows(docs: DataFrame) -> DataFrame:
    """One row per value of the tree at any depth, read back from the VARIANT by its path."""
    d = docs.select("doc_id", "metadata_tree", F.posexplode("metadata_leaves").alias("pos", "leaf"))
    return d.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("leaf_pos"), F.col("leaf.path").alias("path"),
                    F.col("leaf.text").alias("value"),
                    F.try_variant_get("metadata_tree", F.col("leaf.path"), "string").alias("tree_value"))


def metadata_rows(docs: DataFrame) -> DataFrame:
    """One row per metadata key, in file order (1-based ``key_pos``)."""
    return docs.select("doc_id", F.posexplode("metadata").alias("pos", "kv")).select(
        "doc_id",
        (F.col("pos") + 1).cast("bigint").alias("key_pos"),
        F.col("kv.key").alias("meta_key"),
        F.col("kv.value").alias("meta_value"),
    )


def document_title(metadata: Column, default: str = "the document") -> Column:
    """``metadata['title']`` or a default."""
    t = F.try_element_at(F.filter(metadata, lambda e: e["key"] == "title"), F.lit(1))["value"]
    return F.coalesce(t, F.lit(default))


def metadata_block(metadata: Column) -> Column:
    """Prompt block with one ``- key: value`` line per key in file order, or '' (E8)."""
    lines = F.array_join(F.transform(metadata, lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"])), "\n")
    return F.when(F.size(metadata) > 0, F.concat(F.lit("Document metadata:\n"), lines, F.lit("\n"))).otherwise(F.lit(""))


REQUIRED_KEYS = ("title", "description")


def missing_required_metadata(docs: DataFrame, required=REQUIRED_KEYS) -> DataFrame:
    """Documents lacking a required frontmatter key: one row per (document, key)."""
    req = F.array(*[F.lit(k) for k in required])
    keys = F.transform("metadata", lambda e: e["key"])
    return docs.select(
        "doc_id", "document_name",
        F.explode(F.array_except(req, keys)).alias("missing_key"),
    )
