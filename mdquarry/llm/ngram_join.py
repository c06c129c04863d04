"""Jaccard join of documents on word n-grams by chosen paths.

A document is the set of its runs of five words (a text of one to four words
has one run of all its words). Documents with equal sets form a node, and
everything below works on nodes.

1. A node's set is embedded as ``TOKENS`` min-hashes. In each run a node goes
   from the root of a tree to the children of the tokens it samples: token t of
   path p is taken if hash(p, t) is below 1 / (threshold * TOKENS). Sampling
   depends on path and token only, so similar nodes take the same turns. A child
   with at most ``SMALL`` nodes is done; larger ones are split again, up to
   ``DEPTH`` times.
2. Runs are repeated until the target recall: a pair at the threshold meets d
   turns deep with probability p(d) = 1 - exp(-p(d - 1)), p(0) = 1, so
   log(1 - recall) / log(1 - p(d)) runs are needed (:func:`runs_for`). All nodes
   go through the runs for one turn; nodes that met a bucket that was split go
   through as many more as the deepest turn asks for.
3. Nodes of one bucket are compared by brute force on their min-hashes; likely
   pairs connect nodes to clusters. A large bucket is cut into blocks. First
   every block is compared with itself; only if the bucket's nodes aren't all
   connected by then, each block is compared with the others, and only pairs
   that connect two components of the bucket are handed on.
4. Within a cluster the exact similarity of every pair of sets is computed, by
   blocks in the same way: a pair is a link if it reaches the threshold. What
   leaves a task is the number of links of each node of its block, and the pairs
   that connect components, never the pairs of a group.

At the default recall a pair is missed with probability below 1e-5 by step 2,
and below 1e-4 by the loose test of step 3 (``LOOSE`` of the min-hashes equal) if
its similarity is 0.8; pairs of larger similarity are missed less often.

Edge cases: null texts and texts without words link to nothing and stay their
own class; equal rows are documents of one node; ids may be null or repeated,
a class is named by its smallest id; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import binary, connected, groups, id_and_text, keep, read, unpack, unused
from .ragged import mix, shingles, word_rows

THRESHOLD = 0.8
TOKENS = 64
RECALL = 0.99999  # share of the pairs at the threshold that meet in a bucket
SMALL = 256
DEPTH = 3
LOOSE = 0.58
BLOCK = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def text_sets(texts: list):
    """(first row, hashes flat, offsets): the distinct shingles of every text in ascending order."""
    for first, h, _, _, off in word_rows(texts):
        s, off = shingles(h, off)
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))
        order = np.lexsort((s, row))
        s, row = s[order], row[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
        s, row = s[new], row[new]
        yield first, s, np.searchsorted(row, np.arange(len(off)))


def _per_set(values: np.ndarray, off: np.ndarray, reduce) -> np.ndarray:
    """Reduces each non-empty set; empty ones give 0."""
    out = np.zeros(len(off) - 1, np.uint64)
    full = np.diff(off) > 0
    if full.any():
        out[full] = reduce(values, off[:-1][full])
    return out


def set_names(s: np.ndarray, off: np.ndarray) -> np.ndarray:
    """16 bytes that name each set: two sums of hashes of its members."""
    a = mix(_per_set(mix(s), off, np.add.reduceat) + np.diff(off).astype(np.uint64))
    b = mix(_per_set(mix(s ^ _ODD), off, np.add.reduceat))
    return np.stack([a, b], axis=1).astype(">u8")


def min_hashes(s: np.ndarray, off: np.ndarray, tokens: int = TOKENS) -> np.ndarray:
    """``tokens`` 32-bit minima of each set."""
    out = np.zeros((len(off) - 1, tokens), "<u4")
    for i, m in enumerate(_multipliers(tokens)):
        out[:, i] = _per_set(s * m, off, np.minimum.reduceat) >> np.uint64(32)
    return out


def signatures(docs: DataFrame, with_tokens: bool = True) -> DataFrame:
    """doc_id, node, n (shingles) and the min-hashes of every row."""
    def run(batches):
        for b in batches:
            for first, s, off in text_sets(b.column(1).to_pylist()):
                rows = len(off) - 1
                columns = [b.column(0).slice(first, rows), binary(set_names(s, off).reshape(-1), np.arange(rows + 1) * 2),
                           pa.array(np.diff(off))]
                names = ["doc_id", "node", "n"]
                if with_tokens:
                    columns.append(binary(min_hashes(s, off).reshape(-1), np.arange(rows + 1) * TOKENS))
                    names.append("tokens")
                yield pa.RecordBatch.from_arrays(columns, names)

    d = id_and_text(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, node binary, n long"
                        + (", tokens binary" if with_tokens else ""))


def runs_for(depth: int, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met in a bucket ``depth`` turns deep with probability ``recall``."""
    p = 1.0
    for _ in range(depth):
        p = 1 - np.exp(-p)
    return int(np.ceil(np.log(1 - recall) / np.log(1 - p)))


def _turns(threshold: float, runs: range):
    """Children that each node takes from its paths: rows (path or null, node, tokens) to (path, node)."""
    limit = np.uint64(min(2**64 - 1, int(2**64 / (threshold * TOKENS))))

    def run(batches):
        for b in batches:
            flat, _ = unpack(b.column(2), "<u4")
            t = flat.reshape(-1, TOKENS).astype(np.uint64)
            t = mix(t + (np.arange(1, TOKENS + 1, dtype=np.uint64) << np.uint64(32)))
            if b.column(0).null_count:
                starts = mix(np.arange(runs.start + 1, runs.stop + 1, dtype=np.uint64) * _ODD)
                paths = [np.full(len(t), p) for p in starts]
            else:
                paths = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)]
            for p in paths:
                row, i = np.nonzero(mix(t ^ p[:, None]) < limit)
                child = mix(p[row] * np.uint64(3) + t[row, i] + np.uint64(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child.view(np.int64)), b.column(1).take(pa.array(row))], ["path", "node"])
    return run


def _labels(near: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component in a boolean matrix with a true diagonal."""
    n = len(near)
    label = np.arange(n)
    while True:
        new = np.where(near, label[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _blocks(rows: DataFrame, group: str, size: str, extra: list[str]) -> DataFrame:
    """Rows of ``group`` with its number of blocks ``_n`` and their own ``_block``: of at most about ``BLOCK`` nodes."""
    n = F.ceil(F.col(size) / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(11), group), n).cast("int")
    return rows.select(group, "node", *extra, n.alias("_n"), mine.alias("_block"))


def _own(rows: DataFrame, group: str, extra: list[str]) -> DataFrame:
    """Every block by itself: sorted rows (_key, node, extra)."""
    r = rows.select(F.xxhash64(group, "_block", F.lit(12)).alias("_key"), "node", *extra)
    return r.repartition("_key").sortWithinPartitions("_key", "node")


def _others(rows: DataFrame, group: str, extra: list[str], later_only: bool) -> DataFrame:
    """Every block with the other (or only the later) blocks of its group: sorted rows (_part, _key, _side, node, extra).

    The block's own rows come first (_side 0), then those of the others, block
    by block; _part tells these parts from each other, so a task holds two blocks.
    """
    r = rows.where(F.col("_n") > 1)
    last = F.col("_block") if later_only else F.col("_n") - 1
    r = r.withColumn("_to", F.explode(F.sequence(F.lit(0), last)))
    own = F.col("_to") == F.col("_block")
    r = r.withColumn("_key", F.xxhash64(group, "_to", F.lit(13))).withColumn("_side", F.when(own, 0).otherwise(1))
    r = r.withColumn("_part", F.xxhash64("_key", "_side", "_block"))
    return r.repartition("_key").sortWithinPartitions("_key", "_side", "_block", "node").select(
        "_part", "_key", "_side", "node", *extra)


def _equal_tokens(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal min-hashes of every row of a and of b."""
    equal = np.zeros((len(a), len(b)), np.uint16)
    for i in range(TOKENS):
        equal += a[:, i][:, None] == b[:, i][None, :]
    return equal


def _likely_own(loose: float):
    """Sorted rows (block, node, tokens) to edges (a, b) that connect likely similar nodes of a block: one a node."""
    def run(batches):
        for b, off in groups(batches):
            nodes = b.column(1)
            flat, _ = unpack(b.column(2), "<u4")
            t = flat.reshape(-1, TOKENS)
            left, right = [], []
            for a, z in zip(off, off[1:]):
                if z - a < 2:
                    continue
                if z - a == 2:
                    if (t[a] == t[a + 1]).mean() >= loose:
                        left.append(a)
                        right.append(a + 1)
                    continue
                label = _labels(_equal_tokens(t[a:z], t[a:z]) >= loose * TOKENS)
                far = np.flatnonzero(label != np.arange(z - a))
                left += (a + label[far]).tolist()
                right += (a + far).tolist()
            if left:
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(left)), nodes.take(pa.array(right))], ["a", "b"])
    return run


class _Joined:
    """Which components a task has connected so far; says which pairs of components are news."""

    def __init__(self):
        self.up: dict[bytes, bytes] = {}

    def top(self, x: bytes) -> bytes:
        while x in self.up:
            x = self.up[x]
        return x

    def news(self, near: np.ndarray, left: list[bytes], right: list[bytes]):
        """(left component, right component) of near pairs, each connection once."""
        code: dict[bytes, int] = {}
        a, b = (np.array([code.setdefault(x, len(code)) for x in side]) for side in (left, right))
        i, j = np.nonzero(near)
        _, first = np.unique(a[i] * len(code) + b[j], return_index=True)
        for k in first.tolist():
            x, y = self.top(left[i[k]]), self.top(right[j[k]])
            if x != y:
                self.up[max(x, y)] = min(x, y)
                yield left[i[k]], right[j[k]]


def _likely_others(loose: float):
    """Sorted rows (part, key, side, node, tokens, root) to edges (a, b) between components."""
    def run(batches):
        held = held_roots = joined = key = None
        for b, off in groups(batches):
            flat, _ = unpack(b.column(4), "<u4")
            t = flat.reshape(-1, TOKENS)
            roots, side, keys = b.column(5).to_pylist(), b.column(2).to_numpy(), b.column(1).to_numpy()
            left, right = [], []
            for a, z in zip(off.tolist(), off[1:].tolist()):
                if side[a] == 0:
                    held, held_roots, joined, key = t[a:z].copy(), roots[a:z], _Joined(), keys[a]
                    continue
                if keys[a] != key:  # a block without nodes
                    continue
                near = _equal_tokens(held, t[a:z]) >= loose * TOKENS
                for x, y in joined.news(near, held_roots, roots[a:z]):
                    left.append(x)
                    right.append(y)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])
    return run


def _rooted(rows: DataFrame, root: DataFrame) -> DataFrame:
    """Rows with ``root``, the component of their node (itself if it has none)."""
    return rows.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _in_buckets(nodes: DataFrame, threshold: float, runs: range) -> tuple[DataFrame, DataFrame | None, int]:
    """Buckets (path, node, tokens, size) of these runs; the nodes that met a split bucket; the deepest turn."""
    step = nodes.select(F.lit(None).cast("bigint").alias("path"), "node", "tokens")
    done, split = [], None
    for depth in range(1, DEPTH + 1):
        paths = keep(step.mapInArrow(_turns(threshold, runs), "path long, node binary"), "paths")
        size = paths.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
        both = keep(paths.join(size, "path").join(nodes, "node").select("path", "node", "tokens", "size"), "buckets")
        last = depth == DEPTH
        done.append(both if last else both.where(F.col("size") <= SMALL))
        step = both.where(F.col("size") > SMALL).select("path", "node", "tokens")
        if last or step.isEmpty():
            break
        split = step if split is None else split.unionAll(step)
    buckets = done[0]
    for d in done[1:]:
        buckets = buckets.unionAll(d)
    return buckets, split, depth


def candidate_clusters(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """node, root of the clusters of nodes that are likely similar; nodes without a partner are left out."""
    first = runs_for(1, recall)
    buckets, split, depth = _in_buckets(nodes, threshold, range(first))
    if split is not None:
        again = keep(split.select("node", "tokens").dropDuplicates(["node"]), "again")
        more, _, deeper = _in_buckets(again, threshold, range(first, runs_for(depth, recall)))
        buckets = buckets.unionAll(more)
        if deeper > depth:  # the few more runs that a deeper turn asks for
            last, _, _ = _in_buckets(again, threshold, range(runs_for(depth, recall), runs_for(deeper, recall)))
            buckets = buckets.unionAll(last)
    rows = _blocks(buckets, "path", "size", ["tokens"])
    edges = keep(_own(rows, "path", ["tokens"]).mapInArrow(_likely_own(LOOSE), "a binary, b binary"), "edges")
    root = connected(edges)
    large = rows.where(F.col("_n") > 1)
    if split is None and large.isEmpty():
        return root
    large = keep(_rooted(large, root), "large")
    apart = large.groupBy("path").agg(F.min("root").alias("x"), F.max("root").alias("y")).where(F.col("x") != F.col("y"))
    large = large.join(apart.select("path"), "path", "left_semi")
    others = _others(large, "path", ["tokens", "root"], later_only=True)
    between = others.mapInArrow(_likely_others(LOOSE), "a binary, b binary")
    star = root.where(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b"))
    return connected(star.unionAll(between))


def _similar(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of the left list reach the threshold with which of the right one."""
    sizes = [np.array([len(s) for s in x]) for x in (left, right)]
    flat = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    place = np.cumsum(new) - 1
    # members of one set only cannot add to a common part
    shared = np.bincount(place)[place] > 1
    place, row = place[shared], row[shared]
    _, place = np.unique(place, return_inverse=True)
    common = np.zeros((len(left), len(right)), np.float32)
    width = 8192
    for at in range(0, int(place.max(initial=-1)) + 1, width):
        a, z = np.searchsorted(place, [at, at + width])
        m = np.zeros((len(left) + len(right), width), np.float32)
        m[row[a:z], place[a:z] - at] = 1
        common += m[:len(left)] @ m[len(left):].T
    union = sizes[0][:, None] + sizes[1][None, :] - common
    return common >= threshold * union - 1e-6


def _exact_own(threshold: float):
    """Sorted rows (block, node, copies, set) to (a, b, links): links of a within its block, an edge to b."""
    def run(batches):
        for b, off in groups(batches):
            nodes, copies = b.column(1), b.column(2).to_numpy()
            flat, at = unpack(b.column(3), "<u8")
            rows, roots, links = [], [], []
            for a, z in zip(off, off[1:]):
                if z - a < 2:
                    continue
                sets = [flat[at[i]:at[i + 1]] for i in range(a, z)]
                near = _similar(sets, sets, threshold)
                np.fill_diagonal(near, True)
                label = _labels(near)
                n = near @ copies[a:z] - copies[a:z]
                hit = np.flatnonzero(n > 0)
                rows += (a + hit).tolist()
                roots += (a + label[hit]).tolist()
                links += n[hit].tolist()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(rows)), nodes.take(pa.array(roots)), pa.array(links, pa.int64())],
                    ["a", "b", "links"])
    return run


def _exact_others(threshold: float):
    """Sorted rows (part, key, side, node, copies, set, root) to (a, b, links): the links of each node of a block to
    all other blocks (b is the node itself), and edges between components (without links)."""
    def run(batches):
        held = None

        def out(edges, with_links):
            rows = [(x, y, 0) for x, y in edges]
            if with_links and held is not None:
                rows += [(x, x, n) for x, n in zip(held["nodes"], held["links"].tolist()) if n]
            if rows:
                a, b, n = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()),
                                                  pa.array(n, pa.int64())], ["a", "b", "links"])

        for b, off in groups(batches):
            side, nodes, roots = b.column(2).to_numpy(), b.column(3).to_pylist(), b.column(6).to_pylist()
            copies, keys = b.column(4).to_numpy(), b.column(1).to_numpy()
            flat, at = unpack(b.column(5), "<u8")
            for a, z in zip(off.tolist(), off[1:].tolist()):
                sets = [flat[at[i]:at[i + 1]] for i in range(a, z)]
                if side[a] == 0:
                    yield from out([], True)
                    held = {"key": keys[a], "nodes": nodes[a:z], "roots": roots[a:z], "sets": [s.copy() for s in sets],
                            "links": np.zeros(z - a, np.int64), "joined": _Joined()}
                    continue
                if held is None or keys[a] != held["key"]:  # a block without nodes
                    continue
                near = _similar(held["sets"], sets, threshold)
                held["links"] += near @ copies[a:z]
                yield from out(list(held["joined"].news(near, held["roots"], roots[a:z])), False)
        yield from out([], True)
    return run


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, cluster, size, copies, members of every wanted node, read again from the text of its first document."""
    def run(batches):
        for b in batches:
            names = b.column(0).to_pylist()
            for first, s, off in text_sets(b.column(1).to_pylist()):
                rows = len(off) - 1
                got = set_names(s, off)
                mine = [i for i in range(rows) if got[i].tobytes() == names[first + i]]  # ids may be repeated
                part = pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, rows), *(b.column(i).slice(first, rows) for i in (2, 3, 4)),
                     binary(s.astype("<u8"), off)], ["node", "cluster", "size", "copies", "members"])
                yield part.take(pa.array(mine, pa.int64()))

    d = id_and_text(docs).withColumnRenamed("doc_id", "_id")
    j = wanted.join(d, F.col("first_id").eqNullSafe(F.col("_id"))).select("node", "text", "cluster", "size", "copies")
    s = j.mapInArrow(run, "node binary, cluster binary, size long, copies long, members binary")
    # repeated rows of one document give one set
    return s.groupBy("node").agg(*(F.first(c).alias(c) for c in ("cluster", "size", "copies", "members")))


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, node, n) and nodes (node, class_id, first_id, copies, n_links)."""
    signed = keep(signatures(docs), "signatures")
    nodes = keep(signed.where(F.col("n") > 0).groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.min("tokens").alias("tokens")), "nodes")
    cluster = keep(candidate_clusters(nodes.select("node", "tokens"), threshold, recall), "clusters")
    size = cluster.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    wanted = cluster.join(size, "root").join(nodes.drop("tokens"), "node").select(
        "node", F.col("root").alias("cluster"), "size", "first_id", "copies")
    rows = keep(_blocks(_sets(docs, wanted), "cluster", "size", ["copies", "members"]), "sets")
    found = keep(_own(rows, "cluster", ["copies", "members"]).mapInArrow(
        _exact_own(threshold), "a binary, b binary, links long"), "links")
    root = connected(found.select("a", "b"))
    large = rows.where(F.col("_n") > 1)
    if not large.isEmpty():
        others = _others(_rooted(large, root), "cluster", ["copies", "members", "root"], later_only=False)
        found = found.unionAll(keep(others.mapInArrow(_exact_others(threshold), "a binary, b binary, links long"), "links"))
        root = connected(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    every = nodes.drop("tokens").join(links, "node", "left").join(root, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    name = every.groupBy("root").agg(F.min("first_id").alias("class_id"))
    every = every.join(name, "root").select(
        "node", "class_id", "root", "first_id", "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("doc_id", "node", "n"), keep(every, "classes")


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links for every row.

    class_id is the smallest id of the documents that links connect; n_links
    counts the other documents at or above the threshold, copies among them.
    """
    rows, nodes = classes(docs, threshold)
    # a row without words has no node to look up, so such rows don't meet in one place
    found = rows.where(F.col("n") > 0).join(nodes.select("node", "class_id", "n_links"), "node") \
        .select("doc_id", "class_id", "n_links")
    alone = rows.where(F.col("n") == 0).select("doc_id", F.col("doc_id").alias("class_id"),
                                               F.lit(0).cast("long").alias("n_links"))
    return found.unionAll(alone)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every class with all its columns: of the smallest id, and of its texts the smallest node.

    Rows without words stay.
    """
    _, nodes = classes(docs, threshold)
    best = nodes.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("best"))
    names, at = docs.columns, docs.columns.index("text")
    node_, first_, best_ = unused(names, "_node", "_first", "_best")
    best = best.select(F.col("best.first_id").alias(first_), F.col("best.node").alias(best_))
    schema = StructType([*docs.schema.fields, StructField(node_, BinaryType())])

    def run(batches):
        for b in batches:
            for first, s, off in text_sets(b.column(at).to_pylist()):
                rows = len(off) - 1
                node = binary(set_names(s, off).reshape(-1), np.arange(rows + 1) * 2)
                empty = pa.array(np.diff(off) == 0)
                node = pa.compute.if_else(empty, pa.scalar(None, pa.binary()), node)
                yield pa.RecordBatch.from_arrays([*b.slice(first, rows).columns, node], [*names, node_])

    d = docs.mapInArrow(run, schema)
    same = F.col("doc_id").eqNullSafe(F.col(first_)) & (F.col(node_) == F.col(best_))
    stay = d.where(F.col(node_).isNotNull()).join(best, same).dropDuplicates(["doc_id", node_])
    return stay.select(*names).unionAll(d.where(F.col(node_).isNull()).select(*names))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\s\x{85}\p{Z}]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0
), e AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 0.000001
), reach(a, b) AS (
  SELECT a, b FROM p UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a
)
SELECT d.doc_id, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS class_id,
       coalesce((SELECT count(*) FROM p WHERE p.a = d.doc_id), 0) AS n_links
FROM documents d LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""
