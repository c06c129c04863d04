"""Token files: the ids of all documents, compressed by Re-Pair grammars with random access.

A dataset of token files is a folder with two tables:

* ``blocks`` -- one row a shard of up to ``BLOCK`` ids: part, block, first (ids
  of the part before it), n_ids, the ids of its documents and ``data``, the
  grammar in binary form (:class:`Grammar`);
* ``parts`` -- the number of ids before each part.

:func:`write_tokens` deals the documents by range of their id, so parts follow
each other; a task encodes its documents in order, ends each with the end id
and compresses shard by shard. Re-Pair (:meth:`Grammar.of`) counts the adjacent
pairs of a shard and replaces the pairs that occur at least ``USES`` times by new
symbols, round by round, until there are none. All frequent pairs of a round are
replaced at once; where two overlap, the more frequent one wins. No pair goes
over the end of a document. Every symbol's expansion length is stored, so any
range of ids is found by a search on the summed lengths, and only the symbols it
touches are expanded.

Files are written by Spark's committed writers, so a lost executor or a task
that runs twice leaves no wrong file, and any file system will do. The driver
sees one row for each of at most ``PARTS`` parts.

Edge cases: null and empty texts are the end id alone; null ids come first;
rows of one id follow each other by a hash of their text, equal rows count as
often as they occur; a document of more than a shard is cut into pieces of one
shard each and put together again by reading; an empty table gives tables
without rows; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe
from .common import binary, groups, id_and_text, read
from .ragged import expand, once
from .tokens import vocabulary_path

END_ID = 0
BLOCK = 1 << 18  # ids of a shard
USES = 4  # a new symbol takes the place of so many pairs at least
PART_BYTES = 16 << 20  # text of a part
PARTS = 16_384  # parts at most; they grow beyond
_MAGIC = b"RPG1"
_NO_RANK = np.int64(2**62)


def _sorted_pairs(pair: np.ndarray, at: np.ndarray, limit: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (below ``limit``) in order with their places; one sort of both in one word where they fit in."""
    bits = places.bit_length()
    if limit < 1 << (63 - bits):
        both = np.sort(pair << bits | at)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(pair, kind="stable")
    return pair[order], at[order]


class Grammar:
    """Symbols of a shard, and for each symbol from ``base`` on the pair it stands for and its expansion length."""

    def __init__(self, base: int, left: np.ndarray, right: np.ndarray, lengths: np.ndarray, symbols: np.ndarray,
                 pieces: np.ndarray):
        self.base, self.left, self.right, self.lengths, self.symbols = base, left, right, lengths, symbols
        self.pieces = pieces  # ids of each document in the shard
        size = np.where(symbols < base, 1, lengths[np.maximum(symbols - base, 0)] if len(lengths) else 1)
        self.at = np.zeros(len(symbols) + 1, np.int64)
        np.cumsum(size, out=self.at[1:])

    @classmethod
    def of(cls, ids: np.ndarray, pieces: np.ndarray, uses: int = USES) -> "Grammar":
        """Re-Pair of one shard; no pair crosses the pieces."""
        s = ids.astype(np.int64)
        base = int(s.max(initial=-1)) + 1
        joins = np.ones(len(s), bool)  # whether a symbol and the next one belong to one piece
        joins[np.cumsum(pieces) - 1] = False
        fresh = joins.copy()  # whether the pair that starts here may be frequent; a rare pair of old symbols stays rare
        lefts, rights, sizes, top = [], [], [np.zeros(0, np.int64)], base
        while len(s) > 1:
            at = np.flatnonzero(joins[:-1] & fresh[:-1])
            if len(at) < uses:
                break
            pair = s[at] * top + s[at + 1]
            # of overlapping equal pairs (a a a) every second one from the left counts
            again = (at[1:] == at[:-1] + 1) & (pair[1:] == pair[:-1])
            skipped = at[:0]
            if again.any():
                place = np.arange(len(at))
                chain = np.maximum.accumulate(np.where(np.r_[False, again], 0, place))
                even = (place - chain) % 2 == 0
                skipped, at, pair = at[~even], at[even], pair[even]
            pair, at = _sorted_pairs(pair, at, top * top, len(s))
            head = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            count = np.diff(np.append(head, len(pair)))
            often = np.flatnonzero(count >= uses)
            if not len(often):
                break
            # rank of each place's pair: the more frequent first, ties by the pair
            by_count = np.empty(len(often), np.int64)
            by_count[np.argsort(-count[often], kind="stable")] = np.arange(len(often))
            here = at[expand(head[often], count[often])]
            rank = np.full(len(s) + 1, _NO_RANK)
            rank[here] = np.repeat(by_count, count[often])
            # a place beats its neighbours if its pair ranks higher; what loses is counted anew in the next round
            mine = rank[here]
            won = here[(mine < rank[here + 1]) & (mine < rank[here - 1])]
            kept = np.bincount(rank[won], minlength=len(often)) >= uses
            won = won[kept[rank[won]]]
            number = np.cumsum(kept) - 1 + top
            made = np.empty(len(often), np.int64)
            made[by_count] = pair[head[often]]
            a, b = np.divmod(made[kept], top)
            known = np.concatenate(sizes)
            lefts.append(a)
            rights.append(b)
            sizes.append(sum(np.where(x < base, 1, known[np.maximum(x - base, 0)] if len(known) else 1) for x in (a, b)))
            top += len(a)
            s[won] = number[rank[won]]
            joins[won] = joins[won + 1]
            fresh[:] = False
            for i in (here, skipped, won, np.maximum(won - 1, 0)):
                fresh[i] = True
            stay = np.ones(len(s), bool)
            stay[won + 1] = False
            s, joins, fresh = s[stay], joins[stay], fresh[stay]
        none = [np.zeros(0, np.int64)]
        return cls(base, np.concatenate(lefts or none), np.concatenate(rights or none), np.concatenate(sizes), s,
                   np.asarray(pieces, np.int64))

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` to before ``stop``: only the symbols that cover them are expanded."""
        stop = int(self.at[-1]) if stop is None else min(stop, int(self.at[-1]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.at, start, side="right")) - 1
        z = int(np.searchsorted(self.at, stop, side="left"))
        sym, at = self.symbols[a:z], self.at[a:z] - self.at[a]
        out = np.zeros(int(self.at[z] - self.at[a]), np.uint32)
        while len(sym):
            leaf = sym < self.base
            out[at[leaf]] = sym[leaf]
            sym, at = sym[~leaf] - self.base, at[~leaf]
            left, right = self.left[sym], self.right[sym]
            width = np.where(left < self.base, 1, self.lengths[np.maximum(left - self.base, 0)])
            sym, at = np.concatenate([left, right]), np.concatenate([at, at + width])
        return out[start - int(self.at[a]):stop - int(self.at[a])]

    def pack(self) -> bytes:
        """Binary form: magic, counts, rules, expansion lengths, piece lengths, symbols (3 bytes each where these do)."""
        top = self.base + len(self.left)
        width = 3 if top < 1 << 24 else 4

        def narrow(v):
            return np.ascontiguousarray(v.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]).tobytes()

        head = np.array([self.base, len(self.left), len(self.pieces), len(self.symbols), width], "<i8")
        return b"".join([_MAGIC, head.tobytes(), narrow(self.left), narrow(self.right),
                         self.lengths.astype("<i8").tobytes(), self.pieces.astype("<i8").tobytes(),
                         narrow(self.symbols)])

    @classmethod
    def unpack(cls, data: bytes) -> "Grammar":
        if data[:4] != _MAGIC:
            raise ValueError("no token shard")
        base, rules, pieces, symbols, width = (int(v) for v in np.frombuffer(data, "<i8", 5, 4))
        at = 44

        def wide(n):
            nonlocal at
            v = np.zeros((n, 4), np.uint8)
            v[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
            at += n * width
            return v.view("<u4").reshape(-1).astype(np.int64)

        def longs(n):
            nonlocal at
            v = np.frombuffer(data, "<i8", n, at)
            at += 8 * n
            return v

        left, right = wide(rules), wide(rules)
        lengths, pieces = longs(rules), longs(pieces)
        return cls(base, left, right, lengths, wide(symbols), pieces)


def _shards(vocabulary: str, end_id: int, block: int, id_type: pa.DataType):
    """Sorted rows (doc_id, text) of one part to rows of ``blocks``."""
    names = ["part", "block", "first", "n_ids", "before", "doc_ids", "data"]

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        # one for all tasks of a worker process, so that its table of pre-tokens (bounded) is not learned anew by each
        enc = once(("merging encoder", vocabulary), lambda: bpe.Encoder(bpe.Vocabulary.load(vocabulary), bpe.merge))
        number = first = 0

        def shard(held: list[np.ndarray], keys: list, before: int | None = None):
            nonlocal number, first
            size = np.array([len(p) for p in held], np.int64)
            g = Grammar.of(np.concatenate(held), size)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([int(size.sum())], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([keys], pa.list_(id_type)), pa.array([g.pack()], pa.binary())], names)
            number, first = number + 1, first + int(size.sum())
            return row

        held, keys, size = [], [], 0
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for at, ids, off in enc.encode(b.column(1).to_pylist()):
                for i in range(len(off) - 1):
                    doc, key = np.append(ids[off[i]:off[i + 1]], np.int32(end_id)), doc_ids[at + i]
                    if size and size + len(doc) > block:
                        yield shard(held, keys)
                        held, keys, size = [], [], 0
                    if len(doc) > block:
                        for before in range(0, len(doc), block):
                            yield shard([doc[before:before + block]], [key], before)
                    else:
                        held.append(doc)
                        keys.append(key)
                        size += len(doc)
        if size:
            yield shard(held, keys)

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, block: int = BLOCK) -> None:
    """Writes the ids of all documents in ascending order of doc_id, each with the end id, as token files."""
    spark = docs.sparkSession
    d = id_and_text(docs)
    total = d.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 0
    parts = int(min(PARTS, max(1, total // PART_BYTES + 1)))
    # equal rows are told apart by their place, so a hot id fills several parts
    d = d.withColumn("_hash", F.xxhash64("text")).withColumn("_place", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_place")]
    d = d.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    kind = d.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = (f"part int, block int, first long, n_ids long, before long, "
              f"doc_ids array<{kind.simpleString()}>, data binary")
    d.mapInArrow(_shards(vocabulary, end_id, block, to_arrow_type(kind)), schema).write.parquet(f"{path}/blocks")
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    start, rows = 0, []
    for r in sorted(sizes, key=lambda r: r["part"]):  # at most PARTS rows
        rows.append((r["part"], start, r["n"]))
        start += r["n"]
    spark.createDataFrame(rows, "part int, start long, n_ids long").coalesce(1).write.parquet(f"{path}/parts")


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    parts = spark.read.parquet(f"{path}/parts").select("part", "start")
    return spark.read.parquet(f"{path}/blocks").join(F.broadcast(parts), "part")  # at most PARTS rows


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit) of every document."""
    def documents(batches):
        for b in batches:
            for first, before, keys, data in zip(*(b.column(i) for i in range(4))):
                g = Grammar.unpack(data.as_py())
                at = np.cumsum(g.pieces) - g.pieces
                start = first.as_py() - (before.as_py() or 0) + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(start), pa.array(first.as_py() + at), keys.values, pa.array(g.pieces),
                     binary(g.ids().astype("<u4"), np.append(at, g.at[-1]))], names)

    def joined(batches):
        for b, off in groups(batches):
            for a, z in zip(off, off[1:]):
                ids = b"".join(b.column(4).slice(a, z - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).slice(a, 1) for i in range(3)), pa.array([len(ids) // 4], pa.int64()),
                     pa.array([ids], pa.binary())], names)

    b = _blocks(spark, path)
    key = b.schema["doc_ids"].dataType.elementType.simpleString()
    names, schema = ["start", "place", "doc_id", "n_tokens", "ids"], (
        f"start long, place long, doc_id {key}, n_tokens long, ids binary")
    b = b.select((F.col("start") + F.col("first")).alias("first"), "before", "doc_ids", "data")
    whole = b.where(F.col("before").isNull()).mapInArrow(documents, schema)
    cut = b.where(F.col("before").isNotNull()).mapInArrow(documents, schema)
    cut = cut.repartition("start").sortWithinPartitions("start", "place").mapInArrow(joined, schema)
    return whole.unionAll(cut).select("doc_id", "start", "n_tokens", "ids")


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """place, ids: the ids at the places ``start`` to before ``stop`` of the whole sequence, one row for each shard."""
    b = _blocks(spark, path).withColumn("at", F.col("start") + F.col("first"))
    b = b.where((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))

    def run(batches):
        for b in batches:
            for at, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = Grammar.unpack(data).ids(max(0, start - at), stop - at).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array([max(start, at)], pa.int64()), pa.array([got.tobytes()])],
                                                 ["place", "ids"])

    return b.select("at", "data").mapInArrow(run, "place long, ids binary")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"tokens-{uuid.uuid4().hex[:12]}")
    write_tokens(read(spark, sf_dir, "documents"), path, vocabulary_path())
    d = read_tokens(spark, path)
    return d.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
