"""Most similar sections of the same document by TF-IDF cosine.

Semantics (per document, ``n`` sections):

* corpus text = each whole section; tokens are the lower-cased runs of two or
  more word characters, minus English stop words;
* vocabulary = all terms of the document; ``idf = ln((1 + n) / (1 + df)) + 1``;
  vectors are ``tf * idf``, L2-normalised;
* a query (a whole section, or a fact) is vectorised over that vocabulary;
* the ``k = min(3, n - 1)`` nearest corpus sections by cosine -- the query's
  own section included, ties (similarity rounded to 6 places) by index --
  are taken, then the query's own section is removed.

``max_chars`` and ``max_terms`` limit the corpus text to a prefix and the
vocabulary to the most frequent terms (ties by term); by default nothing is cut.

Execution plan. A section travels as one row with its tokens, never as a row
for each term. Scoring is blocked and streamed: a document's sections are cut into
corpus blocks; rows are sorted so that a block's corpus rows come first and its
queries follow, and the queries are scored slice by slice against the block's
postings. A task holds one corpus block and one slice, however many queries
(facts) a section or document has. A document of one block is dealt out once:
its terms are counted and weighed where it is scored, and sections that ask
for their own neighbours are sent once for both sides. In a document of several
blocks each block counts its terms, the counts are summed by document and term
(``groupBy``), and each block gets the idf of its own terms back to weigh its
sections, so a hot document never lands whole in one task. Every block has an
upper bound for a query (the query's product with the block's maximal
weights); a query goes to the block with the highest bound first and then only
to those blocks whose bound reaches its k-th similarity so far. Only the
per-block top-k survives, and a final top-k over the survivors gives the
answer. No pair list of a document is ever materialised.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stopwords import english_stop_words
from ..llm.common import binary, groups, unpack
from ..plans.templates import NO_NEIGHBOURS
from .sections import by_document

TOKEN = r"[\p{L}\p{N}_]{2,}"  # Python's \w: letters, numbers and the underscore
K = 3
SLICE_ROWS = 1024  # queries scored at once
SLICE_POSTINGS = 1 << 22  # or fewer, if they meet more postings than this


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def words(text: Column) -> Column:
    """The tokens of a text without stop words, in one string with spaces between them."""
    return F.array_join(F.filter(tokens(F.coalesce(text, F.lit(""))), lambda t: ~t.isin(*english_stop_words())), " ")


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    salt: Column, buckets: int = 32, rank_col: str = "rank") -> DataFrame:
    """Exact top-k per group in two stages: top-k within (group, salt) buckets,
    then top-k of the <= buckets*k survivors. No group is sorted whole."""
    s = df.withColumn("_salt", F.abs(F.xxhash64(salt)) % buckets)
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    s = s.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return s.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)


def _without_stop_words(toks: DataFrame) -> DataFrame:
    # fixed 181-word set: an in-row hash-set filter (InSet), no join at all
    return toks.where(~F.col("term").isin(*english_stop_words()))


def prefix(text: str, max_chars: int | None) -> Column:
    return F.col(text) if max_chars is None else F.substring(text, 1, max_chars)


def _with_idf(stats: DataFrame, sections: DataFrame, max_terms: int | None) -> DataFrame:
    """doc_id, term, term_id, idf from doc_id, term, cf, dfreq: the terms that stay in the vocabulary."""
    if max_terms is not None:
        stats = top_k_per_group(stats, ["doc_id"], [F.col("cf").desc(), F.col("term")], max_terms,
                                salt=F.col("term"))
    # one row for each document on the right; a document with very many terms is split by AQE
    n = sections.select("doc_id", "n").where(F.col("section_idx") == 1)
    return stats.join(n, "doc_id").withColumns({
        "term_id": F.xxhash64("term"),
        "idf": F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("dfreq"))) + 1.0}).drop("cf", "dfreq", "n")


def vectors(tf: DataFrame, vocab: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, term_ids array<bigint>, weights array<double>) L2-normalised tf-idf."""
    w = tf.join(vocab, ["doc_id", "term"]).select(*keys, "term_id", (F.col("tf") * F.col("idf")).alias("w"))
    return w.groupBy(*keys).agg(
        F.collect_list(F.struct("term_id", "w")).alias("v"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
    ).select(*keys, F.transform("v", lambda e: e["term_id"]).alias("term_ids"),
             F.transform("v", lambda e: e["w"] / F.col("norm")).alias("weights"))


def packed(df: DataFrame) -> DataFrame:
    """``term_ids`` and ``weights`` as bytes, as the scorer reads them."""
    names = df.columns

    def run(batches):
        for b in batches:
            columns = dict(zip(names, b.columns))
            for c, kind in (("term_ids", "<i8"), ("weights", "<f8")):
                off = columns[c].offsets.to_numpy()
                columns[c] = binary(np.asarray(columns[c].flatten()).astype(kind), off - off[0])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return df.mapInArrow(run, ", ".join(f"{f.name} {'binary' if f.name in ('term_ids', 'weights') else f.dataType.simpleString()}"
                                        for f in df.schema))


def query_tf(queries: DataFrame, text: str, keys: list[str]) -> DataFrame:
    t = _without_stop_words(queries.select(*keys, F.explode(tokens(F.col(text))).alias("term")))
    return t.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def _empty(t: str) -> Column:
    return F.array().cast(f"array<{t}>")


_OUT_SCHEMA = "doc_id bigint, self_idx int, qsub int, k int, nbr_idx int, sim double"
_OUT_NAMES = ["doc_id", "self_idx", "qsub", "k", "nbr_idx", "sim"]
_IN = ["doc_id", "cb", "qb", "side", "idx", "qsub", "k", "term_ids", "weights"]
OUT_ROWS = 8192  # rows that the tasks hand back at once


def _ragged(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places begin[i] to begin[i] + n[i], one after another."""
    ends = np.cumsum(n)
    return np.repeat(begin - (ends - n), n) + np.arange(int(n.sum()))


def _nearest(block, off, terms, weights, k: int, slice_rows: int, slice_postings: int):
    """(first query, last, sections, similarities) of slices of queries: each one's top-k of a block.

    ``block``: the sections' numbers and their postings (term, section's place, weight), by term.
    """
    idx, t, at, w = block
    rows = len(off) - 1
    lo = np.searchsorted(t, terms, "left")
    met = np.searchsorted(t, terms, "right") - lo
    total = np.append(0, np.cumsum(met))[off]
    at_row = 0
    while at_row < rows:
        stop = max(at_row + 1, min(at_row + slice_rows, int(np.searchsorted(
            total, total[at_row] + slice_postings, "right")) - 1))
        x, y = int(off[at_row]), int(off[stop])
        n = met[x:y]
        hit = _ragged(lo[x:y], n)
        row = np.repeat(np.repeat(np.arange(stop - at_row), np.diff(off[at_row:stop + 1])), n)
        score = np.repeat(weights[x:y], n) * w[hit]
        sims = np.bincount(row * len(idx) + at[hit], score, (stop - at_row) * len(idx))
        # (no match at all gives integers)
        sims = np.round(sims.astype(np.float64).reshape(stop - at_row, len(idx)), 6)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :min(k, len(idx))]  # ties: lower section
        yield at_row, stop, idx[best], np.take_along_axis(sims, best, axis=1)
        at_row = stop


def _postings(idx, at, terms, weights):
    order = np.argsort(terms, kind="stable")
    return idx, terms[order], at[order], weights[order]


def _runs(columns, rows: int):
    """(first, last) of the runs of rows with equal values in all columns."""
    change = np.zeros(rows, bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    cuts = np.concatenate([[0], np.flatnonzero(change), [rows]]).tolist()
    return [(a, z) for a, z in zip(cuts[:-1], cuts[1:]) if a < z]


def _scorer(slice_rows: int, slice_postings: int):
    """Sorted rows (block, side, ...) to each query's top-k of the block; self-contained, it runs in the workers."""
    def run(batches):
        key, parts, block = None, [], None
        for b in batches:
            col = [b.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            terms, off = unpack(b.column(7), "<i8")
            weights, _ = unpack(b.column(8), "<f8")
            for a, z in _runs(col[:4], b.num_rows):
                here = tuple(int(c[a]) for c in col[:3])
                if col[3][a] == 0:
                    if here != key:
                        key, parts = here, []
                    parts.append((col[4][a:z], np.diff(off[a:z + 1]), terms[off[a]:off[z]], weights[off[a]:off[z]]))
                    block = None
                    continue
                if here != key:
                    continue
                if block is None:
                    idx = np.concatenate([p[0] for p in parts])
                    at = np.repeat(np.arange(len(idx)), np.concatenate([p[1] for p in parts]))
                    block = _postings(idx, at, np.concatenate([p[2] for p in parts]),
                                      np.concatenate([p[3] for p in parts]))
                for x, y, nbr, sims in _nearest(block, off[a:z + 1] - off[a], terms[off[a]:off[z]],
                                                weights[off[a]:off[z]], int(col[6][a]), slice_rows, slice_postings):
                    rows = np.repeat(np.arange(a + x, a + y), nbr.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(col[0][rows]), pa.array(col[4][rows]), pa.array(col[5][rows]), pa.array(col[6][rows]),
                         pa.array(nbr.reshape(-1)), pa.array(sims.reshape(-1))], _OUT_NAMES)

    return run


def _counted(text: pa.Array, group: np.ndarray, vocabulary: pa.Array | None = None):
    """(group, code, tf) by group and code, and the terms that the codes number: the terms of rows of words.

    ``group`` numbers the rows, equal numbers are counted together; with a
    ``vocabulary`` its places are the codes and other terms are left out.
    """
    lists = pc.split_pattern(text, " ")
    row = np.repeat(group, np.asarray(pc.list_value_length(lists)))
    coded = lists.flatten().dictionary_encode()
    code, terms = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    if vocabulary is not None:
        to = np.asarray(pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1)).astype(np.int64)
        code, terms = to[code], vocabulary
        stay = code >= 0
    else:
        # a row without words is one empty string
        stay = code != pc.fill_null(pc.index_in(pa.scalar("", terms.type), value_set=terms), -1).as_py()
    row, code = row[stay], code[stay]
    both, tf = np.unique(row * max(len(terms), 1) + code, return_counts=True)
    return *np.divmod(both, max(len(terms), 1)), tf, terms


def _term_rows(row, code, tf, idf_code, idf, size: int):
    """(row, code, tf, idf, weight): every term with each of its idf values (sorted by code), tf * idf normalised by row."""
    lo = np.searchsorted(idf_code, code, "left")
    n = np.searchsorted(idf_code, code, "right") - lo
    row, code, tf, idf = np.repeat(row, n), np.repeat(code, n), np.repeat(tf, n), idf[_ragged(lo, n)]
    w = tf * idf
    norm = np.sqrt(np.bincount(row, w * w, size))
    return row, code, tf, idf, w / norm[row]


def _weighed(row, code, tf, idf_code, idf, size: int):
    """(row, code, weight) of :func:`_term_rows`."""
    row, code, _, _, w = _term_rows(row, code, tf, idf_code, idf, size)
    return row, code, w


def _copied(row, values, to, size: int):
    """(offsets, *values): the values of the row ``to[i]`` for each i; ``row`` is sorted, ``size`` rows are numbered."""
    start = np.searchsorted(row, np.arange(size + 1))
    n = np.diff(start)[to]
    hit = _ragged(start[:-1][to], n)
    return np.append(0, np.cumsum(n)), *(v[hit] for v in values)


_WORDS_IN = ["doc_id", "side", "idx", "qsub", "k", "n", "max_terms", "words", "asked"]


def _document_scorer(own: bool, slice_rows: int, slice_postings: int):
    """Rows of whole documents of one block, sections first, to each query's top-k: terms are counted and weighed here.

    ``own``: the sections are the queries, with the words ``asked`` where these are not the same.
    """
    def block_of(parts):
        idx, n = (np.concatenate([np.asarray(p.column(i)) for p in parts]) for i in (2, 5))
        limit = parts[0].column(6)[0].as_py()
        number, group = np.unique(idx, return_inverse=True)
        # rows that share a number are one section of the vocabulary
        row, code, tf, terms = _counted(pa.concat_arrays([p.column(7) for p in parts]), group)
        df = np.bincount(code, minlength=len(terms))
        stay = np.flatnonzero(df)
        if limit is not None and len(stay) > limit:
            rank = np.empty(len(terms), np.int64)
            rank[np.asarray(pc.array_sort_indices(terms))] = np.arange(len(terms))
            cf = np.bincount(code, tf, len(terms))
            stay = np.sort(stay[np.lexsort((rank[stay], -cf[stay]))[:limit]])
        first = n[idx == 1].astype(np.float64)
        idf_code = np.repeat(stay, len(first))
        idf = (np.log((1.0 + first[None, :]) / (1.0 + df[stay][:, None])) + 1.0).reshape(-1)
        row, code, w = _weighed(row, code, tf, idf_code, idf, len(number))
        off, code, w = _copied(row, (code, w), group, len(number))
        at = np.repeat(np.arange(len(idx)), np.diff(off))
        return _postings(idx, at, code, w), terms, (idf_code, idf), (off, code, w)

    def answers(block, rows, vectors):
        ids, idx, qsub, k = (np.asarray(rows.column(i)) for i in (0, 2, 3, 4))
        for x, y, nbr, sims in _nearest(block, *vectors, int(k[0]), slice_rows, slice_postings):
            at = np.repeat(np.arange(x, y), nbr.shape[1])
            yield ids[at], idx[at], qsub[at], k[at], nbr.reshape(-1), sims.reshape(-1)

    def vectors_of(text, terms, idf):
        n = len(text)
        row, code, tf, _ = _counted(text, np.arange(n), terms)
        row, code, w = _weighed(row, code, tf, *idf, n)
        return _copied(row, (code, w), np.arange(n), n)

    def found(batches):
        key, parts, block = None, [], None

        def of_sections():
            if own and parts:
                postings, terms, idf, vectors = block_of(parts)
                rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                if rows.column(8).null_count < rows.num_rows:
                    vectors = vectors_of(pc.coalesce(rows.column(8), rows.column(7)), terms, idf)
                yield from answers(postings, rows, vectors)

        for b in batches:
            ids, side = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for a, z in _runs((ids, side), b.num_rows):
                here, rows = int(ids[a]), b.slice(a, z - a)
                if side[a] == 0:
                    if here != key:
                        yield from of_sections()
                        key, parts, block = here, [], None
                    parts.append(rows)
                elif here == key:
                    if block is None:
                        block = block_of(parts)
                    yield from answers(block[0], rows, vectors_of(rows.column(7), block[1], block[2]))
        yield from of_sections()

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], _OUT_NAMES)

    def run(batches):
        held, size = [], 0
        for columns in found(batches):
            held.append(columns)
            size += len(columns[0])
            if size >= OUT_ROWS:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    return run


def block_terms(sections: DataFrame) -> DataFrame:
    """doc_id, cb, term, cf, dfreq: the terms of every block, from doc_id, cb, section_idx, words."""
    def counts(key, parts):
        idx = np.concatenate([np.asarray(p.column(2)) for p in parts])
        _, group = np.unique(idx, return_inverse=True)
        _, code, tf, terms = _counted(pa.concat_arrays([p.column(3) for p in parts]), group)
        df = np.bincount(code, minlength=len(terms))
        stay = np.flatnonzero(df)
        cf = np.bincount(code, tf, len(terms)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(stay), key[0], np.int64)), pa.array(np.full(len(stay), key[1], np.int32)),
             terms.take(pa.array(stay)), pa.array(cf[stay]), pa.array(df[stay].astype(np.int64))],
            ["doc_id", "cb", "term", "cf", "dfreq"])

    def run(batches):
        key, parts = None, []
        for b in batches:
            ids, cb = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for a, z in _runs((ids, cb), b.num_rows):
                here = int(ids[a]), int(cb[a])
                if here != key and parts:
                    yield counts(key, parts)
                    parts = []
                key = here
                parts.append(b.slice(a, z - a))
        if parts:
            yield counts(key, parts)

    rows = sections.select("doc_id", "cb", "section_idx", "words").repartition("doc_id", "cb") \
        .sortWithinPartitions("doc_id", "cb")
    return rows.mapInArrow(run, "doc_id bigint, cb int, term string, cf bigint, dfreq bigint")


def block_vectors(sections: DataFrame, idf: DataFrame, terms: bool = False) -> DataFrame:
    """doc_id, n, cb, section_idx, term_ids, weights: the sections' vectors (64-bit numbers in a row), and with
    section_idx null the block's maximal weight of each term; or with ``terms`` the rows of :func:`document_weights`.

    sections: doc_id, n, cb, section_idx, words; idf: doc_id, cb, term, term_id, idf of each block's own terms.
    """
    names = ["doc_id", "n", "cb", "section_idx", "term_ids", "weights"]

    def vectors(key, parts):
        known = pa.Table.from_batches([p for s, p in parts if not s]).combine_chunks() if not parts[0][0] else None
        rows = pa.Table.from_batches([p for s, p in parts if s]).combine_chunks() if parts[-1][0] else None
        if rows is None:
            return
        idx = np.asarray(rows.column(3))
        n = np.asarray(rows.column(4))
        number, group = np.unique(idx, return_inverse=True)
        off, code, w = np.zeros(len(idx) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
        term_id = np.zeros(0, np.int64)
        if known is not None:
            column = known.column(5).combine_chunks()
            coded = (column.chunk(0) if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
            at = np.asarray(coded.indices).astype(np.int64)
            order = np.argsort(at, kind="stable")
            term_id = np.zeros(len(coded.dictionary), np.int64)
            term_id[at] = np.asarray(known.column(6))
            text = rows.column(5).combine_chunks()
            text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
            row, code, tf, _ = _counted(text, group, coded.dictionary)
            row, code, tf, weight, w = _term_rows(row, code, tf, at[order], np.asarray(known.column(7))[order], len(number))
            if terms:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), key[0], np.int64)), pa.array(number[row].astype(np.int32)),
                     coded.dictionary.take(pa.array(code)), pa.array(tf.astype(np.int64)), pa.array(weight), pa.array(w)],
                    _WEIGHT_NAMES)
                return
            off, code, w = _copied(row, (code, w), group, len(number))
        if terms:
            return
        yield batch(key, n, idx, off, term_id[code], w)
        top, at = np.unique(code, return_inverse=True)
        most = np.zeros(len(top))
        np.maximum.at(most, at, w)
        if len(top):
            yield batch(key, n[:1], None, np.array([0, len(top)]), term_id[top], most)

    def batch(key, n, idx, off, ids, w):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), key[0], np.int64)), pa.array(n.astype(np.int32)),
             pa.array(np.full(len(n), key[1], np.int32)),
             pa.nulls(1, pa.int32()) if idx is None else pa.array(idx.astype(np.int32)),
             binary(ids.astype("<i8"), off), binary(w.astype("<f8"), off)], names)

    def run(batches):
        key, parts = None, []
        for b in batches:
            ids, cb, side = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for a, z in _runs((ids, cb, side), b.num_rows):
                here = int(ids[a]), int(cb[a])
                if here != key and parts:
                    yield from vectors(key, parts)
                    parts = []
                key = here
                parts.append((bool(side[a]), b.slice(a, z - a)))
        if parts:
            yield from vectors(key, parts)

    no = F.lit(None)
    known = idf.select("doc_id", "cb", F.lit(False).alias("side"), no.cast("int").alias("section_idx"),
                       no.cast("int").alias("n"), F.col("term").alias("words"), "term_id", "idf")
    rows = sections.select("doc_id", "cb", F.lit(True).alias("side"), "section_idx", "n", "words",
                           no.cast("long").alias("term_id"), no.cast("double").alias("idf"))
    rows = known.unionByName(rows).repartition("doc_id", "cb").sortWithinPartitions("doc_id", "cb", "side")
    return rows.mapInArrow(run, _WEIGHTS if terms else
                           "doc_id bigint, n int, cb int, section_idx int, term_ids binary, weights binary")


_WEIGHTS = "doc_id bigint, section_idx int, term string, tf bigint, idf double, weight double"
_WEIGHT_NAMES = ["doc_id", "section_idx", "term", "tf", "idf", "weight"]
WORD_BYTES = 1 << 22  # words of documents that are weighed at once (one document at least)


def document_weights(sections: DataFrame, max_terms: int | None) -> DataFrame:
    """doc_id, section_idx, term, tf, idf, weight of documents of one block, from doc_id, n, section_idx, words.

    A document's sections are dealt out once, as words; some documents are counted and weighed together.
    """
    def weighed(rows, off):
        ids, idx, n = (np.asarray(rows.column(i)) for i in range(3))
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        # rows that share a number are one section
        number, group = np.unique(doc << 32 | idx, return_inverse=True)
        section_doc = number >> 32
        row, code, tf, terms = _counted(rows.column(3), group)
        size = max(len(terms), 1)
        pair, at, df = np.unique(section_doc[row] * size + code, return_inverse=True, return_counts=True)
        stay = np.ones(len(pair), bool)
        if max_terms is not None:
            rank = np.empty(size, np.int64)
            rank[np.asarray(pc.array_sort_indices(terms))] = np.arange(len(terms))
            cf = np.bincount(at, tf, len(pair))
            order = np.lexsort((rank[pair % size], -cf, pair // size))
            begin = np.searchsorted(pair // size, np.arange(len(off) - 1))
            stay[order[np.arange(len(pair)) - begin[(pair // size)[order]] >= max_terms]] = False
        # a document that comes twice has two numbers of sections, its terms then come with each of them
        first = np.flatnonzero(idx == 1)
        lo = np.searchsorted(doc[first], pair // size, "left")
        many = np.where(stay, np.searchsorted(doc[first], pair // size, "right") - lo, 0)
        idf = np.log((1.0 + n[first][_ragged(lo, many)]) / (1.0 + np.repeat(df, many))) + 1.0
        row, at, tf, idf, w = _term_rows(row, at, tf, np.repeat(np.arange(len(pair)), many), idf, len(number))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[off[:-1]][section_doc[row]]), pa.array((number & 0xffffffff)[row].astype(np.int32)),
             terms.take(pa.array(pair[at] % size)), pa.array(tf.astype(np.int64)), pa.array(idf), pa.array(w)], _WEIGHT_NAMES)

    def run(batches):
        for rows, off in groups(batches):
            size = np.append(0, np.cumsum(np.asarray(pc.binary_length(rows.column(3)))))[off]
            a = 0
            while a < len(off) - 1:
                z = max(a + 1, int(np.searchsorted(size, size[a] + WORD_BYTES, "right")) - 1)
                yield weighed(rows.slice(off[a], off[z] - off[a]), off[a:z + 1] - off[a])
                a = z

    rows = sections.where(F.col("doc_id").isNotNull()).select("doc_id", "section_idx", "n", "words")
    return rows.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, _WEIGHTS)


def _block(c: str, size: int) -> Column:
    return F.floor((F.col(c) - 1) / size).cast("int")


def _scored(corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """Each query's top-k of each corpus block it is sent to.

    corpus:  doc_id, cb, qb, idx, term_ids, weights; queries: the same with qsub and k.
    A key is (document, corpus block cb, run of queries qb). Documents of one block come as words instead of vectors
    (corpus: doc_id, idx, k, n, max_terms, words, asked; queries: doc_id, idx, qsub, k, words); queries that hold no
    words are the corpus itself, which is dealt out once.
    """
    if "words" in corpus.columns:
        own = "words" not in queries.columns
        rows = corpus.withColumns({"side": F.lit(0), "qsub": F.lit(0)}).select(*_WORDS_IN)
        if not own:
            no = F.lit(None)
            rows = rows.unionByName(queries.withColumns({
                "side": F.lit(1), "n": no.cast("int"), "max_terms": no.cast("int"), "asked": no.cast("string")})
                .select(*_WORDS_IN))
        rows = rows.repartition("doc_id").sortWithinPartitions("doc_id", "side", "idx", "qsub")
        return rows.mapInArrow(_document_scorer(own, SLICE_ROWS, SLICE_POSTINGS), _OUT_SCHEMA)
    c = corpus.select("doc_id", "cb", "qb", F.lit(0).alias("side"), "idx", F.lit(0).alias("qsub"), F.lit(0).alias("k"),
                      "term_ids", "weights")
    q = queries.select("doc_id", "cb", "qb", F.lit(1).alias("side"), "idx", "qsub", "k", "term_ids", "weights")
    rows = c.unionByName(q).select(*_IN).repartition("doc_id", "cb", "qb") \
        .sortWithinPartitions("doc_id", "cb", "qb", "side", "idx", "qsub")
    return rows.mapInArrow(_scorer(SLICE_ROWS, SLICE_POSTINGS), _OUT_SCHEMA)


_QUERY = ["doc_id", "self_idx", "qsub"]
GROUP_BLOCKS = 256  # blocks whose maximal weights a task holds
MARGIN = 2e-6  # similarities and bounds are rounded to 6 places


def _best(scored: DataFrame) -> DataFrame:
    w = Window.partitionBy(*_QUERY).orderBy(F.col("sim").desc(), F.col("nbr_idx"))
    return scored.withColumn("r", F.row_number().over(w)).where(F.col("r") <= F.col("k"))


def block_bounds(queries: DataFrame, top: DataFrame, query_block: int) -> DataFrame:
    """doc_id, self_idx, qsub, cb, bound: no section of the block is more similar to the query than ``bound``.

    A block's bound is the query's product with the block's maximal weight of each
    term: a vector like a section's, so the same scorer gives all blocks' bounds,
    ``GROUP_BLOCKS`` blocks at a time. Blocks that share no term are left out,
    except the first ones (``n_first``), whose sections come first among those of
    similarity 0.

    queries: doc_id, n_blocks, n_first, self_idx, qsub, term_ids, weights;
    top: doc_id, n, cb, term_ids, weights of every block's terms.
    """
    runs = F.floor((F.col("n") - 1) / query_block).cast("int")
    c = top.select("doc_id", (F.floor(F.col("cb") / GROUP_BLOCKS)).cast("int").alias("cb"), F.col("cb").alias("idx"),
                   F.explode(F.sequence(F.lit(0), runs)).alias("qb"), "term_ids", "weights")
    groups = F.floor((F.col("n_blocks") - 1) / GROUP_BLOCKS).cast("int")
    q = queries.select("doc_id", F.explode(F.sequence(F.lit(0), groups)).alias("cb"), _block("self_idx", query_block).alias("qb"),
                       F.col("self_idx").alias("idx"), "qsub", F.lit(GROUP_BLOCKS).alias("k"), "term_ids", "weights")
    found = _scored(c, q).where(F.col("sim") > 0).select(*_QUERY, F.col("nbr_idx").alias("cb"), F.col("sim").alias("bound"))
    first = queries.select(*_QUERY, F.explode(F.sequence(F.lit(0), F.col("n_first") - 1)).alias("cb"),
                           F.lit(0.0).alias("bound"))
    return found.unionByName(first).groupBy(*_QUERY, "cb").agg(F.max("bound").alias("bound"))


def _pruned(queries: DataFrame, corpus: DataFrame, top: DataFrame, k: int, block_size: int, query_block: int, keep) -> DataFrame:
    """Top-k of the queries of documents with several corpus blocks: blocks that can't reach it are skipped.

    Every query is scored against the block with its highest bound first; the
    k-th similarity there is its threshold, and it goes only to those other blocks
    whose bound reaches the threshold.

    corpus: doc_id, n, cb, section_idx, term_ids, weights; top: the blocks' maximal weights (see :func:`block_vectors`).
    """
    n_blocks = (F.floor((F.col("n") - 1) / block_size) + 1).cast("int")
    always = -(-k // block_size)  # blocks that hold the first k sections
    q = queries.withColumn("n_blocks", n_blocks).withColumn("n_first", F.least(F.lit(always), "n_blocks")) \
        .withColumn("k", F.least(F.lit(k), F.col("n") - 1).cast("int"))
    blocks = corpus.withColumnRenamed("section_idx", "idx")
    bounds = keep(block_bounds(q, top, query_block))
    home = bounds.groupBy(*_QUERY).agg(F.max_by("cb", F.struct("bound", -F.col("cb"))).alias("cb"))
    runs = F.floor((F.col("n") - 1) / query_block).cast("int")
    c = blocks.withColumn("qb", F.explode(F.sequence(F.lit(0), runs)))

    def sent(to: DataFrame) -> DataFrame:
        j = q.join(to, _QUERY)
        return j.withColumn("qb", _block("self_idx", query_block)).withColumnRenamed("self_idx", "idx")

    first = keep(_scored(c, sent(home)))
    kth = first.groupBy(*_QUERY).agg(F.min("sim").alias("kth"), F.count(F.lit(1)).alias("found"), F.max("k").alias("k"))
    # fewer than k sections in the first block set no threshold
    floor = kth.select(*_QUERY, F.when(F.col("found") >= F.col("k"), F.col("kth")).otherwise(F.lit(0.0)).alias("floor"))
    rest = bounds.join(home.select(*_QUERY, F.col("cb").alias("home")), _QUERY).where(F.col("cb") != F.col("home")) \
        .join(floor, _QUERY).where((F.col("cb") < always) | (F.col("bound") >= F.col("floor") - MARGIN))
    return first.unionByName(_scored(c, sent(rest.select(*_QUERY, "cb"))))


def knn(sections: DataFrame, queries: DataFrame | None, large, k: int = K, block_size: int = 512,
        query_block: int = 4096, max_terms: int | None = None, keep=lambda df: df) -> DataFrame:
    """Blocked exact kNN.

    sections: doc_id, n (sections in the doc), section_idx, words, asked (every section of the doc)
    queries:  doc_id, n, self_idx int, qsub int (fact number), words; none: each section asks, with the words
              ``asked``, or its own where these are null
    Returns doc_id, self_idx, qsub, rank, nbr_idx, sim (self removed).

    Documents of one block are dealt out as words and scored at once. For larger ones ``large()`` gives the
    vectors of the queries, those of the corpus and the blocks' maximal weights; there a key is (document, corpus
    block, run of ``query_block`` sections whose queries it serves), so both sides of a large document are spread
    over tasks, and a query skips the blocks whose bound is below its threshold (:func:`_pruned`). ``n`` rides on
    every row, so block counts need no per-document join. ``keep`` writes the
    tables that the larger documents' steps share.
    """
    several = F.col("n") > block_size
    one = (F.col("n") >= 2) & ~several
    nearest = F.least(F.lit(k), F.col("n") - 1).cast("int").alias("k")
    c = sections.where(one).select("doc_id", F.col("section_idx").alias("idx"), nearest, "n",
                                   F.lit(max_terms).cast("int").alias("max_terms"), "words", "asked")
    q = c.drop("words", "asked") if queries is None else queries.where(one).select(
        "doc_id", F.col("self_idx").alias("idx"), "qsub", nearest, "words")
    scored = _scored(c, q)
    if not sections.where(several).isEmpty():
        scored = scored.unionByName(_pruned(*large(), k, block_size, query_block, keep))
    top = _best(scored).where(F.col("nbr_idx") != F.col("self_idx"))
    w = Window.partitionBy(*_QUERY).orderBy("r")
    return top.withColumn("rank", F.row_number().over(w).cast("int")).drop("r", "k")


class Neighbours:
    """TF-IDF neighbours of sections and of facts for one corpus."""

    def __init__(self, sections: DataFrame, block_size: int = 512, max_chars: int | None = None,
                 max_terms: int | None = None, k: int = K, keep=lambda df: df):
        self.sections = sections.select("doc_id", "document_name", F.col("n_sections").alias("n"),
                                        "section_idx", "section")
        self.block_size, self.k = block_size, k
        self.max_chars, self.max_terms, self.whole = max_chars, max_terms, max_chars is None and max_terms is None
        self._keep = keep
        self._large = None

    def term_weights(self) -> DataFrame:
        """doc_id, section_idx, term, tf, idf, weight (normalised) of the corpus side."""
        s = self._words().drop("asked")
        large = s.where(F.col("n") > self.block_size)
        if large.isEmpty():
            return document_weights(s, self.max_terms)
        # all sections of a document go one way
        ids = large.select("doc_id").distinct()
        blocks = self._keep(s.join(ids, "doc_id", "left_semi").withColumn("cb", _block("section_idx", self.block_size)))
        return document_weights(s.join(ids, "doc_id", "left_anti"), self.max_terms).unionByName(
            block_vectors(blocks, self._known(blocks)[1], terms=True))

    def _known(self, s: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(vocab, doc_id, cb, term, term_id, idf of each block's own terms) of the documents of several blocks."""
        terms = self._keep(block_terms(s))
        stats = terms.groupBy("doc_id", "term").agg(F.sum("cf").alias("cf"), F.sum("dfreq").alias("dfreq"))
        vocab = _with_idf(stats, s, self.max_terms)
        if self.max_terms is not None:
            return vocab, terms.select("doc_id", "cb", "term").join(vocab, ["doc_id", "term"])
        same = Window.partitionBy("doc_id", "term")
        return vocab, _with_idf(terms.withColumn("dfreq", F.sum("dfreq").over(same)), s, None)

    def _words(self) -> DataFrame:
        """doc_id, n, section_idx, words, asked: the words of every section as far as it is compared, and those of the
        whole section if it is cut."""
        asked = F.lit(None).cast("string") if self.max_chars is None else F.when(
            F.length("section") > self.max_chars, words(F.col("section")))
        return self.sections.select("doc_id", "n", "section_idx", words(prefix("section", self.max_chars)).alias("words"),
                                    asked.alias("asked"))

    def _large_vectors(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(vocab, corpus, top) of the documents of several blocks."""
        if self._large is None:
            large = self.sections.where(F.col("n") > self.block_size)
            s = self._keep(large.select("doc_id", "n", "section_idx", _block("section_idx", self.block_size).alias("cb"),
                                        words(prefix("section", self.max_chars)).alias("words")))
            vocab, known = self._known(s)
            v = self._keep(block_vectors(s, known))
            self._large = (vocab, v.where(F.col("section_idx").isNotNull()),
                           v.where(F.col("section_idx").isNull()).drop("section_idx"))
        return self._large

    def _query_vectors(self, q: DataFrame, text: str, vocab: DataFrame) -> DataFrame:
        keys = ["doc_id", "self_idx", "qsub"]
        v = vectors(query_tf(q, text, keys), vocab, keys)
        return packed(q.select(*keys, "n").join(v, keys, "left").select(
            *keys, "n", F.coalesce("term_ids", _empty("bigint")).alias("term_ids"),
            F.coalesce("weights", _empty("double")).alias("weights")))

    def _knn(self, queries: DataFrame | None, large) -> DataFrame:
        return knn(self._words(), queries, large, self.k, self.block_size, max_terms=self.max_terms, keep=self._keep)

    def of_sections(self) -> DataFrame:
        """doc_id, section_idx, rank, nbr_idx, sim."""
        def large():
            vocab, corpus, top = self._large_vectors()
            if self.whole:  # a section as a query has the vector that it has in the corpus
                q = corpus.drop("cb").withColumnRenamed("section_idx", "self_idx").withColumn("qsub", F.lit(0))
            else:
                q = self.sections.where(F.col("n") > self.block_size).select(
                    "doc_id", "n", F.col("section_idx").alias("self_idx"), F.lit(0).alias("qsub"), "section")
                q = self._keep(self._query_vectors(q, "section", vocab))
            return q, corpus, top

        r = self._knn(None, large)
        return r.select("doc_id", F.col("self_idx").alias("section_idx"), "rank", "nbr_idx", "sim")

    def of_facts(self, facts: DataFrame) -> DataFrame:
        """doc_id, section_idx, fact_number, rank, nbr_idx, sim (own section removed)."""
        q = facts.select("doc_id", F.col("n_sections").alias("n"), F.col("section_idx").alias("self_idx"),
                         F.col("fact_number").cast("int").alias("qsub"), "fact")

        def large():
            vocab, corpus, top = self._large_vectors()
            return self._keep(self._query_vectors(q.where(F.col("n") > self.block_size), "fact", vocab)), corpus, top

        r = self._knn(q.withColumn("words", words(F.col("fact"))), large)
        return r.select("doc_id", F.col("self_idx").alias("section_idx"),
                        F.col("qsub").alias("fact_number"), "rank", "nbr_idx", "sim")


def neighbour_context(nbrs: DataFrame, sections: DataFrame, keys: list[str],
                      nbr_images: DataFrame | None = None, max_chars: int | None = None) -> DataFrame:
    """(keys…, neighbour_text, neighbour_images) -- D9/D10.

    Neighbour text = neighbour sections (their first ``max_chars`` characters, if
    given) in rank order joined by a blank line; images = images referenced in
    that text, in neighbour order. Rows per key are bounded by k.
    """
    s = sections.select("doc_id", F.col("section_idx").alias("nbr_idx"),
                        prefix("section", max_chars).alias("ntext"))
    j = nbrs.join(s, ["doc_id", "nbr_idx"])
    if nbr_images is not None:
        j = j.join(nbr_images.withColumnRenamed("section_idx", "nbr_idx"), ["doc_id", "nbr_idx"], "left")
    else:
        j = j.withColumn("image_paths", F.lit(None).cast("array<string>"))
    g = j.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        "rank", "ntext", F.coalesce("image_paths", F.array().cast("array<string>")).alias("imgs")))).alias("nb"))
    return g.select(*keys,
                    F.array_join(F.transform("nb", lambda x: x["ntext"]), "\n\n").alias("neighbour_text"),
                    F.flatten(F.transform("nb", lambda x: x["imgs"])).alias("neighbour_images"))


def neighbour_numbers(nbrs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, nb): rank and number of the neighbours."""
    return nbrs.groupBy(*keys).agg(F.collect_list(F.struct("rank", "nbr_idx")).alias("nb"))


def with_neighbour_text(rows: DataFrame, sections: DataFrame, name: str, max_chars: int | None = None) -> DataFrame:
    """Rows with ``nb`` of :func:`neighbour_numbers` to rows with the text of :func:`neighbour_context`, null without any.

    A document's sections are dealt out once, as one row (see ``sections.by_document``), instead of once for each row
    that has them as neighbours.
    """
    texts = by_document(sections.select("doc_id", "section_idx", prefix("section", max_chars).alias("ntext")), "_texts")
    each = F.flatten(F.transform("nb", lambda x: F.transform(
        F.get("_texts", x["nbr_idx"] - 1), lambda s: F.struct(x["rank"].alias("rank"), s["ntext"].alias("ntext")))))
    return rows.join(texts, "doc_id").withColumn(
        name, F.array_join(F.transform(F.sort_array(each), lambda x: x["ntext"]), "\n\n")).drop("nb", "_texts")


def with_neighbour_context(base: DataFrame, ctx: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(ctx, keys, "left").select(
        *[c for c in base.columns], F.coalesce("neighbour_text", F.lit(NO_NEIGHBOURS)).alias("neighbour_text"),
        F.coalesce("neighbour_images", F.array().cast("array<string>")).alias("neighbour_images"))
