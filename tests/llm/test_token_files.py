import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from mdquarry.llm import token_files
from mdquarry.llm.common import read
from mdquarry.llm.queries import QUERIES
from mdquarry.llm.token_files import Grammar
from mdquarry.llm.tokens import vocabulary_path

from .conftest import ODD_TEXTS, SMALL


def _library(texts):
    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return [e.ids + [0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_query_equals_the_library(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in read(spark, SMALL, "documents").select("doc_id", "text").collect())
    want, start = [], 0
    for (i, _), ids in zip(docs, _library([t for _, t in docs])):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op13_token_files"](spark, SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_long_documents_repeated_and_null_ids(spark, docs_of, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 300)
    texts = [*ODD_TEXTS, "word " * 500, "a b c d e f g " * 90, "x"]
    rows = [(i % 7 if i % 5 else None, t) for i, t in enumerate(texts)] + [(3, "same text")] * 40
    path = f"{tmp_path}/files"
    token_files.write_tokens(docs_of(rows).repartition(5), path, vocabulary_path(), block=64)
    got = token_files.read_tokens(spark, path).collect()
    assert spark.read.parquet(f"{path}/parts").count() > 1
    ids = dict(zip([r[1] for r in rows], _library([t for _, t in rows])))
    want = sorted((i is not None, i or 0, np.array(ids[t], "<u4").tobytes()) for i, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == want
    # the documents follow each other without a gap, in ascending order, nulls first
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    assert [r["doc_id"] is not None for r in got] == sorted(r["doc_id"] is not None for r in got)
    known = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert known == sorted(known)
    whole = b"".join(bytes(r["ids"]) for r in got)
    for a, z in ((0, 10), (60, 70), (5, 700), (len(whole) // 4 - 3, len(whole) // 4 + 9)):
        parts = sorted((r["place"], bytes(r["ids"])) for r in token_files.read_range(spark, path, a, z).collect())
        assert b"".join(p for _, p in parts) == whole[4 * a:4 * z]
        assert parts[0][0] == a


def test_grammars_give_back_any_range():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        pieces = rnd.integers(1, 60, size=rnd.integers(1, 30))
        ids = rnd.integers(0, rnd.integers(1, 9), size=pieces.sum())
        g = Grammar.of(ids, pieces)
        h = Grammar.unpack(g.pack())
        assert (h.ids() == ids).all() and (h.pieces == pieces).all()
        a, z = sorted(rnd.integers(0, len(ids) + 1, size=2).tolist())
        assert (h.ids(a, z) == ids[a:z]).all()
        _check_rules(g, pieces)


def _check_rules(g, pieces):
    """Every new symbol is used, its length is that of its pair, no symbol crosses a document, no pair is left."""
    size = {s: 1 for s in range(g.base)}
    for i, (a, b) in enumerate(zip(g.left.tolist(), g.right.tolist())):
        size[g.base + i] = size[a] + size[b]
        assert g.lengths[i] == size[g.base + i]
    assert set(np.cumsum(pieces).tolist()) <= set(g.at.tolist())
    left = {}
    ends = set(np.cumsum(pieces).tolist())
    last = None
    for i in range(len(g.symbols) - 1):
        pair = g.symbols[i], g.symbols[i + 1]
        if g.at[i + 1] in ends or pair == last:
            last = None
            continue
        left[pair] = left.get(pair, 0) + 1
        last = pair if pair[0] == pair[1] else None
    assert all(n < token_files.USES for n in left.values())


def test_a_run_of_one_id_and_repeated_documents_compress():
    g = Grammar.of(np.full(1 << 16, 7), np.array([1 << 16]))
    assert len(g.symbols) < 16 and (g.ids() == 7).all()
    one = np.random.default_rng(2).integers(0, 50_000, 500)
    g = Grammar.of(np.tile(one, 40), np.full(40, 500))
    assert len(g.symbols) + 2 * len(g.left) < 2500


def test_large_ids_take_the_wide_form():
    rnd = random.Random(4)
    ids = np.array([rnd.choice([2**30, 5, 2**25]) for _ in range(999)])
    g = Grammar.unpack(Grammar.of(ids, np.array([999])).pack())
    assert (g.ids() == ids).all()
    with pytest.raises(ValueError):
        Grammar.unpack(b"none" + g.pack()[4:])


def test_empty_table(spark, docs_of, tmp_path):
    token_files.write_tokens(docs_of([]), f"{tmp_path}/none", vocabulary_path())
    assert token_files.read_tokens(spark, f"{tmp_path}/none").collect() == []
    assert token_files.read_range(spark, f"{tmp_path}/none", 0, 10).collect() == []
