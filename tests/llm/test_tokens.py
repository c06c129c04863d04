"""Encoding, decoding and counting against the tokenizers library, on odd and real texts."""

import hashlib
import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from mdquarry.llm import bpe, tokens

from .conftest import ODD_TEXTS, SMALL

LETTERS = list("aab's tmdrevl  \n\t1 2.!é 日<|>́")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.vocabulary_path())


def _random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("method", [bpe.merge, bpe.speculate])
def test_ids_equal_the_library(library, method):
    texts = [t or "" for t in ODD_TEXTS] + _random_texts(1500)
    enc = bpe.Encoder(bpe.Vocabulary.load(tokens.vocabulary_path()), method)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [ids[a:z].tolist() for _, ids, off in enc.encode(texts) for a, z in zip(off, off[1:])]
    assert got == want
    assert enc.counts(texts).tolist() == [len(w) for w in want]


def test_long_texts_are_cut_at_safe_places(library, monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", 50)
    from mdquarry.llm import ragged
    monkeypatch.setattr(ragged.segments, "__defaults__", (40,))
    text = " ".join(_random_texts(40)) + "<|endoftext|>" + "word " * 100
    enc = bpe.Encoder(bpe.Vocabulary.load(tokens.vocabulary_path()))
    got = [ids.tolist() for _, ids, _ in enc.encode([text])]
    want = library.encode(text, add_special_tokens=False).ids
    assert got == [want] and enc.counts([text]).tolist() == [len(want)]


def _alternating(n, x, y):
    return "".join((x, y)[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("method", [bpe.merge, bpe.speculate])
@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_texts_whose_sums_collide_modulo_a_power_of_two(library, method, n):
    texts = [_alternating(n, "a", "b"), _alternating(n, "b", "a")]
    enc = bpe.Encoder(bpe.Vocabulary.load(tokens.vocabulary_path()), method)
    got = [ids[a:z].tolist() for _, ids, off in enc.encode(texts) for a, z in zip(off, off[1:])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)] and got[0] != got[1]


def _long_runs():
    rng = random.Random(6)
    return {"chinese": "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(100_000)),
            "letters": "".join(rng.choice("etaoinshrdlu") for _ in range(20_000)), "one": "a" * 50_001,
            "two": "ab" * 20_000, "signs": "".join(rng.choice("!?.-=_*#") for _ in range(30_000)),
            "words": "theofandtoinisthatforit" * 1000, "digits": "".join(rng.choice("0123456789") for _ in range(20_000))}


@pytest.mark.parametrize("method", [bpe.merge, bpe.speculate])
@pytest.mark.parametrize("name", list(_long_runs()))
def test_long_runs_take_time_in_proportion(library, method, name):
    text = _long_runs()[name]
    enc = bpe.Encoder(bpe.Vocabulary.load(tokens.vocabulary_path()), method)
    began = time.process_time()
    (_, ids, _), = enc.encode([text])
    assert time.process_time() - began < 10  # a second here; minutes where every length was tried at every token
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_windows_without_a_common_boundary_are_merged_whole(library, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 40)
    monkeypatch.setattr(bpe, "OVERLAP", 3)
    rng = random.Random(8)
    texts = ["".join(rng.choice("etaoinaaab ") for _ in range(400)) for _ in range(50)] + ["a" * 333, "=" * 1000]
    enc = bpe.Encoder(bpe.Vocabulary.load(tokens.vocabulary_path()), bpe.merge)
    texts = [t.replace(" ", "") for t in texts]
    got = [ids[a:z].tolist() for _, ids, off in enc.encode(texts) for a, z in zip(off, off[1:])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_full_table_is_emptied(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 5)
    texts = _random_texts(50)
    enc = bpe.Encoder(bpe.Vocabulary.load(tokens.vocabulary_path()))
    for t in texts:
        (_, ids, _), = enc.encode([t])
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


def test_compatible_agrees_with_merging():
    v = bpe.Vocabulary.load(tokens.vocabulary_path())
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 3000, 3000), rng.integers(0, 3000, 3000)
    ok = bpe.compatible(v, a, b)
    for x, y, good in zip(a, b, ok):
        data = np.frombuffer(bpe.decode(v, np.array([x, y])), np.uint8)
        ids, _ = bpe.merge(v, data, np.array([0]), np.array([len(data)]))
        assert good == (ids.tolist() == [x, y])


def _want(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_queries_on_odd_texts(spark, library, docs_of, data_dir):
    rows = list(enumerate(ODD_TEXTS)) + [(3, "again"), (3, "again"), (None, "no id")]
    sf = data_dir(documents=docs_of(rows))
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in tokens.op4_bpe_encode_decode(spark, sf).collect())
    assert got == sorted((i is None, i, *_want(library, t or "")) for i, t in rows)
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in tokens.op5_token_counts(spark, sf).collect())
    want = [(i is None, i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
            for i, t in rows]
    assert got == sorted((*w, w[3] > 512) for w in want)


def test_empty_table(spark, docs_of, data_dir):
    sf = data_dir(documents=docs_of([]))
    assert tokens.op4_bpe_encode_decode(spark, sf).count() == 0
    assert tokens.op5_token_counts(spark, sf).count() == 0


def test_real_texts(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in tokens.op4_bpe_encode_decode(spark, SMALL).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == _want(library, texts[r.doc_id])


def test_decode_replaces_broken_bytes(spark):
    v = bpe.Vocabulary.load(tokens.vocabulary_path())
    lone = np.array([v.of_byte[0xE2]], "<u4").tobytes()
    df = spark.createDataFrame([(1, lone), (2, None)], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in tokens.decode(df, tokens.vocabulary_path()).collect()}
    assert got == {1: "�", 2: ""}
