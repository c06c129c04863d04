"""Packing: ids, gapless places, no lost or doubled piece, and few sequences."""

import itertools
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from mdquarry.llm import packing, tokens

from .conftest import ODD_TEXTS, SMALL


def _check(rows, docs, library):
    want = Counter()
    for i, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 or 1024 if len(ids) > 1024 else len(ids)
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        for n, (a, z) in enumerate(itertools.pairwise(cuts)):
            want[i, n, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024
    total = sum(r.length for r in rows)
    # no packing needs fewer: all tokens fit, and pieces above half a sequence never share one
    return len(bins), max(-(-total // 1024), sum(r.length > 512 for r in rows))


def test_real_documents(spark):
    library = Tokenizer.from_file(tokens.vocabulary_path())
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    bins, least = _check(packing.op7_best_fit_packing(spark, SMALL).collect(), docs, library)
    assert bins <= 1.02 * least


def test_odd_texts_and_repeated_rows(spark, docs_of, data_dir, monkeypatch):
    library = Tokenizer.from_file(tokens.vocabulary_path())
    docs = [*enumerate(ODD_TEXTS), (3, "twice"), (3, "twice"), (99, "word and " * 3000)]
    monkeypatch.setattr(packing, "SLICE", 4)
    sf = data_dir(documents=docs_of(docs))
    _check(packing.op7_best_fit_packing(spark, sf).collect(), docs, library)


def test_empty_table(spark, docs_of, data_dir):
    assert packing.op7_best_fit_packing(spark, data_dir(documents=docs_of([]))).count() == 0


def test_fullest_is_the_best_subset_sum():
    rng = np.random.default_rng(1)
    for _ in range(200):
        items = rng.integers(1, 30, rng.integers(0, 9)).tolist()
        room = int(rng.integers(0, 60))
        got = packing.fullest(Counter(items), room)
        assert all(Counter(items)[n] >= c for n, c in got.items())
        best = max(s for k in range(len(items) + 1) for c in itertools.combinations(items, k)
                   if (s := sum(c)) <= room)
        assert sum(n * c for n, c in got.items()) == best


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    counts = Counter(rng.integers(1, 1025, 20000).tolist())
    plan = packing.plan_bins(counts)
    used = Counter()
    for b, times in plan:
        assert sum(n * c for n, c in b.items()) <= 1024
        for n, c in b.items():
            used[n] += c * times
    assert used == counts
    # above half a sequence no two pieces share one, which bounds every packing from below
    least = max(-(-sum(n * c for n, c in counts.items()) // 1024), sum(c for n, c in counts.items() if n > 512))
    assert sum(t for _, t in plan) <= least * 1.01 + 1
