"""Compact windows and repeated passages against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from mdquarry.llm import substrings as sub

from .conftest import ODD_TEXTS, SF


def _brute_windows(v, span):
    out = set()
    for c in np.flatnonzero(v):
        lo = hi = c
        while lo > 0 and v[lo - 1] > v[c]:
            lo -= 1
        while hi + 1 < len(v) and v[hi + 1] > v[c]:
            hi += 1
        if hi - lo + 1 >= span:
            out.add((int(c), int(lo), int(hi)))
    return out


def test_compact_windows():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n, span = int(rng.integers(1, 80)), int(rng.integers(1, 12))
        v = rng.permutation(np.arange(1, n + 1)).astype(np.uint64)
        v[rng.random(n) < 0.04] = 0
        assert set(zip(*(x.tolist() for x in sub.compact_windows(v, span)))) == _brute_windows(v, span)


def _exact_repeats(docs):
    """(doc, first word, past-the-last word, earlier doc) of longest word runs that an earlier document holds too."""
    index = defaultdict(list)
    words = {i: (t or "").split() for i, t in docs if i is not None}
    for i in sorted(words):
        w = words[i]
        for p in range(len(w) - 4):
            index[tuple(w[p:p + 5])].append((i, p))
    out = []
    for i in sorted(words):
        w, p = words[i], 0
        open_ = {}
        for p in range(len(w) - 3):
            here = {(j, q - p) for j, q in index.get(tuple(w[p:p + 5]), ()) if j < i} if p < len(w) - 4 else set()
            for k in [k for k in open_ if k not in here]:
                if p + 4 - open_[k] > 50:
                    out.append((i, open_[k], p + 4, k[0]))
                del open_[k]
            for k in here:
                open_.setdefault(k, p)
    return out


def _covered(spans, i, start, end, slack):
    hit = np.zeros(end - start, bool)
    for a, z in spans[i]:
        hit[max(0, a - start):max(0, z - start)] = True
    return hit.sum() >= (end - start) - slack


def _spans(rows):
    out = defaultdict(list)
    for r in rows:
        assert r.src_doc_id < r.doc_id and r.end - r.start >= sub.MIN_WORDS and r.similarity >= sub.THRESHOLD
        out[r.doc_id].append((r.start, r.end))
    return out


def test_every_exact_repeat_of_the_documents_is_found(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sub.op1_substring_dedup(spark, SF).collect()
    spans = _spans(got)
    want = _exact_repeats(docs)
    assert want
    missed = [x for x in want if not _covered(spans, x[0], x[1], x[2], 5)]
    assert not missed
    # and every reported passage is similar when compared word for word
    words = {i: t.split() for i, t in docs}

    def grams(i, a, z):
        return {tuple(words[i][p:p + 5]) for p in range(a, z - 4)}
    for r in got:
        x, y = grams(r.doc_id, r.start, r.end), grams(r.src_doc_id, r.src_start, r.src_end)
        assert len(x & y) >= 0.8 * len(x | y) - 1e-9


def _prose(rng, n):
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


@pytest.fixture
def planted():
    rng = np.random.default_rng(4)
    p, q = _prose(rng, 60), _prose(rng, 140)
    edited = list(q)
    edited[70] = "changed"
    docs = [(i, " ".join(_prose(rng, int(rng.integers(20, 400))))) for i in range(30)]
    docs += [(100, " ".join(_prose(rng, 90) + p + _prose(rng, 30))), (101, " ".join(p)),
             (102, " ".join(_prose(rng, 200) + p + _prose(rng, 5) + q)), (103, " ".join(edited + _prose(rng, 10))),
             (104, " ".join(_prose(rng, 60) + p[:40]))]
    return docs


def test_planted_passages_and_clean_documents(spark, docs_of, planted):
    spans = _spans(sub.passages(docs_of(planted)).collect())
    assert set(spans) == {101, 102, 103}
    assert spans[101] == [(0, 60)] and spans[102] == [(200, 260)]
    (a, z), = spans[103]
    assert a <= 1 and 139 <= z <= 141


def test_stretches_overlap(spark, docs_of, planted, monkeypatch):
    monkeypatch.setattr(sub, "STRETCH", 128)
    assert set(_spans(sub.passages(docs_of(planted)).collect())) == {101, 102, 103}


def test_cutting(spark, docs_of, planted):
    rows = [*planted, *((200 + i, t) for i, t in enumerate(ODD_TEXTS)), (None, planted[30][1]), (300, planted[30][1])]
    before = dict((i, t) for i, t in rows if i is not None)
    got = {r.doc_id: r for r in sub.cut_repeats(docs_of(rows)).collect()}
    assert 101 not in got and 300 not in got and None in got and got[None].text == planted[30][1]
    assert set(got) == ({i for i, _ in rows} - {101, 300})
    words = before[102].split()
    assert got[102].text.split() == words[:200] + words[260:]
    assert got[102].n_chars == len(got[102].text)
    for i in set(got) - {102, 103, None}:
        assert got[i].text == before[i]


def test_places_of_one_text_are_not_cut_out_of_another_of_its_id(spark, docs_of):
    rng = np.random.default_rng(21)
    passage = _prose(rng, 80)
    clean = [" ".join(_prose(rng, 200)) for _ in range(6)]
    rows = [(1, " ".join(_prose(rng, 50) + passage)), (9, " ".join(_prose(rng, 30) + passage + _prose(rng, 30)))]
    rows += [(9, t) for t in clean[:4]] + [(1, clean[4]), (9, clean[5] + " " + " ".join(passage))]
    got = sorted((r.doc_id, r.text) for r in sub.cut_repeats(docs_of(rows)).collect())
    kept = {t for _, t in got}
    assert {rows[0][1], *clean[:5]} <= kept and len(got) == len(rows)
    other = [t for i, t in got if i == 9 and t not in clean]
    assert [len(t.split()) for t in other] == [60] and clean[5] in kept


def test_ids_with_one_text_are_not_widened(spark, docs_of, planted, monkeypatch):
    from mdquarry.llm import substrings

    kinds, passages = [], substrings.passages
    monkeypatch.setattr(substrings, "passages", lambda d: kinds.append(d.schema["doc_id"].dataType.simpleString()) or passages(d))
    text = "one text"
    for rows in ([(1, text), (1, text), (2, "other"), (None, text), (None, "x")], [(1, text), (1, "other")], [(1, None), (1, text)]):
        assert sorted(map(repr, substrings.cut_repeats(docs_of(rows)).collect())) == sorted(map(repr, docs_of(rows).collect()))
    assert kinds[0] == "bigint" and all(k.startswith("struct") for k in kinds[1:])


def test_scratch_columns_with_the_names_of_the_table(spark, docs_of, planted):
    from pyspark.sql import functions as F
    d = docs_of(planted)
    plain = sorted((r.doc_id, r.text) for r in sub.cut_repeats(d).collect())
    clash = d.select("*", *(F.lit(c).alias(c) for c in ("_id", "_spans", "_key", "_mine", "src", "key", "tile")))
    got = sub.cut_repeats(clash)
    assert got.columns == clash.columns
    rows = got.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == plain and {r._spans for r in rows} == {"_spans"}


def test_repeated_rows_and_empty_table(spark, docs_of, planted):
    rows = [planted[30], planted[30], planted[31], planted[31], planted[31]]
    spans = {(r.doc_id, r.src_doc_id) for r in sub.passages(docs_of(rows)).collect()}
    assert spans == {(101, 100)}
    assert sub.passages(docs_of([])).count() == 0 and sub.cut_repeats(docs_of([])).count() == 0


def test_an_earlier_part_of_a_passage_hides_no_repeat(spark, docs_of):
    rng = np.random.default_rng(12)
    line = _prose(rng, 14)
    rows, want = [], []
    for k in range(12):
        p = _prose(rng, 23) + line + _prose(rng, 23)
        # a variant that is too far away, parts of the passage, and the line alone, all of them earlier
        far = [w if i % 9 or 23 <= i < 37 else f"far{k}" for i, w in enumerate(p)]
        rows += [(k, " ".join(_prose(rng, 40) + far + _prose(rng, 40))), (20 + k, " ".join(p[:45] + _prose(rng, 40))),
                 (40 + k, " ".join(_prose(rng, 40) + p[15:] + _prose(rng, 9))),
                 (60 + k, " ".join(_prose(rng, 60) + line + _prose(rng, 60)))]
        rows += [(100 + k, " ".join(_prose(rng, 30) + p + _prose(rng, 30))), (200 + k, " ".join(_prose(rng, 50) + p))]
        want.append((200 + k, 50, 110))
    got = sub.passages(docs_of(rows)).collect()
    spans = _spans(got)
    missed = [x for x in want if not _covered(spans, *x, 0)]
    assert not missed
    assert {(r.doc_id, r.src_doc_id) for r in got} >= {(200 + k, 100 + k) for k in range(12)}


def _jaccard(x, y):
    a, b = ({tuple(w[p:p + 5]) for p in range(len(w) - 4)} for w in (x, y))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("earlier", [0, 1, 3, 10])
def test_earlier_variants_hide_no_near_passage(spark, docs_of, earlier):
    """Passages with an edit in every 47 words; earlier documents hold variants that are too far away."""
    rng = np.random.default_rng(31)
    rows, want = [], []
    for k in range(150):
        p = _prose(rng, 140)
        near = [w if (i + 23) % 47 else f"near{k}" for i, w in enumerate(p)]
        assert _jaccard(p, near) >= sub.THRESHOLD
        for v in range(earlier):
            far = [w if (i + 5 * v) % 12 else f"far{v}" for i, w in enumerate(p)]
            assert _jaccard(p, far) < 0.5
            rows.append((k * 20 + v, " ".join(_prose(rng, 40) + far + _prose(rng, 40))))
        rows.append((10_000 + k, " ".join(_prose(rng, 30) + p + _prose(rng, 30))))
        rows.append((20_000 + k, " ".join(_prose(rng, 50) + near + _prose(rng, 10))))
        want.append((20_000 + k, 50, 190, 10_000 + k))
    got = sub.passages(docs_of(rows)).collect()
    spans = _spans(got)
    links = {(r.doc_id, r.src_doc_id) for r in got}
    found = [x for x in want if (x[0], x[3]) in links and _covered(spans, *x[:3], 28)]
    assert len(found) >= 0.99 * len(want)
    assert {d for d, _ in links} == {x[0] for x in want}


def test_kept_tables_are_compressed_with_zstd(spark):
    from mdquarry.llm.common import keep
    kept = keep(spark.range(10), "kept")
    assert all(f.endswith(".zstd.parquet") for f in kept.inputFiles()) and kept.count() == 10
