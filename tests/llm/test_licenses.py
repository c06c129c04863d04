"""License scans: alignment against brute force, planted notices, odd texts."""

import numpy as np

from mdquarry.llm import licenses as lic

from .conftest import ODD_TEXTS, SF


def _lcs(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    return int(t[-1, -1])


def test_a_wide_band_is_the_longest_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = (rng.integers(0, 6, rng.integers(1, 15)).astype(np.uint64) for _ in range(2))
        n, first, end = lic.align(a, b, 0, 30)
        assert n == _lcs(a.tolist(), b.tolist())
        if n:
            assert _lcs(a.tolist(), b[first:end].tolist()) == n and b[first] in a and b[end - 1] in a


def test_winnowing_keeps_one_of_every_window():
    rng = np.random.default_rng(1)
    for n in (1, 3, 4, 5, 50):
        h = rng.integers(0, 20, n).astype(np.uint64)
        kept = set(lic.winnow(h).tolist())
        assert all(kept & set(range(i, i + 4)) for i in range(max(1, n - 3)))
    assert len(lic.winnow(np.zeros(0, np.uint64))) == 0


def _found(df):
    return sorted((r.doc_id, r.license, r.start, r.end) for r in df.collect())


def test_planted_notices(spark, docs_of):
    notice = dict(lic.TEMPLATES)
    mit, gpl, cc = notice["MIT-permission"], notice["GPL-3.0-short"], notice["CC-BY-NC-4.0-short"]
    edited = mit.replace("free of charge", "without fee").replace("merge", "fuse")
    rows = [(1, f"some words {mit} more"), (2, edited.upper()), (3, f"{cc}\nother text {cc}"),
            (4, "a license is a public thing of version 3"), (5, mit[:200]), (6, f"x {gpl} y {notice['MIT-short']}"),
            (7, "Licensed\tunder\nCC   by-nc 4.0!")]
    got = lic.scan(docs_of(rows)).collect()
    names = sorted((r.doc_id, r.license) for r in got)
    assert names == [(1, "MIT-permission"), (2, "MIT-permission"), (3, "CC-BY-NC-4.0-short"), (3, "CC-BY-NC-4.0-short"),
                     (6, "GPL-3.0-short"), (6, "MIT-short"), (7, "CC-BY-NC-4.0-short")]
    texts = dict(rows)
    for r in got:
        assert r.passage == texts[r.doc_id][r.start:r.end]
        assert r.coverage == 1.0 or r.doc_id == 2 and 0.9 < r.coverage < 1
    assert [(r.start, r.end) for r in got if r.doc_id == 1] == [(11, 11 + len(mit) - 1)]


def test_documents_hold_exactly_the_notices_that_a_search_finds(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = set()
    for r in rows:
        for name, t in lic.TEMPLATES:
            if t in r.text:
                want.add((r.doc_id, name, r.text.index(t), r.text.index(t) + len(t.rstrip("."))))
    assert want <= set(_found(lic.op8_license_scan(spark, SF)))
    lines = {r.doc_id for r in rows if any(w in r.text.lower() for w in ("licen", "rights reserved"))}
    assert {f[0] for f in _found(lic.op8_license_scan(spark, SF))} == lines


def test_odd_texts_repeated_rows_and_empty_table(spark, docs_of):
    rows = [*enumerate(ODD_TEXTS), (50, "All rights reserved."), (50, "All rights reserved."), (None, "ALL RIGHTS RESERVED")]
    assert sorted(str(r.doc_id) for r in lic.scan(docs_of(rows)).collect()) == ["50", "50", "None"]
    assert lic.scan(docs_of([])).count() == 0
    assert lic.scan(docs_of(rows), templates=()).count() == 0


def test_notices_that_follow_each_other_directly(spark, docs_of):
    notice = dict(lic.TEMPLATES)
    for name in ("All-rights-reserved", "MIT-short", "CC-BY-NC-4.0-short", "Apache-2.0-short"):
        line = notice[name]
        for times in (2, 3, 40):
            text = " ".join([line] * times)
            want = [(1, name, k * (len(line) + 1), k * (len(line) + 1) + len(line) - 1) for k in range(times)]
            assert _found(lic.scan(docs_of([(1, text)]))) == want


def test_versions_and_variants_keep_their_names(spark, docs_of):
    # every registered notice is found under its own name; those that lie in it have the same words
    rows = [(i, f"some words. {t} More words") for i, (_, t) in enumerate(lic.TEMPLATES)]
    inside = {("Apache-2.0-header", "Apache-2.0-short")}
    got = {(lic.TEMPLATES[r.doc_id][0], r.license) for r in lic.scan(docs_of(rows)).collect()}
    assert got - inside == {(n, n) for n, _ in lic.TEMPLATES}
    gpl = dict(lic.TEMPLATES)["GPL-3.0-short"]
    other = [(1, gpl.replace("3", "1")), (2, gpl.replace("General", "Library General"))]
    assert lic.scan(docs_of(other)).count() == 0
