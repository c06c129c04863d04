import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from mdquarry.llm import periods
from mdquarry.llm.common import read
from mdquarry.llm.queries import QUERIES

from .conftest import ODD_TEXTS, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _runs(w, min_length=24, min_power=3):
    """All runs, from the definition: stretches of equal words p apart that no smaller period covers."""
    out = []
    for p in range(1, len(w) // min_power + 1):
        k = 0
        while k < len(w) - p:
            a = k
            while k < len(w) - p and w[k] == w[k + p]:
                k += 1
            n = k - a + p
            if k > a and n >= max(min_length, min_power * p) and not any(
                    w[a:a + n - q] == w[a + q:a + n] for q in range(1, p)):
                out.append((a, n, p))
            k += k == a
    return sorted(out, key=lambda r: (r[0], r[2]))


def _row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _runs(w)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    docs = read(spark, SMALL, "documents").select("doc_id", "text").collect()
    want = sorted(_row(r["doc_id"], r["text"]) for r in docs)
    got = QUERIES["op12_periodic_runs"](spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(r[1] > 0 for r in want) > 5


def test_planted_periods_in_long_and_odd_texts(spark, docs_of, data_dir):
    rnd = random.Random(3)
    loop = " ".join(str(i) for i in range(50))
    texts = [*ODD_TEXTS, " ".join(["a b c"] * 9) + " a", "x " * 23, "x " * 24, "    " * 30, f"{loop} " * 3,
             f"start {loop} {loop} {loop} end", "\x0b".join("ab" * 40), "\x1c " * 30 + "\x85 " * 30,
             " ".join(rnd.choice("ab") for _ in range(600)), " ".join(str(i) for i in range(3000)) + " y" * 100]
    rows = [(i, t) for i, t in enumerate(texts * 12)]
    got = QUERIES["op12_periodic_runs"](spark, data_dir(documents=docs_of(rows))).collect()
    assert sorted(tuple(r) for r in got) == sorted(_row(*r) for r in rows)


def test_lyndon_arrays_by_grouping():
    def longest(s, i):
        return max(j - i for j in range(i + 1, len(s) + 1)
                   if all(s[i:j] < s[k:j] for k in range(i + 1, j)))

    rnd = random.Random(5)
    for _ in range(300):
        s = [rnd.randint(0, 2) for _ in range(rnd.randint(1, 14))]
        assert periods.lyndon(s) == [longest(s, i) for i in range(len(s))]
        turned = [-x for x in s]
        assert periods.lyndon(s, high_first=False) == [longest(turned, i) for i in range(len(s))]


@pytest.mark.parametrize("min_length, min_power", [(24, 3), (8, 3), (4, 4), (3, 3)])
def test_runs_of_random_sequences(min_length, min_power):
    rnd = random.Random(min_length)
    for _ in range(120):
        s = []
        while len(s) < 120:
            s += [rnd.randint(0, 2) for _ in range(rnd.randint(1, 9))] * rnd.choice([1, 1, 3, 5])
            if rnd.random() < 0.3:
                s += s[-rnd.randint(1, len(s)):] * rnd.choice([1, 2, 3])
        half = len(s) // 3
        want = [(0, *r) for r in _runs(s[:half], min_length, min_power)]
        want += [(1, *r) for r in _runs(s[half:], min_length, min_power)]
        got = periods.runs_of_texts(np.array(s), np.array([0, half, len(s)]), min_length, min_power)
        assert [tuple(r) for r in got.tolist()] == want


def test_a_text_of_alternating_complements_has_its_own_runs():
    """Sequences of the Thue-Morse kind, whose polynomial fingerprints modulo a power of two collide."""
    a = np.array([bin(i).count("1") % 2 for i in range(2048)])
    s = np.concatenate([a, 1 - a, a, a, a])
    assert (0, 10240, 2048) not in [tuple(r) for r in periods.runs(s).tolist()]
    assert (4096, 6144, 2048) in [tuple(r) for r in periods.runs(s).tolist()]


def test_one_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(periods, "SEGMENT", 40)
    text = "  one two  " + "abc de\n" * 60 + "z" * 100 + " end"
    ids, off, words = periods.word_ids([text, "two one"])
    assert [words[i] for i in ids] == WORD.findall(text) + ["two", "one"]
    assert off.tolist() == [0, len(WORD.findall(text)), len(ids)]


def test_nulls_clashing_columns_and_empty_tables(spark):
    d = spark.createDataFrame([(None, None, 1, "a"), (None, "b " * 30, 2, "a"), (7, "b " * 30, 2, "a"),
                               (7, "b " * 30, 2, "a")], "doc_id long, text string, runs int, key string")
    got = sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.find(d).collect())
    assert got == [(0, [], ""), (0, [(0, 30, 1)], "b"), (7, [(0, 30, 1)], "b"), (7, [(0, 30, 1)], "b")]
    assert periods.find(d.limit(0)).collect() == []
    assert periods.with_planted_periods(d).count() == 4
    with pytest.raises(ValueError):
        periods.find(d, min_power=2)
