"""Periodic runs of words: maximal stretches that repeat with a smallest period.

A run is (start, length, period): words ``period`` apart are equal, no
neighbouring word extends it, and its length is at least ``min_length`` and
``min_power`` periods. Words are maximal runs of other characters than blank and
the control characters 9 to 13.

1. :func:`stretches` -- within a run every eight words occur again one period
   on or back, so only stretches of words whose eight-word windows occur twice
   in the text can hold runs. This screen drops no run, and a run's ends lie in
   its stretch.
2. :func:`lyndon` -- the first phase of Baier's suffix sorter groups the
   suffixes of a stretch by their longest Lyndon prefix: groups are taken from
   the highest down, every suffix of a group is appended to the context of the
   nearest suffix before it that is in a lower group, and these move to a new
   group right above their old one (the more appended contexts, the higher). The
   length of a group's context is the Lyndon array. It runs under both orders of
   the words.
3. :func:`runs` -- every run has a Lyndon root in one of both orders. Roots that
   follow themselves are extended in both directions by the longest common
   extension (:class:`Matcher`: fingerprints and binary search, all roots at
   once), and what is found is compared word by word before it is reported.

Each text is handled by itself in one scan without a shuffle; memory follows
the longest text (about 100 bytes a word).

Edge cases: null and empty texts have no words and no runs; repeated rows give
equal rows, one each; ids may be null or repeated and are handed on; an empty
table stays empty; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, read
from .ragged import SEGMENT, mix, modulo, packs

MIN_LENGTH = 24
MIN_POWER = 3
WINDOW = 8  # words of the screen, at most
GAP = r"[ \t-\r]+"
_WORDS = re.compile(r"[^ \t-\r]+")
_GAPS = re.compile(r"[ \t-\r]")
_PRIME = np.uint64((1 << 31) - 1)  # what modulo() divides by
# fixed values: two bases of fingerprints modulo the prime
_BASES = (1_220_703_125, 630_360_016)


def word_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Numbers of the words of all texts, the words before each text (with the total), and the distinct words."""
    number: dict[str, int] = {}
    parts, sizes = [], []
    for t in texts:
        n = at = 0
        while at < len(t):
            cut = len(t)
            if cut - at > SEGMENT:  # a long text piece by piece, cut between words
                m = _GAPS.search(t, at + SEGMENT)
                cut = m.start() if m else cut
            found = _WORDS.findall(t, at, cut)
            parts.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found)))
            n += len(found)
            at = cut
        sizes.append(n)
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=off[1:])
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), off, list(number)


def stretches(ids: np.ndarray, off: np.ndarray, window: int = WINDOW, shortest: int = MIN_LENGTH):
    """(start, end) of the stretches of at least ``shortest`` words whose windows occur twice in their text."""
    n = len(ids) - window + 1
    if n < 2:
        return np.zeros((0, 2), np.int64)
    code = mix(ids.astype(np.uint64) + np.uint64(1))
    h = np.zeros(n, np.uint64)
    for i in range(window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + code[i:i + n]
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    whole = text[:n] == text[window - 1:]
    at = np.flatnonzero(whole)
    key = mix(h[at] + text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[at[order[1:][same]]] = True
    twice[at[order[:-1][same]]] = True
    # windows of one stretch follow each other within a text
    first = np.flatnonzero(twice & ~np.r_[False, twice[:-1] & (text[1:n] == text[:n - 1])])
    last = np.flatnonzero(twice & ~np.r_[twice[1:] & (text[1:n] == text[:n - 1]), False])
    got = np.stack([first, last + window], axis=1)
    return got[got[:, 1] - got[:, 0] >= shortest]


def lyndon(rank: list[int], high_first: bool = True) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, by grouping suffixes.

    ``rank`` orders the letters; with ``high_first`` False it is the reversed order.
    """
    n = len(rank)
    start: dict[int, list[int]] = {}
    for i, r in enumerate(rank):
        start.setdefault(r, []).append(i)
    order = sorted(start)
    if not high_first:
        order.reverse()
    group = [0] * n  # of each suffix
    members, size, below = [[]], [0], [0]  # of each group; group 0 ends the list
    for g, r in enumerate(order, 1):
        members.append(start[r])
        size.append(1)
        below.append(g - 1)
        for i in start[r]:
            group[i] = g
    above = [*range(1, len(order) + 1), 0]
    previous = [-1] * n
    done = [False] * n
    length = [0] * n
    g = len(order)
    while g:
        mine = [i for i in members[g] if group[i] == g]
        context = size[g]
        for i in mine:
            done[i] = True
            length[i] = context
        targets: dict[int, int] = {}
        for i in mine:
            j = i - 1
            while j >= 0 and done[j]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                targets[j] = targets.get(j, 0) + 1
        if targets:
            split: dict[tuple[int, int], list[int]] = {}
            for j, times in targets.items():
                split.setdefault((times, group[j]), []).append(j)
            # more contexts first: each new group goes right above the old one, so fewer end lower
            for times, old in sorted(split, reverse=True):
                new = len(members)
                moved = split[times, old]
                members.append(moved)
                size.append(size[old] + times * context)
                up = above[old]
                below.append(old)
                above.append(up)
                below[up] = new
                above[old] = new
                for j in moved:
                    group[j] = new
        members[g] = []
        g = below[g]
    return length


class Matcher:
    """Longest common extensions within one sequence, many at once."""

    def __init__(self, s: np.ndarray):
        self.n = len(s)
        code = modulo(mix(s.astype(np.uint64) + np.uint64(1)))
        self._sum, self._up = [], []
        for base in _BASES:
            up = np.ones(self.n + 1, np.uint64)
            k = 1
            power = np.uint64(base)
            while k <= self.n:  # base ** i by doubling
                up[k:2 * k] = modulo(up[:min(k, self.n + 1 - k)] * power)
                power = modulo(np.array([power * power], np.uint64))[0]
                k *= 2
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(modulo(code * up[:-1]), out=total[1:])
            self._sum.append(modulo(total))
            self._up.append(up)

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the slices of that length at i and at j (i < j) have one fingerprint."""
        out = np.ones(len(i), bool)
        for total, up in zip(self._sum, self._up):
            a = modulo(total[i + length] + _PRIME - total[i])
            b = modulo(total[j + length] + _PRIME - total[j])
            out &= modulo(a * up[j - i]) == b
        return out

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j (i < j)."""
        return self._search(self.n - j, lambda k: self.equal(i, j, k))

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common suffix of the prefixes that end before i and j (i < j)."""
        return self._search(i.copy(), lambda k: self.equal(i - k, j - k, k))

    @staticmethod
    def _search(high: np.ndarray, fits) -> np.ndarray:
        low = np.zeros_like(high)
        while (low < high).any():
            k = (low + high + 1) // 2
            ok = fits(k)
            low, high = np.where(ok, k, low), np.where(ok, high, np.maximum(low, k - 1))
        return low


def _holds(s: np.ndarray, start: int, length: int, period: int) -> bool:
    """Whether words ``period`` apart are equal, compared one by one."""
    return bool((s[start:start + length - period] == s[start + period:start + length]).all())


def runs(s: np.ndarray, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> np.ndarray:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period."""
    rank = s.tolist()
    found = []
    match = Matcher(s)
    for high_first in (True, False):
        root = np.array(lyndon(rank, high_first), np.int64)
        at = np.arange(len(s))
        # a run of three periods holds a root that is followed by itself
        ok = at + 2 * root <= len(s)
        at, p = at[ok], root[ok]
        ok = match.equal(at, at + p, p)
        at, p = at[ok], p[ok]
        back, on = match.backward(at, at + p), match.forward(at, at + p)
        length = back + p + on
        ok = length >= np.maximum(min_length, min_power * p)
        found.append(np.stack([at - back, length, p], axis=1)[ok])
    got = np.unique(np.concatenate(found), axis=0)[:, [0, 2, 1]] if len(s) else np.zeros((0, 3), np.int64)
    got = got[np.lexsort((got[:, 1], got[:, 0]))][:, [0, 2, 1]]
    for start, length, period in got.tolist():
        if not _holds(s, start, length, period):
            raise RuntimeError("two different stretches of words have one fingerprint")
    return got


def runs_of_texts(ids: np.ndarray, off: np.ndarray, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER):
    """Runs of several texts: rows (text, start in the text, length, period)."""
    # every window of a run has its like one period on or back if the run is this longer than two periods
    window = max(1, min(WINDOW, min_length + 1 - 2 * -(-min_length // min_power)))
    out = [np.zeros((0, 4), np.int64)]
    for a, z in stretches(ids, off, window, min_length).tolist():
        got = runs(ids[a:z], min_length, min_power)
        if len(got):
            text = int(np.searchsorted(off, a, side="right")) - 1
            got[:, 0] += a - off[text]
            out.append(np.column_stack([np.full(len(got), text), got]))
    return np.concatenate(out)


def find(docs: DataFrame, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, runs array<struct<start, length, period>> (by start, then period), collapsed text of every row.

    The collapsed text leaves out the words that some run contains after its
    first period, and joins the others by one blank.
    """
    if min_length < 3 or min_power < 3:
        raise ValueError("runs need three words and three periods at least")

    def run(batches):
        for b in batches:
            for first, rows in packs(b.column(1).to_pylist()):
                ids, off, words = word_ids(rows)
                got = runs_of_texts(ids, off, min_length, min_power)
                change = np.zeros(len(ids) + 1, np.int64)
                begin = off[got[:, 0]] + got[:, 1]
                np.add.at(change, begin + got[:, 3], 1)
                np.add.at(change, begin + got[:, 2], -1)
                stays = np.cumsum(change[:-1]) == 0
                flat = pa.StructArray.from_arrays([pa.array(got[:, i]) for i in (1, 2, 3)],
                                                  ["start", "length", "period"])
                at = np.searchsorted(got[:, 0], np.arange(len(rows) + 1)).astype(np.int32)
                texts = []
                for a, z in zip(off.tolist(), off[1:].tolist()):
                    texts.append(" ".join([words[i] for i in ids[a:z][stays[a:z]].tolist()]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(rows)), pa.ListArray.from_arrays(pa.array(at), flat), pa.array(texts)],
                    ["key", "runs", "collapsed"])

    d = id_and_text(docs, key, text)
    t = d.schema[key].dataType.simpleString()
    return d.mapInArrow(run, f"key {t}, runs array<struct<start:long,length:long,period:long>>, collapsed string") \
        .withColumnRenamed("key", key)


def strongest(found: Column) -> Column:
    """The run with the greatest length / period, exactly; ties by start, then period. Null without runs."""
    def better(best, r):
        left, right = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (left > right), r).otherwise(best)  # runs come by start, then period
    return F.aggregate(found, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text: texts whose id hashes to a multiple of ten repeat from word a on with period p, as op12's
    contract says; the words of such a text are joined by one blank. Null ids hash to nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
    w = F.filter(F.split("text", GAP), lambda x: x != "")
    d = d.withColumn("w", F.when(F.col("h") % 10 == 0, w))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    d = d.withColumn("n", n).withColumn("a", F.when(n > 0, g % n))
    d = d.withColumn("p", F.lit(1).cast("long") + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + g % 8)))
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = find(with_planted_periods(read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    best = r.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256)
        .alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
