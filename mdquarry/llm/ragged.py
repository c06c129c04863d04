"""Ragged numpy arrays shared by the operators of this subpackage.

Texts of one Arrow batch are joined into flat arrays and cut into pre-tokens
or words with a handful of array operations, so the cost is a few passes over
the characters instead of one Python call per token.

Edge cases: a null text is an empty text; a text of any length is cut into
segments at places where no token crosses, so memory follows the segment size
(only a text without a single blank between two words is held whole).
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata

import numpy as np

SEGMENT = 1 << 18  # characters handled at once

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# fixed values: the code points with the Unicode property White_Space
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def once(key, build):
    """A value built once per process: functions travel to the workers by value, so their globals do not last."""
    kept = sys.modules.setdefault("_mdquarry_process_values", types.ModuleType("_mdquarry_process_values")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def _classes() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    t = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    t[_WHITE] = SPACE
    return t


def char_classes() -> np.ndarray:
    """Class of every code point (uint8)."""
    return once("char_classes", _classes)


def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least 2**bits of them."""
    def build():
        a = np.full((2, 1 << bits), [[_BASE], [_INVERSE]], np.uint64)
        a[:, 0] = 1
        return np.cumprod(a, axis=1, dtype=np.uint64)

    bits = max(19, bits)
    got = once(("powers", bits), build)
    return got[0], got[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words with well spread low bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_PRIME = np.uint64((1 << 31) - 1)
_PRIME_BASE = 1_220_703_125
_PRIME_INVERSE = pow(_PRIME_BASE, -1, (1 << 31) - 1)


def modulo(x: np.ndarray) -> np.ndarray:
    """64-bit words modulo the prime 2**31 - 1, by shifts."""
    x = (x & _PRIME) + (x >> np.uint64(31))
    x = (x & _PRIME) + (x >> np.uint64(31))
    return np.where(x >= _PRIME, x - _PRIME, x)


def prime_powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**31 - 1, at least 2**bits of them."""
    def build():
        out = np.ones((2, 1 << bits), np.uint64)
        for row, base in zip(out, (_PRIME_BASE, _PRIME_INVERSE)):
            k, power = 1, base
            while k < len(row):  # by doubling
                row[k:2 * k] = modulo(row[:k] * np.uint64(power))
                power = power * power % int(_PRIME)
                k *= 2
        return out

    bits = max(19, bits)
    got = once(("prime powers", bits), build)
    return got[0], got[1]


class Prefix:
    """Hashes of arbitrary slices of a flat array by differences of prefix sums.

    Sums modulo 2**64 have collisions of a known kind between long slices (two
    letters that alternate as in the Thue-Morse sequence, from 1,024 letters on).
    So slices of ``LONG`` values or more also take in a sum modulo a prime.
    """

    LONG = 32

    def __init__(self, values: np.ndarray):
        self._values, self._prime_sum = values, None
        up, self._down = _powers(int(len(values)).bit_length())
        self._sum = np.empty(len(values) + 1, np.uint64)
        self._sum[0] = 0
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:len(values)], out=self._sum[1:])

    @staticmethod
    def _terms(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
        """values * powers, folded below 2**33."""
        v = values.astype(np.uint64)
        if values.dtype.itemsize == 8:
            v = (v & _PRIME) + ((v >> np.uint64(31)) & _PRIME) + (v >> np.uint64(62))
        v = (v + np.uint64(1)) * powers
        return (v & _PRIME) + (v >> np.uint64(31))

    def _modulo_prime(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sum of value times power modulo the prime, of each slice."""
        bits = int(max(len(self._values), 1)).bit_length()
        up, down = prime_powers(bits)
        total = int(size.sum())
        if self._prime_sum is None and total < len(self._values):  # few long slices
            first = np.cumsum(size) - size
            place = np.arange(total) - np.repeat(first, size)
            terms = self._terms(self._values[np.repeat(start, size) + place], up[place])
            return modulo(np.add.reduceat(terms, first))
        if self._prime_sum is None:
            self._prime_sum = np.zeros(len(self._values) + 1, np.uint64)
            np.cumsum(self._terms(self._values, up[:len(self._values)]), out=self._prime_sum[1:])
        return modulo(modulo(self._prime_sum[start + size] - self._prime_sum[start]) * down[start])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        h = (self._sum[end] - self._sum[start]) * self._down[start] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        long = np.flatnonzero(size >= self.LONG)
        if len(long):
            start, size = np.asarray(start)[long], size[long]
            h[long] += self._modulo_prime(start, size) * np.uint64(0x9FB21C651E98DF25)
        h = mix(h)
        h[h == 0] = 1
        return h


class KeyTable:
    """Open-addressing map from non-zero 64-bit keys to dense int32 numbers, in vectorised steps."""

    def __init__(self, bits: int = 12):
        self.keys, self.vals, self.n = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        mask = np.uint64(len(self.keys) - 1)
        slot = (h & mask).astype(np.int64)
        got = self.keys[slot]
        out = np.where(got == h, self.vals[slot], np.int32(-1))
        at = np.flatnonzero((got != h) & (got != 0))
        slot = slot[at]
        while len(at):
            slot = (slot + 1) & (len(self.keys) - 1)
            got = self.keys[slot]
            hit = got == h[at]
            out[at[hit]] = self.vals[slot[hit]]
            live = ~hit & (got != 0)
            at, slot = at[live], slot[live]
        return out

    def put(self, h: np.ndarray, vals: np.ndarray) -> None:
        """Add keys that are distinct and not present."""
        while (self.n + len(h)) * 2 > len(self.keys):
            old = self.keys != 0
            k, v = self.keys[old], self.vals[old]
            self.keys, self.vals = np.zeros(4 * len(self.keys), np.uint64), np.zeros(4 * len(self.vals), np.int32)
            self._place(k, v)
        self._place(h, np.asarray(vals, np.int32))
        self.n += len(h)

    def _place(self, h: np.ndarray, vals: np.ndarray) -> None:
        mask = len(self.keys) - 1
        slot = (h & np.uint64(mask)).astype(np.int64)
        while len(h):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[free]
            won = self.keys[slot] == h
            self.vals[slot[won]] = vals[won]
            h, vals, slot = h[~won], vals[~won], (slot[~won] + 1) & mask

    def number(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each key, giving new ones the next numbers; and for each new key where it first stands."""
        out = self.find(h)
        miss = np.flatnonzero(out < 0)
        if not len(miss):
            return out, miss
        new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
        ids = np.arange(self.n, self.n + len(new), dtype=np.int32)
        self.put(new, ids)
        out[miss] = ids[back]
        return out, miss[first]


def expand(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i]+length[i]-1 of all i, one after another."""
    total = int(length.sum())
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(total)


_CUT = re.compile(r"\S(?= \S)")


def segments(text: str, size: int = SEGMENT):
    """Cut a long text before single blanks between words: every cut starts a pre-token."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size - 1)
        if not m or m.end() >= len(text):
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:] if at else text


def packs(texts: list, size: int = SEGMENT):
    """(first row, texts) for runs of whole texts of about ``size`` characters; a longer text stands alone."""
    rows, n, first = [], 0, 0
    for i, t in enumerate(texts):
        t = t or ""
        if rows and n + len(t) > size:
            yield first, rows
            rows, n, first = [], 0, i
        rows.append(t)
        n += len(t)
    if rows:
        yield first, rows


def flat(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the joined pieces (uint32), and where each piece begins (with the end)."""
    cp = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
    bounds = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(p) for p in pieces], out=bounds[1:])
    return cp, bounds


def words(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs without white space) of each piece.

    Returns the hash, first and past-the-last code point within the joined
    pieces of every word, and the number of words before each piece (with the
    total).
    """
    cp, bounds = flat(pieces)
    solid = char_classes()[cp] != SPACE
    before = np.empty(len(solid), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = bounds[1:-1]
    before[inner[inner < len(before)]] = False
    start = np.flatnonzero(solid & ~before)
    after = np.empty(len(solid), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    ends = inner[inner > 0] - 1
    after[ends] = False
    end = np.flatnonzero(solid & ~after) + 1
    h = Prefix(cp).slices(start, end) if len(start) else np.zeros(0, np.uint64)
    return h, start, end, np.searchsorted(start, bounds)


def shingles(h: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words within each piece, and their offsets.

    A piece of 1 to width-1 words has one shingle of all its words; a piece
    without words has none.
    """
    n = np.diff(offsets)
    m = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(m, out=out[1:])
    start = expand(offsets[:-1], m)
    end = start + np.repeat(np.minimum(n, width), m)
    return (Prefix(h >> np.uint64(1)).slices(start, end) if len(start) else np.zeros(0, np.uint64)), out


def word_rows(texts: list):
    """(first row, hashes, starts, ends, offsets) as :func:`words`, over all texts; positions are within each text."""
    for first, rows in packs(texts):
        if len(rows) == 1 and len(rows[0]) > 2 * SEGMENT:
            parts, at = [], 0
            for piece in segments(rows[0]):
                h, s, e, _ = words([piece])
                parts.append((h, s + at, e + at))
                at += len(piece)
            h, s, e = (np.concatenate(x) for x in zip(*parts))
            yield first, h, s, e, np.array([0, len(h)])
        else:
            h, s, e, off = words(rows)
            begin = np.zeros(len(rows), np.int64)
            np.cumsum([len(r) for r in rows[:-1]], out=begin[1:])
            shift = np.repeat(begin, np.diff(off))
            yield first, h, s - shift, e - shift, off
