"""Byte-level byte-pair encoding over ragged numpy arrays.

``Vocabulary`` reads a public tokenizer file (its path is a parameter); the
file is never trained or copied. Two ways lead from pre-tokens to tokens:

* :func:`merge` -- rank-synchronous merging: all pre-tokens of a batch are held
  as one ragged array of symbols, and in every round each pre-token applies its
  lowest-rank pair at the same time as all others;
* :func:`speculate` -- greedy longest match proposes tokens, a vectorised check
  tests every adjacent pair, and only pre-tokens with a failing pair go
  through :func:`merge`.

Both give the ids of the reference library; pre-tokens that were seen before
are looked up in a table that is emptied when it reaches ``KEEP`` entries.

Edge cases: null and empty texts have no tokens; the strings of added tokens
inside a text become their ids, as the library does by default; texts of any
length are handled in segments (see :mod:`.ragged`); a pre-token of any length
takes time in proportion to it.
"""

from __future__ import annotations

import json

import numpy as np

from .ragged import (SEGMENT, SPACE, KeyTable, Prefix, char_classes, expand, flat, mix, once, packs,
                     segments)

KEEP = 1 << 21  # distinct pre-tokens remembered by a task
WINDOW, OVERLAP = 2048, 256  # bytes of a long pre-token that are merged together, and that two windows share
LONG_WALK = 512  # bytes of a pre-token that is walked by itself
_NONE = np.int32(2**31 - 1)


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 stands for itself, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.astype(np.uint64) * np.uint64(1 << 32) + b.astype(np.uint64) + np.uint64(1))


class Vocabulary:
    """Tables of a byte-level BPE vocabulary whose ids rise in merge order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte = spec["model"], _byte_of_char()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        text = [b""] * self.size
        for s, i in ids.items():
            text[i] = s.encode() if s in self.special else bytes(byte[c] for c in s)
        for s, i in self.special.items():
            text[i] = s.encode()
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.length = np.array([len(t) for t in text], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.of_byte = np.zeros(256, np.int32)
        for c, b in byte.items():
            self.of_byte[b] = ids[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = np.array([ids[a + b] for a, b in merges], np.int32)
        left, right = (np.array([ids[m[k]] for m in merges], np.int32) for k in (0, 1))
        if len(made) and not (np.diff(made) > 0).all():
            raise ValueError("ids must rise in merge order")
        self.left, self.right = np.full(self.size, -1, np.int32), np.full(self.size, -1, np.int32)
        self.left[made], self.right[made] = left, right
        self.pairs = KeyTable()
        self.pairs.put(_pair(left, right), made)
        # beginnings of tokens by the hash of their bytes, for the longest match; the token that ends there, or -1
        plain = np.array(sorted(set(ids.values()) - set(self.special.values())), np.int64)
        prefix, size = Prefix(self.bytes), self.length[plain]
        head = np.repeat(self.start[plain], size)
        self.beginnings = KeyTable()
        number, _ = self.beginnings.number(prefix.slices(head, head + 1 + expand(np.zeros(len(plain), np.int64), size)))
        self.ends_in = np.full(self.beginnings.n, -1, np.int32)
        self.ends_in[number[np.cumsum(size) - 1]] = plain

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        return once(("bpe", path), lambda: cls(path))

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the token that two adjacent tokens merge to, or the largest number."""
        got = self.pairs.find(_pair(a, b))
        got[got < 0] = _NONE
        return got


def pretokens(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts as byte-level tokenizers do; each piece is a text of its own.

    Returns the UTF-8 bytes of the joined pieces, first and past-the-last byte
    of each pre-token, and the number of pre-tokens before each piece.

    A pre-token is a contraction (apostrophe with s, t, m, d, re, ve, ll), or a
    run of letters, of numbers or of other signs with one blank before it if
    there is one, or the white space before that.
    """
    cp, bounds = flat(pieces)
    n = len(cp)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(pieces) + 1, np.int64)
    kind = char_classes()[cp]
    run = np.empty(n, bool)
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    inner = bounds[:-1]
    first = np.zeros(n, bool)
    first[inner[inner < n]] = True
    run |= first
    starts = np.flatnonzero(run)
    # a run of signs after white space of the same piece takes the last blank along
    solid = starts[(kind[starts] != SPACE) & ~first[starts]]
    solid = solid[kind[solid - 1] == SPACE]
    run[solid - 1] = True
    run[solid[cp[solid - 1] == 32]] = False
    # contractions: the apostrophe opens its run and takes no blank
    q = starts[(cp[starts] == 39)]
    if len(q):
        q = q[first[q] | (cp[q - 1] != 32)]
        ends = np.searchsorted(bounds, q, side="right")
        room = bounds[ends] - q
        pad = np.append(cp, [0, 0, 0])
        a, b = pad[q + 1], pad[q + 2]
        two = (room >= 2) & np.isin(a, [ord(c) for c in "stmd"])
        three = (room >= 3) & np.isin(a * 65536 + b, [ord(x) * 65536 + ord(y) for x, y in ("re", "ve", "ll")])
        for hit, size in ((two, 2), (three & ~two, 3)):
            at, stop = q[hit], room[hit] > size
            run[at + 1] = False
            run[at[stop] + size] = True
            # a contraction ends its letters; what follows starts anew, except signs that follow a blank
    starts = np.flatnonzero(run)
    width = np.ones(n, np.int64)
    width += cp >= 0x80
    width += cp >= 0x800
    width += cp >= 0x10000
    at_byte = np.zeros(n + 1, np.int64)
    np.cumsum(width, out=at_byte[1:])
    b = np.frombuffer("".join(pieces).encode("utf-8"), np.uint8)
    begin = at_byte[starts]
    return b, begin, np.append(begin[1:], at_byte[-1]), np.searchsorted(starts, bounds)


def merge(v: Vocabulary, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of many pre-tokens, flat, and their number for each: rank-synchronous merging.

    A pre-token of more than ``WINDOW`` bytes goes as windows that overlap, which
    are merged like others and joined at a boundary that both have and that is
    compatible (so every adjacent pair is, and the tokens are those of the whole).
    """
    long = np.flatnonzero(end - begin > WINDOW)
    if not len(long):
        return _merge_rows(v, data, begin, end)
    of, first, last = [np.flatnonzero(end - begin <= WINDOW)], [], []
    first.append(begin[of[0]])
    last.append(end[of[0]])
    for r in long.tolist():
        at = np.arange(begin[r], end[r] - OVERLAP, WINDOW - OVERLAP)
        of.append(np.full(len(at), r))
        first.append(at)
        last.append(np.minimum(at + WINDOW, end[r]))
    of, first, last = (np.concatenate(x) for x in (of, first, last))
    tok, n = _merge_rows(v, data, first, last)
    ends = np.cumsum(n)
    parts, rows = [tok[:int(n[:len(begin) - len(long)].sum())]], [np.repeat(of, n)[:int(n[:len(begin) - len(long)].sum())]]
    for r in long.tolist():
        mine = np.flatnonzero(of == r)
        whole = _joined(v, [tok[ends[i] - n[i]:ends[i]] for i in mine], first[mine] - begin[r])
        if whole is None:
            whole = _merge_rows(v, data, begin[r:r + 1], end[r:r + 1])[0]
        parts.append(whole)
        rows.append(np.full(len(whole), r))
    row = np.concatenate(rows)
    return np.concatenate(parts)[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(begin))


def _joined(v: Vocabulary, windows: list[np.ndarray], starts: np.ndarray) -> np.ndarray | None:
    """Tokens of the whole from those of overlapping windows; None if two windows have no boundary to join at."""
    out, tok, at = [], windows[0], starts[0]
    begins = at + np.cumsum(v.length[tok]) - v.length[tok]
    for new, start in zip(windows[1:], starts[1:].tolist()):
        new_begins = start + np.cumsum(v.length[new]) - v.length[new]
        end = begins[-1] + v.length[tok[-1]]
        both, i, j = np.intersect1d(np.append(begins, end), new_begins, assume_unique=True, return_indices=True)
        ok = np.flatnonzero((i > 0) & compatible(v, tok[np.maximum(i - 1, 0)], new[j]))
        if not len(ok):
            return None
        pick = ok[len(ok) // 2]
        out.append(tok[:i[pick]])
        tok, begins = new[j[pick]:], new_begins[j[pick]:]
    return np.concatenate([*out, tok])


def _merge_rows(v: Vocabulary, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every round finds the lowest-rank pair of each pre-token and merges all of its places from the left;
    pre-tokens without a mergeable pair leave."""
    n = end - begin
    sym = v.of_byte[data[expand(begin, n)]]
    row = np.repeat(np.arange(len(n)), n)
    out_row, out_sym = [], []
    rank = np.full(len(sym), _NONE)
    if len(sym) > 1:
        near = np.flatnonzero(row[:-1] == row[1:])
        rank[near] = v.merged(sym[near], sym[near + 1])
    while len(sym):
        heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        low = np.minimum.reduceat(rank, heads)
        size = np.diff(np.append(heads, len(sym)))
        done = np.repeat(low == _NONE, size)
        if done.any():
            out_row.append(row[done])
            out_sym.append(sym[done])
            keep = ~done
            sym, row, rank = sym[keep], row[keep], rank[keep]
            low, size = low[low != _NONE], size[low != _NONE]
            if not len(sym):
                break
        at = np.flatnonzero(rank == np.repeat(low, size))
        # of overlapping places (a a a) every second one from the left merges
        lone = np.r_[True, np.diff(at) > 1]
        if not lone.all():
            chain = np.maximum.accumulate(np.where(lone, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - chain) % 2 == 0]
        sym[at] = rank[at]
        gone = np.zeros(len(sym), bool)
        gone[at + 1] = True
        place = np.cumsum(~gone) - 1
        at = place[at]
        sym, row, rank = sym[~gone], row[~gone], rank[~gone]
        touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
        rank[touched] = _NONE
        touched = touched[touched + 1 < len(sym)]
        touched = touched[row[touched] == row[touched + 1]]
        rank[touched] = v.merged(sym[touched], sym[touched + 1])
    if not out_sym:
        return np.zeros(0, np.int32), np.zeros(len(begin), np.int64)
    row, sym = np.concatenate(out_row), np.concatenate(out_sym)
    order = np.argsort(row, kind="stable")
    return sym[order], np.bincount(row, minlength=len(begin))


def compatible(v: Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging would leave the boundary between two adjacent tokens alone.

    The last merges of both tokens are undone, the later one first. While the
    two symbols at the boundary coexist, their own merge must not be due before
    one of them was used up.
    """
    ok = np.ones(len(a), bool)
    at, x, y = np.arange(len(a)), a.astype(np.int32), b.astype(np.int32)
    until = np.full(len(a), _NONE)
    while len(at):
        bad = v.merged(x, y) < until
        ok[at[bad]] = False
        go = ~bad & ((v.left[x] >= 0) | (v.left[y] >= 0))
        at, x, y, until = at[go], x[go], y[go], until[go]
        # a later id was merged later; of two equal tokens the right one was
        undo_x = np.where(v.left[x] < 0, False, np.where(v.left[y] < 0, True, x > y))
        until = np.where(undo_x, x, y + 1)
        x, y = np.where(undo_x, v.right[x], x), np.where(undo_x, y, v.left[y])
    return ok


def propose(v: Vocabulary, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy longest match of all pre-tokens: tokens flat, and their number for each.

    The longest token that starts at each byte is found for all bytes at once, by
    lengthening the beginnings of tokens as long as there are any; then every
    pre-token is walked from match to match.
    """
    size = end - begin
    place = expand(begin, size)
    prefix = Prefix(data)
    room = np.repeat(end, size)
    longest, open_ = np.full(len(place), -1, np.int32), np.arange(len(place))
    length = 0
    while len(open_):
        length += 1
        open_ = open_[place[open_] + length <= room[open_]]
        number = v.beginnings.find(prefix.slices(place[open_], place[open_] + length))
        open_, number = open_[number >= 0], number[number >= 0]
        token = v.ends_in[number]
        longest[open_[token >= 0]] = token[token >= 0]
    step = v.length[longest]
    at = np.cumsum(size) - size  # of each pre-token among the bytes looked at
    stop = at + size
    row = np.arange(len(begin))
    rows, toks = [], []
    wide = np.flatnonzero(size > LONG_WALK)
    for r in wide.tolist():  # one by one: their walks are long
        steps, i, walk = step[at[r]:stop[r]].tolist(), 0, []
        while i < len(steps):
            walk.append(i)
            i += steps[i]
        rows.append(np.full(len(walk), r))
        toks.append(longest[at[r] + np.array(walk)])
    short = size <= LONG_WALK
    at, stop, row = at[short], stop[short], row[short]
    while len(row):
        rows.append(row)
        toks.append(longest[at])
        at = at + step[at]
        live = at < stop
        at, stop, row = at[live], stop[live], row[live]
    if not rows:
        return np.zeros(0, np.int32), np.zeros(len(begin), np.int64)
    row, tok = np.concatenate(rows), np.concatenate(toks)
    return tok[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(begin))


def speculate(v: Vocabulary, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of many pre-tokens, flat, and their number for each: speculate and verify."""
    tok, n = propose(v, data, begin, end)
    row = np.repeat(np.arange(len(n)), n)
    near = np.flatnonzero(row[:-1] == row[1:])
    pair = tok[near].astype(np.int64) << 32 | tok[near + 1]
    seen, back = np.unique(pair, return_inverse=True)
    ok = compatible(v, seen >> 32, seen & 0xFFFFFFFF)[back]
    wrong = np.zeros(len(n), bool)
    wrong[row[near[~ok]]] = True
    fail = np.flatnonzero(wrong)
    if not len(fail):
        return tok, n
    tok2, n2 = merge(v, data, begin[fail], end[fail])
    keep = ~wrong[row]
    row = np.concatenate([row[keep], np.repeat(fail, n2)])
    tok = np.concatenate([tok[keep], tok2])
    n = n.copy()
    n[fail] = n2
    return tok[np.argsort(row, kind="stable")], n


class Encoder:
    """Encodes texts of one task; ``method`` is :func:`speculate` or :func:`merge`."""

    def __init__(self, vocabulary: Vocabulary, method=speculate):
        self.v, self.method = vocabulary, method
        self._reset()

    def _reset(self) -> None:
        self.table = KeyTable(16)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.first, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, tok: np.ndarray, n: np.ndarray, at: int) -> None:
        while self.used + len(tok) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while at + len(n) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.pool[self.used:self.used + len(tok)] = tok
        self.first[at:at + len(n)] = self.used + np.cumsum(n) - n
        self.count[at:at + len(n)] = n
        self.used += len(tok)

    def _split(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Pieces without added tokens; the row of each piece; the id of those that are an added token, else -1."""
        pieces, row, special = [], [], []
        for i, t in enumerate(texts):
            parts = [(t, -1)]
            for s, k in self.v.special.items():
                if s in t:
                    parts = [x for p, known in parts for x in (
                        [(p, known)] if known >= 0 else
                        [y for j, q in enumerate(p.split(s)) for y in (((" ", k), (q, -1)) if j else ((q, -1),))])]
            for p, k in parts:
                for piece in segments(p) if k < 0 else (p,):
                    pieces.append(piece)
                    row.append(i)
                    special.append(k)
        return pieces, np.array(row, np.int64), np.array(special, np.int64)

    def _numbers(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, begin, end, off = pretokens(pieces)
        if not len(begin):
            return np.zeros(0, np.int32), off
        known = self.table.n
        wid, new = self.table.number(Prefix(data).slices(begin, end))
        if len(new):
            self._learn(*self.method(self.v, data, begin[new], end[new]), known)
        return wid, off

    def encode(self, texts: list):
        """(first row, ids flat, offsets) for runs of rows that follow each other."""
        for first, rows in packs(texts):
            pieces, row, special = self._split(rows)
            ids, counts = [], np.zeros(len(rows), np.int64)
            at = 0
            while at < len(pieces):
                stop, size = at, 0
                while stop < len(pieces) and (size == 0 or size + len(pieces[stop]) <= SEGMENT):
                    size += len(pieces[stop])
                    stop += 1
                if self.table.n > KEEP:
                    self._reset()
                wid, off = self._numbers(pieces[at:stop])
                n = self.count[wid]
                got = self.pool[expand(self.first[wid], n)]
                per = np.add.reduceat(np.append(n, 0), off[:-1]) * (np.diff(off) > 0) if len(wid) else np.diff(off)
                known = special[at:stop]
                if (known >= 0).any():  # an added token stands where one blank was encoded
                    begins = np.cumsum(per) - per
                    got[begins[known >= 0]] = known[known >= 0]
                ids.append(got)
                np.add.at(counts, row[at:stop], per)
                at = stop
            off = np.zeros(len(rows) + 1, np.int64)
            np.cumsum(counts, out=off[1:])
            yield first, np.concatenate(ids) if ids else np.zeros(0, np.int32), off

    def counts(self, texts: list) -> np.ndarray:
        """Number of tokens of each text, without building the ids."""
        out = np.zeros(len(texts), np.int64)
        for first, rows in packs(texts):
            pieces, row, special = self._split(rows)
            for at in range(0, len(pieces), 1 << 16):
                some, known = pieces[at:at + (1 << 16)], special[at:at + (1 << 16)]
                if len(rows) == 1 and len(rows[0]) > SEGMENT:  # one long text, segment by segment
                    for p in some:
                        self._bound()
                        out[first] += int(self.count[self._numbers([p])[0]].sum())
                    continue
                self._bound()
                wid, off = self._numbers(some)
                total = np.zeros(len(wid) + 1, np.int64)
                np.cumsum(self.count[wid], out=total[1:])
                np.add.at(out, first + row[at:at + (1 << 16)], total[off[1:]] - total[off[:-1]])
        return out

    def _bound(self) -> None:
        if self.table.n > KEEP:
            self._reset()


def decode(v: Vocabulary, ids: np.ndarray) -> bytes:
    """Bytes of a sequence of ids, gathered at once from the vocabulary's byte table."""
    return v.bytes[expand(v.start[ids], v.length[ids])].tobytes()
