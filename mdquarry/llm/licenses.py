"""License notices in texts: winnowed fingerprints, then banded alignment.

Templates are cut into words (lower-cased runs of letters and digits). Hashes of
``GRAM`` words are winnowed: of every ``WINDOW`` hashes in a row the smallest is
kept, and an inverted index leads from it to its places in the templates. In a
text, every gram that the index knows gives a seed (template, diagonal); seeds
of a template on nearby diagonals make one candidate, whose words are aligned to
the template's within a band around those diagonals. An occurrence is reported
if the matched words cover ``COVERAGE`` of the template and it has the template's
version and variant words (``TELLING``), no more and no fewer.

The registered templates are short notices and headers; the bodies of licenses,
and notices worded otherwise, are found only if they are handed in as templates.

The index holds the templates only, so it is as large as its parameter; texts
are scanned once, without a shuffle, whole and in order.

Edge cases: null and empty texts have no occurrence; a text may hold a template
several times, and different templates may overlap; equal texts give equal
rows; templates shorter than ``GRAM`` words are matched as one gram; other
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import id_and_text, read
from .ragged import LETTER, NUMBER, KeyTable, Prefix, char_classes, flat, packs

GRAM = 3
WINDOW = 4
BAND = 8
COVERAGE = 0.8

# fixed values: public license notices and headers
TEMPLATES = (
    ("Apache-2.0-short", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
     "either express or implied. See the License for the specific language governing permissions and limitations "
     "under the License."),
    ("MIT-short", "Released under the MIT License."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     'and associated documentation files (the "Software"), to deal in the Software without restriction, including '
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software."),
    ("GPL-3.0-short", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("CC-BY-NC-4.0-short", "Licensed under CC BY-NC 4.0."),
    ("BSD-redistribution", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("All-rights-reserved", "All rights reserved."),
    ("GPL-2.0-short", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-header", "This program is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
     "or (at your option) any later version."),
    ("LGPL-2.1-short", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1-header", "This library is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
     "License, or (at your option) any later version."),
    ("LGPL-3.0-short", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("AGPL-3.0-short", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("MPL-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
     "of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC-permission", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
     "all copies."),
    ("CC-BY-4.0-short", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-short", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0-short", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0-short", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0-short", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0-short", "Licensed under CC0 1.0."),
)
# words that tell versions and variants of a license apart: an occurrence has those of its template and no other
TELLING = (*"0123456789", "lesser", "library", "affero", "nc", "nd", "sa", "noncommercial", "noderivatives", "sharealike")


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and past-the-last code point (within its text) of every word; words before each text."""
    # letters are lowered one by one, so that positions stay those of the text
    cp, bounds = flat(texts)
    if not len(cp):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(texts) + 1, np.int64)
    kind = char_classes()[cp]
    word = (kind == LETTER) | (kind == NUMBER)
    edge = np.zeros(len(cp) + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(word & (edge[:-1] | ~np.append(False, word[:-1])))
    end = np.flatnonzero(word & (edge[1:] | ~np.append(word[1:], False))) + 1
    low = np.where((cp >= 65) & (cp <= 90), cp + 32, cp)
    off = np.searchsorted(start, bounds)
    shift = np.repeat(bounds[:-1], np.diff(off))
    return Prefix(low).slices(start, end), start - shift, end - shift, off


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest hash (the last of equals) of every window."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1))


class Index:
    """Inverted index from winnowed grams to (template, place)."""

    def __init__(self, templates, gram: int = GRAM, window: int = WINDOW):
        self.names = [n for n, _ in templates]
        h, _, _, off = tokens([t for _, t in templates])
        self.words = [h[a:z] for a, z in zip(off, off[1:])]
        self.telling = np.unique(tokens([" ".join(TELLING)])[0])
        self.marks = [w[np.isin(w, self.telling)] for w in self.words]
        self.grams = sorted({min(gram, len(w)) for w in self.words if len(w)})
        self.table, self.places = KeyTable(), []
        found = defaultdict(list)
        for t, w in enumerate(self.words):
            g = min(gram, len(w))
            if g:
                hashes = Prefix(w >> np.uint64(1)).slices(np.arange(len(w) - g + 1), np.arange(g, len(w) + 1))
                for p in winnow(hashes, window):
                    found[int(hashes[p])].append((t, int(p)))
        if found:
            self.table.put(np.array(list(found), np.uint64), np.arange(len(found)))
            self.places = list(found.values())

    def same_marks(self, t: int, h: np.ndarray, start: int, end: int) -> bool:
        """Whether words start to end name the version and variant that template t names."""
        span = h[start:end]
        return np.array_equal(span[np.isin(span, self.telling)], self.marks[t])

    def seeds(self, h: np.ndarray):
        """(place in the text, template, place in the template) of all known grams."""
        prefix = Prefix(h >> np.uint64(1))
        for g in self.grams:
            if len(h) >= g:
                at = self.table.find(prefix.slices(np.arange(len(h) - g + 1), np.arange(g, len(h) + 1)))
                for i in np.flatnonzero(at >= 0):
                    for t, p in self.places[at[i]]:
                        if min(GRAM, len(self.words[t])) == g:
                            yield int(i), t, p


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """Longest common subsequence of template and text where |place in text - place in template - shift| <= band.

    Returns the matched words, and the first and past-the-last matched word of
    the text; of equally long alignments the one that ends first, then the one
    that begins last.
    """
    width = 2 * band + 1
    best = [(0, 0, 0)] * (width + 1)  # (matched, begin, -end) by diagonal; one more for the upper neighbour
    for i, w in enumerate(template):
        row = list(best)
        left = (0, 0, 0)
        for d in range(width):
            j = i + shift - band + d
            top = max(best[d + 1] if d + 1 < width else (0, 0, 0), left)
            if 0 <= j < len(text) and text[j] == w:
                n, b, _ = best[d]
                top = max(top, (n + 1, b if n else j, -(j + 1)))
            row[d] = left = top
        best = row
    n, b, e = max(best)
    return n, b, -e


def occurrences(index: Index, h: np.ndarray, band: int = BAND, coverage: float = COVERAGE):
    """(template, matched words, first word, past-the-last word) found in a text of hashed words."""
    by_template = defaultdict(list)
    for i, t, p in index.seeds(h):
        by_template[t].append((i - p, i))
    for t, seeds in sorted(by_template.items()):
        seeds.sort()
        runs: list[list] = []
        for d, i in seeds:
            if runs and d - runs[-1][-1][0] <= band:
                runs[-1].append((d, i))
            else:
                runs.append([(d, i)])
        w, slices = index.words[t], []
        for run in runs:
            # a long chain of nearby diagonals is cut, so that the band stays narrow
            for d in range(run[0][0], run[-1][0] + 1, 2 * band):
                mine = [x for x in run if d <= x[0] < d + 2 * band]
                if mine:
                    lo, hi = mine[0][0], mine[-1][0]
                    slices.append(((lo + hi) // 2, band + (hi - lo + 1) // 2, np.array([i for _, i in mine])))
        used, tried, taken = np.zeros(len(h), bool), set(), []
        # what an occurrence leaves of a slice is aligned again, as the template may stand there several times
        while slices:
            found, again = [], []
            for base, wide, places in slices:
                low, high = max(0, base - wide), min(len(h), base + wide + len(w))
                free = np.flatnonzero(np.diff(np.concatenate([[True], used[low:high], [True]]).astype(np.int8))) + low
                for s, e in zip(free[::2].tolist(), free[1::2].tolist()):
                    if (base, s, e) in tried or not ((places >= s) & (places < e)).any():
                        continue
                    tried.add((base, s, e))
                    n, x, y = align(w, h[s:e], base - s, wide)
                    if n >= coverage * len(w) and index.same_marks(t, h, s + x, s + y):
                        found.append((n, s + x, s + y))
                        again.append((base, wide, places))
            # overlapping finds of one template are one occurrence: the best, then the first
            for n, b, e in sorted(found, key=lambda x: (-x[0], x[2] - x[1], x[1])):
                if not used[b:e].any():
                    used[b:e] = True
                    taken.append((n, b, e))
            slices = list({x[0]: x for x in again}.values())
        for n, b, e in sorted(taken, key=lambda x: x[1]):
            yield t, n, b, e


def scan(docs: DataFrame, templates=TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, coverage, matched_words, start, end (code points), passage of every occurrence."""
    templates = tuple(templates)

    def run(batches):
        index = Index(templates)
        for b in batches:
            for first, texts in packs(b.column(1).to_pylist()):
                h, start, end, off = tokens(texts)
                # texts without any gram of the index need no look at their words
                hit = np.zeros(len(h) + 1, np.int64)
                prefix = Prefix(h >> np.uint64(1))
                for g in index.grams:
                    if len(h) >= g:
                        n = len(h) - g + 1
                        hit[1:n + 1] += index.table.find(prefix.slices(np.arange(n), np.arange(g, g + n))) >= 0
                total = np.cumsum(hit)
                out = []
                for i in np.flatnonzero(total[off[1:]] > total[off[:-1]]):
                    a, z = off[i], off[i + 1]
                    for t, n, x, y in occurrences(index, h[a:z], coverage=coverage):
                        s, e = int(start[a + x]), int(end[a + y - 1])
                        out.append((i, index.names[t], n / len(index.words[t]), n, s, e, texts[i][s:e]))
                if out:
                    rows, *rest = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(np.array(rows) + first)), pa.array(rest[0]),
                         pa.array(rest[1], pa.float64()), pa.array(rest[2], pa.int32()), pa.array(rest[3], pa.int64()),
                         pa.array(rest[4], pa.int64()), pa.array(rest[5])],
                        ["doc_id", "license", "coverage", "matched_words", "start", "end", "passage"])

    d = id_and_text(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, license string, coverage double, "
                             "matched_words int, start long, end long, passage string")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
