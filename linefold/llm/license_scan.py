r"""License scanning: winnowed fingerprints, then banded alignment.

Templates and documents are sequences of lower-cased words (``\w+``).  Of the
hashes of all consecutive ``gram`` words of a template, winnowing keeps the
smallest of each ``window`` consecutive ones (the last among equals); of a
document all are looked up, so any common run of ``gram + window - 1`` words is a
common fingerprint.  Both are chosen for each template: if some of its words are
changed or left out, and ``LEAST_COVERAGE`` of them still match, then a run of so
many is certain to be left.  The fingerprints
of the templates form an inverted index; each (template, diagonal) of a
document's fingerprints in it is a candidate, so every place of a repeated
notice has its own.  The whole template is aligned word by word within ``BAND``
of the diagonal (match 1, mismatch and gap -1, words around it are free), all
candidates of a template at a time.  Alignments whose matched words cover
``LEAST_COVERAGE`` of the template are reported with the covered share and the
span in code points.

Of overlapping alignments the one with more matched words stays, then the one
with the higher coverage, the earlier one, and the smaller template name.  The
others are aligned again without the words that are taken, until no new match
comes up.  Null and empty texts have no match.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import map_texts

#: Words of a fingerprint at most, and the window that long templates have with it.
GRAM, WINNOW = 3, 2
BAND = 8
LEAST_COVERAGE = 0.8
#: Candidates that are aligned at a time.
BATCH = 512
WORD = re.compile(r"\w+")

_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)

#: Default templates: (license, text).  Public license texts and notices; callers pass their own list for more.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        _MIT_GRANT + "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    ("MIT", _MIT_GRANT),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("BSD-2-Clause", _BSD_2 + _WARRANTY),
    ("BSD-2-Clause", _BSD_2),
    (
        "BSD-3-Clause",
        _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. " + _WARRANTY,
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def unbroken(n: int) -> int:
    """Words that are sure to stand in a row if ``LEAST_COVERAGE`` of ``n`` words are left."""
    gone = n - math.ceil(LEAST_COVERAGE * n)
    return math.ceil((n - gone) / (gone + 1))


def grams(words: list[str], n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return _runs(h, n)


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    g = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(g)]
    return g ^ (g >> np.uint64(29))


def fingerprints(words: list[str], gram: int = GRAM, window: int = WINNOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs of ``gram`` words that winnowing keeps: of each ``window`` in a row the smallest, the last among equals."""
    g = grams(words, gram)
    if len(g) <= window:
        at = np.array([len(g) - 1 - int(np.argmin(g[::-1]))]) if len(g) else np.zeros(0, np.int64)
        return at, g[at]
    views = np.stack([g[k : len(g) - window + 1 + k] for k in range(window)])
    at = np.unique(np.arange(views.shape[1]) + window - 1 - views[::-1].argmin(0))
    return at, g[at]


class Index:
    """Inverted index from fingerprint to (template, position), for each number of words of a fingerprint."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        self.words = [_words(t) for _, t in templates]
        if any(len(w) > MOST_WORDS for w in self.words):
            raise ValueError(f"a template has more than {MOST_WORDS} words")
        posts: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, w in enumerate(self.words):
            if not w:
                continue
            run = unbroken(len(w))
            gram = min(GRAM, run)
            g = grams(w, gram)
            own = set(fingerprints(w, gram, run - gram + 1)[1].tolist())
            for p, x in enumerate(g.tolist()):
                if x in own:
                    posts.setdefault(gram, defaultdict(list))[x].append((k, p))
        self.posts = {n: (np.array(sorted(own), np.uint64), dict(own)) for n, own in posts.items()}
        vocabulary = sorted({w for words in self.words for w in words})
        self.number = {w: n for n, w in enumerate(vocabulary, 1)}  # 0: a word of no template, or taken
        self.numbers = [np.array([self.number[w] for w in words], np.int64) for words in self.words]

    def candidates(self, words: list[str]) -> list[tuple[int, int]]:
        """Each (template, diagonal) of the hits."""
        h, out = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), set()
        for n, (keys, posts) in self.posts.items():
            g = _runs(h, n)
            if not len(g):
                continue
            at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, g), len(keys) - 1)] == g)
            out.update((k, p - q) for p, x in zip(at.tolist(), g[at].tolist()) for k, q in posts[x])
        return sorted(out)


#: An alignment in one number, compared as a whole: its score, matched words, and the first and the last matched word in the window.
_SCORE, _MATCHED, _FIRST = 1 << 46, 1 << 30, 1 << 15
_FIELD, _MOST_MATCHED = _FIRST - 1, _SCORE // _MATCHED - 1
_OUT = -(1 << 61)
#: Words of a template at most: its places and those of the band fill a field.
MOST_WORDS = _FIELD - 2 * BAND


def align(template: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matched words, first, last + 1 position) of the best alignment of the whole template in each window.

    A window is a row of words that starts ``band`` before the diagonal, as
    wide as the template and twice the band; words are numbers.  Among equal
    scores and matches the alignment that ends nearest to the diagonal counts.
    """
    band = (windows.shape[1] - len(template)) // 2
    gaps = np.arange(2 * band + 1) * _SCORE
    best = np.zeros((len(windows), 2 * band + 1), np.int64)
    for i, w in enumerate(template.tolist()):
        at = np.arange(i, i + 2 * band + 1)
        same = windows[:, i : i + 2 * band + 1] == w
        fresh = (best >> 30) & _MOST_MATCHED == 0
        first = np.where(fresh, at, (best >> 15) & _FIELD)
        hit = (best >> 30 << 30) + _SCORE + _MATCHED + first * _FIRST + at + 1
        row = np.where(same, hit, best - _SCORE)
        row[:, :-1] = np.maximum(row[:, :-1], best[:, 1:] - _SCORE)  # a template word is left out
        best = np.maximum.accumulate(row + gaps, axis=1) - gaps  # words of the window are left out
    near = np.abs(np.arange(2 * band + 1) - band)
    score = best >> 30
    top = np.where(score == score.max(1, keepdims=True), -near, _OUT).argmax(1)
    got = np.take_along_axis(best, top[:, None], 1)[:, 0]
    return (got >> 30) & _MOST_MATCHED, (got >> 15) & _FIELD, got & _FIELD


def _free(starts: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether no interval of a sorted list overlaps [a, b)."""
    k = bisect_left(starts, (a, a))
    return (k == 0 or starts[k - 1][1] <= a) and (k == len(starts) or starts[k][0] >= b)


def find(index: Index, texts: list[str]) -> list[list[dict]]:
    """The matches of each text."""
    split = [_words(t) for t in texts]
    pending = [(i, k, d) for i, w in enumerate(split) for k, d in index.candidates(w)]
    known = {i: np.fromiter((index.number.get(w, 0) for w in split[i]), np.int64, len(split[i])) for i in {c[0] for c in pending}}
    taken: dict[int, list[tuple[int, int]]] = defaultdict(list)
    chosen: dict[int, list] = defaultdict(list)
    while pending:
        by_template: dict[int, list] = defaultdict(list)
        for c in pending:
            by_template[c[1]].append(c)
        hits = []
        for k, own in by_template.items():
            n = len(index.words[k])
            for at in range(0, len(own), BATCH):
                part = own[at : at + BATCH]
                windows = np.zeros((len(part), n + 2 * BAND), np.int64)
                for row, (i, _, d) in zip(windows, part):
                    lo, hi = max(0, d - BAND), min(len(split[i]), d + n + BAND)
                    row[lo - d + BAND : hi - d + BAND] = known[i][lo:hi]
                for c, m, a, b in zip(part, *(x.tolist() for x in align(index.numbers[k], windows))):
                    if m >= LEAST_COVERAGE * n:
                        hits.append((-m, -m / n, a + c[2] - BAND, index.names[k], k, b + c[2] - BAND, c))
        pending = []
        for m, share, a, _, k, b, c in sorted(hits):
            own = taken[c[0]]
            if _free(own, a, b):
                insort(own, (a, b))
                chosen[c[0]].append((a, b, k, -m, -share))
            else:
                pending.append(c)
        for i in {c[0] for c in pending}:  # without the words that are taken
            for a, b in taken[i]:
                known[i][a:b] = 0
    out: list[list[dict]] = [[] for _ in texts]
    for i, found in chosen.items():
        at = [m.span() for m in WORD.finditer(texts[i])]
        out[i] = [
            {"license": index.names[k], "template": k, "matched": m, "coverage": round(share, 4), "start": at[a][0], "end": at[b - 1][1]} for a, b, k, m, share in sorted(found)
        ]
    return out


_FIELDS = "license: string, template: int, matched: int, coverage: double, start: int, end: int"


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, keep: list[str] | None = None) -> DataFrame:
    """Append ``licenses``, the array of matches in each text; no shuffle."""
    index = docs.sparkSession.sparkContext.broadcast(Index(templates))  # as large as the template list

    def make():
        return lambda texts: [find(index.value, texts)]

    return map_texts(docs, f"licenses array<struct<{_FIELDS}>>", make, keep=keep)


def matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id") -> DataFrame:
    """One row per match."""
    return scan(docs, templates, keep=[id_col]).select(id_col, F.explode("licenses").alias("m")).select(id_col, "m.*")
