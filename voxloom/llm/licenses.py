"""License texts in documents: winnowed fingerprints pick candidates, banded alignment confirms them.

Templates and documents are reduced to words (letters and digits, lower case). Of all hashes of GRAM consecutive words, every
stretch of WINDOW such hashes keeps its least; these are the fingerprints, so a document that repeats
GRAM + WINDOW - 1 consecutive words of a template shares at least one with it. An inverted index leads from a
fingerprint to the places in templates that have it. Each shared fingerprint fixes a diagonal; templates
are aligned with the document in a band around it. Where words are put into a license, its parts lie on several diagonals: matched
runs that follow one another in both texts, at most GAP words apart in the document, are chained, and the chain gives the share of the
template that is matched, and where.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import carry
from .hashing import hash_pieces, lower_ascii, sequences, text_blocks, window_minimum

GRAM, WINDOW = 3, 3
BAND = 8
# Words that may stand between two parts of one license, e.g. a page footer or an added clause.
GAP = 250

# Published wordings of license statements and of the notices that licenses open with.
TEMPLATES = {
    "mit-statement": "Released under the MIT License.",
    "apache-2.0-statement": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-statement": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-statement": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
}

# Published wordings of whole licenses, without their headings and copyright lines.
WHOLE_TEXTS = {
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
        "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
}

_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end, row and hash of every word of a block."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    solid = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, hash_pieces(lower_ascii(data), starts, ends)


def winnow(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, number of its first word). A row of fewer hashes than a stretch keeps its least one."""
    hashes, at = sequences(words, rows, GRAM)
    if not len(hashes):
        return hashes, at
    row = rows[at]
    picked = np.zeros(len(hashes), bool)
    if len(hashes) >= WINDOW:
        least = window_minimum(hashes, WINDOW)
        picked[least[row[: len(least)] == row[WINDOW - 1 :]]] = True
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    sizes = np.diff(np.append(first, len(row)))
    for a, n in zip(first[sizes < WINDOW], sizes[sizes < WINDOW]):
        picked[a + int(np.argmin(hashes[a : a + n]))] = True
    return hashes[picked], at[picked]


Pairs = list[tuple[int, int]]
# Place in the template, place in the document, number of equal words.
Run = tuple[int, int, int]


def align_pairs(template: Sequence[int], words: Sequence[int], diagonal: int, band: int = BAND) -> Pairs:
    """(template place, document place) of the words matched by the best local alignment within ``band`` of a diagonal.

    A match counts 2, a word that is changed, missing or extra -1. The diagonal is the document's place of the template's
    first word.
    """
    none = (0, 0, None)
    before: dict[int, tuple] = {}
    best = none
    for i, word in enumerate(template):
        now: dict[int, tuple] = {}
        for j in range(max(0, i + diagonal - band), min(len(words), i + diagonal + band + 1)):
            score, hits, chain = before.get(j - 1, none)
            if word == words[j]:
                cell = (score + 2, hits + 1, (i, j, chain))
            else:
                cell = (score - 1, hits, chain)
            for score, hits, chain in (before.get(j, none), now.get(j - 1, none)):
                if score - 1 > cell[0]:
                    cell = (score - 1, hits, chain)
            if cell[0] > 0:
                now[j] = cell
                if cell[:2] > best[:2]:
                    best = cell
        before = now
    pairs, chain = [], best[2]
    while chain is not None:
        pairs.append(chain[:2])
        chain = chain[2]
    return pairs[::-1]


def align(template: Sequence[int], words: Sequence[int], diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first, last + 1) of the alignment of ``align_pairs``."""
    pairs = align_pairs(template, words, diagonal, band)
    return (len(pairs), pairs[0][1], pairs[-1][1] + 1) if pairs else (0, -1, -1)


def _runs(pairs: set[tuple[int, int]]) -> list[Run]:
    """Matched places as runs of consecutive words."""
    runs: list[Run] = []
    last = None
    for shift, i in sorted((j - i, i) for i, j in pairs):
        if last == (shift, i - 1):
            runs[-1] = (*runs[-1][:2], runs[-1][2] + 1)
        else:
            runs.append((i, i + shift, 1))
        last = shift, i
    return runs


def _best_chains(runs: list[Run], gap: int) -> list[tuple[int, int, int]]:
    """(matched words, first, last + 1) of the best chain that ends in each run; runs are sorted by their document end.

    A run adds its words beyond the end, in both texts, of the run before. Where it continues more than BAND words away in either text, both must be as
    long as a fingerprint; more than ``gap`` words away in the document it does not continue. Of equal chains the shortest is taken.
    """
    best: list[tuple[int, int, int]] = []
    ends = [j + n for _, j, n in runs]
    for q, (i, j, n) in enumerate(runs):
        top = (n, j, ends[q])
        for p in range(bisect_left(ends, j - gap), bisect_left(ends, ends[q])):
            i_end, j_end = runs[p][0] + runs[p][2], ends[p]
            cut = max(0, i_end - i, j_end - j)
            near = max(i + cut - i_end, j + cut - j_end) <= BAND
            if cut < n and j + cut - j_end <= gap and (near or min(n - cut, runs[p][2]) >= GRAM):
                hits, first, _ = best[p]
                if (hits + n - cut, first) > top[:2]:
                    top = (hits + n - cut, first, ends[q])
        best.append(top)
    return best


def chain(runs: list[Run], least: int, gap: int = GAP) -> list[tuple[int, int, int]]:
    """Chains of ``least`` matched words and more as (matched words, first, last + 1), no two of them overlapping.

    The chain with most matched words comes first, then the shorter, then the earlier. Runs that overlap a chain taken are
    put away, and the rest is chained anew until nothing is left to take.
    """
    found: list[tuple[int, int, int]] = []
    runs = sorted(runs, key=lambda r: (r[1] + r[2], r[0]))
    while True:
        good = [c for c in set(_best_chains(runs, gap)) if c[0] >= least]
        if not good:
            return sorted(found, key=lambda c: c[1])
        # Starts and ends of what is taken, both ascending, as nothing in it overlaps.
        firsts: list[int] = []
        ends: list[int] = []
        for hits, first, end in sorted(good, key=lambda c: (-c[0], c[2] - c[1], c[1])):
            at = bisect_right(ends, first)
            if at == len(firsts) or firsts[at] >= end:
                firsts.insert(at, first)
                ends.insert(at, end)
                found.append((hits, first, end))

        def free(run: Run) -> bool:
            at = bisect_right(ends, run[1])
            return at == len(firsts) or firsts[at] >= run[1] + run[2]

        runs = [r for r in runs if free(r)]


class _Library:
    """Templates as words, and the inverted index of their fingerprints."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = list(templates)
        self.words: list[list[int]] = []
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, text in enumerate(templates.values()):
            data = np.frombuffer(text.encode(), np.uint8)
            _, _, rows, words = _words(data, np.array([0, len(data)]))
            self.words.append(words.tolist())
            for mark, at in zip(*map(np.ndarray.tolist, winnow(words, rows))):
                self.places[mark].append((k, at))
        self.marks = np.array(sorted(self.places), np.uint64)

    def search(self, words: list[int], hits: list[tuple[int, int]], least: float) -> list[tuple[int, float, int, int]]:
        """(template, coverage, first word, last + 1) in one document; ``hits`` are its (fingerprint, word)."""
        shared: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for mark, at in hits:
            for k, place in self.places[mark]:
                shared[k].append((at - place, place))
        found = []
        for k, places in shared.items():
            template = self.words[k]
            pairs: set[tuple[int, int]] = set()
            reached = None
            for diagonal, place in sorted(places):
                # Diagonals inside the band of the last alignment are covered by it, but for parts that lost against a better one.
                if reached is None or diagonal - reached > BAND // 2:
                    reached = diagonal
                    pairs.update(align_pairs(template, words, diagonal))
                pairs.update((place + x, place + x + diagonal) for x in range(GRAM) if place + x < len(template))
            # The least whole number of words that reaches the share asked for.
            size = len(template)
            wanted = next(n for n in range(max(1, int(least * size)), size + 2) if n / size >= least)
            found += [(k, hit / size, a, b) for hit, a, b in chain(_runs(pairs), wanted)]
        return sorted(found, key=lambda f: (f[2], f[0]))


MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))


def find_licenses(
    df: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    least: float = 0.8,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    out: str = "licenses",
) -> DataFrame:
    """The columns ``keep`` of every row with its license matches as ``out``: name, coverage, start and end.

    Coverage is the share of the template's words that are matched in order, in parts at most GAP words apart; matches below ``least`` are left
    out. Positions are code points, the end exclusive. Matches of one template do not overlap. Null, empty and other texts without a
    match have an empty list. The index holds the templates alone and goes to every worker. A column of ``keep``
    named like ``out`` is replaced.
    """
    keep = [c for c in keep if c != out]
    templates = dict(templates)
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField(out, MATCHES)])
    texts, column = carry(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _Library(templates)
        for batch in batches:
            rows: list[list[dict]] = []
            for low, high, data, offsets in text_blocks(batch.column(column)):
                own: list[list[dict]] = [[] for _ in range(high - low)]
                starts, ends, row, words = _words(data, offsets)
                marks, at = winnow(words, row)
                known = np.flatnonzero(np.isin(marks, library.marks))
                hits = defaultdict(list)
                for mark, place in zip(marks[known].tolist(), at[known].tolist()):
                    hits[int(row[place])].append((mark, place))
                for k, found in hits.items():
                    a, b = np.searchsorted(row, [k, k + 1])
                    matches = library.search(words[a:b].tolist(), [(m, p - a) for m, p in found], least)
                    # Code points: bytes that do not continue a character.
                    heads = np.cumsum((data[offsets[k] : offsets[k + 1]] & 0xC0) != 0x80) if matches else None
                    for t, coverage, x, y in matches:
                        start, end = starts[a + x] - offsets[k], ends[a + y - 1] - offsets[k]
                        own[k].append({"license": library.names[t], "coverage": coverage, "start": int(heads[start]) - 1, "end": int(heads[end - 1])})
                rows += own
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(rows, _ARROW)], [*keep, out])

    return texts.mapInArrow(run, schema)
