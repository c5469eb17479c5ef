"""License scans by patience alignment of texts with license notices."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.storage import texts
from scrubline.llm.textscan import SIGNS, words

_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GRANT_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software. "
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU_HEADER = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as "
    "published by the Free Software Foundation{mark2} either version {version} of the License, or (at your option) any "
    "later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)


def _gnu(name: str, version: str, what: str = "program") -> str:
    return _GNU_HEADER.format(what=what, mark=":", mark2=",", name=name, version=version)


#: Notices looked for unless others are given; fixed wordings of public licenses: whole short
#: licenses, the headers that long ones are cited by, and one-line references.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": _GRANT_MIT + _WARRANTY_MIT,
    "BSD-2-Clause-text": _BSD_CONDITIONS + _WARRANTY_BSD,
    "BSD-3-Clause-text": _BSD_CONDITIONS + _BSD_NAME + _WARRANTY_BSD,
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-header": _gnu("General Public License", "2"),
    "GPL-3.0-header": _gnu("General Public License", "3"),
    "LGPL-2.1-header": _gnu("Lesser General Public License", "2.1", "library"),
    "LGPL-3.0-header": _gnu("Lesser General Public License", "3"),
    "AGPL-3.0-header": _gnu("Affero General Public License", "3"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
}
#: Least share of a notice's words that must be aligned.
COVERAGE = 0.8
#: Words that an occurrence may take up, for each word of its notice; tried in turn.
STRETCH = (1.1, 1.5, 2.0)
FOUND = "doc_id long, n_words long, found array<struct<license: string, first: int, last: int, coverage: double>>"


def _increasing(places: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(places)
    for k, p in enumerate(places):
        at = bisect_left(tails, p)
        back[k] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(p)
            ends.append(k)
        else:
            tails[at], ends[at] = p, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def align(text: list, notice: list) -> list[tuple[int, int]]:
    """Pairs of places of aligned words, increasing on both sides.

    Equal heads and tails are paired.  In between, words that occur once on either side are
    anchors; their longest increasing subsequence is kept, and the gaps are aligned likewise.
    A gap without anchors gives nothing more.
    """
    pairs, open_ = [], [(0, len(text), 0, len(notice))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and text[a] == notice[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == notice[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        here, there = _once(text, a, b), _once(notice, c, d)
        shared = sorted((place, there[word]) for word, place in here.items() if word in there)
        kept = [shared[k] for k in _increasing([t for _, t in shared])]
        if not kept:
            continue
        pairs += kept
        for (x, y), (z, w) in zip([(a - 1, c - 1), *kept], [*kept, (b, d)]):
            if z - x > 1 and w - y > 1:
                open_.append((x + 1, z, y + 1, w))
    return sorted(pairs)


def _once(values: list, low: int, high: int) -> dict:
    """Place of every value that occurs exactly once."""
    places: dict = {}
    for k in range(low, high):
        places[values[k]] = None if values[k] in places else k
    return {v: k for v, k in places.items() if k is not None}


def _best_window(held: np.ndarray, low: int, high: int, size: int, least: float, dull: np.ndarray) -> int:
    """Where, in a part of a text, most words of a notice lie in ``size`` words; -1 if too few anywhere."""
    starts = np.arange(low, high)
    count = held[np.minimum(starts + size, high)] - held[starts]
    count[dull[low:high]] = -1
    best = int(count.argmax()) if len(count) else -1
    return low + best if best >= 0 and count[best] >= least else -1


def occurrences(text: np.ndarray, mine: np.ndarray, notice: list, least: float) -> list[tuple[int, int, int]]:
    """First and last word of each occurrence of a notice in a text, and its aligned words.

    ``mine`` marks the words of the text that the notice holds.  The part of the text with most of
    them in a window is aligned first, narrow windows before wide ones, and what lies on either
    side of an occurrence is then looked at alike.  A window whose alignment covers too little is passed by.
    """
    held = np.concatenate([[0], np.cumsum(mine)])
    need = least * len(notice)
    out, open_ = [], [(0, len(text))]
    while open_:
        low, high = open_.pop()
        if held[high] - held[low] < need:
            continue
        found = None
        for stretch in STRETCH:
            size = max(int(np.ceil(stretch * len(notice))), len(notice) + 1)
            dull = np.zeros(len(text), bool)
            while found is None and (at := _best_window(held, low, high, size, need, dull)) >= 0:
                pairs = align(text[at : min(at + size, high)].tolist(), notice)
                if len(pairs) >= need:
                    # The window may have begun early or late: look again around what is aligned.
                    before, after = pairs[0][1], len(notice) - pairs[-1][1]
                    begin = max(low, at + pairs[0][0] - int(stretch * before))
                    end = min(high, at + pairs[-1][0] + int(stretch * after) + 1)
                    again = align(text[begin:end].tolist(), notice)
                    if len(again) > len(pairs):
                        at, pairs = begin, again
                    found = (at + pairs[0][0], at + pairs[-1][0], len(pairs))
                near = max(1, size // 8)
                dull[max(0, at - near) : at + near + 1] = True
            if found:
                break
        if found:
            out.append(found)
            open_ += [(low, found[0]), (found[1] + 1, high)]
    return sorted(out)


def _told_apart(found: list[tuple[str, int, int, int, float]]) -> list[dict]:
    """Of occurrences that overlap by half of the shorter one, the one with most words aligned: of
    variants of a license the one that the text covers most."""
    kept: list[tuple[str, int, int, int, float]] = []
    for one in sorted(found, key=lambda f: (-f[3], -f[4], f[0], f[1])):
        _, first, last, _, _ = one
        if all(2 * (min(last, k[2]) - max(first, k[1]) + 1) < min(last - first, k[2] - k[1]) + 1 for k in kept):
            kept.append(one)
    kept.sort(key=lambda f: (f[1], f[0]))
    return [{"license": n, "first": a, "last": b, "coverage": c} for n, a, b, _, c in kept]


def _known(notices: dict[str, str]) -> dict[str, np.ndarray]:
    """Word hashes of the notices that have words."""
    out = {}
    names = list(notices)
    for row, _, hashes, counts in words(pa.array(list(notices.values()), pa.string()), SIGNS):
        ends = np.cumsum(counts)
        out |= {names[row + k]: hashes[ends[k] - n : ends[k]] for k, n in enumerate(counts) if n}
    return out


def _scan(notices: dict[str, str], least: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(notices)
        vocabulary = np.unique(np.concatenate([*known.values(), np.zeros(1, np.uint64)]))
        member = {name: np.isin(vocabulary, notice) for name, notice in known.items()}
        plain = {name: notice.tolist() for name, notice in known.items()}
        for batch in batches:
            for row, after, hashes, counts in words(batch.column(1), SIGNS):
                ends = np.cumsum(counts)
                place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                at = np.flatnonzero(vocabulary[place] == hashes)
                owner = np.searchsorted(ends, at, side="right")
                found: list[list[tuple]] = [[] for _ in counts]
                for name, notice in plain.items():
                    hits = at[own := member[name][place[at]]]
                    need = int(np.ceil(least * len(notice)))
                    if len(hits) < need:
                        continue
                    # Words that the notice needs at least, in no more words than it may take up.
                    reach = hits[need - 1 :] - hits[: len(hits) - need + 1] < max(STRETCH) * len(notice) + 1
                    same = owner[own][need - 1 :] == owner[own][: len(hits) - need + 1]
                    for text in np.unique(owner[own][: len(hits) - need + 1][reach & same]):
                        first, last = ends[text] - counts[text], ends[text]
                        mine = np.zeros(last - first, bool)
                        mine[hits[(hits >= first) & (hits < last)] - first] = True
                        for low, high, n in occurrences(hashes[first:last], mine, notice, least):
                            found[text].append((name, int(low), int(high), n, n / len(notice)))
                spans = [_told_apart(f) for f in found]
                kind = pa.struct([("license", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("coverage", pa.float64())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, after - row), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(kind))],
                    ["doc_id", "n_words", "found"],
                )

    return scan


def license_scan(docs: DataFrame, notices: dict[str, str] | None = None, least: float = COVERAGE) -> DataFrame:
    """``doc_id, n_words, found, n_found, licenses, coverage`` for every row.

    ``found`` lists each occurrence of a notice with its first and last word in the text and
    the share of its words aligned; ``licenses`` are the distinct names in order, joined by
    commas; ``coverage`` is the best share, 0 where nothing was found.  Words are runs of
    letters and digits after lower-casing A-Z.  A part of a text is aligned if it holds as many of
    a notice's words as must be aligned within twice the notice's length, so changed, inserted
    and repeated words don't hide a notice; every such part of the whole text is, however
    long the text.  Where notices overlap, as variants of a license do, the one with most
    words aligned counts, then the better covered, then the first by name.  NULL, empty and
    wordless texts hold nothing; repeated rows are scanned each; an empty table gives no rows;
    other columns are ignored.
    """
    found = texts(docs).mapInArrow(_scan(notices or NOTICES, least), FOUND)
    return found.select(
        "*",
        F.size("found").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("found.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("found.coverage"), F.lit(0.0)).alias("coverage"),
    )
