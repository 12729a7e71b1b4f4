"""License notices in documents, found by MinHash over overlapping windows.

Templates are grouped by length. For a group whose shortest template has c shingles (runs of five
words), every document is read through windows of c shingles, one starting every ``c // 8`` (at
least one) shingles. Each window and each template has ``BANDS`` minima under independent hashes;
a window retrieves the templates that share a band, one minimum, with it.

Guarantee: where a document repeats a template, the nearest window shares at least
3/4 c - c/16 of its shingles with it, as groups span lengths up to a factor of 4/3 and at most a
fifth of the shingles may be missing. So their likeness is at least 0.3, and a copy of the whole
template has at least 0.6. A band is then shared with a probability of 1 - 0.7**32 = 0.99999 at
least. What is retrieved is verified on exact shingles of the text around the window. Only texts
that hold enough shingles of a group for one of its templates are read so; no other can hold one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.llm.ragged import (
    M1,
    M3,
    Words,
    flat,
    lowered,
    mix,
    slices,
    span_hashes,
    strings,
    times,
    word_bounds,
)

BANDS, SHINGLE, SHARE = 32, 5, 0.8
SIEVE = 1 << 20
CHUNK = 1 << 20
MARKS = np.ones(256, bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: More templates than this are sent to the workers in several passes.
PER_PASS = 10_000

#: Notices by the name of the license (fixed values).
NOTICES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    ("All-rights-reserved", "All rights reserved."),
)


def gnu(kind: str, work: str, version: str, mark: str, stop: str) -> str:
    return (
        f"This {work} is free software{mark} you can redistribute it and/or modify it under the terms "
        f"of the GNU {kind} Public License as published by the Free Software Foundation{stop} either "
        f"version {version} of the License, or (at your option) any later version."
    )


CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer. 2. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission. "
)
DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Further notices and the texts of short licenses (fixed values).
MORE_NOTICES: tuple[tuple[str, str], ...] = (
    ("GPL-2.0-or-later", gnu("General", "program", "2", ";", ";")),
    (
        "GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License version 2 as published by the Free Software Foundation.",
    ),
    ("LGPL-2.0-or-later", gnu("Library General", "library", "2", ";", ";")),
    ("LGPL-2.1-or-later", gnu("Lesser General", "library", "2.1", ";", ";")),
    ("LGPL-3.0-or-later", gnu("Lesser General", "program", "3", ":", ",")),
    ("AGPL-3.0-or-later", gnu("Affero General", "program", "3", ":", ",")),
    (
        "AGPL-3.0",
        "Notwithstanding any other provision of this License, if you modify the Program, your "
        "modified version must prominently offer all users interacting with it remotely through a "
        "computer network (if your version supports such interaction) an opportunity to receive the "
        "Corresponding Source of your version by providing access to the Corresponding Source from a "
        "network server at no charge, through some standard or customary means of facilitating "
        "copying of software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", CONDITIONS + DISCLAIMER),
    ("BSD-3-Clause", CONDITIONS + ENDORSEMENT + DISCLAIMER),
    (
        "MIT",
        f"{NOTICES[4][1]} The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
)


def templates() -> list[tuple[str, str]]:
    """All notices, and the full license texts that lie beside this module."""
    folder = Path(__file__).with_name("license_texts")
    full = [(f.stem, f.read_text("utf-8", "replace")) for f in sorted(folder.glob("*.txt"))]
    return [*NOTICES, *MORE_NOTICES, *full]


class Plain(Words):
    """Words as runs of letters and digits, so quotes, stops and comment marks do not count."""

    def __init__(self, texts: pa.LargeStringArray) -> None:
        data, self.at = flat(texts)
        self.padded = lowered(data)
        two = (self.padded[:-1] == 0xC2) & (self.padded[1:] >= 0x80)
        three = (self.padded[:-1] == 0xE2) & (self.padded[1:] == 0x80)  # quotes, dashes, bullets
        for found, n in ((two, 2), (three, 3)):
            for i in range(n):
                self.padded[np.flatnonzero(found) + i] = 32
        self.starts, self.ends = word_bounds(self.padded, self.at, MARKS)
        self.hashes = span_hashes(self.padded, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.at)
        self.counts = np.diff(self.first)
        self.texts = np.repeat(np.arange(len(self.counts)), self.counts)


def minima(h: np.ndarray, width: int, starts: np.ndarray) -> np.ndarray:
    """The least of ``width`` hashes from each start on, by doubling."""
    least, span = h, 1
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    return np.minimum(least[starts], least[starts + width - span])


class Group:
    """Templates of like length."""

    def __init__(self, k: int, members: list[tuple[int, np.ndarray]]) -> None:
        self.k = k
        self.width = min(len(s) for _, s in members)
        self.longest = max(len(s) for _, s in members)
        self.step = max(1, self.width // 8)
        self.members = [(t, np.unique(s)) for t, s in members]
        self.least = min(len(s) for _, s in self.members)
        self.known = np.unique(np.concatenate([s for _, s in self.members]))
        self.bands = []
        for band in range(BANDS):
            least = np.array([banded(s, band).min() for _, s in self.members])
            order = np.argsort(least, kind="stable")
            self.bands.append((least[order], order))

    def retrieve(self, h: np.ndarray, starts: np.ndarray) -> set[tuple[int, int]]:
        """(window start, member) of windows and templates that share a band."""
        found: set[tuple[int, int]] = set()
        for band, (least, order) in enumerate(self.bands):
            own = minima(banded(h, band), self.width, starts)
            low = np.searchsorted(least, own)
            for i in np.flatnonzero(least[np.minimum(low, len(least) - 1)] == own).tolist():
                for j in range(int(low[i]), int(np.searchsorted(least, own[i], "right"))):
                    found.add((int(starts[i]), int(order[j])))
        return found


def banded(h: np.ndarray, band: int) -> np.ndarray:
    return mix(h ^ times(band + 1, M3))


def runs_of_words(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words, and whether it lies in one text."""
    n = max(len(words.hashes) - k + 1, 0)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = mix(h * M1 + words.hashes[i : i + n])
    return h, words.texts[:n] == words.texts[k - 1 : k - 1 + n]


def among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are in the sorted, not empty, ``known``."""
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def groups_of(notices: Sequence[tuple[str, str]], kind: type[Words] = Words) -> list[Group]:
    """Templates grouped by shingle size (five, or all words of a shorter one) and length."""
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    for t, (_, text) in enumerate(notices):
        words = kind(pa.array([text], pa.large_string()))
        k = min(SHINGLE, len(words.hashes))
        if k:
            by_size.setdefault(k, []).append((t, runs_of_words(words, k)[0]))
    out = []
    for k, members in by_size.items():
        members.sort(key=lambda m: len(m[1]))
        while members:
            limit = max(len(members[0][1]) * 4 // 3, len(members[0][1]))
            out.append(Group(k, [m for m in members if len(m[1]) <= limit]))
            members = [m for m in members if len(m[1]) > limit]
    return out


class Hit(NamedTuple):
    text: int
    template: int
    start: int
    end: int
    share: float
    matched: int
    words: np.ndarray


def scan(texts: pa.LargeStringArray, groups: list[Group], share: float) -> list[tuple]:
    """(text, template, first byte, end byte, share) of each notice found."""
    return [tuple(hit[:5]) for hit in hits(Words(texts), groups, share)]


def tightest(at: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The shortest run of places that holds every kind: one copy, without its neighbours."""
    left, seen, missing = 0, dict.fromkeys(kind.tolist(), 0), len(np.unique(kind))
    kinds, places = kind.tolist(), at.tolist()
    best = (places[-1] - places[0] + 1, 0, len(places))
    for right, x in enumerate(kinds):
        missing -= seen[x] == 0
        seen[x] += 1
        while seen[kinds[left]] > 1:
            seen[kinds[left]] -= 1
            left += 1
        if not missing:
            best = min(best, (places[right] - places[left], left, right + 1))
    return at[best[1] : best[2]]


def hits(words: Words, groups: list[Group], share: float) -> list[Hit]:
    """Each notice found, with the number of its shingles and the words of its text that hold them."""
    best: dict[tuple[int, int], list[tuple[float, int, int, int, np.ndarray]]] = {}
    hashed = {k: runs_of_words(words, k) for k in {g.k for g in groups}}
    for group in groups:
        h, inside = hashed[group.k]
        last = np.maximum(words.counts - group.k + 1, 0)  # shingles of each text
        fits = np.where(last > 0, np.maximum(-(-(last - group.width) // group.step), 0) + 1, 0)
        # a text with fewer shingles of these templates holds too little of any
        met = words.texts[: len(h)][inside & among(h, group.known)]
        able = np.bincount(met, minlength=len(fits)) >= share * group.least - 1e-9
        fits = np.where(able, fits, 0)
        if not fits.any():
            continue
        begin = words.first[:-1]
        nth = np.arange(int(fits.sum())) - np.repeat(np.cumsum(fits) - fits, fits)
        starts = np.repeat(begin, fits) + nth * group.step
        stop = np.repeat(begin + last, fits)
        # the last window of a text ends with it; a text too short for one is read as far as it goes
        starts = np.maximum(np.minimum(starts, stop - group.width), np.repeat(begin, fits))
        short = starts + group.width > stop
        some = [starts[~short]]
        found = group.retrieve(h, some[0]) if len(some[0]) else set()
        for s in starts[short].tolist():  # such a text may still hold most of a template
            found |= {(s, m) for m in range(len(group.members))}
        for start, m in found:
            t, want = group.members[m]
            text = int(words.texts[start])
            low = max(start - group.longest // 2, int(words.first[text]))
            high = min(start + group.width + group.longest // 2, int(words.first[text] + last[text]))
            own = h[low:high]
            place = np.minimum(np.searchsorted(want, own), len(want) - 1)
            hit = np.flatnonzero((want[place] == own) & inside[low:high])
            matched = len(np.unique(place[hit]))
            held = matched / len(want)
            if held >= share - 1e-9:
                hit = tightest(hit, place[hit])
                first = int(words.starts[low + hit[0]] - words.at[text])
                end = int(words.ends[low + hit[-1] + group.k - 1] - words.at[text])
                own_words = np.unique((low + hit)[:, None] + np.arange(group.k)) - words.first[text]
                best.setdefault((text, t), []).append((held, first, end, matched, own_words))
    out = []
    for (text, t), spans in best.items():
        spans.sort(key=lambda s: (-s[3], s[2] - s[1], s[1]))
        kept: list[tuple[float, int, int, int, np.ndarray]] = []
        taken: list[tuple[int, int]] = []
        for s in spans:  # of windows around one notice the best and shortest span stays
            i = bisect_left(taken, (s[1], s[2]))
            if (i == 0 or taken[i - 1][1] <= s[1]) and (i == len(taken) or s[2] <= taken[i][0]):
                taken.insert(i, (s[1], s[2]))
                kept.append(s)
        out += [Hit(text, t, first, end, held, n, own) for held, first, end, n, own in kept]
    return sorted(out, key=lambda hit: hit[:5])


def explained(found: list[Hit]) -> list[Hit]:
    """Of hits on the same words, those of the template that holds most shingles there.

    A hit goes if at least half of its words are words of hits that stay. So a license whose text
    resembles or holds another one's is not reported as both, and neighbours both stay.
    """
    kept: list[Hit] = []
    taken = {t: np.zeros(max(x.words[-1] for x in own) + 1, bool) for t, own in by_text(found).items()}
    for hit in sorted(found, key=lambda x: (-x.matched, -x.share, x.template, x.start)):
        if 2 * taken[hit.text][hit.words].sum() < len(hit.words):
            taken[hit.text][hit.words] = True
            kept.append(hit)
    return sorted(kept, key=lambda x: (x.text, x.template, x.start))


def by_text(found: list[Hit]) -> dict[int, list[Hit]]:
    out: dict[int, list[Hit]] = {}
    for hit in found:
        out.setdefault(hit.text, []).append(hit)
    return out


def promising(words: Words, groups: list[Group]) -> np.ndarray:
    """Numbers of the texts that hold a shingle of some template."""
    some = np.zeros(len(words.counts), bool)
    for k in {g.k for g in groups}:
        h, inside = runs_of_words(words, k)
        known = np.unique(np.concatenate([g.known for g in groups if g.k == k]))
        low = np.uint64(SIEVE - 1)
        sieve = np.zeros(SIEVE, bool)
        sieve[(known & low).astype(np.int64)] = True
        at = np.flatnonzero(sieve[(h & low).astype(np.int64)] & inside)
        some[words.texts[at[among(h[at], known)]]] = True
    return np.flatnonzero(some)


FOUND = "array<struct<license: string, start: bigint, end: bigint, share: double>>"


def license_notices(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] | None = None,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: (doc_id, notices), the spans of bytes that hold at least ``share`` of a template.

    Without ``notices`` all of ``templates()`` are looked for. Letters A-Z count as a-z, marks between
    letters and digits as space. Of templates on the same words the one that holds most counts
    (``explained``). Templates without words are found nowhere. Null and empty texts hold
    none. Rows and ids may repeat, ids may be null.
    """
    groups: list[Group] = []
    notices = templates() if notices is None else notices
    names = [name for name, _ in notices]
    shared = docs.sparkSession.sparkContext.broadcast
    passes = []
    for start in range(0, max(len(notices), 1), PER_PASS):
        groups = groups_of(notices[start : start + PER_PASS], Plain)
        passes.append((start, shared(groups)))
    kind = pa.list_(pa.struct([
        ("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, CHUNK):
            texts = strings(batch.column(1))
            rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            words, found = Plain(texts), []
            for first, groups in passes:
                near = promising(words, groups.value)
                if len(near):
                    some = hits(Plain(texts.take(pa.array(near))), groups.value, share)
                    found += [
                        hit._replace(text=int(near[hit.text]), template=first + hit.template)
                        for hit in some
                    ]
            for hit in explained(found):
                rows[hit.text].append({
                    "license": names[hit.template], "start": hit.start, "end": hit.end,
                    "share": hit.share,
                })
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, kind)], names=["doc_id", "notices"]
            )

    own = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return own.mapInArrow(run, f"doc_id long, notices {FOUND}")
