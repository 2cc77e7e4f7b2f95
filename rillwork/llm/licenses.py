"""License notices by conditional compression.

Candidates are windows of a template's length, with room for added words, around
words of licensing, wherever they stand in a text: every place where enough of the
template's words occur.  The words of each window are compressed with Zstandard
alone and with the template as a raw-content dictionary.  Windows that the
dictionary shrinks too little are dropped, and the others are ranked by the bytes
it saves.  Down the ranking, a window is confirmed by its exact wording: most of
the template's words in their order, all its numbers and the words that name the
license, and few others in between.  What is left on both sides of a confirmed
notice is searched again.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillwork.llm.common import add_columns

# Short statements and the usual notices of public licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce "
        "the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. Neither the name of the copyright holder nor the "
        "names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission.",
    ),
    ("proprietary", "All rights reserved."),
)
GATE = re.compile(r"licen[sc]|copyright|warrant|permission|redistribut|rights\s+reserved", re.I)
TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: Words of a stretch at least.
BLOCK_WORDS = 400
#: Share of a window's compressed bytes that its template must take off.
LEAST_REDUCTION = 0.15
#: Share of a template's words that must be found, and share that may be added in between.
LEAST_FOUND = 0.8
MOST_ADDED = 0.25
LEVEL = 3
#: Stands for an alignment that is not allowed.
NEVER = -(1 << 20)


def terms(text: str) -> list[tuple[str, int, int]]:
    """Words and numbers in lower case with their places."""
    return [(m[0], m.start(), m.end()) for m in TERM.finditer(text.lower())] if len(text.lower()) == len(text) else [
        (m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9]+(?:\.[0-9]+)*", text)
    ]


class Templates:
    """The templates' words, and a compressor for each."""

    def __init__(self, templates):
        self.named = [(name, [t for t, _, _ in terms(text)]) for name, text in templates]
        #: Whether each template can be found by words of licensing alone.
        self.gated = all(GATE.search(text) for _, text in templates)
        #: Words that must be found: numbers, and those that name the license.
        self.needed = [
            {w for w in ws if w[0].isdigit() or w in {t for t, _, _ in terms(name)}} for name, ws in self.named
        ]
        self.code = {w: i for i, w in enumerate(sorted({w for _, ws in self.named for w in ws}))}
        self.coded = [np.array([self.code[w] for w in ws], dtype=np.int32) for _, ws in self.named]
        self.counts = np.array([np.bincount(c, minlength=len(self.code)) for c in self.coded])
        self.least = np.array([LEAST_FOUND * len(c) for c in self.coded])
        #: Words of the longest notice that can be confirmed; stretches overlap by as many.
        self.longest = ceil(max((len(ws) for _, ws in self.named), default=0) * (1 + MOST_ADDED))
        options = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
        )
        self.plain = zstandard.ZstdCompressor(compression_params=options)
        self.given = [
            zstandard.ZstdCompressor(
                compression_params=options,
                dict_data=zstandard.ZstdCompressionDict(" ".join(ws).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for _, ws in self.named
        ]

    def saved(self, words: list[str], template: int) -> tuple[int, float]:
        """Bytes and share that a template takes off the compressed words."""
        data = " ".join(words).encode()
        alone = len(self.plain.compress(data))
        less = alone - len(self.given[template].compress(data))
        return less, less / alone

    def possible(self, coded: np.ndarray) -> list[int]:
        """Templates of whose words enough occur, in whatever order."""
        there = np.bincount(coded[coded >= 0], minlength=len(self.code))
        return np.flatnonzero(np.minimum(self.counts, there).sum(axis=1) >= self.least - 1e-9).tolist()

    def difference(self, words: list[str], coded: np.ndarray, template: int):
        """(first, end, differences) of the words that stand for the template, or None.

        Of the alignments with any stretch of the words the one with most words found
        less words added wins; numbers and the words that name the license must be found.
        """
        wanted, ids, needed = self.named[template][1], self.coded[template], self.needed[template]
        n = len(ids)
        place = np.arange(len(words) + 1, dtype=np.int32)
        score = np.zeros((n + 1, len(words) + 1), dtype=np.int32)
        for i in range(n):
            row = np.full(len(words) + 1, NEVER, dtype=np.int32) if wanted[i] in needed else score[i].copy()
            found = np.flatnonzero(coded == ids[i])
            row[found + 1] = np.maximum(row[found + 1], score[i][found] + 1)
            score[i + 1] = np.maximum.accumulate(row + place) - place
        ends = np.flatnonzero(score[n] >= (LEAST_FOUND - MOST_ADDED) * n - 1e-9)
        for end in ends[np.argsort(-score[n][ends], kind="stable")].tolist():
            i, j, missing, added = n, end, [], []
            while i:
                if j and coded[j - 1] == ids[i - 1] and score[i, j] == score[i - 1, j - 1] + 1:
                    i, j = i - 1, j - 1
                elif wanted[i - 1] not in needed and score[i, j] == score[i - 1, j]:
                    i -= 1
                    missing.append(wanted[i])
                else:
                    j -= 1
                    added.append(words[j])
            if n - len(missing) >= LEAST_FOUND * n - 1e-9 and len(added) <= MOST_ADDED * n:
                return j, end, [f"-{w}" for w in missing[::-1]] + [f"+{w}" for w in added[::-1]]
        return None

    def windows(self, coded: np.ndarray, template: int) -> Iterator[tuple[int, int]]:
        """Where enough of a template's words occur in its length with room for added words, in whatever order.

        Of neighbouring places the first one with most words is given.
        """
        ids, wanted = self.coded[template], self.counts[template]
        width = min(len(coded), len(ids) + int(MOST_ADDED * len(ids)))
        least = ceil(self.least[template] - 1e-9)
        there = np.zeros(len(self.code), dtype=np.int64)
        inside, run = 0, None
        for at, word in enumerate(coded.tolist()):
            if word >= 0:
                inside += there[word] < wanted[word]
                there[word] += 1
            if at >= width and (gone := coded[at - width]) >= 0:
                there[gone] -= 1
                inside -= there[gone] < wanted[gone]
            if at >= width - 1:
                first = at - width + 1
                if inside >= least:
                    if run is None or inside > run[0]:
                        run = inside, first
                    continue
                if run is not None:
                    yield run[1], run[1] + width
                    run = None
        if run is not None:
            yield run[1], run[1] + width

    def stretches(self, text: str, block: list) -> list[tuple[int, int]]:
        """The parts of a text's words that may hold a notice: those near a word of licensing."""
        if not self.gated:
            return [(0, len(block))] if block else []
        starts = [a for _, a, _ in block]
        out: list[tuple[int, int]] = []
        for m in GATE.finditer(text):
            at = bisect_right(starts, m.start())
            first, end = max(0, at - 1 - self.longest), min(len(block), at + self.longest)
            if out and first <= out[-1][1]:
                out[-1] = out[-1][0], max(end, out[-1][1])
            else:
                out.append((first, end))
        return out

    def find(self, text: str):
        """(start, end, license, reduction, differences) of every confirmed notice."""
        out: list = []
        if self.gated and not GATE.search(text):
            return out
        block = terms(text)
        size = max(BLOCK_WORDS, 2 * self.longest)
        for first, end in self.stretches(text, block):
            while first < end:
                last = first + size >= end
                # What begins in the overlap is left to the next stretch, which holds it whole.
                border = end if last else first + size - self.longest
                hits = [h for h in self.notices(block, first, min(first + size, end)) if h[0] < border]
                out += [(block[a][1], block[b - 1][2], *rest) for a, b, *rest in hits]
                first = max([border, *[b for _, b, *_ in hits]])
        return sorted(out, key=lambda x: x[:3])

    def ranked(self, words: list[str], coded: np.ndarray) -> list[tuple]:
        """(bytes saved, share saved, template, first, end) of the windows that their template shrinks, best first."""
        out = []
        for i in self.possible(coded):
            for a, b in self.windows(coded, i):
                less, share = self.saved(words[a:b], i)
                if share >= LEAST_REDUCTION:
                    out.append((less, share, i, a, b))
        return sorted(out, key=lambda c: (-c[0], -c[1], c[3], c[2]))

    def notices(self, block: list, first: int, end: int) -> list:
        """(first, end, license, reduction, differences) of the notices in a stretch of a block, in words."""
        out = []
        rest = [(first, end)]
        # A stretch may hold several notices: what is left on both sides is searched again.
        while rest:
            first, end = rest.pop()
            if end - first < 2:
                continue
            plain = [w for w, _, _ in block[first:end]]
            coded = np.array([self.code.get(w, -1) for w in plain], dtype=np.int32)
            for _, share, i, a, b in self.ranked(plain, coded):
                # The notice may reach over the window's edges where words are missing.
                slack = len(self.named[i][1])
                a, b = max(0, a - slack), min(len(plain), b + slack)
                if hit := self.difference(plain[a:b], coded[a:b], i):
                    begin, stop, changes = first + a + hit[0], first + a + hit[1], hit[2]
                    out.append((begin, stop, self.named[i][0], share, changes))
                    rest += [(first, begin), (stop, end)]
                    break
        return out


@lru_cache(maxsize=2)
def prepared(templates) -> Templates:
    return Templates(templates)


FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("license", T.StringType()),
            T.StructField("reduction", T.DoubleType()),
            T.StructField("differences", T.ArrayType(T.StringType())),
        ]
    )
)


def scan(df: DataFrame, text: str = "text", templates=TEMPLATES, keep_text: bool = True) -> DataFrame:
    """Add ``notices``: (start, end, license, reduction, differences) per confirmed notice.

    Places are code points, end exclusive.  Whole texts are searched, long parts
    with words of licensing in stretches that overlap by the longest notice; if a
    template has no such word, whole texts are.  Null and empty texts have no
    notice, repeated rows are searched like others, an empty table stays empty, and
    an input column ``notices`` is replaced.
    """
    keys = ("start", "end", "license", "reduction", "differences")

    def make():
        known = prepared(templates)
        return lambda value: ([dict(zip(keys, n)) for n in known.find((value or b"").decode())],)

    return add_columns(df, [text], [("notices", FOUND)], make, [] if keep_text else [text])


def report(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: its id, its licenses and all confirmed notices.

    Null and empty texts have none; repeated rows get a row each; an empty table
    gives no rows; other columns are ignored.
    """
    found = scan(df.select(F.col(id), F.col(text)), text, keep_text=False)
    return found.select(
        id,
        F.size("notices").cast("bigint").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.col("notices.license"))), ",").alias("licenses"),
        F.array_join(
            F.transform("notices", lambda n: F.concat_ws(":", n["license"], n["start"].cast("string"), n["end"].cast("string"), F.size(n["differences"]).cast("string"))),
            ",",
        ).alias("spans"),
    )
