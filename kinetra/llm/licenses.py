"""License scans: winnowed template fingerprints pick candidates, banded alignment measures them.

Templates are cut into runs of words, of which winnowing keeps the least hash in every window; an inverted index
leads from a hash to the templates and places that have it.  A document looks up all its runs; hits near one diagonal
make a candidate, and an alignment inside a band around it gives the words matched and their span.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.llm.common import NO_ID, NOT_ALNUM, gram_hashes, text_bytes, word_hashes

# Notices of well-known licenses.
TEMPLATES = {
    "AGPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
    "LGPL-3.0-header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later
        version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "MIT": "Released under the MIT License",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
        in all copies or substantial portions of the Software.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
}


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the fingerprints: in each window of hashes the least, the last of equal ones."""
    if hashes.size <= window:
        return np.array([hashes.size - 1 - int(np.argmin(hashes[::-1]))]) if hashes.size else np.zeros(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views, axis=1))


def fingerprint_sizes(words: int, gram: int, window: int, least: float) -> tuple[int, int, int]:
    """Least number of matched words of a notice of a template, and the gram and window that find it.

    With so many words matched, e others are not.  After up to e + 1 words, but two at least, were replaced, left out or
    put in, the matched words have a run of need / (e + 2) or more.  Winnowing has a fingerprint in every run of
    gram + window - 1 words, so neither is larger than that run allows.
    """
    need = next((m for m in range(words) if m / words >= least), words)
    run = max(1, -(-need // (max(1, words - need) + 2)))
    gram = min(gram, run)
    return need, gram, min(window, run - gram + 1)


class Index:
    """Inverted indices of the templates' fingerprints, one for each length of grams, sorted by hash."""

    def __init__(self, templates: dict[str, str], gram: int, window: int, least: float):
        self.names = sorted(templates)
        self.words = [word_hashes(templates[n].encode(), NOT_ALNUM)[0] for n in self.names]
        self.counts = [Counter(words.tolist()) for words in self.words]
        self.need, self.edits = [], []
        rows: dict[int, list] = {}
        for t, words in enumerate(self.words):
            need, n, w = fingerprint_sizes(int(words.size), gram, window, least)
            self.need.append(need)
            self.edits.append(int(words.size) - need + 1)  # words that a notice may have lost, and one more
            grams = gram_hashes(words, n, whole_if_short=False)
            rows.setdefault(n, []).extend((int(grams[i]), t, int(i)) for i in winnow(grams, w))
        self.tables = {n: tuple(np.array(c, dtype=d) for c, d in zip(zip(*sorted(found), strict=True), ("u8", "i8", "i8"), strict=True)) for n, found in rows.items() if found}

    def hits(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(template, diagonal) of every gram of the document's words that is a fingerprint."""
        out = set()
        for n, (hashes, template, place) in self.tables.items():
            grams = gram_hashes(words, n, whole_if_short=False)
            lo = np.searchsorted(hashes, grams, side="left")
            known = np.flatnonzero(hashes[np.minimum(lo, hashes.size - 1)] == grams)
            for i in known.tolist():
                k = int(lo[i])
                while k < hashes.size and hashes[k] == grams[i]:
                    out.add((int(template[k]), i - int(place[k])))
                    k += 1
        return out

    def possible(self, t: int, words: list[int]) -> bool:
        """Whether there are enough of the template's words, in any order, for a notice of it."""
        there = Counter(words)
        return sum(min(n, there[w]) for w, n in self.counts[t].items()) >= self.need[t]


def align(template: list[int], words: list[int], first: int, low: int, high: int) -> tuple[int, int, int]:
    """(matched words, first and last+1 matched word of the document) of the best alignment in a band.

    The band allows diagonals from low to high; words[0] is word number first of the document.
    A match scores 2, a replaced, missing or additional word -1; the document's ends are free.
    """
    width = high - low + 1
    # For each cell: score, matches, first matched word, end of the last matched word.
    start = (0, 0, -1, -1)
    row = [start] * width
    for i, t in enumerate(template):
        new: list[tuple[int, int, int, int]] = []
        for d in range(width):
            j = i + low + d - first  # the document word this cell ends with
            s, m, a, b = row[d]
            if 0 <= j < len(words) and words[j] == t:
                best = (s + 2, m + 1, a if a >= 0 else first + j, first + j + 1)
            else:
                best = (s - 1, m, a, b)
            if d + 1 < width and row[d + 1][0] - 1 > best[0]:  # a template word is missing
                best = (row[d + 1][0] - 1, *row[d + 1][1:])
            if d and new[d - 1][0] - 1 > best[0]:  # the document has a word more
                best = (new[d - 1][0] - 1, *new[d - 1][1:])
            new.append(best)
        row = new
    _, m, a, b = max(row)
    return m, a, b


def find_licenses(data: bytes, index: Index, band: int, least: float) -> list[tuple]:
    """(template, words, matched, coverage, first word, end word, first character, end character)."""
    hashes, starts, ends = word_hashes(data, NOT_ALNUM)
    found = []
    groups: list[list] = []  # template, lowest and highest diagonal of hits close together
    for t, diagonal in sorted(index.hits(hashes)):
        if groups and groups[-1][0] == t and diagonal - groups[-1][2] <= max(band, index.edits[t]):
            groups[-1][2] = diagonal
        else:
            groups.append([t, diagonal, diagonal])
    for t, low, high in groups:
        template, wide = index.words[t], max(band, index.edits[t])
        # Many close occurrences in a row make a wide group: each stretch of it has a band of its own.
        for base in range(low, high + 1, 4 * wide):
            top = min(base + 4 * wide - 1, high)
            first = max(0, base - wide)
            words = hashes[first : top + wide + template.size + 1].tolist()
            while index.possible(t, words):  # until no further occurrence is in the band
                m, a, b = align(template.tolist(), words, first, base - wide, top + wide)
                if m / template.size < least:
                    break
                found.append((m, t, a, b))
                words[a - first : b - first] = [-1] * (b - a)
    # More matched words first, then the template that they are more of.
    found.sort(key=lambda x: (-x[0], index.words[x[1]].size, x[1], x[2]))
    longest = max((b - a for _, _, a, b in found), default=0)
    kept: list[tuple] = []  # by first word; only those that start near can overlap
    for m, t, a, b in found:
        near = kept[bisect.bisect_left(kept, (a - longest,)) : bisect.bisect_left(kept, (b,))]
        if all(min(b, y) - max(a, x) <= 0.5 * (b - a) for x, y, _, _ in near):
            bisect.insort(kept, (a, b, t, m))
    if not kept:
        return []
    # How many code points start before each byte.
    points = np.concatenate([[0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)])
    out = []
    for a, b, t, m in kept:
        n = int(index.words[t].size)
        out.append((index.names[t], n, m, round(m / n, 6), a, b, int(points[starts[a]]), int(points[ends[b - 1]])))
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, gram: int = 4, window: int = 4, band: int = 6, least: float = 0.8) -> DataFrame:
    """A row for each license notice found in documents (doc_id, text), whole texts.

    doc_id, license, template_words, matched_words, coverage (matched share of the template), and the span in
    words and in code points, ends excluded.  Notices with coverage below least are not reported; of
    notices that overlap by more than half, the one with more matched words is, then that of the shorter template.
    Null and empty texts and an empty table have none; a null doc_id stays null; equal rows each give their notices;
    other columns are ignored.  Texts of any length are searched whole, in time linear in their notices.
    gram and window are the largest used: a template has smaller ones where a notice with few words changed, up to
    the share that least leaves, would have no fingerprint.  Words shifted by more than band, and by more than a notice may
    lose at the least coverage, are not matched.
    The templates are an argument of the call, at most 1 MB of text, and go to every task.
    """
    templates = TEMPLATES if templates is None else templates
    if sum(map(len, templates.values())) > 1 << 20:
        raise ValueError("more than 1 MB of templates")
    kinds = "license string, template_words long, matched_words long, coverage double, start_word long, end_word long, start_char long, end_char long"
    names = [k.split()[0] for k in kinds.split(", ")]

    def search(batches):
        index = Index(templates, gram, window, least)
        for b in batches:
            rows = [(doc, *r) for doc, data in zip(b["doc_id"], b["data"], strict=True) for r in find_licenses(bytes(data), index, band, least)]
            yield pd.DataFrame(rows, columns=["doc_id", *names])

    found = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), text_bytes().alias("data")).mapInPandas(search, f"doc_id long, {kinds}")
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
