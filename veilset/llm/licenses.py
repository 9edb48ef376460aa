"""License scans by conditional compression.

A block that holds a license text compresses far better once the compressor
has seen that text.  Each candidate block is compressed alone and with every
template as zstandard's raw dictionary; a template is a candidate if what it saves
is enough, as a share of its own size, and candidates are confirmed by exact
wording: the words of the template are aligned with the block's, and the words
that differ must be few enough for the template's length, and on neither side
(missing, added or changed) a word that tells licenses apart or a number.
Confirmed templates that overlap are ranked by size reduction: the bytes that each
saves the stretch it was found on.  Numbers of list items are no words.  A text that
goes on as a longer license does where the template ends is not the template's.

A candidate block is a run of lines from one that holds a cue word ("license",
"copyright", ...) to another, no more than ``gap`` lines from one such line to
the next, with as much text on either side as the longest template has, since
a license text may start before its first cue.  In a block a template is tried
on stretches of four times its own length around the cue words (every template
holds one), which together hold every place where it can stand; so the work
for a text of any length is in proportion to it, and nothing is left out.

Texts are scanned where they lie, in one pass with no shuffle; the templates
are a parameter, small and sent with the code.

Defined cases: NULL and empty texts have no blocks; a template found several
times counts each time; of finds that overlap the one that saves most bytes stays
(so a license that holds another one whole wins), then the one with fewer
differences, then the smaller name, then the first; repeated rows are scanned each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, text_bytes

# Names and the wording that stands for each license in texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."),
    "MIT": "Released under the MIT License",
    "MIT-notice": "Licensed under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        'all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", '
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution."),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "BSD-4-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. 3. All advertising materials "
        "mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by the organization. 4. "
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "GPL-2.0-or-later-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."),
    "LGPL-2.0-or-later-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Library General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."),
    "LGPL-2.1-or-later-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "AGPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "GPL-2.0-only-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License version 2 as published by the Free Software "
        "Foundation."),
    # the long licenses by their titles
    "GPL-2.0-body": "GNU General Public License Version 2, June 1991",
    "GPL-3.0-body": "GNU General Public License Version 3, 29 June 2007",
    "LGPL-2.0-body": "GNU Library General Public License Version 2, June 1991",
    "LGPL-2.1-body": "GNU Lesser General Public License Version 2.1, February 1999",
    "LGPL-3.0-body": "GNU Lesser General Public License Version 3, 29 June 2007",
    "AGPL-3.0-body": "GNU Affero General Public License Version 3, 19 November 2007",
    "Apache-2.0-body": "Apache License Version 2.0, January 2004",
    "GPL-2.0": "licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC0-1.0": "Licensed under CC0 1.0",
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain."),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0",
}
CUES = (b"licen", b"copyright", b"permission", b"redistribut", b"warrant", b"public domain",
        b"free software", b"unencumbered")
# Words that tell one license from another: these, and numbers, must not differ.
TELLING = frozenset(
    "affero apache boost bsd by cc cc0 gnu isc lesser mit mozilla nc nd public sa unlicense "
    "general".split())

# Words of which every template holds one, as stems.
_CUE = re.compile("licen|copyright|permission|redistribut|warrant|public|software|unencumbered")
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_KIND = re.compile("-(?:text|header|notice|body)$")
_DIGIT = re.compile(r"\d")
# The number of a list item: one or two digits, a point or bracket behind them,
# and before them no word that they could belong to ("version 3.").
_ITEM = re.compile(r"(?:\A|[:;.,*#/(])\s*\(?(\d{1,2})[.)](?=\s)")


@dataclass(frozen=True)
class Params:
    gap: int = 4                 # lines from one cue to the next in a block
    min_saving: float = 0.2      # bytes that a template must save, as a share of its own
    differing: float = 0.05      # share of a template's words that may differ
    level: int = 19              # matches of few bytes are found at high levels only


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Folded words with their places."""
    return [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def placed_words(text: str) -> tuple[list[tuple[str, int, int]], list[str]]:
    """Words but for the numbers of lists, and for each what tells licenses
    apart in it: its parts that are such words, or a number; else empty."""
    items = {m.start(1) for m in _ITEM.finditer(text)}
    placed = [w for w in words_of(text) if w[1] not in items]
    return placed, [w if _DIGIT.search(w) else
                    " ".join(x for x in re.split("[.-]", w) if x in TELLING)
                    for w, _, _ in placed]


def differences(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """Fewest word differences (missing, added or changed) between the
    template and a stretch of the block, and that stretch (start, end)."""
    n = len(block)
    if not n:
        return len(template), 0, 0
    cost = np.zeros(n + 1, np.int64)              # row of an alignment: free start
    start = np.arange(n + 1)
    words = np.array(block, object)
    for i, word in enumerate(template):
        change = cost[:-1] + (words != word)
        skip = cost[1:] + 1                       # the template's word is missing
        first = cost[0] + 1
        best = np.minimum(change, skip)
        origin = np.where(change <= skip, start[:-1], start[1:])
        # an added word of the block: running minimum along the row
        row = np.concatenate([[first], best])
        own = np.concatenate([[0], origin])
        shift = row - np.arange(n + 1)
        low = np.minimum.accumulate(shift)
        at = np.maximum.accumulate(np.where(shift == low, np.arange(n + 1), 0))
        cost = low + np.arange(n + 1)
        start = own[at]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


class Scanner:
    """Templates prepared as dictionaries."""

    def __init__(self, templates: dict[str, str], p: Params) -> None:
        self.p = p
        self.plain = zstandard.ZstdCompressor(level=p.level)
        self.frame = len(self.plain.compress(b""))
        self.templates = []
        for name, text in sorted(templates.items()):
            placed, tells = placed_words(text)
            words = [w for w, _, _ in placed]
            data = " ".join(words).encode()
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            if not any(map(_CUE.search, words)):
                raise ValueError(f"template {name} holds no cue word")
            self.templates.append((name, words, zstandard.ZstdCompressor(
                level=p.level, dict_data=raw), len(self.plain.compress(data)) - self.frame,
                [t for t in tells if t], frozenset(words)))
        # where a template is how another license starts: the words that follow there
        self.goes_on = {name: {tuple(other[len(words):len(words) + 4])
                               for longer, other, *_ in self.templates
                               if len(other) > len(words) and other[:len(words)] == words
                               and _KIND.sub("", longer) != _KIND.sub("", name)}
                        for name, words, *_ in self.templates}
        self.margin = max((len(t) for t in templates.values()), default=0) * 3 // 2

    def blocks(self, text: str) -> list[tuple[int, str]]:
        """Candidate blocks: place and text."""
        runs: list[list[int]] = []
        at = number = last = 0
        for line in text.split("\n"):
            low = line.lower().encode()
            if any(c in low for c in CUES):
                if runs and number - last <= self.p.gap:
                    runs[-1][1] = at + len(line)
                else:
                    runs.append([at, at + len(line)])
                last = number
            number += 1
            at += len(line) + 1
        # text beside a run that may belong to its license; blocks that meet are one
        wide: list[list[int]] = []
        for a, b in runs:
            a, b = max(0, a - self.margin), min(len(text), b + self.margin)
            if wide and a <= wide[-1][1]:
                wide[-1][1] = b
            else:
                wide.append([a, b])
        return [(a, text[a:b]) for a, b in wide]

    def saved(self, words: list[str], template: tuple) -> int:
        """Bytes that a template saves the words."""
        data = " ".join(words).encode()
        return len(self.plain.compress(data)) - len(template[2].compress(data))

    def saving(self, words: list[str], template: tuple) -> float:
        """What a template saves the words, as a share of its own size."""
        return self.saved(words, template) / template[3]

    def windows(self, cues: list[int], n: int, size: int) -> Iterator[tuple[int, int]]:
        """Stretches that hold every run of ``size`` words with a cue in it."""
        reach = -1
        for c in cues:
            if c > reach:
                yield max(0, c - 2 * size), min(n, c + 2 * size)
                reach = c + size

    def found(self, words: list[str], tells: list[str], template: tuple) -> Iterator[tuple]:
        """(first word, word behind the last, saving, differences) of each time
        that a template stands in a window."""
        _, own, _, _, own_tells, distinct = template
        most = self.p.differing * len(own)
        todo = [(0, len(words))]
        while todo:
            a, b = todo.pop()
            # each word of the template that the window lacks is a difference
            if b <= a or len(distinct.difference(words[a:b])) > most or \
                    (saving := self.saving(words[a:b], template)) < self.p.min_saving:
                continue
            n, i, j = differences(own, words[a:b])
            if n > most:
                continue
            # with a word that tells differing, it is another license; look on beside it
            if not n or [t for t in tells[a + i:a + j] if t] == own_tells:
                yield a + i, a + j, saving, n
            todo += [(a, a + i), (a + j, b)]

    def scan(self, text: str) -> tuple[int, list[tuple]]:
        """Number of candidate blocks, and the finds in order."""
        low = text.lower().encode()
        if not any(c in low for c in CUES):
            return 0, []
        blocks = self.blocks(text)
        every: set[tuple] = set()
        for place, block in blocks:
            placed, tells = placed_words(block)
            words = [w for w, _, _ in placed]
            cues = [i for i, w in enumerate(words) if _CUE.search(w)]
            for t in self.templates:
                for a, b in self.windows(cues, len(words), len(t[1])):
                    for i, j, saving, n in self.found(words[a:b], tells[a:b], t):
                        if tuple(words[a + j:a + j + 4]) in self.goes_on[t[0]]:
                            continue
                        every.add((place + placed[a + i][1], place + placed[a + j - 1][2], t[0],
                                   round(saving, 6), n, self.saved(words[a + i:a + j], t)))
        # of finds that overlap: the most bytes saved, then the best wording
        kept: list[tuple] = []
        for f in sorted(every, key=lambda f: (-f[5], f[4], f[2], f[0], -f[3])):
            if all(f[1] <= k[0] or k[1] <= f[0] for k in kept):
                kept.append(f[:5])
        return len(blocks), sorted(kept)


_SCANNERS: dict[tuple, Scanner] = {}       # per Python worker

_FIND = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()),
                   ("saving", pa.float64()), ("differences", pa.int64())])


def scan(docs: DataFrame, templates: dict[str, str] | None = None,
         p: Params = Params()) -> DataFrame:
    """doc_id, n_blocks, n_found, licenses (names, comma-joined, each once) and
    the finds (start, end in code points, license, saving, differences): a row
    per row of ``docs``."""
    ship_code(docs.sparkSession)
    given = tuple(sorted((TEMPLATES if templates is None else templates).items()))

    @F.arrow_udf("struct<n_blocks:long,finds:array<struct<start:long,end:long,license:string,"
                 "saving:double,differences:long>>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = _SCANNERS.get((given, p)) or _SCANNERS.setdefault(
            (given, p), Scanner(dict(given), p))
        names = [f.name for f in _FIND]
        for batch in batches:
            found = [scanner.scan((v.as_py() or b"").decode()) for v in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()),
                 pa.array([[dict(zip(names, f, strict=True)) for f in fs] for _, fs in found],
                          pa.list_(_FIND))], names=["n_blocks", "finds"])

    out = docs.select("doc_id", run.asNondeterministic()(text_bytes("text")).alias("s"))
    return out.select(
        "doc_id", "s.n_blocks", F.size("s.finds").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("s.finds.license")), ",").alias("licenses"),
        "s.finds")
