"""License notices by conditional compression.

Neighbouring lines with words of the templates form a region. Each template is aligned with the region's
words: where as few words as possible are missing or added, and enough of the template is there, lies a
candidate block, which may begin and end within a line. In lower case and with single spaces, a block is
compressed alone and with the template as a raw Zstandard dictionary. Blocks are taken in the order of
the bytes saved, unless the exact words say that an overlapping block explains more; what lies
between the blocks taken is looked at again.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from difflib import SequenceMatcher

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.llm import tokens
from lapseflow.llm.registry import query, table

#: The conditions and disclaimers that whole license texts share.
_BSD_FIRST = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software."
)
_MIT_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_ISC_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)

#: Short notices, the operative wording and the whole short texts of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        'by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "BSD-2-Clause-whole": _BSD_FIRST + _BSD_DISCLAIMER,
    "BSD-3-Clause-whole": _BSD_FIRST + _BSD_THIRD + _BSD_DISCLAIMER,
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "ISC": _ISC_GRANT,
    "ISC-whole": _ISC_GRANT + _ISC_DISCLAIMER,
    "MIT": "Released under the MIT License.",
    "MIT-text": _MIT_GRANT,
    "MIT-whole": _MIT_GRANT + _MIT_DISCLAIMER,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "proprietary": "Copyright. All rights reserved.",
}

#: Words of fewer letters don't make a line a candidate, and a region holds so many different others.
SIGNAL_WORD, SIGNALS = 5, 2
#: A block is a notice with changed words if this share of the template's words is there.
LEAST_SHARED = 0.7
#: Level of compression.
LEVEL = 6
PIECE = 1 << 19

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def _plain(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Notice:
    """A confirmed block: its place in the text, the template, and how it differs from it."""

    block: int
    start: int
    end: int
    license: str
    saving: float
    runner_up: str | None
    missing: list[str]
    added: list[str]

    @property
    def exact(self) -> bool:
        return not self.missing and not self.added


def best_spans(want: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each end in ``have`` (0 to its length) the start of the span that is nearest to ``want``, and how far it is.

    The distance counts words missing from the span and words added by it. Of spans equally far
    the longest is meant, which holds most of ``want``. One vector operation per word of ``want``, so the time is linear in ``have``.
    """
    n = len(have)
    one = 1 << 40
    at = np.arange(n + 1, dtype=np.int64)
    # Distance and, below it, the start: the least is the best.
    row = at.copy()
    for word in want:
        below = row + one
        below[1:] = np.minimum(below[1:], np.where(have == word, row[:-1], below[1:]))
        row = np.minimum.accumulate(below - at * one) + at * one
    return row & (one - 1), row >> 40


@dataclass
class Block:
    """A candidate: words ``start`` to ``end`` of a region, nearest to one template."""

    start: int
    end: int
    name: str
    gain: int
    saved: int = 0


class Scanner:
    """Templates made ready: compressors, words, and the matcher of candidate lines."""

    def __init__(self, templates: Mapping[str, str]) -> None:
        self.words = {k: _words(v) for k, v in templates.items()}
        self.counts = {k: Counter(v) for k, v in self.words.items()}
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.with_template = {}
        for name, text in templates.items():
            given = zstandard.ZstdCompressionDict(_plain(text), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_template[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=given)
        self.signals = ahocorasick.Automaton()
        for word in {w for words in self.words.values() for w in words if len(w) >= SIGNAL_WORD}:
            self.signals.add_word(word, word)
        if len(self.signals):
            self.signals.make_automaton()

    def blocks(self, text: str) -> Iterator[tuple[int, int]]:
        """Ranges of neighbouring lines with signal words, SIGNALS different ones in all.

        Blank lines and single lines without signals don't part a range; the line before it and the
        one behind it belong to it.
        """
        if not len(self.signals):
            return
        lower = text.lower()
        if len(lower) != len(text):
            # Places must stay those of the text.
            lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        seen: dict[tuple[int, int], set[str]] = {}
        line = (0, -1)
        for end, word in self.signals.iter(lower):
            start = end - len(word) + 1
            edges = lower[start - 1 : start] + lower[end + 1 : end + 2]
            if any(c.isalnum() for c in edges):
                continue
            if not line[0] <= start < line[1]:
                after = lower.find("\n", start)
                line = (lower.rfind("\n", 0, start) + 1, len(lower) if after < 0 else after)
            seen.setdefault(line, set()).add(word)

        def around(low: int, high: int) -> tuple[int, int]:
            after = text.find("\n", high + 1)
            return text.rfind("\n", 0, max(low - 1, 0)) + 1, len(text) if after < 0 else after

        low = high = 0
        held: set[str] = set()
        for (start, end), found in sorted(seen.items()):
            if held and sum(1 for x in text[high:start].split("\n") if x.strip()) <= 1:
                high, held = end, held | found
                continue
            if len(held) >= SIGNALS:
                yield around(low, high)
            low, high, held = start, end, found
        if len(held) >= SIGNALS:
            yield around(low, high)

    def _saved(self, raw: bytes, name: str) -> int:
        return len(self.plain.compress(raw)) - len(self.with_template[name].compress(raw))

    def savings(self, block: str) -> list[tuple[float, str]]:
        """Templates by the share of the block's compressed size that they save, greatest first."""
        raw = _plain(block)
        alone = len(self.plain.compress(raw))
        found = [(self._saved(raw, name) / alone, name) for name in self.with_template]
        return sorted(found, key=lambda x: (-x[0], x[1]))

    def differences(self, have: list[str], name: str) -> tuple[list[str], list[str]]:
        """Words of the template that the block's words lack, and words that they add, in order."""
        want = self.words[name]
        missing, added = [], []
        for kind, a, b, c, d in SequenceMatcher(None, want, have, autojunk=False).get_opcodes():
            if kind != "equal":
                missing += want[a:b]
                added += have[c:d]
        return missing, added

    def candidates(self, words: list[str]) -> list[Block]:
        """For each template the spans that hold enough of it, the nearest first, none overlapping another of its own."""
        codes: dict[str, int] = {}
        have = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
        held = Counter(words)
        found = []
        for name, want in self.words.items():
            least = LEAST_SHARED * len(want)
            # A template of which the whole region holds too few words is in no span of it.
            if not want or sum(min(n, held[w]) for w, n in self.counts[name].items()) < least:
                continue
            starts, far = best_spans(np.array([codes.get(w, -1) for w in want]), have)
            matched = (len(want) + np.arange(len(have) + 1) - starts - far) // 2
            ends = np.flatnonzero((matched >= least) & (matched > 0))
            taken: list[tuple[int, int]] = []
            for end in ends[np.lexsort((ends, -matched[ends], far[ends]))].tolist():
                start, place = int(starts[end]), bisect_left(taken, (end, 0))
                if place and taken[place - 1][1] > start:
                    continue
                taken.insert(place, (start, end))
                # Words that are there less those that aren't: of two overlapping blocks, the one
                # with more differs less from all that both of them span.
                found.append(Block(start, end, name, 2 * int(matched[end]) - len(want)))
        return found

    def chosen(self, text: str, places: list[tuple[int, int]]) -> list[Block]:
        """Blocks that don't overlap, of the words at ``places`` in ``text``."""
        done: list[Block] = []
        left = [(0, len(places))]
        while left:
            low, high = left.pop()
            words = [text[a:b].lower() for a, b in places[low:high]]
            found = self.candidates(words)
            for c in found:
                c.start, c.end = c.start + low, c.end + low
                c.saved = self._saved(_plain(text[places[c.start][0] : places[c.end - 1][1]]), c.name)
            found.sort(key=lambda c: (c.start, c.end, c.name))
            starts = [c.start for c in found]
            longest = max((c.end - c.start for c in found), default=0)
            free = [True] * len(found)

            def overlapping(k: int) -> list[int]:
                near = range(bisect_left(starts, found[k].start - longest), bisect_left(starts, found[k].end))
                return [r for r in near if free[r] and found[r].end > found[k].start]

            taken: list[Block] = []
            for k in sorted(range(len(found)), key=lambda k: (-found[k].saved, found[k].name, found[k].start)):
                while free[k]:
                    # The greatest saving is confirmed unless an overlapping block differs in fewer words.
                    best = min(overlapping(k), key=lambda r: (-found[r].gain, -found[r].saved, found[r].name, found[r].start))
                    taken.append(found[best])
                    for r in overlapping(best):
                        free[r] = False
            if taken:
                taken.sort(key=lambda c: c.start)
                edges = [low, *[x for c in taken for x in (c.start, c.end)], high]
                left += [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]
            done += taken
        return sorted(done, key=lambda c: c.start)

    def scan(self, text: str | None) -> list[Notice]:
        """All notices of a text, in its order. A block ends behind the full stop after its last word, if there is one."""
        found: list[Notice] = []
        for low, high in self.blocks(text or ""):
            places = [m.span() for m in _WORD.finditer(text, low, high)]
            for c in self.chosen(text, places):
                start, end = places[c.start][0], places[c.end - 1][1]
                end += text[end : end + 1] == "."
                ranked = self.savings(text[start:end])
                saving = next(x for x, name in ranked if name == c.name)
                runner_up = next((name for _, name in ranked if name != c.name), None)
                words = [text[a:b].lower() for a, b in places[c.start : c.end]]
                found.append(Notice(len(found), start, end, c.name, saving, runner_up, *self.differences(words, c.name)))
        return found


_RESULT = (
    "doc_id bigint, block int, start int, end int, license string, verdict string, saving double, runner_up string, "
    "missing array<string>, added array<string>, notice string"
)


def license_notices(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """One row per license notice found in ``docs`` (doc_id, text).

    ``start`` and ``end`` count code points, ``verdict`` is ``exact`` if no word differs from the
    template and ``modified`` else. Null and empty texts have no notices; repeated rows and rows without
    an id are scanned like all others; of two templates that fit alike the one that saves more, then
    the first in the alphabet is named. No templates and empty tables give no rows. Of a long text only the regions
    with signal words are looked at, in time linear in their length; notices that keep fewer than
    ``SIGNALS`` different signal words are none.
    """
    given = dict(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given)
        for batch in batches:
            for low, high in tokens.slices(batch.column(1), PIECE):
                piece = batch.slice(low, high - low)
                rows = [
                    (i, n.block, n.start, n.end, n.license, "exact" if n.exact else "modified", round(n.saving, 6), n.runner_up, n.missing, n.added, text[n.start : n.end])
                    for i, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)
                    for n in scanner.scan(text)
                ]
                if rows:
                    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
                    names = [x.split()[0] for x in _RESULT.split(", ")]
                    yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(scan, _RESULT)


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The license notices of every document."""
    return license_notices(table(spark, folder, "documents"))
