"""License notices by conditional compression.

Paragraphs with a licensing cue are candidate blocks (neighbouring paragraphs form one block), so that a notice may be wrapped
in any way and have comment signs before its lines. Each block is compressed alone and then
with every template as a raw zstandard dictionary; templates are ranked by how much smaller the block got. Every template is
then confirmed by its wording: word for word, or, for a long template that saves bytes, but for a few words. Words that tell
licenses apart (versions, names, ShareAlike, Lesser...) may neither be lacking nor be added.

A notice runs over its whole lines and the neighbouring lines with cues. Lines with cues that no notice runs over are listed
as ``unknown`` if they name a license, and are left out otherwise.

Null and empty texts have no blocks. Blocks are compressed in parts that overlap by more than a template; words are compared
over the whole block.
Rows are judged one by one, so repeated rows and null ids give a row each.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import zstandard
from pyspark.sql import DataFrame

from creditloom.llm.tasks import map_rows

_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
    published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

    This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

    You should have received a copy of the GNU General Public License along with this program. If not, see
    <https://www.gnu.org/licenses/>."""
#: Notices by SPDX name, in full or in part. Fixed values.
TEMPLATES = {
    "MIT": [
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions:

        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "Apache-2.0": [
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
        "Licensed under the Apache License, Version 2.0", "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "GPL-3.0": [
        _GPL.format(version=3),
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3", "Licensed under the GNU General Public License v3.0.", "This work is licensed under the GNU General Public License, version 3."],
    "GPL-2.0": [
        _GPL.format(version=2),
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2", "Licensed under the GNU General Public License v2.0.", "This work is licensed under the GNU General Public License, version 2."],
    "BSD-3-Clause": [
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the
        copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
        ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
        A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
        "Redistribution and use in source and binary forms, with or without modification, are permitted", "Licensed under the BSD 3-Clause License."],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "proprietary": ["All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
#: The words of a cue may stand on two lines.
CUE = re.compile(
    r"licen[sc]e|copyright|all\W+rights\W+reserved|permission\W+is\W+hereby|redistribution\W+and\W+use|creative\W+commons|spdx|proprietary\W+and|waived\W+all|mozilla\W+public",
    re.IGNORECASE,
)
NAMED = re.compile(r"\blicen[sc]ed?\b", re.IGNORECASE)
WORD = re.compile(r"[A-Za-z0-9]+")
#: Percent of a template's words that may be lacking or passed over; a short template must be there word for word.
MAX_CHANGED_PERCENT = 15
SHORT_WORDS = 16
#: Words that make another license of a notice: never passed over. These, names and whatever holds a digit are never lacking.
VARIANTS = frozenset("affero lesser library nc nd noncommercial noderivatives noderivs sa sharealike".split())
NAMES = frozenset("apache attribution bsd cc gnu mit mozilla".split())
COMPRESSED_WORDS = 1024


def blocks(text: str) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Bounds of candidate blocks, runs of paragraphs that each hold a cue, with the runs of lines in them that each hold a part of a cue."""
    cues = [m.span() for m in CUE.finditer(text)]
    if not cues:
        return
    at = next_cue = 0
    whole: list[tuple[int, int]] = []  # paragraphs with cues that neighbour each other
    marked: list[tuple[int, int]] = []  # their runs of lines with cues
    start, lines = None, []  # of the paragraph
    for line in [*text.split("\n"), ""]:
        end = at + len(line)
        while next_cue < len(cues) and cues[next_cue][1] <= at:
            next_cue += 1
        if any(c.isalnum() for c in line):
            start = at if start is None else start
            if next_cue < len(cues) and cues[next_cue][0] < end:
                if lines and lines[-1][1] == at - 1:
                    lines[-1] = (lines[-1][0], end)
                else:
                    lines.append((at, end))
            last = end
        elif start is not None:
            if lines:
                whole.append((start, last))
                marked += lines
            elif whole:
                yield whole[0][0], whole[-1][1], marked
                whole, marked = [], []
            start, lines = None, []
        at = end + 1
    if whole:
        yield whole[0][0], whole[-1][1], marked


def _words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def aligned(wanted: list[str], words: list[str], allowed: int) -> tuple[int, int] | None:
    """The run of words nearest to the template, first and end, if at most ``allowed`` words are lacking or passed over."""
    never = allowed + 1
    costs, firsts = [0] * (len(words) + 1), list(range(len(words) + 1))
    for want in wanted:
        lack = never if want in VARIANTS or want in NAMES or not want.isalpha() else 1
        above, first = costs[0], firsts[0]
        costs[0] += lack
        for j, word in enumerate(words, 1):
            best, start = costs[j] + lack, firsts[j]
            if (cost := costs[j - 1] + (never if word in VARIANTS else 1)) < best:
                best, start = cost, firsts[j - 1]
            if word == want and above <= best:
                best, start = above, first
            above, first = costs[j], firsts[j]
            costs[j], firsts[j] = best, start
    best = min(costs)
    return (firsts[costs.index(best)], costs.index(best)) if best <= allowed else None


class Block:
    """The words of a block, and where runs of them are."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.line = f" {' '.join(words)} "
        self.starts = list(accumulate((len(w) + 1 for w in words), initial=0))

    def exact(self, wanted: list[str]) -> Iterator[int]:
        """Where the words are, in order and without any other between."""
        run, at = f" {' '.join(wanted)} ", -1
        while (at := self.line.find(run, at + 1)) >= 0:
            yield bisect_left(self.starts, at)

    def near(self, wanted: list[str]) -> Iterator[tuple[int, int]]:
        """Runs with the template's wording, but for the changes allowed. One more piece than changes: some piece is whole in each."""
        allowed = len(wanted) * MAX_CHANGED_PERCENT // 100
        bounds = [i * len(wanted) // (allowed + 1) for i in range(allowed + 2)]
        tried = set()
        found: list[tuple[int, int]] = []
        for at, end in zip(bounds, bounds[1:]):
            for place in self.exact(wanted[at:end]):
                low = place - at - allowed
                if low in tried or any(first <= place < last for first, last in found):
                    continue
                tried.add(low)
                base = max(low, 0)
                if run := aligned(wanted, self.words[base : low + len(wanted) + 2 * allowed], allowed):
                    found.append((base + run[0], base + run[1]))
                    yield found[-1]


class Scanner:
    def __init__(self) -> None:
        self.alone = zstandard.ZstdCompressor(level=3)
        self.templates = []
        for name, notices in TEMPLATES.items():
            for notice in notices:
                words = _words(notice)
                known = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.templates.append((name, words, zstandard.ZstdCompressor(level=3, dict_data=known)))
        self.overlap = 2 * max(len(words) for _, words, _ in self.templates)

    def rank(self, words: list[str]) -> list[tuple[int, str, list[str]]]:
        """Templates by the bytes they save in the part of the block that they suit best, best first."""
        saved = [0] * len(self.templates)
        for start in range(0, max(len(words) - self.overlap, 1), COMPRESSED_WORDS):
            data = " ".join(words[start : start + COMPRESSED_WORDS + self.overlap]).encode()
            plain = len(self.alone.compress(data))
            for i, (_, _, squeezed) in enumerate(self.templates):
                saved[i] = max(saved[i], plain - len(squeezed.compress(data)))
        rows = [(s, name, words) for s, (name, words, _) in zip(saved, self.templates)]
        return sorted(rows, key=lambda r: (-r[0], r[1], r[2]))

    def runs(self, words: list[str]) -> Iterator[tuple[int, int, str]]:
        """First and end word of all runs with a template's wording, and the license, the best template first."""
        block = Block(words)
        for saved, name, wanted in self.rank(words):
            yield from ((at, at + len(wanted), name) for at in block.exact(wanted))
            if saved > 0 and len(wanted) > SHORT_WORDS:
                yield from ((first, end, name) for first, end in block.near(wanted))

    def notices(self, text: str, start: int, end: int, marked: list[tuple[int, int]]) -> set[tuple[int, int, str]]:
        """The notices of a block."""
        words = [(m.start(), m.end(), m[0].lower()) for m in WORD.finditer(text, start, end)]
        starts, ends = [a for a, _ in marked], [b for _, b in marked]
        touched = set()
        found: dict[str, list[tuple[int, int]]] = {}
        for first, last, name in self.runs([w for _, _, w in words]):
            low = max(text.rfind("\n", start, words[first][0]) + 1, start)
            high = text.find("\n", words[last - 1][1], end)
            high = end if high < 0 else high
            at, past = bisect_right(ends, low), bisect_left(starts, high)  # the lines with cues that it runs over
            if at < past:
                touched.update(range(at, past))
                low, high = min(starts[at], low), max(ends[past - 1], high)
            found.setdefault(name, []).append((low, high))
        out = set()
        for name, spans in found.items():
            low, high = min(spans)
            for a, b in sorted(spans):  # runs of one license that overlap are one notice
                if a >= high:
                    out.add((low, high, name))
                    low = a
                high = max(high, b)
            out.add((low, high, name))
        unknown = {(a, b, "unknown") for i, (a, b) in enumerate(marked) if i not in touched and NAMED.search(text, a, b)}
        return out | unknown

    def scan(self, text: str | None) -> list[tuple[int, int, str]]:
        """Start, end and license of every notice; lines may hold several."""
        text = text or ""
        return sorted(notice for start, end, marked in blocks(text) for notice in self.notices(text, start, end, marked))


def scan(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns with the number of notices, the distinct licenses, and all notices as license:start:end."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        scanner = Scanner()
        for *kept, body in rows:
            found = scanner.scan(body)
            yield (*kept, len(found), ",".join(sorted({n for _, _, n in found})), ",".join(f"{n}:{s}:{e}" for s, e, n in found))

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_notices bigint, licenses string, notices string"])
    return map_rows(df.select(*(f"`{c}`" for c in keep), f"`{text}`"), schema, work)
