"""License scans: winnowed fingerprints in an inverted index pick candidates, banded local alignment measures them.

Texts and templates are lower-cased words. A match is a best local alignment (+2 a match, -1 a change or gap, never
below zero) that covers at least the share `least` of its template. At that coverage every fifth word may go and more may
be put in between, so runs of three or more words are not certain to be shared. Hence the fingerprints:

* Templates of `pairs_from` words or more are winnowed: of every two neighbouring words the one that is rarer among the
  templates is a fingerprint. Any two neighbouring words that text and template share leave the same one in both,
  beside the same neighbour, which a look at the neighbours confirms. A match of such a template must share two neighbouring
  words; it does if its matched words outnumber its edits by two, however the edits lie.
* In shorter notices every word is a fingerprint, since one edit in three words may leave no two neighbours.

A template stays a candidate of a text while the text holds enough of its words (repeats counted as in the template).
In an alignment every text word adds two at most if it is one of the template's and takes one if not, so a match lies in a
stretch where that running sum does not fall below zero, and that again holds enough words and a fingerprint. There the
template is aligned in bands around the diagonals of the shared fingerprints. A path that leaves a band of half width w has more than w
gaps and so scores less than two for each template word less w; the band is widened until that is below the best score found,
so the result is that of the full matrix. The words before and after an alignment are searched again.

A match reports the template, its matched words and their share (coverage), and the span in
code points of the text. Where matches overlap by half or more, the one with more matched words
stays. The template set is a parameter, bounded by what a library of licenses holds, and goes to
the executors with the code; texts are scanned whole, where they lie, without a shuffle.

Null and empty texts have no matches, and give no rows; repeated rows give repeated matches; an
empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")
SLICE = 1 << 16
NARROW = 4
SCHEMA = "doc_id long, template string, matched_words long, template_words long, coverage double, span_start long, span_end long"

AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
    "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# The wording of common license notices; whole licenses and their parts, versions and variants are entries of their own.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "BSD clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC BY-NC 4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC BY-SA 4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "All rights reserved. No part of this publication may be reproduced without permission.",
}


def _gnu(program: str, name: str, version: str, given: str) -> str:
    """The header of a GNU license."""
    return (
        f"{program} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
        f"{program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} General Public License for more details. "
        f"You should have received a copy of the GNU {name} General Public License along with {given}"
    )


_SITE = "this program. If not, see <https://www.gnu.org/licenses/>."
_POST = "{}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_BSD_2 = TEMPLATES["BSD clauses"] + " "
_BSD_3 = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
TEMPLATES |= {
    "MIT whole": TEMPLATES["MIT"] + (
        ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause whole": _BSD_2 + AS_IS,
    "BSD-3-Clause whole": _BSD_2 + _BSD_3 + AS_IS,
    "ISC whole": TEMPLATES["ISC"] + (
        ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD notice": "Released under the BSD License.",
    "Apache-2.0 release notice": "Released under the Apache License, Version 2.0.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1 notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "GPL-3.0 header": _gnu("This program", "", "3", _SITE),
    "GPL-2.0 header": _gnu("This program", "", "2", _POST.format("this program")),
    "LGPL-2.1 header": _gnu("This library", "Lesser", "2.1", _POST.format("this library")),
    "LGPL-3.0 header": _gnu("This program", "Lesser", "3", _SITE),
    "AGPL-3.0 header": _gnu("This program", "Affero", "3", _SITE),
    "CC BY 4.0 notice": "Licensed under CC BY 4.0.",
    "CC BY-SA 4.0 short notice": "Licensed under CC BY-SA 4.0.",
    "CC BY-ND 4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC BY-NC-SA 4.0 notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC BY 4.0 long notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC BY-NC 4.0 long notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0 1.0 notice": "This work is dedicated to the public domain under CC0 1.0 Universal.",
}


def tokens(text: str) -> list[str]:
    return [word for word, _ in placed(text)] if len(text.lower()) != len(text) else WORD.findall(text.lower())


def placed(text: str) -> list[tuple[str, tuple[int, int]]]:
    """The words of a text with their spans; lower case may be longer than the letters it stands for."""
    low = text.lower()
    return [(m[0].lower(), m.span()) for m in WORD.finditer(low if len(low) == len(text) else text)]


@dataclass(frozen=True)
class Match:
    template: str
    matched: int
    length: int
    first: int
    last: int

    @property
    def coverage(self) -> float:
        return self.matched / self.length


class Scanner:
    """The inverted index of a template set."""

    def __init__(self, templates: dict[str, str], least: float = 0.6, pairs_from: int = 20):
        self.least = least
        self.names = sorted(templates)
        self.words = [tokens(templates[name]) for name in self.names]
        uses = Counter(word for found in self.words for word in found)
        # Places go from rare to frequent words, so that of two neighbours the one with the smaller place is the rarer.
        self.place = {word: i + 1 for i, word in enumerate(sorted(uses, key=lambda word: (uses[word], word)))}
        self.counts = np.zeros((len(self.place) + 1, len(self.names)), np.int64)
        for t, found in enumerate(self.words):
            for word in found:
                self.counts[self.place[word], t] += 1
        self.needs = np.array([max(1, math.ceil(least * len(found))) for found in self.words], np.int64)
        self.places = [np.array([self.place[word] for word in found], np.int64) for found in self.words]
        self.paired = np.array([len(found) >= pairs_from for found in self.words], bool)
        self.index()

    def index(self) -> None:
        """Fingerprints of the longer templates by word: template, position in it, and the words on both sides."""
        entries = [(t, i) for t in np.flatnonzero(self.paired).tolist() for i in winnowed(self.places[t]).tolist()]
        entries.sort(key=lambda entry: self.places[entry[0]][entry[1]])
        side = lambda t, i: self.places[t][i] if 0 <= i < len(self.places[t]) else -1
        listed = np.array([(side(t, i), t, i, side(t, i - 1), side(t, i + 1)) for t, i in entries], np.int64).reshape(-1, 5)
        word, self.at_template, self.at_position, self.at_left, self.at_right = listed.T.copy()
        self.starts = np.searchsorted(word, np.arange(len(self.place) + 2))

    def hits(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints that a text shares with the longer templates: template, position in it, position in the text."""
        chosen = winnowed(places)
        beside = np.concatenate(([-2], places, [-2]))
        found = []
        for low in range(0, len(chosen), SLICE):
            some = chosen[low : low + SLICE]
            first = self.starts[places[some]]
            n = self.starts[places[some] + 1] - first
            entry = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            where = np.repeat(some, n)
            same = (beside[where] == self.at_left[entry]) | (beside[where + 2] == self.at_right[entry])
            found.append((self.at_template[entry[same]], self.at_position[entry[same]], where[same]))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def shared(self, t: int, stretch: np.ndarray) -> int:
        """How many words of a template a stretch holds, each as often as in the template at most."""
        return int(np.minimum(np.bincount(stretch, minlength=len(self.counts)), self.counts[:, t]).sum())

    def matches(self, found: list[str]) -> list[Match]:
        """All matches of all templates; those of one template do not overlap."""
        places = np.fromiter((self.place.get(word, 0) for word in found), np.int64, len(found))
        held, n = np.unique(places, return_counts=True)
        enough = np.minimum(n[:, None], self.counts[held]).sum(axis=0) >= self.needs
        if not enough.any():
            return []
        of, position, where = self.hits(places) if (enough & self.paired).any() else (np.zeros(0, np.int64),) * 3
        out: list[Match] = []
        for t in np.flatnonzero(enough).tolist():
            if self.paired[t]:
                at, diagonals = where[of == t], (where - position)[of == t]
            else:
                spots = [np.flatnonzero(places == word) for word in self.places[t]]
                at, diagonals = np.concatenate(spots), np.concatenate([spot - i for i, spot in enumerate(spots)])
            if not len(at):
                continue
            # Where the running sum falls to a new smallest value, no alignment goes on; one of score zero keeps its matches.
            total = np.cumsum(np.where(self.counts[places, t] > 0, 2, -1))
            over = total >= np.minimum.accumulate(np.concatenate(([0], total[:-1])))
            edges = np.flatnonzero(np.diff(np.concatenate(([0], over, [0]))))
            open_ = [(low, high) for low, high in edges.reshape(-1, 2).tolist() if high - low >= self.needs[t]]
            while open_:
                low, high = open_.pop()
                if high - low >= self.needs[t] and self.shared(t, places[low:high]) >= self.needs[t]:
                    near = np.unique(diagonals[(at >= low) & (at < high)])
                    matched, first, last = self.align(t, found, low, high, near) if len(near) else (0, 0, 0)
                    if matched >= self.needs[t]:
                        out.append(Match(self.names[t], matched, len(self.words[t]), first, last))
                    if matched:
                        open_ += [(low, first), (last + 1, high)]
        return out

    def align(self, t: int, found: list[str], low: int, high: int, diagonals: np.ndarray) -> tuple[int, int, int]:
        """Matched words, first and last place of the best local alignment with the text words [low, high)."""
        most, width = 2 * len(self.words[t]), NARROW
        while True:
            best, last = (0, 0, 0), low
            cuts = np.flatnonzero(np.diff(diagonals) > 2 * width) + 1
            for near in np.split(diagonals, cuts):
                best, last = band(self.words[t], found, low, high, int(near[0]) - width, int(near[-1]) + width, best, last)
            if width >= most - best[0]:
                return best[1], -best[2], last
            width = most - best[0]

    def scan(self, text: str | None) -> list[tuple[Match, int, int]]:
        """Matches in order of place, with their spans in code points."""
        found = tokens(text) if text else []
        matches = self.matches(found) if found else []
        kept: list[Match] = []
        taken = np.zeros(len(found) + 1, bool)
        for m in sorted(matches, key=lambda m: (-m.matched, -m.coverage, m.first, m.template)):
            if 2 * int(taken[m.first : m.last + 1].sum()) < m.last + 1 - m.first:
                taken[m.first : m.last + 1] = True
                kept.append(m)
        if not kept:
            return []
        spans = [span for _, span in placed(text)]
        return [(m, spans[m.first][0], spans[m.last][1]) for m in sorted(kept, key=lambda m: (m.first, m.template))]


def winnowed(places: np.ndarray) -> np.ndarray:
    """Of every two neighbouring words of the index the position of the rarer one, the right one of two equals."""
    pairs = np.flatnonzero((places[:-1] > 0) & (places[1:] > 0))
    return np.unique(pairs + (places[pairs] >= places[pairs + 1]))


def band(words: list[str], found: list[str], low: int, high: int, lowest: int, highest: int, best: tuple[int, int, int], last: int) -> tuple[tuple[int, int, int], int]:
    """The better of `best` and the best local alignment in text words [low, high) whose cells have text place less template place in
    [lowest, highest]: score, matched words, first place (negative), and its last place."""
    nothing = (0, 0, 0)
    above = [nothing] * (len(words) + 1)
    for j in range(max(low, lowest), min(high, highest + len(words))):
        start = max(0, j - highest)
        word, left, row = found[j], nothing, [nothing] * (len(words) + 1)
        for i in range(start, min(len(words), j - lowest + 1)):
            score, matched, first = above[i]
            if word == words[i]:
                cell = (score + 2, matched + 1, first if matched else -j)
                if cell[:2] > best[:2]:
                    best, last = cell, j
            else:
                cell = (score - 1, matched, first)
            up = above[i + 1]
            if up[0] - 1 > cell[0] or (up[0] - 1 == cell[0] and up[1:] > cell[1:]):
                cell = (up[0] - 1, up[1], up[2])
            if left[0] - 1 > cell[0] or (left[0] - 1 == cell[0] and left[1:] > cell[1:]):
                cell = (left[0] - 1, left[1], left[2])
            left = cell if cell[0] >= 0 and cell[1] else nothing
            row[i + 1] = left
        above = row
    return best, last


def scan(docs: DataFrame, templates: dict[str, str] | None = None, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per match of a template in a document."""
    scanner = Scanner(TEMPLATES if templates is None else templates, **options)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = [
                (key.as_py(), m.template, m.matched, m.length, m.coverage, first, last)
                for key, value in zip(batch.column(0), batch.column(1), strict=True) for m, first, last in scanner.scan(value.as_py())
            ]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, SCHEMA)
