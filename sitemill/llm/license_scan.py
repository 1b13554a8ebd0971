"""Licence notices by the Dice coefficient over word bigrams (operator 10)."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .substring_dedup import units

DICE = 0.8
WORD = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*")

#: Notices and licence texts, by the name that a match reports. Version numbers are
#: compared as numbers of any value.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "Released under the Apache License, Version 2.0."),
    ("Apache", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "Licensed under the GNU General Public License, version 2 or later."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND", "Licensed under CC BY-ND 4.0."),
    ("CC0", "Released under CC0 1.0 Universal public domain dedication."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
        "use of this software.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
        "use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or "
        "altered from any source distribution.",
    ),
)


def word_list(text: str) -> list[str]:
    """Lower-case words; numbers are alike."""
    return ["#" if x[0].isdigit() else x for x in WORD.findall(text.lower())]


def bigrams(text: str) -> Counter[tuple[str, str]]:
    """Word bigrams with repeats; a single word pairs with nothing."""
    w = word_list(text)
    return Counter(zip(w, w[1:], strict=False)) if len(w) != 1 else Counter({(w[0], ""): 1})


def dice(a: Counter, b: Counter) -> float:
    """Twice the common bigrams over all bigrams of both."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Scanner:
    """Finds runs of consecutive units that match a template."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = DICE):
        self.threshold = threshold
        self.templates = [(name, bigrams(text)) for name, text in templates]
        self.sizes = [b.total() for _, b in self.templates]
        self.having: dict[tuple[str, str], list[int]] = {}
        for i, (_, b) in enumerate(self.templates):
            for g in b:
                self.having.setdefault(g, []).append(i)

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(name, dice, start, end) of the matches in order, best first where they overlap.

        A coefficient of t needs sizes within t/(2-t) and (2-t)/t of each other, and t/(2-t) of the
        template's bigrams in common. A run starts at a unit with a bigram of the template (one
        that runs into the next words counts), grows until it is too large, whatever it passes, and is
        only tried where so many of the template's bigrams stand in reach.
        """
        low, high = self.threshold / (2 - self.threshold), (2 - self.threshold) / self.threshold
        spans = units(text)
        words: list[str] = []
        ends = []  # words up to the end of each unit; units end behind white space, so no word crosses
        for a, b in spans:
            words += word_list(text[a:b])
            ends.append(len(words))
        pairs = list(zip(words, words[1:], strict=False))
        at: dict[int, list[int]] = {}  # for each template the places of its bigrams
        for k, g in enumerate(pairs):
            for t in self.having.get(g, ()):
                at.setdefault(t, []).append(k)
        starts = [0, *ends[:-1]]
        found: list[tuple[float, int, int, str]] = []
        for t, places in at.items():
            name, own, size = self.templates[t][0], self.templates[t][1], self.sizes[t]
            least, most = size * low - 1e-9, size * high + 1e-9
            if len(places) < least:
                continue
            for i in sorted({bisect_right(ends, k) for k in places}):
                p = starts[i]
                k = bisect_left(places, p)
                if bisect_left(places, p + most) - k < least:
                    continue
                run: Counter[tuple[str, str]] = Counter()
                common, q = 0, p
                for j in range(i, len(spans)):
                    n = ends[j] - 1 - p
                    if n > most:
                        break
                    for g in pairs[q : ends[j] - 1]:
                        run[g] += 1
                        common += run[g] <= own[g]
                    q = max(q, ends[j] - 1)
                    if n >= least and n > 0 and (d := 2 * common / (n + size)) >= self.threshold:
                        found.append((round(d, 9), spans[i][0], spans[j][1], name))
        for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
            if b - a == 1:
                found += [(1.0, *spans[i], self.templates[t][0]) for t in self.having.get((words[a], ""), ())]
        out: list[tuple[str, float, int, int]] = []
        for d, a, b, name in sorted(found, key=lambda x: (-x[0], x[1], x[2], x[3])):
            if all(b <= x or a >= y for _, _, x, y in out):
                out.append((name, d, a, b))
        return sorted(out, key=lambda x: (x[2], x[3]))


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = DICE
) -> DataFrame:
    """doc_id, n_matches, best, licenses: one row for each input row.

    ``licenses`` has a struct (license, dice, start, end) for each notice found, in order, with code
    point offsets into the whole text; ``best`` is the name of the closest. Units are lines and the
    sentences in them. Null and empty texts have none. Rows of one id each give a row; extra columns
    are ignored. No shuffle: templates are a fixed table of this module or the caller.
    """
    kind = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for b in batches:
            hits = [scanner.scan(t) if t else [] for t in b.column(1).to_pylist()]
            best = [max(h, key=lambda x: (x[1], -x[2]))[0] if h else None for h in hits]
            rows = [[dict(zip(("license", "dice", "start", "end"), x, strict=True)) for x in h] for h in hits]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(h) for h in hits], pa.int32()), pa.array(best, pa.string()), pa.array(rows, pa.list_(kind))],
                names=["doc_id", "n_matches", "best", "licenses"],
            )

    cols = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return cols.mapInArrow(run, "doc_id long, n_matches int, best string, licenses array<struct<license:string,dice:double,start:int,end:int>>")
