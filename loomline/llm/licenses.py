"""License scans (operator 5): sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Templates are whole licences and headers; each of their paragraphs is a template, too (one that several licences share
counts for the first of them), and so is each whole licence. Of every text the lines and the paragraphs (wrapped lines
joined, marks of comments taken off) are compared with them as sparse TF-IDF vectors, and of a licence file (LICENSE,
COPYING, NOTICE and so on) the whole text, which goes before its parts. Words that no template has weigh as the rarest
do, so prose around a notice lowers its cosine. A vector can reach the threshold only if it has one of those words of the
template without which the rest is too short (the longest first, common ones last), so only lines with such a word, and their
paragraphs, are weighed; they are found by one automaton.
A file without a licence of its own takes that of the nearest directory at or above its own that a licence file is in.
Notices in other files hold for these files alone. Directories, not files, are joined with their ancestors.

Defined cases: null and empty texts have no licence of their own; very long texts are scanned whole; a null path is the
root; of several notices in a file the best counts, then the first name, then the first line; of several licence files of
a directory the best, then the least file id; rows that repeat a path or an id are rows of their own; an empty table
gives no rows; extra columns play no part.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import chunks
from loomline.session import cut

THRESHOLD = 0.6
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_ONE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_TWO = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THREE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(name: str, version: str, later: str) -> str:
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, {later}

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.

This work is licensed under the GNU {name}, version {version}."""


#: Published licence texts, headers and usual short notices by SPDX identifier; paragraphs by blank lines.
TEMPLATES = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_OPENING}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n{_BSD_END}"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_OPENING}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n{_BSD_THREE}\n\n{_BSD_END}"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", _gnu("General Public License", "2", "either version 2 of the License, or (at your option) any later version.")),
    ("GPL-3.0", _gnu("General Public License", "3", "either version 3 of the License, or (at your option) any later version.")),
    ("LGPL-3.0", _gnu("Lesser General Public License", "3", "either version 3 of the License, or (at your option) any later version.")),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", "Released under the ISC License."),
    ("MIT", f"""MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

{_AS_IS}"""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", f"""This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

{_AS_IS}"""),
]
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"
_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
#: Anchors are chosen among these last; the choice changes no result.
_COMMON = frozenset("in is it be at or to of by on an as if no so do a the that with this are from and for not but you your can may other such will more one all any has have was were when which use work into over than these those there their about even".split())
#: Next to these a word's letters are part of a longer word.
_INSIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
#: Marks of comments at the ends of a line.
_MARKS = re.compile(r"^\s*(?://+|/\*+|\*+/?|#+|--+|;+|<!--+|%+)?\s*|\s*(?:\*+/|--+>)?\s*$")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def paragraphs(lines: list[str]) -> list[int]:
    """The first line of the paragraph that each line is in; -1 for lines that are blank but for marks of comments."""
    out, start = [], -1
    for i, line in enumerate(lines):
        start = -1 if not _MARKS.sub("", line) else i if start < 0 else start
        out.append(start)
    return out


def joined(lines: list[str]) -> str:
    """Lines as one, without marks of comments."""
    return " ".join(_MARKS.sub("", x) for x in lines)


def pieces(templates: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Whole templates and their paragraphs; a piece that several templates have counts for the first."""
    out: dict[tuple, tuple[str, str]] = {}
    for name, text in templates:
        for piece in (text, *text.split("\n\n")):
            out.setdefault(tuple(_words(piece)), (name, piece))
    return list(out.values())


class Matcher:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD):
        import ahocorasick

        self.pieces = pieces(templates)
        self.threshold, self.names = threshold, [n for n, _ in self.pieces]
        bags = [Counter(_words(t)) for _, t in self.pieces]
        df = Counter(w for b in bags for w in b)
        self.idf = {w: math.log((1 + len(bags)) / (1 + n)) + 1 for w, n in df.items()}
        self.rare = math.log(1 + len(bags)) + 1
        self.postings: dict[str, list[tuple[int, float]]] = {}
        anchors: set[str] = set()
        for t, bag in enumerate(bags):
            v = self._vector(bag)
            left = 1.0
            for w, x in sorted(v.items(), key=lambda x: (x[0] in _COMMON, -len(x[0]), -x[1], x[0])):
                self.postings.setdefault(w, []).append((t, x))
                if left >= threshold**2 * 0.999:  # without the words so far the rest can still reach it
                    anchors.add(w)
                    left -= x * x
        self.automaton = ahocorasick.Automaton()
        for w in anchors:
            self.automaton.add_word(w, w)
        self.automaton.make_automaton()

    def _vector(self, bag: Counter) -> dict[str, float]:
        v = {w: (1 + math.log(n)) * self.idf.get(w, self.rare) for w, n in bag.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    def match(self, text: str) -> tuple[float, str] | None:
        """Best cosine of a piece of text and its licence, if the threshold is reached."""
        scores: Counter = Counter()
        for w, x in self._vector(Counter(_words(text))).items():
            for t, y in self.postings.get(w, ()):
                scores[t] += x * y
        best = min(((-round(s, 9), self.names[t]) for t, s in scores.items() if s >= self.threshold), default=None)
        return best and (min(1.0, -best[0]), best[1])

    def scan(self, text: str | None, whole: bool) -> tuple[str | None, float, int]:
        """Licence, cosine and line of a text's best notice; whole: of the text as one piece, if that is a licence."""
        if not text:
            return None, 0.0, -1
        if whole and (m := self.match(joined(text.split("\n")))):
            return m[1], m[0], 0
        lines = text.split("\n")
        starts, at = [], 0
        for line in lines:
            starts.append(at)
            at += len(line.lower()) + 1
        low = text.lower()
        near = lambda at: 0 <= at < len(low) and low[at] in _INSIDE
        hits = sorted({bisect_right(starts, end) - 1 for end, w in self.automaton.iter(low) if not near(end + 1) and not near(end - len(w))})
        found = [(m, i) for i in hits if (m := self.match(lines[i]))]
        if hits:
            of = paragraphs(lines)
            for start in sorted({of[i] for i in hits} - {-1}):
                end = start + 1
                while end < len(lines) and of[end] == start:
                    end += 1
                if end > start + 1 and (m := self.match(joined(lines[start:end]))):
                    found.append((m, start))
        if not found:
            return None, 0.0, -1
        (score, name), line = min(found, key=lambda x: (-x[0][0], x[0][1], x[1]))
        return name, score, line


_MATCHERS: dict = {}


def _matcher(templates: list[tuple[str, str]], threshold: float) -> Matcher:
    """One matcher for each worker process and set of templates."""
    key = (tuple(templates), threshold)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(templates, threshold)
    return _MATCHERS[key]


def _scan(templates: list[tuple[str, str]], threshold: float):
    licence_file = re.compile(LICENCE_FILE)

    def run(batches):
        m = _matcher(templates, threshold)
        for b in chunks(batches, "text"):
            names, scores, declares = [], [], []
            for text, path in zip(b["text"].to_pylist(), b["path"].to_pylist(), strict=True):
                own = bool(path and licence_file.match(path.rsplit("/", 1)[-1]))
                name, score, _ = m.scan(text, own)
                names.append(name)
                scores.append(score)
                declares.append(name is not None and own)
            yield pa.RecordBatch.from_arrays([b["id"], b["path"], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(declares, pa.bool_())], ["id", "path", "license", "score", "declares"])

    return run


def scan_licenses(files: DataFrame, id_col: str, path_col: str, text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """id, license, score, origin (own, inherited, none) and declared_by for each row."""
    base = files.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"), F.col(text_col).alias("text"))
    kind = dict(base.dtypes)["id"]
    own = base.mapInArrow(_scan(templates, threshold), f"id {kind}, path string, license string, score double, declares boolean")
    own = cut(own.withColumn("dir", F.regexp_extract("path", r"^(.*)/", 1)).drop("path"))  # small rows: no text
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("id"), "license"))
    declared = own.where("declares").groupBy("dir").agg(best.alias("b")).select(F.col("dir").alias("above"), F.col("b.license").alias("inherited"), F.col("b.id").alias("by"))
    dirs = own.where("license is null").select("dir").distinct()
    steps = F.split("dir", "/")
    ancestors = dirs.select("dir", F.explode(F.concat(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")), F.array(F.lit("")))).alias("above")).distinct()
    nearest = ancestors.join(declared, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), "inherited", "by")).alias("x")).select("dir", "x.inherited", "x.by")
    out = own.join(nearest, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        "id", F.coalesce("license", "inherited").alias("license"), "score",
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("id")).otherwise(F.col("by")).alias("declared_by"),
    )
