r"""License scan by patience alignment of texts with templates.

Words are runs of letters and digits (inner dots and hyphens stay), lower-cased.
Where a text may hold a template it is aligned as in a patience sort: words that
occur once in both are anchors, the longest increasing subsequence of anchors
stands, and each gap between them is aligned in the same way; a gap without
anchors is aligned by its longest common subsequence. The coverage is the share
of the template's words that are aligned.

Words that tell licenses apart (name, version, variant: ``TELLING``) must stand
in the text as a whole, in one of their spellings; they count as aligned and the
rest is aligned on either side of them. A short line with another name or version
is thus another license, however many of its words agree.

A text holds a template where words that cover enough of it lie within a stretch
of twice its length. Only such stretches, and as many words on either side as the
template has, are aligned.

Scale: one pass over whole texts, no shuffle; templates are a fixed list of about
0.3 MB that is sent to all tasks.

Defined cases: a null or empty text holds nothing; repeated rows are reported
each; of several places with a template the best counts, then the first; other
columns take no part.
"""

from __future__ import annotations

import pkgutil
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame

from tenantlens.llm.common import texts

WORD = re.compile(rb"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?")
LEAST_COVERAGE = 0.8
STRETCH = 2  # times a template's length in which its words must lie
LINE = 15  # words of a line at most: what belongs to its telling words stands close to them
# fixed values: whole texts of public licenses (licenses/NAME.txt), notices and lines
WHOLE = (
    "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-1.0",
    "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "Unlicense",
)
TEMPLATES = {name: pkgutil.get_data(__package__, f"licenses/{name}.txt").decode() for name in WHOLE} | {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD line": "Released under the BSD License.",
    "BSD-2-Clause line": "Released under the 2-Clause BSD License.",
    "BSD-3-Clause line": "Released under the 3-Clause BSD License.",
    "CC0-1.0 line": "Released under CC0 1.0.",
    "ISC line": "Released under the ISC License.",
    "MIT line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0 line": "Licensed under the Mozilla Public License, version 2.0.",
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense line": "Released under the Unlicense.",
}
# words that tell a license from others, as patterns of words with single spaces: they must stand together
CLAUSE = "(?:(?:[0-9]|[a-d]|i{1,3}) )?"
TELLING = {
    "Apache-2.0 line": r"apache (?:software )?licen[cs]e(?: version| v)? v?2(?:\.0)?|apache[- ]v?2(?:\.0)?",
    "Apache-2.0 notice": r"apache licen[cs]e(?: version| v)? v?2(?:\.0)?",
    "AGPL-3.0": "this license refers to version 3 of the gnu affero general public license",
    "BSD line": r"(?<!-clause )(?<!new )(?<!modified )(?<!revised )(?<!simplified )bsd(?! [0-9]-clause)",
    "BSD-2-Clause": f"(?:the|this) (?:distribution|distributions) {CLAUSE}this software is provided",
    "BSD-2-Clause line": r"bsd[- ]2-clause|2-clause bsd|simplified bsd",
    "BSD-3-Clause": r"(?:the distribution|conditions and the following disclaimer in the documentation [a-z -]{0,80}) "
    f"{CLAUSE}(?:neither )?the names?",
    "BSD-3-Clause line": r"bsd[- ]3-clause|3-clause bsd|(?:new|modified|revised) bsd",
    "CC0-1.0 line": r"(?:cc0|creative commons zero)(?:[- ]v?1\.0)?|cc0-1\.0",
    "GPL-1.0": "gnu general public license version 1",
    "GPL-2.0": "the terms of this general public license",
    "GPL-3.0": "this license refers to version 3 of the gnu general public license",
    "ISC line": "isc",
    "LGPL-2.0": "the terms of this library general public license",
    "LGPL-2.1": "the terms of this lesser general public license",
    "LGPL-3.0": r"(?:this license refers to version 3 of the gnu lesser general public license|"
    r"gnu lesser general public license version 3)",
    "MIT line": "mit",
    "MPL-2.0 line": r"mozilla public licen[cs]e(?: mpl)?(?: version| v)? v?2(?:\.0)?|mpl[- ]?v?2(?:\.0)?",
    "MPL-2.0 notice": r"mozilla public licen[cs]e(?: version| v)? v?2(?:\.0)?",
    "Unlicense line": "unlicense",
}
# one of these must be in a text before the patterns of a family are tried
HINTS = {"AGPL": (b"general public", b"gpl"), "CC-": (b"creative commons", b"cc by", b"cc-by")}
HINTS |= {"GPL": HINTS["AGPL"], "LGPL": HINTS["AGPL"]}
GNU = (
    ("AGPL", "GNU Affero General Public License", ("3",)),
    ("GPL", "GNU General Public License", ("1", "2", "3")),
    ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
    ("LGPL", "GNU Library General Public License", ("2",)),
)
for short, full, versions in GNU:
    for version in versions:
        name = f"{short}-{version}" if "." in version else f"{short}-{version}.0"
        what = "library" if short == "LGPL" else "program"
        TEMPLATES[f"{name} line"] = f"Licensed under the {full}, version {version}."
        TEMPLATES[f"{name} notice"] = (
            f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {full} as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
            f"later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
            "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
            f"{full} for more details."
        )
        number = f"v?{re.escape(version)}" + ("" if "." in version else r"(?:\.0)?") + r"(?:\+|-only|-or-later)?"
        named = full.lower() if short != "AGPL" else "(?:gnu )?affero general public license"
        between = r"(?: (?!v[0-9])[a-z]\S*)"
        TELLING[f"{name} line"] = (
            f"{named}{between}{{0,3}} {number}|(?:gnu )?{short.lower()}(?:[- ]version)?[- ]?{number}"
        )
        TELLING[f"{name} notice"] = f"{named}{between}{{0,12}} {number}"

CC = (
    ("BY",), ("BY", "NC"), ("BY", "NC", "ND"), ("BY", "NC", "SA"), ("BY", "ND"), ("BY", "SA"),
)
CC_NAMES = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
CC_WORDS = {"BY": "attribution", "NC": "non-?commercial", "ND": "no-?deriv(?:ative)?s?(?:[- ]works)?", "SA": "share-?alike"}
for parts in CC:
    code, full = "-".join(parts), "-".join(CC_NAMES[p] for p in parts)
    named = "[- ]".join(parts).lower() + "|" + "[- ]".join(CC_WORDS[p] for p in parts)
    for version in ("4.0", "3.0", "2.5", "2.0"):
        name, number = f"CC-{code}-{version}", f"v?{version[0]}" + (r"(?:\.0)?" if version.endswith(".0") else r"\.5")
        kind = r"(?:[- ](?:international|unported|generic|version|licen[cs]e|public))*"
        TEMPLATES[f"{name} line"] = f"Licensed under CC {code} {version}."
        TELLING[f"{name} line"] = f"(?:cc|creative commons)[- ](?:{named}){kind}[- ]{number}"
    # the variants of 4.0 have most of their text in common; NC and ND stand as that text under their own title
    base = TEMPLATES["CC-BY-SA-4.0" if "SA" in parts else "CC-BY-4.0"]
    own = "Attribution-ShareAlike" if "SA" in parts else "Attribution"
    TEMPLATES[f"CC-{code}-4.0"] = base.replace(f"{own} 4.0 International Public", f"{full} 4.0 International Public")
    TELLING[f"CC-{code}-4.0"] = "(?:" + "[- ]".join(CC_WORDS[p] for p in parts) + ") 4.0 international(?: public license)?"


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def joined(found: list[bytes]) -> bytes:
    return b" %b " % b" ".join(found)


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs rising in both parts; pairs come by first part, equal ones by falling second."""
    tails: list[int] = []  # last second part of the best run of each length
    at: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        place = bisect_left(tails, j)
        before.append(at[place - 1] if place else -1)
        if place == len(tails):
            tails.append(j)
            at.append(n)
        else:
            tails[place], at[place] = j, n
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Aligned positions (in text, in template), rising in both."""
    out: list[tuple[int, int]] = []
    open_gaps = [(0, len(text), 0, len(template))]
    while open_gaps:
        a, b, c, d = open_gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        own, other = Counter(text[a:b]), Counter(template[c:d])
        place = {w: j for j, w in enumerate(template[c:d], c) if other[w] == 1 and own.get(w) == 1}
        anchors = longest_increasing([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place])
        if anchors:
            i0, j0 = a, c
            for i, j in anchors:
                open_gaps.append((i0, i, j0, j))
                i0, j0 = i + 1, j + 1
            open_gaps.append((i0, b, j0, d))
            out += anchors
        else:
            where: dict[bytes, list[int]] = {}
            for j in reversed(range(c, d)):
                where.setdefault(template[j], []).append(j)
            out += longest_increasing([(i, j) for i in range(a, b) for j in where.get(text[i], ())])
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, least: float, telling: str | None = None):
        self.name, self.words = name, words(text.encode())
        self.counts = Counter(self.words)
        self.need = max(1, ceil(len(self.words) * least - 1e-9))
        self.telling = telling and re.compile(b"(?<= )(?:%b)(?= )" % telling.encode())
        self.there = self.need  # words of the template that a text must have before it is looked at
        if self.telling:
            self.hints = next((h for family, h in HINTS.items() if name.startswith(family)), (b"",))
            self.told = next(self.told_in(joined(self.words)))
            self.there -= self.told[1] - self.told[0]

    def told_in(self, text: bytes) -> Iterator[tuple[int, int]]:
        """First and last position of the telling words, wherever they stand."""
        at = n = 0
        if not any(h in text for h in self.hints):
            return
        for m in self.telling.finditer(text):
            n, at = n + text.count(b" ", at, m.start()), m.start()
            yield n - 1, n + m[0].count(b" ")

    def stretches(self, at: list[int]) -> Iterator[tuple[int, int]]:
        """Parts of a text where hits lie close enough, from its hit positions; overlapping ones joined."""
        span, start, stop = STRETCH * len(self.words), None, None
        for first, last in zip(at, at[self.need - 1 :], strict=False):
            if last - first >= span:
                continue
            if stop is not None and first <= stop:
                stop = last + 1
                continue
            if start is not None:
                yield start, stop
            start, stop = first, last + 1
        if start is not None:
            yield start, stop

    def best(self, text: list[bytes], line: bytes | None = None) -> tuple[int, int, int] | None:
        """Words aligned, first and last position of the best place; ``line`` is the text as ``joined`` has it."""
        return self.best_told(text, line or joined(text)) if self.telling else self.best_of_stretches(text)

    def best_of_stretches(self, text: list[bytes]) -> tuple[int, int, int] | None:
        hits = [i for i, w in enumerate(text) if w in self.counts]
        found = None
        for a, b in self.stretches(hits):
            a, b = max(0, a - len(self.words)), min(len(text), b + len(self.words))
            pairs = align(text[a:b], self.words)
            if len(pairs) >= self.need and (found is None or len(pairs) > found[0]):
                found = len(pairs), a + pairs[0][0], a + pairs[-1][0] + 1
        return found

    def best_told(self, text: list[bytes], line: bytes) -> tuple[int, int, int] | None:
        """As above; the telling words are an anchor, and what lies before and behind is aligned from there."""
        c, d = self.told
        before, behind = self.words[:c][::-1], self.words[d:]
        short = len(self.words) <= LINE
        back, on = (STRETCH * (n + 1 if short else len(self.words)) for n in (len(before), len(behind)))
        found = hits = None
        for p, q in self.told_in(line):
            if hits is None:
                hits = [i for i, w in enumerate(text) if w in self.counts]
            a, b = max(0, p - back), min(len(text), q + on)
            near = bisect_left(hits, p) - bisect_left(hits, a) + bisect_left(hits, b) - bisect_left(hits, q)
            if near + d - c < self.need:
                continue
            left, right = align(text[a:p][::-1], before), align(text[q:b], behind)
            n = len(left) + d - c + len(right)
            if short and 2 * (n - (d - c)) < len(before) + len(behind):
                continue  # a name alone says nothing
            if n >= self.need and (found is None or n > found[0]):
                found = n, p - 1 - left[-1][0] if left else p, q + right[-1][0] + 1 if right else q
                if n == len(self.words):
                    break
        return found


def find_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    least: float = LEAST_COVERAGE,
    telling: dict[str, str] | None = None,
) -> DataFrame:
    """doc_id, license, coverage, n_aligned, start_word, end_word: a row per template that a text holds."""
    chosen = dict(TEMPLATES if templates is None else templates)
    tells = dict(TELLING if templates is None and telling is None else telling or {})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t for t in (Template(n, x, least, tells.get(n)) for n, x in chosen.items()) if t.words]
        vocabulary = set().union(*(t.counts for t in known))
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                own = words(text or b"")
                there, line = vocabulary.intersection(own), joined(own)
                for t in known:
                    if sum(t.counts[w] for w in there) >= t.there and (found := t.best(own, line)):
                        n, start, stop = found
                        out.append((doc_id, t.name, n / len(t.words), n, start, stop))
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "license", "coverage", "n_aligned", "start_word", "end_word"]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, license string, coverage double, n_aligned long, start_word long, end_word long"
    )
