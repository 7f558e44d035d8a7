"""License scans by patience alignment (operator 8).

A template is a list of words.  A text is aligned with it recursively: words that occur once in
both sides are anchors; the longest increasing subsequence of their positions (patience sorting)
is kept; the stretches between kept anchors, after equal words beside the anchors are taken, are
aligned in the same way; a stretch without common unique words ends the recursion.  Coverage is the share of the template's words that
are matched.  A license is found where coverage reaches ``LEAST``.

Long texts: a template can only be covered inside a window of a few template lengths, so windows
are opened around every stretch of text that holds enough template words (found by one pass over
word hashes).  A window may hold a notice several times, and then no word is unique in it: it is
aligned from each template word that enough distinct template words follow, at several lengths,
and every copy found counts; a window without any is aligned in slices.  Of notices that overlap
the one of best coverage stays, so a text gives each license it declares, with its place.  Words that
tell a license from its relatives (``NAMED``: name, version, terms) must be matched as they stand.

Words are lower-cased runs of ASCII letters, digits and bytes beyond ASCII.

Cases: null or empty text: no row of coverage, ``license`` null; ties between templates go to the
longer template, then to the name, then to the first place; every row of the input gives one row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import texts as T

LEAST = 0.8
#: window of text that is aligned, in template lengths, and the lengths tried from a word
ROOM = 3
LENGTHS = (1, 1.5, 2, ROOM)

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")

# Statements by which texts declare public licenses, and whole texts of short licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD": "Licensed under the BSD License",
    "BSD-2-Clause": _BSD_2 + _AS_IS,
    "BSD-3-Clause": _BSD_2 + (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. ") + _AS_IS,
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "released into the public domain under CC0 1.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "MIT": "Released under the MIT License",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
        "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend "
        "this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
        "under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
}

# The words that tell a license from its relatives.  They must be matched with nothing else between
# them; those in brackets may be missing.
NAMED = {
    "Apache-2.0": "Apache License [Version] 2.0",
    "Apache-2.0-notice": "Apache License [Version] 2.0",
    "BSD": "BSD License",
    "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "CC0-1.0": "CC0 1.0",
    "GPL-3.0": "GNU General Public License [version] 3",
    "GPL-notice": "version 3 of the License",
    "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License [v] 2.0",
}

NOTICE = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def split_words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.translate(T.LOWER.tobytes()))


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    top_at: list[int] = []
    back: list[int] = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back[i] = top_at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            top_at.append(i)
        else:
            tops[pile] = v
            top_at[pile] = i
    out = []
    i = top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Matched positions of template ``a`` and text ``b``, increasing on both sides."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a.get(w) == 1}
        pairs = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in where]
        if not pairs:
            continue
        kept = [pairs[i] for i in increasing([j for _, j in pairs])]
        out.extend(kept)
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        work.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1)
    return sorted(out)


def name_places(template: list[bytes], phrase: str) -> tuple[range, set[int]]:
    """Where a name stands in its template, and which of its words may not be missing."""
    words = split_words(phrase.replace("[", " ").replace("]", " ").encode())
    optional = {w for x in re.findall(r"\[(.*?)\]", phrase) for w in split_words(x.encode())}
    at = next(i for i in range(len(template)) if template[i:i + len(words)] == words)
    return range(at, at + len(words)), {at + i for i, w in enumerate(words) if w not in optional}


class Scanner:
    def __init__(self, templates: dict[str, str], least: float, named: dict[str, str] | None = None):
        self.least = least
        self.names = sorted(templates)
        self.words = {n: split_words(templates[n].encode()) for n in self.names}
        self.hashes = {}
        for n in self.names:
            joined = b" ".join(dict.fromkeys(self.words[n]))
            data = np.frombuffer(joined, np.uint8)
            self.hashes[n] = np.sort(T.words(data, np.array([0, len(data)])).hash)
        self.all = np.unique(np.concatenate(list(self.hashes.values())))
        self.named = {n: name_places(self.words[n], phrase) for n, phrase in (named or {}).items() if n in self.words}

    def share(self, name: str, pairs: list[tuple[int, int]]) -> float:
        """The template's coverage by an alignment, 0 where the license's name is not matched as it stands."""
        if name in self.named:
            places, required = self.named[name]
            spot = {i: j for i, j in pairs if i in places}
            if not required <= spot.keys() or max(spot.values()) - min(spot.values()) + 1 != len(spot):
                return 0.0
        return len(pairs) / len(self.words[name])

    def windows(self, hashes: np.ndarray, name: str) -> list[tuple[int, int]]:
        """Word ranges that may hold the template: enough hits within one template length and a half."""
        own = self.hashes[name]
        at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
        hit = np.flatnonzero(own[at] == hashes)
        # coverage needs this many matched words, hence hits, inside the aligned room
        need = int(np.ceil(self.least * len(self.words[name])))
        room = ROOM * len(self.words[name])
        if len(hit) < need:
            return []
        span = hit[need - 1:] - hit[:len(hit) - need + 1]
        start = hit[:len(span)][span < room]
        if not len(start):
            return []
        cut = np.flatnonzero(np.diff(start) > room) + 1
        return [(max(0, int(g[0]) - room), int(g[-1]) + 2 * room) for g in np.split(start, cut)]

    def possible(self, w: T.Words) -> list[int]:
        """Documents of a block with a window for some template."""
        if not len(w.hash):
            return []
        at = np.minimum(np.searchsorted(self.all, w.hash), len(self.all) - 1)
        hit = np.flatnonzero(self.all[at] == w.hash)
        which = at[hit]
        docs: set[int] = set()
        for name in self.names:
            own = hit[np.isin(self.all, self.hashes[name])[which]]
            need = int(np.ceil(self.least * len(self.words[name])))
            if len(own) < need:
                continue
            first, last = own[:len(own) - need + 1], own[need - 1:]
            near = (last - first < ROOM * len(self.words[name])) & (w.doc[first] == w.doc[last])
            docs.update(w.doc[first[near]].tolist())
        return sorted(docs)

    def copies(self, text: list[bytes], name: str, low: int, high: int) -> list[tuple[float, int, int]]:
        """(coverage, first, end) of the notices of one template in ``text[low:high]``, in order."""
        template = self.words[name]
        size, kinds = len(template), set(template)
        # a lost template word takes at most one distinct word with it
        least = len(kinds) - (size - int(np.ceil(self.least * size)))
        hits = [i for i in range(low, min(high, len(text))) if text[i] in kinds]
        out: list[tuple[float, int, int]] = []
        held: Counter = Counter()
        to, past = 0, low
        best: tuple[float, int, int] | None = None
        for k, p in enumerate(hits):
            if k:
                w = text[hits[k - 1]]
                held[w] -= 1
                if not held[w]:
                    del held[w]
            while to < len(hits) and len(held) < least:
                held[text[hits[to]]] += 1
                to += 1
            if len(held) < least:
                break
            if best and (best[0] == 1 or p >= best[2] or p > until):
                out.append(best)
                best, past = None, best[2]
            if p < past or hits[to - 1] - p >= ROOM * size:
                continue
            for length in LENGTHS:
                end = p + int(np.ceil(length * size))
                if end < hits[to - 1]:
                    continue
                pairs = align(template, text[p:end])
                share = self.share(name, pairs)
                if share >= self.least and (best is None or (share > best[0] and p + pairs[0][1] < best[2])):
                    if best is None:
                        until = p + size // 2  # later starts that may give a better alignment of this copy
                    best = (share, p + pairs[0][1], p + pairs[-1][1] + 1)
                    if share == 1:
                        break
        return out + [best] if best else out

    def every(self, text: list[bytes], hashes: np.ndarray) -> list[tuple[str, float, int, int]]:
        """(name, coverage, first, end) of every notice, best first; none overlap."""
        found = []
        for name in self.names:
            template = self.words[name]
            size = len(template)
            for low, high in self.windows(hashes, name):
                copies = self.copies(text, name, low, high)
                found += [(share, size, name, first, end) for share, first, end in copies]
                step = ROOM * size
                for at in range(low, max(low + 1, min(high, len(text))), step) if not copies else ():
                    part = text[at:at + 2 * step]
                    pairs = align(template, part)
                    share = self.share(name, pairs)
                    if share >= self.least:
                        found.append((share, size, name, at + pairs[0][1], at + pairs[-1][1] + 1))
        found.sort(key=lambda x: (-x[0], -x[1], x[2], x[3]))
        out: list[tuple[str, float, int, int]] = []
        starts: list[int] = []  # accepted notices by place
        ends: list[int] = []
        for share, _, name, first, end in found:
            k = bisect_left(starts, end)
            if k and ends[k - 1] > first:
                continue
            starts.insert(k, first)
            ends.insert(k, end)
            out.append((name, share, first, end))
        return out

    def best(self, text: list[bytes], hashes: np.ndarray):
        """(name, coverage, first, end) of the best template, or None."""
        return next(iter(self.every(text, hashes)), None)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, license, coverage, first_word, end_word, notices) of each row: the best notice, nulls where no
    license is declared, and every notice in the order of the text."""
    named = NAMED if templates is None else {}
    templates = TEMPLATES if templates is None else templates
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least, named)
        # bytes that split_words takes as words; the same runs are hashed here
        for block in T.blocks(batches):
            w = T.words(block.data, block.offsets, lower=True, between=T.NOT_ALNUM)
            found = [None] * len(block)
            notices: list[list[dict]] = [[] for _ in found]
            for d in scanner.possible(w):
                text = block.data[block.offsets[d]:block.offsets[d + 1]].tobytes()
                every = scanner.every(split_words(text), w.hash[w.bounds[d]:w.bounds[d + 1]])
                found[d] = every[0] if every else None
                notices[d] = [dict(zip(NOTICE.names, x)) for x in sorted(every, key=lambda x: x[2])]
            column = lambda i, t: pa.array([None if x is None else x[i] for x in found], t)
            ids = block.batch.column(0).slice(block.first_row, len(block))
            yield pa.RecordBatch.from_arrays(
                [ids, column(0, pa.string()), column(1, pa.float64()), column(2, pa.int64()), column(3, pa.int64()),
                 pa.array(notices, pa.list_(NOTICE))],
                names=[id_col, "license", "coverage", "first_word", "end_word", "notices"])

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"`{id_col}` {kind}, license string, coverage double, first_word long, end_word long, "
                            "notices array<struct<license: string, coverage: double, first_word: long, end_word: long>>")
