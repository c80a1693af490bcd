"""License scans: patience alignment of texts with license templates."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm import tokens as T
from quarry.llm.license_texts import TEXTS

MIN_COVERAGE = 80            # percent of a template's words that must be aligned

# fixed values: license notices and texts by name
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/."),
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
}

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: {}Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. {}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS "
    "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_NEITHER = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. ")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{} THE "
    "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
#: a GNU header: what is licensed, its license, that license's version
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the Free "
    "Software Foundation, either version {2} of the License, or (at your option) any later version. This {0} is distributed in "
    "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
    "A PARTICULAR PURPOSE. See the {1} for more details. You should have received a copy of the {1} along with this {0}. If not, "
    "see https://www.gnu.org/licenses/.")
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives",
       "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_GNU_NAMES = {"gpl-2.0": ("GNU General Public License", "2"), "gpl-3.0": ("GNU General Public License", "3"),
              "lgpl-2.1": ("GNU Lesser General Public License", "2.1"), "lgpl-3.0": ("GNU Lesser General Public License", "3"),
              "agpl-3.0": ("GNU Affero General Public License", "3")}

# as TEMPLATES: other common notices, headers and full texts
MORE = {
    **{f"{k}-notice": f"Released under the {n} License." for k, n in (
        ("bsd", "BSD"), ("bsd-2-clause", "BSD 2-Clause"), ("bsd-3-clause", "BSD 3-Clause"), ("isc", "ISC"))},
    **{f"{k}-notice": f"This work is licensed under the {n}, version {v}." for k, (n, v) in _GNU_NAMES.items() if k != "gpl-3.0"},
    **{f"{k}-header": _GNU.format("library" if k.startswith("lgpl-2") else "program", n, v) for k, (n, v) in _GNU_NAMES.items() if k != "gpl-3.0"},
    **{f"cc-{k}-4.0-notice": f"Licensed under CC {k.upper()} 4.0." for k in _CC if k != "by-nc"},
    **{f"cc-{k}-4.0-long-notice": f"This work is licensed under a Creative Commons {n} 4.0 International License." for k, n in _CC.items()},
    "cc0-1.0-notice": "Licensed under CC0 1.0.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-2-clause": _BSD.format("1. ", "2. ", ""),
    "bsd-3-clause": _BSD.format("1. ", "2. ", "3. " + _NEITHER),
    "bsd-3-clause-unnumbered": _BSD.format("", "", _NEITHER),
    "isc": _ISC.format(", provided that the above copyright notice and this permission notice appear in all copies."),
    "0bsd": _ISC.format("."),
    **TEXTS,
}

# the words of a template that tell it from others like it; they must stand in the text in one piece
NAMING = {
    "apache-2.0-notice": "Apache License, Version 2.0",
    "mit-notice": "MIT License",
    **{f"{k}-notice": f"{n} License" for k, n in (
        ("bsd", "BSD"), ("bsd-2-clause", "BSD 2-Clause"), ("bsd-3-clause", "BSD 3-Clause"), ("isc", "ISC"))},
    **{f"{k}-notice": f"{n}, version {v}" for k, (n, v) in _GNU_NAMES.items()},
    **{f"{k}-header": f"{n} as published by the Free Software Foundation, either version {v} of the License" for k, (n, v) in _GNU_NAMES.items()},
    **{f"cc-{k}-4.0-notice": f"CC {k.upper()} 4.0" for k in _CC},
    **{f"cc-{k}-4.0-long-notice": f"Creative Commons {n} 4.0 International License" for k, n in _CC.items()},
    "cc0-1.0-notice": "CC0 1.0",
    "mpl-2.0-notice": "Mozilla Public License, v. 2.0",
    "bsd-2-clause": "provided with the distribution. THIS SOFTWARE IS PROVIDED",
    "bsd-3-clause": "provided with the distribution. 3. Neither the name of",
    "bsd-3-clause-unnumbered": "provided with the distribution. Neither the name of",
    "isc": "hereby granted, provided that",
    "0bsd": "hereby granted. THE SOFTWARE IS PROVIDED",
    "apache-2.0": "Apache License Version 2.0, January 2004",
    "cc0-1.0": "CC0 1.0 Universal",
    "gpl-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "mpl-2.0": "Mozilla Public License Version 2.0",
}


def _chain(places: list) -> list:
    """Longest subsequence of (i, j), sorted by i, with growing j, by patience piles."""
    tops, piles, back = [], [], {}
    for i, j in places:
        k = bisect_left(tops, j)
        back[i, j] = piles[k - 1] if k else None
        if k == len(tops):
            tops.append(j)
            piles.append((i, j))
        else:
            tops[k], piles[k] = j, (i, j)
    chain, at = [], piles[-1] if piles else None
    while at:
        chain.append(at)
        at = back[at]
    return chain[::-1]


def _once(words: list, lo: int, hi: int) -> dict:
    """Place of each word that occurs once in words[lo:hi]."""
    found: dict = {}
    for i in range(lo, hi):
        found[words[i]] = -1 if words[i] in found else i
    return {w: i for w, i in found.items() if i >= 0}


def align(a: list, b: list) -> list:
    """Patience alignment of two word lists: matched places (i, j), growing in both.

    Equal ends match; words unique on both sides are anchors; the longest chain of anchors is
    kept, and the gaps between its links are aligned in the same way.
    """
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            matched.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            matched.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        left, right = _once(a, alo, ahi), _once(b, blo, bhi)
        chain = _chain(sorted((i, right[w]) for w, i in left.items() if w in right))
        if chain:
            matched += chain
            ends = [(alo - 1, blo - 1), *chain, (ahi, bhi)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(matched)


def best_alignment(text: list, template: list, vocabulary: set | None = None, name: tuple | None = None):
    """The window of ``text`` with most of the template: (matched, -first word, -last word).

    Windows are twice as long as the template and step by half of it, so each stretch of one and
    a half template lengths is whole in one, and a license that occurs twice does not lose its
    unique words.  With the template's ``vocabulary``, windows that hold too few of its words to
    reach MIN_COVERAGE are passed over.

    With ``name``, the span of the template's naming words, each place where these stand in the
    text in one piece is a start instead, and what is before and after them is aligned on its own.
    """
    n = len(template)
    if name:
        return _named_alignment(text, template, *name)
    step, best = max(1, n // 2), (0, 0, 0)
    need = -(-MIN_COVERAGE * n // 100)
    for lo in range(0, max(1, len(text) - 2 * n + step), step):
        window = text[lo: lo + 2 * n]
        if vocabulary is not None and sum(w in vocabulary for w in window) < need:
            continue
        pairs = align(window, template)
        if pairs:
            best = max(best, (len(pairs), -(lo + pairs[0][0]), -(lo + pairs[-1][0])))
    return best


def _named_alignment(text: list, template: list, lo: int, hi: int):
    words, wide, best = template[lo:hi], 2 * len(template), (0, 0, 0)
    for p in range(len(text) - len(words) + 1):
        if text[p] != words[0] or text[p: p + len(words)] != words:
            continue
        begin, q = max(0, p - wide), p + len(words)
        before = align(text[begin:p], template[:lo])
        after = align(text[q: q + wide], template[hi:])
        first = begin + before[0][0] if before else p
        last = q + after[-1][0] if after else q - 1
        best = max(best, (len(before) + len(words) + len(after), -first, -last))
    return best


def _span(body: list, words: list):
    """Where ``words`` first stand in ``body`` in one piece; None without words."""
    if not words:
        return None
    at = next(i for i in range(len(body)) if body[i: i + len(words)] == words)
    return at, at + len(words)


_FOUND = "doc_id long, license string, matched int, template_words int, coverage int, first_word int, last_word int"


def _scan(templates: dict):
    names = list(templates)

    def run(batches):
        packed, rows = T.bare_word_hashes(pa.array(list(templates.values())))
        bodies = [packed[rows[k]: rows[k + 1]].tolist() for k in range(len(names))]
        packed_names, ends = T.bare_word_hashes(pa.array([NAMING.get(n, "") for n in names]))
        spans = [_span(bodies[k], packed_names[ends[k]: ends[k + 1]].tolist()) for k in range(len(names))]
        vocabulary = np.unique(packed)
        # weight[k, v]: how often template k has word v
        weight = np.array([np.bincount(np.searchsorted(vocabulary, np.array(b, dtype=np.uint64)), minlength=vocabulary.size) for b in bodies])
        for whole in batches:
            for batch in T.pieces(whole):
                h, begin = T.bare_word_hashes(batch.column("text"))
                slot = np.minimum(np.searchsorted(vocabulary, h), vocabulary.size - 1)
                hit = np.flatnonzero(vocabulary[slot] == h)
                row = np.searchsorted(begin, hit, "right") - 1
                # each word of the templates once per row
                row, hit = np.divmod(np.unique(row * vocabulary.size + slot[hit]), vocabulary.size)
                found = []
                for k, body in enumerate(bodies):
                    # a text can align no more of a template than the words it has
                    reach = np.bincount(row, weights=weight[k][hit], minlength=batch.num_rows)
                    for r in np.flatnonzero(100 * reach >= MIN_COVERAGE * len(body)):
                        matched, first, last = best_alignment(h[begin[r]: begin[r + 1]].tolist(), body, set(body), spans[k])
                        if 100 * matched >= MIN_COVERAGE * len(body):
                            found.append((batch.column("doc_id")[int(r)].as_py(), names[k], matched, len(body), 100 * matched // len(body), -first, -last))
                if found:
                    kinds = [pa.int64(), pa.string(), *[pa.int32()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=[f.split()[0] for f in _FOUND.split(", ")])
    return run


def license_scan(docs: DataFrame, templates: dict | None = None) -> DataFrame:
    """One row per document and template of which at least MIN_COVERAGE percent is aligned.

    Columns: doc_id, license (the template's name), matched and template_words, coverage
    (percent, rounded down), first_word and last_word (places in the text, from 0).  Words are
    taken in lower case (A-Z) with marks counted as blanks.  Of several alignments the one with
    most words is given, the earliest of equals.  A template named in NAMING counts only where its
    naming words stand in the text in one piece.  The templates are a fixed list of bounded size
    that goes with the code; each text is read once and nothing is shuffled.

    Null, empty and blank texts give no rows.  A null doc_id is kept.  Equal rows each give their
    rows.  An empty table gives none.
    """
    return docs.select("doc_id", "text").mapInArrow(_scan(templates or {**TEMPLATES, **MORE}), _FOUND)


def op4_license_patience(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    return license_scan(table(spark, sf_dir, "documents"))
