"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are license texts and notices. Runs of ``GRAM`` words are hashed and winnowed: of every ``WINDOW`` hashes in a row
the smallest is kept, so that any ``GRAM + WINDOW - 1`` equal words in a row share a kept hash. An inverted index leads from
a kept hash to the templates and places that have it. Hits on nearby diagonals make a candidate, and a local alignment in a
band around them counts the template's words that the document has in order: that is the coverage, and where they lie is the
span. Names and version numbers within a family of licenses have to agree besides. Documents are neither shuffled nor collected; the index is broadcast, and it is as large as the templates.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import WORD, WordHashes, chained, rows_mapper, words_of

GRAM = 3
WINDOW = 3
BAND = 12
COVERAGE = 0.8
#: Size of all templates together in one scan; more are refused rather than broadcast.
TEMPLATE_BYTES = 64 << 20
#: Words of a document that are winnowed at once, besides the overlap.
CHUNK = 1 << 16

# Words that tell licenses of one family apart, and words that a version number follows.
NAMES = frozenset(["affero", "lesser", "library", "nc", "nd", "noncommercial", "noderivatives", "sa", "sharealike", "zero"])
BEFORE_VERSION = frozenset(["by", "license", "v", "version"])
VERSION = re.compile(r"v?(\d+)")

# Names and texts of widely used licenses and of the notices that refer to them.
_MIT_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)


def _gnu_header(thing: str, name: str, version: str) -> str:
    """The usual notice at the head of a file under a license of the GNU project."""
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
        f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
        f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
    )


TEMPLATES = {
    "AGPL-3.0-header": _gnu_header("program", "GNU Affero General Public License", "3"),
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": f"{_BSD_CONDITIONS} {_BSD_WARRANTY}",
    "BSD-3-Clause": f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_WARRANTY}",
    "BSD-3-Clause-conditions": f"{_BSD_CONDITIONS} {_BSD_NAMES}",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "EPL-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "GPL-2.0-header": _gnu_header("program", "GNU General Public License", "2"),
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": _gnu_header("program", "GNU General Public License", "3"),
    "ISC": (
        f"{_ISC_PERMISSION} THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "ISC-permission": _ISC_PERMISSION,
    "LGPL-2.1-header": _gnu_header("library", "GNU Lesser General Public License", "2.1"),
    "LGPL-3.0-header": _gnu_header("library", "GNU Lesser General Public License", "3"),
    "MIT": (
        f"{_MIT_PERMISSION} THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT-permission": _MIT_PERMISSION,
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. This notice may not be removed or altered from any source "
        "distribution."
    ),
}


@dataclass
class TemplateIndex:
    """Templates as words, with those that tell them apart and the templates that each is a part of, and the inverted index of
    their kept hashes: sorted hashes, template and place of each."""

    names: list[str]
    words: list[list[str]]
    telling: list[list[str]]
    wholes: list[frozenset[str]]
    hashes: np.ndarray
    templates: np.ndarray
    places: np.ndarray


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the hashes that are the smallest, the last of equal ones, of ``window`` in a row; all of a shorter list's
    smallest one."""
    n = len(hashes) - window + 1
    if n < 1:
        return np.arange(len(hashes))[len(hashes) - 1 - np.argmin(hashes[::-1]) :][:1] if len(hashes) else np.empty(0, np.int64)
    best = np.arange(n)
    least = hashes[:n].copy()
    for i in range(1, window):
        other = hashes[i : i + n]
        lower = other <= least
        best, least = np.where(lower, np.arange(n) + i, best), np.where(lower, other, least)
    return np.unique(best)


def grams(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of words; of a text shorter than a run, the hash of all of it."""
    return chained(words, min(GRAM, len(words))) if len(words) else np.empty(0, np.uint64)


def telling(words: list[str]) -> list[str]:
    """Words that tell licenses of one family apart, in order: names, and numbers of versions."""
    out, numbered = [], False
    for before, word, after in zip(["", *words], words, [*words[1:], ""]):
        version = VERSION.fullmatch(word)
        if version and (word[0] == "v" or numbered or before in BEFORE_VERSION or before in NAMES):
            out.append(version[1])
            numbered = True
            continue
        numbered = False
        if word in NAMES and (word != "library" or after == "general"):
            out.append(word)
    return out


def build_index(templates: Mapping[str, str] = TEMPLATES) -> TemplateIndex:
    """The index of the templates that have words; a template shorter than a run of words is found only by itself."""
    hasher = WordHashes()
    names = [name for name in sorted(templates) if words_of(templates[name])]
    words = [words_of(templates[name]) for name in names]
    texts = {name: f" {' '.join(own)} " for name, own in zip(names, words)}
    wholes = [frozenset(w for w, text in texts.items() if texts[name] in text and w != name) for name in names]
    hashes, owner, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, own in enumerate(words):
        runs = grams(hasher.of(own))
        kept = winnow(runs)
        hashes.append(runs[kept])
        owner.append(np.full(len(kept), i))
        places.append(kept)
    all_hashes = np.concatenate(hashes)
    order = np.argsort(all_hashes, kind="stable")
    marks = [telling(own) for own in words]
    return TemplateIndex(names, words, marks, wholes, all_hashes[order], np.concatenate(owner)[order], np.concatenate(places)[order])


def hits(words: np.ndarray, index: TemplateIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template, place in it and place in the document of every kept hash that both have."""
    found = []
    overlap = GRAM + WINDOW - 2
    for begin in range(0, max(1, len(words) - overlap), CHUNK):
        runs = grams(words[begin : begin + CHUNK + overlap])
        kept = winnow(runs)
        low = np.searchsorted(index.hashes, runs[kept], side="left")
        n = np.searchsorted(index.hashes, runs[kept], side="right") - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        found.append((index.templates[at], index.places[at], begin + np.repeat(kept, n)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def align(template: list[str], document: list[str], diagonal: int, band: int = BAND, after: int = 0) -> tuple[int, int, int]:
    """Local alignment of the template with the words near ``diagonal`` (document place minus template place), from the
    document's place ``after`` on.

    Equal words count 1, a skipped or unlike word -0.5. Returns the template words matched and the first and last document
    place of the best alignment; of equally good ones the first to end.
    """
    width = 2 * band + 1
    score = [0.0] * (width + 2)  # of the row before, by place in the band; one cell of room at both ends
    state: list[tuple[int, int]] = [(0, -1)] * (width + 2)
    best, best_state, best_end = 0.0, (0, -1), -1
    for i, word in enumerate(template):
        new_score, new_state = [0.0] * (width + 2), [(0, -1)] * (width + 2)
        for k in range(1, width + 1):
            j = i + diagonal + k - 1 - band
            if not after <= j < len(document):
                continue
            # The cell before on the diagonal has the same k one row up; a skipped template word k + 1, a document word k - 1.
            value, (matched, start) = score[k], state[k]
            if document[j] == word:
                value, matched, start = value + 1, matched + 1, start if start >= 0 else j
            else:
                value -= 0.5
            if score[k + 1] - 0.5 > value:
                value, (matched, start) = score[k + 1] - 0.5, state[k + 1]
            if new_score[k - 1] - 0.5 > value:
                value, (matched, start) = new_score[k - 1] - 0.5, new_state[k - 1]
            if value > 0:
                new_score[k], new_state[k] = value, (matched, start)
                if value > best:
                    best, best_state, best_end = value, (matched, start), j
        score, state = new_score, new_state
    return best_state[0], best_state[1], best_end


def scan(text: str | None, hasher: WordHashes, index: TemplateIndex, least: float = COVERAGE) -> list[tuple]:
    """(name, coverage, matched words, first character, end) of each template found; of overlapping finds the longest, and
    another one only if it is no part of that template and matches a larger share of its own. A find whose names and version
    numbers are not the template's is another license and left out. Characters count in the text as it is, lower-casing does not move them."""
    words = words_of(text)
    template, place, at = hits(hasher.of(words), index)
    if not len(template):
        return []
    out, spans = [], None
    for number in np.unique(template):
        mine = template == number
        diagonals = np.unique(at[mine] - place[mine])
        # Hits on diagonals within half a band of the first one are one candidate.
        starts, last = [], None
        for d in diagonals.tolist():
            if last is None or d - last > BAND // 2:
                starts.append(d)
                last = d
        own, after = index.words[number], 0
        wanted = Counter(own)
        for d in starts:
            # No alignment in the band can match more words than the template shares with that stretch of the document.
            low = max(after, d + BAND // 4 - BAND)
            if (wanted & Counter(words[low : max(low, d + BAND // 4 + BAND + len(own))])).total() < least * len(own):
                continue
            # What an earlier find has taken is not found again from the next one's band.
            matched, first, end = align(own, words, d + BAND // 4, after=after)
            if matched < least * len(own):
                continue
            after = end + 1
            if telling(words[first : end + 1]) != index.telling[number]:
                continue
            if spans is None:
                spans = [m.span() for m in WORD.finditer(text)]
            # Lower-casing can change the number of words only for exotic letters; then the span is the whole text.
            span = (spans[first][0], spans[end][1]) if len(spans) == len(words) else (0, len(text))
            out.append((index.names[number], matched / len(own), matched, *span))
    # Where the finds of two templates overlap, one that matches fewer words and no larger share is the other one's shadow, and
    # so is a part of the other one.
    wholes = dict(zip(index.names, index.wholes))
    kept: list[tuple] = []
    for find in sorted(out, key=lambda x: (-x[2], -x[1], x[3], x[0])):
        apart = (o for o in kept if find[3] < o[4] and find[4] > o[3])
        if all(find[1] > o[1] and o[0] not in wholes[find[0]] for o in apart):
            kept.append(find)
    return sorted(kept, key=lambda x: (x[3], x[4], x[0]))


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("matched_words", pa.int32())]
    + [("start_char", pa.int64()), ("end_char", pa.int64()), ("span", pa.string())]
)
COLUMNS = "doc_id long, license string, coverage double, matched_words int, start_char long, end_char long, span string"


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = COVERAGE) -> DataFrame:
    """One row per license text or notice found in ``docs``: what it is, how much of it, and where.

    Columns: doc_id, license, coverage (share of the template's words matched in order), matched_words, start_char, end_char,
    span (the document's text there). A document without license, an empty or a null one has no row; a repeated row has its
    rows again; a null id stays null. A text that follows a template in all but a name or a version number (``NAMES``) has no row
    of that template. Whole texts are scanned. Other columns are not read. An empty table gives no rows.
    """
    size = sum(len(text.encode()) for text in templates.values())
    if size > TEMPLATE_BYTES:
        raise ValueError(f"{size} bytes of templates, more than {TEMPLATE_BYTES}: scan in several calls")
    index = docs.sparkSession.sparkContext.broadcast(build_index(templates))

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        hasher = WordHashes()
        for doc_id, text in rows:
            for name, coverage, matched, first, end in scan(text, hasher, index.value, least):
                yield doc_id, name, coverage, matched, first, end, text[first:end]

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows_mapper(each, SCHEMA), COLUMNS)
