"""License texts by templates with optional and replaceable regions.

A template is plain wording with two kinds of markup: ``[[ ... ]]`` may be left out, ``<<n>>`` stands for up to n words of
any kind. It is compiled into an automaton over words: a state for each place in the wording, a free move past an optional
region, and a state with a counter for a replaceable one. A text is accepted from a word on if the automaton
reaches its end, so all mandatory wording stands there exactly. Automata run only from words that can begin a template.

Words are runs of letters, digits and characters beyond ASCII; A-Z are lower-cased; punctuation doesn't count.
The score is the largest share of a template's mandatory words that the automaton got through, 1 for an accepted one, 0
where it got through neither eight words nor a fifth of them; a base phrase scores at least 0.5. A licence's template is its
whole text, so an opening alone, or terms with a word added, left out or changed, give a score below 1 and no label.
Notices that refer to a licence are templates of their own.

Defined results: null and empty texts have no words, no label and score 0; repeated rows score alike; extra columns
don't matter. Whole texts are read, at any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .tables import column
from .words import LOWER, slices, text_bytes

#: Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Public wording of whole licences and of the notices that refer to one, with markup.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 [[(the <<1>> License)]]",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at <<12>> Unless required by applicable law or agreed to in writing, software distributed under
        the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: [[1.]] [[a.]] Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. [[2.]] [[b.]] Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY <<12>> AS IS AND ANY
        EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL <<12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
        CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
        OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: [[1.]] [[a.]] Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. [[2.]] [[b.]] Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. [[3.]] [[c.]] Neither the name of <<12>> nor the names of
        <<3>> contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS
        SOFTWARE IS PROVIDED BY <<12>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
        PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE""",
    "cc-by": "Licensed under [[a]] [[the]] [[Creative Commons Attribution]] CC BY 4.0",
    "cc-by-nc": "Licensed under [[a]] [[the]] CC BY NC <<2>>",
    "cc-by-sa": "Licensed under [[a]] [[the]] CC BY SA <<2>>",
    "gpl-3.0": "licensed under the [[terms of the]] GNU General Public License, [[as published by the Free Software Foundation]] version 3",
    "gpl-notice": """free software[[:]] you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
        Software Foundation, either version <<1>> of the License, or (at your option) any later version. <<4>> is distributed in the hope that it will be
        useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details""",
    "isc": """Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<8>> DISCLAIMS ALL WARRANTIES
        WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<8>> BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE""",
    "mit-release": "Released under the [[terms of the]] MIT License",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice [[(including the next paragraph)]] shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<12>> BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
        OR THE USE OR OTHER DEALINGS IN THE SOFTWARE""",
    "mpl-2.0": """subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one
        at""",
}

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True  # of lower-cased bytes
WORD = regex.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def tokens(text: str) -> list[bytes]:
    return WORD.findall(LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes())


class Automaton:
    """States are places in a template; ``moves`` are (word, next) and ``free`` the places reached without a word."""

    def __init__(self, template: str):
        self.words: list[bytes | None] = []  # None: any word
        self.free: dict[int, set[int]] = {}
        mandatory = []
        depth, opened = 0, []
        for part in regex.findall(r"\[\[|\]\]|<<\d+>>|[^\[\]<>]+", template):
            if part == "[[":
                opened.append(len(self.words))
                depth += 1
            elif part == "]]":
                depth -= 1
                self.free.setdefault(opened.pop(), set()).add(len(self.words))
            elif part.startswith("<<"):
                begin, n = len(self.words), int(part[2:-2])
                self.words += [None] * n
                mandatory += [0] * n
                for k in range(n):  # the region may end after any word of it
                    self.free.setdefault(begin + k, set()).add(begin + n)
            else:
                own = tokens(part)
                self.words += own
                mandatory += [int(depth == 0)] * len(own)
        self.end = len(self.words)
        self.sofar = np.concatenate(([0], np.cumsum(mandatory))).tolist()
        self.first = {self.words[s] for s in self._closed({0}) if s < self.end}

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free.get(todo.pop(), ()):
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def share(self, words: list[bytes], begin: int) -> float:
        """The share of the mandatory wording that stands from a word on; 1: the text is accepted there."""
        states, reached = self._closed({0}), 0
        for k in range(begin, min(len(words), begin + self.end)):
            if self.end in states:
                return 1.0
            word = words[k]
            states = {s + 1 for s in states if s < self.end and (self.words[s] is None or self.words[s] == word)}
            if not states:
                break
            states = self._closed(states)
            reached = max(reached, max(self.sofar[s] for s in states))
        if self.end in states:
            return 1.0
        total = max(self.sofar[-1], 1)
        return reached / total * 0.999 if reached >= 8 or reached > 0.2 * total else 0.0


def _scan(templates: dict[str, str], phrases: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = {name: Automaton(t) for name, t in templates.items()}
        by_word: dict[bytes, list[str]] = {}
        for name, automaton in automata.items():
            for word in automaton.first:
                by_word.setdefault(word, []).append(name)
        base = {tuple(tokens(p)): label for p, label in phrases.items()}
        starts = set(by_word) | {p[0] for p in base}
        longest = max(map(len, base))
        # documents without any of these words have nothing to match
        found_any = regex.compile(b"|".join(regex.escape(w) for w in sorted(starts)))
        for batch in batches:
            texts = batch.column("text").fill_null("")
            counts: list[int] = []
            rows: list[tuple] = []
            for begin, end in slices(texts, 1 << 21):
                data, at = text_bytes(texts.slice(begin, end - begin))
                low = LOWER[data[at[0] : at[-1]]]
                solid = _WORD[low]
                edge = np.zeros(len(low) + 1, bool)
                edge[at - at[0]] = True
                heads = solid.copy()
                heads[1:] &= ~solid[:-1] | edge[1:-1]
                counts += np.diff(np.concatenate(([0], np.cumsum(heads)))[at - at[0]]).tolist()
                whole = low.tobytes()
                for a, b in zip((at[:-1] - at[0]).tolist(), (at[1:] - at[0]).tolist()):
                    if not found_any.search(whole, a, b):
                        rows.append((0, None, None, "", "", 0.0))
                        continue
                    words = WORD.findall(whole, a, b)
                    places: list[int] = []
                    labels: set[str] = set()
                    own: set[str] = set()
                    score = 0.0
                    for k, word in enumerate(words):
                        if word not in starts:
                            continue
                        for n in range(1, longest + 1):
                            label = base.get(tuple(words[k : k + n]))
                            if label and k + n <= len(words):
                                places.append(k)
                                labels.add(label)
                                score = max(score, 0.5)
                        for name in by_word.get(word, ()):
                            share = automata[name].share(words, k)
                            score = max(score, share)
                            if share == 1.0:
                                own.add(name)
                    rows.append((len(places), places[0] if places else None, places[-1] if places else None, ",".join(sorted(labels)), ",".join(sorted(labels | own)), score))
            n_base, first, last, base_labels, labels_, scores = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(n_base, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                    pa.array(base_labels, pa.string()), pa.array(labels_, pa.string()), pa.array(scores, pa.float64()),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per document: its words, the places of the base phrases, labels and score."""
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    return rows.mapInArrow(_scan(templates, phrases), SCHEMA)


#: The base columns in DuckDB's SQL, for tests (the templates' labels are not SQL).
BASE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (
  SELECT doc_id, words, list_filter(range(len(words)), lambda k:
           words[k + 1 : k + 2] IN (['mit', 'license'], ['apache', 'license'])
           OR words[k + 1 : k + 3] = ['general', 'public', 'license']) AS hits FROM w)
SELECT doc_id, len(words)::BIGINT AS n_words, len(hits)::BIGINT AS n_base, list_min(hits) AS first_word, list_max(hits) AS last_word FROM places
"""
