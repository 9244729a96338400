"""Licence scan by template markup.

A template is a licence's wording with two kinds of marks: ``{{ ... }}`` is text that may be left out, ``[[n]]`` stands for
up to n words of any kind. Templates are compiled to automata over words; a text holds a licence where an automaton accepts,
that is where all mandatory words stand exactly and in order. Automata start only at places of their first words.

The base labels come from three phrases, wherever their words stand in a row; labels of templates are added to them.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import map_texts

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")

# Phrases of the base and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Wording of public licences and notices, whole, with optional and replaceable regions marked.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:
The above copyright notice and this permission notice {{(including the next paragraph)}} shall be included in all copies or substantial
portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {{THE}} [[12]] BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache-2", "licensed under the apache license version 2 {{0}} {{the license}}"),
    ("apache-2", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this [[3]] except in compliance with the License.
You may obtain a copy of the License at {{[[8]]}}
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    ("bsd-2", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met:
{{1.}} Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
{{2.}} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY {{THE}} [[12]] "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {{THE}} [[12]] BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsd-3", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met:
{{1.}} Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
{{2.}} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
{{3.}} Neither the name of [[12]] nor the names of {{its}} [[3]] may be used to endorse or promote products derived from this software
without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY {{THE}} [[12]] "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {{THE}} [[12]] BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("isc", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
{{1.}} The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
{{2.}} Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
{{3.}} This notice may not be removed or altered from any source distribution."""),
    ("gpl-2-or-later", """
{{This program}} is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
{{This program}} [[3]] is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("gpl-3-or-later", """
{{This program}} is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
{{This program}} [[3]] is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("gpl-3", "licensed under the gnu general public license {{as published by the free software foundation}} {{either}} version 3"),
    ("gpl-2", "licensed under the gnu general public license {{as published by the free software foundation}} {{either}} version 2"),
    ("mpl-2", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at {{[[8]]}}"""),
    ("cc-by-nc", "licensed under {{a}} cc by nc {{sa}} {{[[1]] [[1]]}}"),
    ("cc-by-nc", "{{this work is}} licensed under {{a}} {{the}} creative commons attribution noncommercial {{[[2]]}} license"),
    ("cc-by", "licensed under {{a}} {{the}} creative commons attribution {{[[2]]}} license"),
]


class Automaton:
    """Words in a row as states; an edge is a word, any word, or nothing."""

    def __init__(self, label: str, template: str):
        self.label, self.edges, self.free = label, [], []
        parts = re.findall(r"\{\{|\}\}|\[\[\d+\]\]|[^\s{}\[\]]+", template)
        state, opened = self._state(), []
        for part in parts:
            if part == "{{":
                opened.append(state)
            elif part == "}}":
                self.free[opened.pop()].append(state)
            elif part.startswith("[["):
                last = [state]
                for _ in range(int(part[2:-2])):
                    state = self._edge(state, None)
                    last.append(state)
                for early in last[:-1]:
                    self.free[early].append(state)
            else:
                for word in WORDS.findall(part.encode().lower()):
                    state = self._edge(state, word)
        self.final = state
        self.closed = [self._close(i) for i in range(len(self.edges))]
        #: Words with which a match may begin.
        self.first = {self.edges[s][0] for s in self.closed[0] if self.edges[s]}
        if None in self.first or self.final in self.closed[0]:
            raise ValueError(f"a template must begin with a word of its own: {template}")

    def _state(self) -> int:
        self.edges.append(None)
        self.free.append([])
        return len(self.edges) - 1

    def _edge(self, state: int, word) -> int:
        after = self._state()
        self.edges[state] = (word, after)
        return after

    def _close(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for other in self.free[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)

    def accepts(self, words: list[bytes], at: int) -> bool:
        """Whether a match begins at word ``at``."""
        states = self.closed[0]
        for i in range(at, len(words)):
            if self.final in states:
                return True
            word = words[i]
            states = {s for e in map(self.edges.__getitem__, states) if e and e[0] in (None, word) for s in self.closed[e[1]]}
            if not states:
                return False
        return self.final in states


class Scanner:
    """Compiled templates and phrases, and the words at which each may start."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.automata = [Automaton(*t[:2]) for t in templates]
        self.starts: dict[bytes, list[Automaton]] = {}
        for a in self.automata:
            for word in a.first:
                self.starts.setdefault(word, []).append(a)
        #: One pass tells whether a text has any word that something starts with.
        every = sorted({*self.starts, *(p[0] for p, _ in self.phrases)})
        self.some = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(map(re.escape, every)) + rb")(?![0-9a-z\x80-\xff])")

    def scan(self, text: str) -> tuple:
        data = text.encode("utf-8", "replace").lower()
        words = WORDS.findall(data)
        base, places, found = set(), [], set()
        if self.some.search(data):
            for phrase, label in self.phrases:
                n, at = len(phrase), -1
                for _ in range(words.count(phrase[0])):
                    at = words.index(phrase[0], at + 1)
                    if words[at:at + n] == phrase:
                        places.append(at)
                        base.add(label)
            for word, automata in self.starts.items():
                at = -1
                for _ in range(words.count(word)):
                    at = words.index(word, at + 1)
                    found.update(a.label for a in automata if a.label not in found and a.accepts(words, at))
        labels = base | found
        score = 1.0 if found else 0.5 if base else 0.0
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score)


def licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row of ``docs``.

    ``score`` is 1 where a template is accepted, 0.5 where only a phrase stands, else 0. NULL and empty texts have no words,
    no places and empty labels. Ids may be NULL or repeated; an empty table gives no rows; other columns are ignored.
    """
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def work(texts, scanner):
        rows = [scanner.scan(t) for t in texts]
        return {n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))}

    schema = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return map_texts(docs, ["doc_id"], text, work, schema, Scanner).select("doc_id", *[F.col(n) for n in names])
