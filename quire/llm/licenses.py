"""License scan: licence templates as token automata, beside plain phrases.

A template is wording with two kinds of markup, in the manner of public licence templates:
``[[ ... ]]`` is optional, ``{{name:n}}`` stands for 0 to n words of any kind. All other words
are mandatory and must match exactly, as words after folding A-Z to a-z. A template, a short notice or a
whole licence text, compiles to a nondeterministic automaton over words, and accepts wherever all of its
wording stands in a text.

A text is searched for each template's longest mandatory run of words first (a substring search);
only texts that hold it are run through the automaton, one pass over the words for all starts.

One pass over the rows, no shuffle; memory is one Arrow batch.

Cases: null text counts as empty: n_words 0, n_base 0, null first_word and last_word, empty labels,
score 0. Repeated rows each get their row; a text of any length is scanned whole; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ALNUM_TABLE, no_worker_state

# Phrases and labels of the base.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices that name a licence, as (label, markup).
NOTICES = (
    ("apache-2.0", "licensed under the apache license [[ version ]] 2 0"),
    ("cc-by-4.0", "[[ creative commons ]] cc by [[ license ]] [[ version ]] 4 0"),
    ("cc-by-nc-4.0", "[[ creative commons ]] cc by nc [[ license ]] [[ version ]] 4 0"),
    ("cc-by-sa-4.0", "[[ creative commons ]] cc by sa [[ license ]] [[ version ]] 4 0"),
    ("copyright", "copyright [[ c ]] {{years and holder:12}} all rights reserved"),
    ("gpl-2.0", "gnu general public license [[ as published by the free software foundation ]] [[ either ]] version 2"),
    ("gpl-3.0", "gnu general public license [[ as published by the free software foundation ]] [[ either ]] version 3"),
    ("mit", "[[ the ]] mit license"),
    ("spdx", "spdx license identifier {{name:8}} text"),
)
# Whole licence texts, words only. All wording outside the markup is mandatory.
REDISTRIBUTION = """
    redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
    [[ 1 ]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
    [[ 2 ]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
    in the documentation and or other materials provided with the distribution
"""
AS_IS = """
    this software is provided by {{holder:12}} as is and any express or implied warranties including but not limited to the implied warranties
    of merchantability and fitness for a particular purpose are disclaimed in no event shall {{holder:12}} be liable for any direct indirect
    incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use
    data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort
    including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage
"""
TEXTS = (
    ("apache-2.0", """
        licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
        you may obtain a copy of the license at [[ http www apache org licenses license 2 0 ]] [[ https www apache org licenses license 2 0 ]]
        unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
        without warranties or conditions of any kind either express or implied see the license for the specific language governing
        permissions and limitations under the license"""),
    ("bsd-2-clause", REDISTRIBUTION + AS_IS),
    ("bsd-3-clause", REDISTRIBUTION + """
        [[ 3 ]] neither the name of {{holder:12}} nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission""" + AS_IS),
    ("gpl-2.0-or-later", """
        this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published
        by the free software foundation either version 2 of the license or at your option any later version this program is distributed in the
        hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular
        purpose see the gnu general public license for more details"""),
    ("gpl-3.0-or-later", """
        this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published
        by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the
        hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular
        purpose see the gnu general public license for more details"""),
    ("isc", """
        permission to use copy modify and [[ or ]] distribute this software for any purpose with or without fee is hereby granted provided that
        the above copyright notice and this permission notice appear in all copies the software is provided as is and {{holder:8}} disclaims all
        warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall {{holder:8}} be
        liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits
        whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of
        this software"""),
    ("mit", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files {{defined name:4}}
        to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
        sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following
        conditions the above copyright notice and this permission notice [[ including the next paragraph ]] shall be included in all copies or
        substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not
        limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {{holder:12}} be liable
        for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with
        the software or the use or other dealings in the software"""),
    ("zlib", """
        this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages
        arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial
        applications and to alter it and redistribute it freely subject to the following restrictions [[ 1 ]] the origin of this software must
        not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment
        in the product documentation would be appreciated but is not required [[ 2 ]] altered source versions must be plainly marked as such
        and must not be misrepresented as being the original software [[ 3 ]] this notice may not be removed or altered from any source
        distribution"""),
)
TEMPLATES = NOTICES + TEXTS
MARKUP = re.compile(r"\[\[|\]\]|\{\{[^:}]*:(\d+)\}\}|[^\s\[\]{}]+")


@dataclass
class Automaton:
    """States 0..end; ``moves[s]`` has (word or None for any, next state); ``skips[s]`` epsilon moves."""

    label: str
    moves: list[list[tuple[bytes | None, int]]]
    skips: list[list[int]]
    end: int
    required: bytes

    def closure(self, states: set[int]) -> set[int]:
        todo, found = list(states), set(states)
        while todo:
            for n in self.skips[todo.pop()]:
                if n not in found:
                    found.add(n)
                    todo.append(n)
        return found

    def accepts(self, words: list[bytes]) -> bool:
        """Whether the wording stands anywhere in ``words``."""
        start = self.closure({0})
        now = start
        for word in words:
            if self.end in now:
                return True
            now = self.closure({n for s in now for w, n in self.moves[s] if w is None or w == word}) | start
        return self.end in now


def compile_template(label: str, markup: str) -> Automaton:
    moves: list[list] = [[]]
    skips: list[list] = [[]]
    opened: list[int] = []
    runs: list[list[str]] = [[]]

    def step(word: bytes | None) -> None:
        moves.append([])
        skips.append([])
        moves[-2].append((word, len(moves) - 1))

    for m in MARKUP.finditer(markup):
        part = m.group()
        if part == "[[":
            opened.append(len(moves) - 1)
            runs.append([])
        elif part == "]]":
            skips[opened.pop()].append(len(moves) - 1)
            runs.append([])
        elif m.group(1):
            first = len(moves) - 1
            for _ in range(int(m.group(1))):
                step(None)
            for s in range(first, len(moves) - 1):
                skips[s].append(len(moves) - 1)
            runs.append([])
        else:
            step(part.encode())
            if not opened:
                runs[-1].append(part)
    required = max(runs, key=lambda r: len(" ".join(r)))
    return Automaton(label, moves, skips, len(moves) - 1, f" {' '.join(required)} ".encode())


def _places(text: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which ``phrase`` (a space before and after) starts in ``text``."""
    found, at, words, seen = [], text.find(phrase), 0, 0
    while at >= 0:
        words += text.count(b" ", seen, at)
        seen = at
        found.append(words)
        at = text.find(phrase, at + 1)
    return found


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: 1 if a template accepts, else 0.5 if a phrase stands in the text, else 0.
    """
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

    def run(batches):
        import pyarrow as pa

        base = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        automata = [compile_template(*t) for t in templates]
        no_worker_state()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or "").encode().translate(ALNUM_TABLE).split()
                flat = b" %b " % b" ".join(words) if words else b""
                places, base_labels, labels = [], set(), set()
                for phrase, label in base:
                    if found := _places(flat, phrase):
                        places += found
                        base_labels.add(label)
                for a in automata:
                    if a.label not in labels and a.required in flat and a.accepts(words):
                        labels.add(a.label)
                score = 1.0 if labels else 0.5 if base_labels else 0.0
                rows.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score))
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
            columns = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
