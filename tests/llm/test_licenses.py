import re

from quire.llm import licenses
from quire.llm.oracles import template_pattern

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    flat = " " + " ".join(words) + " " if words else ""
    own = {label for label, markup in licenses.TEMPLATES if re.search(template_pattern(markup), flat)}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if own else 0.5 if base else 0.0)


TEXTS = [
    "Released under the MIT License.", "CC BY cc-by CC by by CC", "Licensed under CC BY-NC 4.0.", "Copyright (c) 2020 Some Holder. All rights reserved.",
    "copyright a b c d e f g h i j k l m n all rights reserved", "GNU General Public License, either version 3", "GNU General Public License version 2 of",
    "Licensed under the Apache License, Version 2.0", "licensed under the apache license 2.0", "licensed under an apache license 2.0",
    "all rights reserved all rights reserved", "allrights reserved", "cc é by", "CC BY 4.0", "the the mit license", None, "", "x" * 100_000 + " cc by",
]


def test_against_regular_expressions(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}
    assert got[0][5] == "mit" and got[3][5] == "copyright,reserved" and got[4][5] == "reserved"


def test_automaton():
    a = licenses.compile_template("x", "one [[ two three ]] {{gap:2}} four")
    accepts = lambda text: a.accepts(text.encode().split())
    assert all(map(accepts, ["one four", "one two three four", "z one a b four z", "one one four", "one two four", "one two three a b four", "one one a four"]))
    assert not any(map(accepts, ["one", "four", "one a b c four", "one two three a b c four", ""]))


def test_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r for r in licenses.scan(odd_docs).collect()}
    assert (got[9].n_base, got[9].base_labels, got[9].labels) == (5, "cc-by,gpl,reserved", "cc-by,cc-by-4.0,gpl,gpl-3.0,reserved")
    assert (got[2].n_words, got[2].first_word, got[2].labels, got[2].score) == (0, None, "", 0.0)
    assert licenses.scan(odd_docs).count() == 10 and licenses.scan(no_docs).count() == 0


MIT = """Copyright (c) 2021 A. Holder

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_whole_texts(spark):
    """The text of a licence is accepted with any holder, and not if a mandatory word is missing or another."""
    texts = [MIT, "before " + MIT + " after", MIT.replace("THE\nAUTHORS OR COPYRIGHT HOLDERS", "EXAMPLE LTD"), MIT.replace("merge, ", ""), MIT.replace("sublicense", "lend"), MIT[:-60]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.labels for r in licenses.scan(frame).orderBy("doc_id").collect()]
    assert got == ["mit"] * 3 + [""] * 3
    longest = max(licenses.TEMPLATES, key=lambda t: len(t[1]))
    a = licenses.compile_template(*longest)
    plain = re.sub(r"\[\[|\]\]", " ", re.sub(r"\{\{.*?\}\}", "any holder", longest[1])).encode().split()
    assert a.accepts(plain) and all(not a.accepts(plain[:i] + [b"zzz"] + plain[i + 1 :]) for i in range(0, len(plain), 17) if plain[i] not in (b"any", b"holder") and not plain[i].isdigit())
