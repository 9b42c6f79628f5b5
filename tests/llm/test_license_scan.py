"""License automata: base places against a plain search, markup semantics."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagwave.llm import license_scan as LS

SCANNER = LS.Scanner()


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, label) for p, label in LS.BASE_PHRASES.items() for i in range(len(w))
                    if w[i:i + len(p.split())] == p.split())
    return len(w), places


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("cc by nc general public license all rights reserved gnu version 3 é CC, By. ALL\n x_y "
                                "copyright c 2020 mit under the".split(" ")), max_size=30))
def test_base_places_equal_plain_search(words):
    text = " ".join(words)
    n, found = SCANNER.scan(text)
    assert (n, sorted((a, label) for label, base, a, _ in found if base)) == plain(text)


@pytest.mark.parametrize("text,labels", [
    ("Released under the MIT License.", {"mit-notice"}),
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
    ("Licensed under the Apache License v2.0", {"apache-2.0"}), ("Licensed under the Apache License 2.0", {"apache-2.0"}),
    ("Licensed under the Apache License, version v. 2.0.", {"apache-2.0"}),
    ("licensed under the apache license", set()),  # the version is mandatory
    ("Licensed under the Apache License, Version 2.1", set()), ("Licensed under the Apache License, Version 4.0", set()),
    ("Licensed under the Apache License, Version 12.0", set()), ("Licensed under the Apache License v3.0", set()),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc"}),
    ("the GNU General Public License, version 3.", {"gpl", "gpl-3.0"}),
    ("GNU General Public License as published by the Free Software Foundation; either version 2", {"gpl", "gpl-2.0"}),
    ("Copyright (c) 2020 Some People. All rights reserved.", {"reserved", "copyright-notice"}),
    ("Copyright 1 2 3 4 5 6 7 8 9 all rights reserved", {"reserved"}),  # the replaceable part is too long
    ("under the MIT big License", set()),  # mandatory wording is interrupted
    ("", set()),
])
def test_templates(text, labels):
    assert {p[0] for p in SCANNER.scan(text)[1]} == labels


@pytest.mark.parametrize("label", ["mit", "bsd-2-clause", "isc"])
def test_full_texts(label):
    words = re.sub(r"<<[^>]*>>", " ", LS.TEMPLATES[label]).split()
    assert label in {p[0] for p in SCANNER.scan("Preamble. " + " ".join(words).title() + " end")[1]}
    words[10] += "x"
    assert label not in {p[0] for p in SCANNER.scan(" ".join(words))[1]}


GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
NAMES = """3. Neither the name of the Example Society nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. """
AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. """
MIT_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


@pytest.mark.parametrize("text,labels", [
    (GRANT + AS_IS, {"bsd-2-clause"}), (GRANT + NAMES + AS_IS, {"bsd-3-clause"}), (GRANT, set()),
    (GRANT + "The name of the author may not be used to endorse or promote products derived from this software without "
     "specific prior written permission. " + AS_IS, {"bsd-3-clause"}),
    (MIT + MIT_AS_IS, {"mit"}), (MIT + MIT_AS_IS.replace("NONINF", "NON-INF"), {"mit"}),
    (MIT + "The Software shall be used for Good, not Evil. " + MIT_AS_IS, set()),
    (ISC, {"isc"}), (ISC.replace("THE AUTHOR", "EXAMPLE SYSTEMS, INC."), {"isc"}),
    ("licensed under the apache license version 1.1", set()), ("Licensed under the Apache License, v1.0", set()),
    ("Licensed under the Apache License 1.1", set()), ("Licensed under the Apache License. 1. Definitions", set()),
])
def test_licenses_are_told_apart(text, labels):
    assert {p[0] for p in SCANNER.scan("Copyright 2020 A. B. " + text + " More.")[1]} == labels


def test_barred_words():
    a = LS.compile_template("t", "a <<opt;c d|e>> b <<end>>")
    for text, end in (("a", 1), ("a b", 2), ("a c", 1), ("a c d", -1), ("a e", -1), ("a b e", 2)):
        assert a.match(LS.words_of(text), 0) == end, text


def test_markup():
    a = LS.compile_template("t", "a <<opt>> b <<opt>> c <<end>> <<end>> <<var;2>> d")
    for text, end in (("a d", 2), ("a b d", 3), ("a b c d", 4), ("a x d", 3), ("a b c x y d", 6), ("a x y z d", -1),
                      ("a d d d", 4), ("b d", -1)):
        assert a.match(LS.words_of(text), 0) == end, text
    for bad in ("a <<opt>> b", "a <<end>>", "<<opt>> a <<end>>", "a <<what>>"):
        with pytest.raises(ValueError):
            LS.compile_template("t", bad)


def test_query_and_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (50, "All rights reserved. x. All Rights Reserved CC BY"), (51, "cc by " * 5000)]
    docs = make_docs(rows).withColumn("labels", F.lit("clash"))
    got = {r.doc_id: r for r in LS.license_digest(docs).collect()}
    assert len(got) == len({i for i, _ in rows})
    r = got[50]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (
        9, 3, 0, 7, "cc-by,reserved", "cc-by,reserved")
    assert r.score == pytest.approx(8 / 9)
    assert (got[51].n_base, got[51].last_word) == (5000, 9998)
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].labels, got[1].score) == (0, 0, None, "", 0.0)
    for i, t in rows:
        n, places = plain(t or "")
        assert (got[i].n_words, got[i].n_base) == (n, len(places))
    assert LS.license_digest(docs.limit(0)).count() == 0
