"""License scans by template markup.

A template is a license wording with markup: ``<<opt>> ... <<end>>`` may be
missing (``<<opt;a b|c>> ... <<end>>`` only where neither "a b" nor "c" follows)
and ``<<var;N>>`` stands for up to N words of any kind.  Each template
is compiled into an automaton over words: mandatory words are its edges,
optional regions can be skipped, replaceable ones consume anything for a
bounded while.  A place in a text is accepted when the automaton reaches its
end, that is when all mandatory wording stands there exactly.

Automata run only where a template's first word stands, in texts that hold its
rarest word.  Work is row-wise and whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwave.llm.common import text_chunks

#: Phrases whose places are counted, with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# License wordings with markup, by label (several where a label has several).
_BSD_GRANT = """redistribution and use in source and binary forms with or without modification are permitted
        provided that the following conditions are met <<opt>> 1 <<end>> redistributions of source code must
        retain the above copyright notice this list of conditions and the following disclaimer
        <<opt>> 2 <<end>> redistributions in binary form must reproduce the above copyright notice this list
        of conditions and the following disclaimer in the documentation and or other materials provided
        with the distribution"""
_BSD_DISCLAIMER = """this software is provided by <<var;16>> as is and any express or implied warranties
        including but not limited to the implied warranties of merchantability and fitness for a particular
        purpose are disclaimed in no event shall <<var;16>> be liable for any direct indirect incidental special
        exemplary or consequential damages including but not limited to procurement of substitute goods or
        services loss of use data or profits or business interruption however caused and on any theory of
        liability whether in contract strict liability or tort including negligence or otherwise arising in
        any way out of the use of this software even if advised of the possibility of such damage"""
_APACHE_NOTICE = "<<opt>> the license you may not use this file except in compliance with the license <<end>>"
TEMPLATES: dict[str, str | tuple[str, ...]] = {
    "mit-notice": "<<opt>> released <<end>> <<opt>> licensed <<end>> <<opt>> distributed <<end>> under the mit license",
    "mit": """permission is hereby granted free of charge to any person obtaining a copy of this software
        and associated documentation files the software to deal in the software without restriction
        including without limitation the rights to use copy modify merge publish distribute sublicense
        and or sell copies of the software and to permit persons to whom the software is furnished to
        do so subject to the following conditions the above copyright notice and this permission notice
        <<opt>> including the next paragraph <<end>> shall be included in all copies or substantial
        portions of the software the software is provided as is without warranty of any kind express or
        implied including but not limited to the warranties of merchantability fitness for a particular
        purpose and <<opt>> non infringement <<end>> <<opt>> noninfringement <<end>> in no event shall
        <<var;16>> be liable for any claim damages or other liability whether in an action of contract tort
        or otherwise arising from out of or in connection with the software or the use or other dealings in
        the software""",
    "apache-2.0": (f"licensed under the apache license <<opt>> version <<end>> <<opt>> v <<end>> 2 0 {_APACHE_NOTICE}",
                   f"licensed under the apache license <<opt>> version <<end>> v2 0 {_APACHE_NOTICE}"),
    "gpl-3.0": "gnu general public license <<opt>> as published by the free software foundation either <<end>> version 3",
    "gpl-2.0": "gnu general public license <<opt>> as published by the free software foundation either <<end>> version 2",
    "cc-by-nc": "cc by nc <<opt>> 4 0 <<end>>",
    "cc-by-sa": "cc by sa <<opt>> 4 0 <<end>>",
    "bsd-2-clause": f"{_BSD_GRANT} {_BSD_DISCLAIMER}",
    "bsd-3-clause": f"""{_BSD_GRANT} <<opt>> 3 <<end>> <<opt>> neither <<end>> the <<opt>> name <<end>>
        <<opt>> names <<end>> of <<var;24>> be used to endorse or promote products derived from this software
        without specific prior written permission {_BSD_DISCLAIMER}""",
    "isc": """permission to use copy modify and <<opt>> or <<end>> distribute this software for any purpose with
        or without fee is hereby granted provided that the above copyright notice and this permission notice
        appear in all copies the software is provided as is and <<var;16>> <<opt>> disclaim <<end>>
        <<opt>> disclaims <<end>> all warranties with regard to this software including all implied warranties
        of merchantability and fitness in no event shall <<var;16>> be liable for any special direct indirect
        or consequential damages or any damages whatsoever resulting from loss of use data or profits whether
        in an action of contract negligence or other tortious action arising out of or in connection with the
        use or performance of this software""",
    "copyright-notice": "copyright <<opt>> c <<end>> <<var;8>> all rights reserved",
}

#: Bytes between words become blanks, A-Z lower case; bytes from 128 on belong to words.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


@dataclass
class Automaton:
    """A template as states: ``words[s]`` leads to s + 1 by that word,
    ``skips[s]`` are the states reached from s without a word (not where a
    phrase of ``barred[s, t]`` follows), and from a state in ``wild`` any word
    may be taken, so many times at most."""

    label: str
    words: list[bytes | None] = field(default_factory=list)
    skips: dict[int, list[int]] = field(default_factory=dict)
    wild: dict[int, int] = field(default_factory=dict)
    barred: dict[tuple[int, int], list[list[bytes]]] = field(default_factory=dict)
    mandatory: set[bytes] = field(default_factory=set)

    @property
    def end(self) -> int:
        return len(self.words)

    def closure(self, states: dict[int, int], words: list[bytes] = (), at: int = 0) -> dict[int, int]:
        """``states`` (state: wild words taken in it) with all skips followed
        that ``words`` from ``at`` on allow."""
        todo = list(states)
        while todo:
            s = todo.pop()
            for t in self.skips.get(s, ()):
                if t not in states and not any(words[at:at + len(p)] == p for p in self.barred.get((s, t), ())):
                    states[t] = 0
                    todo.append(t)
        return states

    def first_words(self) -> set[bytes]:
        return {self.words[s] for s in self.closure({0: 0}) if s < self.end and self.words[s] is not None}

    def match(self, words: list[bytes], start: int) -> int:
        """End of the longest accepted run of words from ``start``, or -1."""
        states, at, accepted = self.closure({0: 0}, words, start), start, -1
        while states:
            if self.end in states:
                accepted = at
            if at == len(words):
                break
            nxt: dict[int, int] = {}
            for s, taken in states.items():
                if s < self.end and self.words[s] == words[at]:
                    nxt[s + 1] = 0
                if taken < self.wild.get(s, 0):
                    nxt[s] = min(nxt.get(s, taken + 1), taken + 1)
            at += 1
            states = self.closure(nxt, words, at)
        return accepted


def compile_template(label: str, markup: str) -> Automaton:
    """Markup to automaton; an unbalanced or unknown mark is an error."""
    a, opened = Automaton(label), []
    for part in re.findall(r"<<[^>]*>>|[^<]+", markup):
        if m := re.fullmatch(r"<<opt(?:;([^>]+))?>>", part):
            opened.append((a.end, [words_of(p) for p in (m[1] or "").split("|") if words_of(p)]))
        elif part == "<<end>>":
            if not opened:
                raise ValueError(f"{label}: <<end>> without <<opt>>")
            start, barred = opened.pop()
            a.skips.setdefault(start, []).append(a.end)
            if barred:
                a.barred[start, a.end] = barred
        elif m := re.fullmatch(r"<<var;([0-9]+)>>", part):
            a.wild[a.end] = int(m[1])
            a.skips.setdefault(a.end, []).append(a.end + 1)
            a.words.append(None)
        elif part.startswith("<<"):
            raise ValueError(f"{label}: unknown mark {part}")
        else:
            new = words_of(part)
            a.words += new
            if not opened:
                a.mandatory.update(new)
    if opened:
        raise ValueError(f"{label}: <<opt>> without <<end>>")
    if not a.mandatory:
        raise ValueError(f"{label}: no mandatory word")
    return a


class Scanner:
    """All templates and base phrases, compiled."""

    def __init__(self, templates: dict[str, str | tuple[str, ...]] | None = None,
                 phrases: dict[str, str] | None = None):
        self.base = [compile_template(label, p) for p, label in (phrases or BASE_PHRASES).items()]
        self.more = [compile_template(label, p) for label, ps in (templates or TEMPLATES).items()
                     for p in ([ps] if isinstance(ps, str) else ps)]
        self.starts: dict[bytes, list[tuple[Automaton, bool]]] = {}
        for group, is_base in ((self.base, True), (self.more, False)):
            for a in group:
                for w in a.first_words():
                    self.starts.setdefault(w, []).append((a, is_base))
        # a text without any of these words holds no template: the longest
        # mandatory word of each
        self.anchors = {max(a.mandatory, key=len) for a in [*self.base, *self.more]}

    def scan(self, text: str) -> tuple[int, list[tuple[str, bool, int, int]]]:
        """Number of words, and the accepted places (label, is base, first
        word, end), by start."""
        words = words_of(text)
        if self.anchors.isdisjoint(words):
            return len(words), []
        held, found = set(words), []
        able = {id(a) for a in [*self.base, *self.more] if a.mandatory <= held}
        for at, w in enumerate(words):
            for a, is_base in self.starts.get(w, ()):
                if id(a) in able and (end := a.match(words, at)) >= 0:
                    found.append((a.label, is_base, at, end))
        return len(words), found


def _covered(places: list[tuple[str, bool, int, int]]) -> int:
    """Words inside at least one place."""
    total, done = 0, 0
    for _, _, a, b in places:
        total += max(0, b - max(a, done))
        done = max(done, b)
    return total


def license_places(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] | None = None,
                   phrases: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, n_words, places array<struct<label, base, first, stop>>,
    n_covered`` of every text, words numbered from 0.

    A null text has no words; repeated rows and ids give a row each, an empty
    table no rows; other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()),
                               ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            at = 0
            for _, texts in text_chunks(batch.column(0), batch.column(1)):
                got = [scanner.scan(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array([n for n, _ in got], pa.int64()),
                     pa.array([[dict(zip(("label", "base", "first", "stop"), p)) for p in ps] for _, ps in got], kind),
                     pa.array([_covered(ps) for _, ps in got], pa.int64())],
                    ["doc_id", "n_words", "places", "n_covered"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words long, "
             "places array<struct<label: string, base: boolean, first: bigint, stop: bigint>>, n_covered long")


def license_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``: base places counted, labels distinct, sorted and comma-joined;
    ``score`` is the share of the text's words inside an accepted place."""
    found = license_places(docs)
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["first"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.when(F.col("n_words") > 0, F.col("n_covered") / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"))
