"""Personal data: patterns propose spans, checksums confirm them, context
words adjust their score.

Work is row-wise: texts stay where they are, only spans come back.  Each
pattern is linear in the text (runs are taken whole and not tried again from
inside; only account numbers are, over a bounded number of characters), so one
very long text costs no more than many short ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwave.llm.common import text_chunks

#: Kinds in their order; the first four are always kept, the others need a score.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")

# The patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}.items() for country in countries.split()}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{32,64}(?![A-Za-z0-9_])")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[a-z]+")

# What a span scores before its context, and the words nearby
# that raise it.
_PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "secret": 0.2}
_CONTEXT = {
    "email": {"mail", "email", "contact", "write"},
    "ip": {"ip", "host", "server", "address", "ping"},
    "card": {"card", "visa", "credit", "payment", "mastercard"},
    "phone": {"phone", "tel", "call", "mobile", "fax"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "secret": {"token", "key", "secret", "password", "apikey", "bearer"},
}
_RAISE, _REACH = 0.3, 40


@dataclass(frozen=True, order=True)
class Span:
    """A finding: code-point offsets, end exclusive; sorts by start, then kind."""

    start: int
    order: int
    end: int
    score: float = 0.0

    @property
    def kind(self) -> str:
        return KINDS[self.order]

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    """The card checksum: every second digit from the right doubled."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d *= 1 + k % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(text: str) -> bool:
    """The account checksum: the rotated number, letters as 10 to 35, is 1 modulo 97."""
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits and what may stand between them
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The match may hold words after the number: its part of the country's own
    length is tried first, then the whole; of an unknown country all parts that
    end at a blank, longest first.  The search goes on after an accepted part,
    or from the next word of a match without one."""
    m = _IBAN.search(text)
    while m:
        start, own = m.start(), _IBAN_LENGTHS.get(m[0][:2])
        ends = [m.end(), *(start + k for k in range(len(m[0]) - 1, 0, -1) if text[start + k] == " ")]
        sizes = {end: end - start - text.count(" ", start, end) for end in ends}
        if own:
            ends = [*(end for end in ends if sizes[end] == own), m.end()]
        end = next((end for end in ends if 15 <= sizes[end] <= 34 and mod97(text[start:end])), None)
        if end:
            yield start, end
        m = _IBAN.search(text, end or start + 1)


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    for m in _SECRET.finditer(text):
        if _DIGIT.search(m[0]) and not m[0].isdigit():
            yield m.span()


def _context_score(text: str, kind: str, start: int, end: int) -> float:
    near = _WORD.findall((text[max(0, start - _REACH):start] + " " + text[end:end + _REACH]).lower())
    return min(1.0, _PRIOR[kind] + (_RAISE if _CONTEXT[kind].intersection(near) else 0.0))


def find_spans(text: str, min_score: float = 0.5) -> list[Span]:
    """All findings in a text, by start and kind.  Kinds beyond the base ones
    need ``min_score``."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(*s, "email") for s in _emails(text)]
    if _DIGIT.search(text):
        for kind, finder in (("ip", _ips), ("card", _cards), ("phone", _phones), ("iban", _ibans)):
            found += [(*s, kind) for s in finder(text)]
        found += [(*m.span(), "ssn") for m in _SSN.finditer(text)]
        found += [(*s, "secret") for s in _secrets(text)]
    out = [Span(a, KINDS.index(kind), b, round(_context_score(text, kind, a, b), 3)) for a, b, kind in found]
    return sorted(s for s in out if s.kind in BASE_KINDS or s.score >= min_score)


def personal_data(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, stop, score>>`` of every text.

    Offsets are code points, ``stop`` exclusive.  A null text has no spans;
    repeated rows and ids give a row each, an empty table no rows; other
    columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                               ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in text_chunks(batch.column(0), batch.column(1)):
                rows = [[{"kind": s.kind, "start": s.start, "stop": s.end, "score": s.score}
                         for s in find_spans(t, min_score)] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(rows, kind)], ["doc_id", "spans"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, spans array<struct<kind: string, start: bigint, stop: bigint, score: double>>")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts per base kind, ``base_sha256`` of the base spans and all
    ``spans`` as ``kind:start:end`` texts; ``risk`` is the highest score."""
    found = personal_data(docs)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *map(number, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("risk"))


def redact(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by its kind in brackets
    (overlapping findings by the first); null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t in batch.column(batch.schema.get_field_index("text")).to_pylist():
                if t is not None:
                    done, parts = 0, []
                    for s in find_spans(t, min_score):
                        if s.start >= done:
                            parts += [t[done:s.start], f"[{s.kind}]"]
                            done = s.end
                    t = "".join([*parts, t[done:]])
                texts.append(t)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
