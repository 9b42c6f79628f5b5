"""Fill-in-middle transformation over a Roaring-style set of line ends.

A text is cut at two of its unit ends (a unit is a line with its newline, or
what follows the last newline) into prefix, middle and suffix, and put
together again with marker strings around the moved parts: ``psm`` (prefix,
suffix, middle) or ``spm`` (suffix, prefix, middle).

The ends of a text's units are held as a set of byte offsets in containers of
2^16 offsets each (``BoundarySet``): sorted 16-bit arrays where few offsets
fall, bitmaps where many do, runs where they follow each other.  Cumulative
cardinalities over the containers answer *which offset is the k-th end?*: a
binary search finds the container, a select inside it the offset.  Both cuts
are two such selects.  What a task holds is one Arrow batch, one text's set
and one chunk of outputs; no rows move between tasks.

Cuts, order and rate come from the first four 8-digit groups of the hex
SHA-256 of ``<seed>:<doc_id>``, so reruns and lost executors change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTAINER = 1 << 16
ARRAY_MAX = 4096  # beyond so many offsets a bitmap is smaller than an array
_WORDS = CONTAINER // 64


@dataclass(frozen=True)
class ArrayContainer:
    """Sorted 16-bit values."""

    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])

    def rank(self, low: int) -> int:
        return int(np.searchsorted(self.values, low, side="right"))


@dataclass(frozen=True)
class BitmapContainer:
    """2^16 bits in 64-bit words, with the number of bits before each word."""

    words: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        w = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[w:w + 1].view(np.uint8), bitorder="little")
        return w * 64 + int(np.flatnonzero(bits)[k - int(self.before[w])])

    def rank(self, low: int) -> int:
        w, bit = divmod(low, 64)
        mask = (1 << (bit + 1)) - 1
        return int(self.before[w]) + (int(self.words[w]) & mask).bit_count()


@dataclass(frozen=True)
class RunContainer:
    """Runs of consecutive values: first values, and the values before each run."""

    starts: np.ndarray
    before: np.ndarray
    size: int

    def select(self, k: int) -> int:
        r = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[r]) + k - int(self.before[r])

    def rank(self, low: int) -> int:
        r = int(np.searchsorted(self.starts, low, side="right")) - 1
        if r < 0:
            return 0
        end = int(self.before[r + 1]) if r + 1 < len(self.before) else self.size
        return min(int(self.before[r]) + low - int(self.starts[r]) + 1, end)


Container = ArrayContainer | BitmapContainer | RunContainer


def _container(low: np.ndarray) -> Container:
    """The smallest of the three forms for sorted, distinct 16-bit values."""
    first = np.flatnonzero(np.diff(low.astype(np.int32), prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(low), CONTAINER // 8):
        return RunContainer(low[first].astype(np.uint16), first.astype(np.int64), len(low))
    if len(low) <= ARRAY_MAX:
        return ArrayContainer(low.astype(np.uint16))
    bits = np.zeros(CONTAINER, dtype=np.uint8)
    bits[low] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    counts = np.bitwise_count(words).astype(np.int64)
    return BitmapContainer(words, np.cumsum(counts) - counts)


class BoundarySet:
    """A set of offsets that gives its k-th smallest member and the number of
    members up to an offset."""

    def __init__(self, offsets: np.ndarray):
        """``offsets``: sorted and distinct, not negative."""
        high = offsets >> 16
        first = np.flatnonzero(np.diff(high, prepend=-1))
        ends = np.append(first[1:], len(offsets))
        self.keys = high[first]
        self.cumulative = np.append(first, len(offsets)).astype(np.int64)
        self.containers = [_container(offsets[a:b] & (CONTAINER - 1)) for a, b in zip(first, ends)]

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, k: int) -> int:
        """The ``k``-th smallest member, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        c = int(np.searchsorted(self.cumulative, k, side="right")) - 1
        return (int(self.keys[c]) << 16) + self.containers[c].select(k - int(self.cumulative[c]))

    def rank(self, offset: int) -> int:
        """How many members are at most ``offset``."""
        c = int(np.searchsorted(self.keys, offset >> 16, side="right")) - 1
        if c < 0:
            return 0
        if int(self.keys[c]) < offset >> 16:
            return int(self.cumulative[c + 1])
        return int(self.cumulative[c]) + self.containers[c].rank(offset & (CONTAINER - 1))


def line_ends(text: bytes) -> BoundarySet:
    """Ends of the units ``[^\\n]*\\n|[^\\n]+`` of a UTF-8 text, as byte offsets
    (a newline is one byte in UTF-8 and part of no other character)."""
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return BoundarySet(ends)


def _chars(part: bytes) -> int:
    """Code points of UTF-8 bytes: those that do not continue a character."""
    return int(np.count_nonzero((np.frombuffer(part, dtype=np.uint8) & 0xC0) != 0x80))


@dataclass(frozen=True)
class FillMiddle:
    """Parameters: seed of the draws, the three markers, percent of the texts
    to transform and percent of those in ``spm`` order."""

    seed: int = 7
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    rate: int = 100
    spm_rate: int = 50

    def markers(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()

    def cut(self, doc_id: str, text: bytes) -> tuple[int, str, int | None, int | None, bytes]:
        """Units, form, prefix and middle characters, output of one text."""
        ends = line_ends(text)
        n = len(ends)
        p, s, m = self.markers()
        digest = hashlib.sha256(f"{self.seed}:{doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
        if not text or p in text or s in text or m in text or h3 % 100 >= self.rate:
            return n, "plain", None, None, text
        units = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (ends.select(k - 1) if k else 0 for k in units)
        head, mid, tail = text[:a], text[a:b], text[b:]
        if h4 % 100 < self.spm_rate:
            return n, "spm", _chars(head), _chars(mid), b"".join((s, tail, p, head, m, mid))
        return n, "psm", _chars(head), _chars(mid), b"".join((p, head, s, tail, m, mid))


_CHUNK_BYTES = 4_000_000


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list]]:
    """(first row, texts) of parts of a batch holding about ``_CHUNK_BYTES``."""
    at, out, size = 0, [], 0
    for t in batch.column(1):
        out.append(t.as_py() or b"")
        size += len(out[-1])
        if size >= _CHUNK_BYTES:
            yield at, out
            at, out, size = at + len(out), [], 0
    if out:
        yield at, out


def fill_in_middle(docs: DataFrame, params: FillMiddle | None = None) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row.

    ``n`` counts the text's units; ``form`` is ``plain`` (``output`` is the
    text; empty texts, texts that hold a marker, texts beyond ``rate``),
    ``psm`` or ``spm``; the character counts are null for ``plain``.

    A null text counts as empty; a null ``doc_id`` draws with an empty id and
    stays null; repeated rows and ids give a row each; an empty table gives no
    rows; other columns are ignored.
    """
    params = params or FillMiddle()
    if len({params.prefix, params.suffix, params.middle}) < 3 or not all(params.markers()):
        raise ValueError("the three markers must differ and must not be empty")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _chunks(batch):
                ids = batch.column(0).slice(at, len(texts))
                rows = [params.cut("" if i is None else str(i), t) for i, t in zip(ids.to_pylist(), texts)]
                n, form, head, mid, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(head, pa.int64()),
                     pa.array(mid, pa.int64()), pa.array(output, pa.binary())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    made = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, params: FillMiddle | None = None) -> Column:
    """The text that ``output`` in ``form`` was made of: parts between markers,
    put back in order.  A marker cannot also begin inside a part, as texts that
    hold one stay ``plain``."""
    params = params or FillMiddle()
    p, s, m = (F.lit(x) for x in (params.prefix, params.suffix, params.middle))

    def after(marker: Column) -> Column:
        return F.split_part(output, marker, F.lit(2))

    def upto(part: Column, marker: Column) -> Column:
        return F.split_part(part, marker, F.lit(1))

    psm = F.concat(upto(after(p), s), after(m), upto(after(s), m))
    spm = F.concat(upto(after(p), m), after(m), upto(after(s), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle_digest(docs: DataFrame, params: FillMiddle | None = None) -> DataFrame:
    """The transformation's columns with SHA-256 sums in place of the output:
    ``output_sha256``, and ``restored_sha256`` of the text rebuilt from output
    and form."""
    made = fill_in_middle(docs, params)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), params), 256).alias("restored_sha256"))


ORACLE_SQL = """with
  d as (select doc_id, coalesce(text, '') as t,
          regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as u,
          sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
  g as (select *, len(u) as n,
          cast('0x' || h[1:8] as ubigint) as h1, cast('0x' || h[9:16] as ubigint) as h2,
          cast('0x' || h[17:24] as ubigint) as h3, cast('0x' || h[25:32] as ubigint) as h4 from d),
  c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
          case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100
                 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from g),
  p as (select *, array_to_string(u[1:a], '') as head, array_to_string(u[a + 1:b], '') as mid,
          array_to_string(u[b + 1:], '') as tail from c)
  select doc_id, cast(n as bigint) as n, form,
    case when form <> 'plain' then cast(length(head) as bigint) end as prefix_chars,
    case when form <> 'plain' then cast(length(mid) as bigint) end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || head || '<S>' || tail || '<M>' || mid
                else '<S>' || tail || '<P>' || head || '<M>' || mid end) as output_sha256,
    sha256(t) as restored_sha256
  from p"""
