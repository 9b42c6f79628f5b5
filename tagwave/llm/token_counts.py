"""Token counts by rank-synchronous merging of ragged arrays.

A byte-level BPE applies, inside each pre-token, the known pair of lowest rank
again and again.  A pair that a merge creates always has a higher rank than
the merge itself, so all places of a sequence's lowest pair can be merged at
once.  Here the pre-tokens of many texts are one flat symbol array with a row
length each; every round finds each row's lowest rank, merges that pair
wherever it stands in the row, and drops rows without a known pair left.  The
number of symbols left in a row is its token count.

Every distinct pre-token is merged once per chunk and remembered by the worker
in a table of bounded size.  Work is row-wise per partition: no shuffle, and a
lost task is simply run again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tagwave.llm.common import text_chunks

VOCABULARY = "byte_bpe_50k.json"
#: Pre-tokens a worker remembers before it starts afresh (about 100 bytes each).
CACHE_SIZE = 400_000
#: Pre-tokens merged in one flat array, and taken at a time from a long text.
BLOCK = 200_000

_NONE = np.int32(2**31 - 1)
_SHIFT = np.int64(20)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in out]
    return out | {b: chr(256 + n) for n, b in enumerate(rest)}


class RaggedBPE:
    """Counts the tokens of texts under one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = (left << _SHIFT) | right
        order = np.argsort(keys)
        self._fill_table(keys[order], order.astype(np.int32))
        names = byte_symbols()
        self.byte_ids = np.array([vocab[names[b]] for b in range(256)], np.int32)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cache: dict[str, int] = {}

    def _fill_table(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """An open-addressing table of the pairs, probed with array reads."""
        self.bits = 18
        size = 1 << self.bits
        self.table = np.full(size, -1, np.int64)
        self.ranks = np.full(size, _NONE, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.table[slot[todo]] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(np.where(free, slot[todo], -1 - todo), return_index=True)[1]] = True
            put = todo[free & first]
            self.table[slot[put]] = keys[put]
            self.ranks[slot[put]] = ranks[put]
            todo = todo[~(free & first)]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << _SHIFT) | right
        slot = self._slot(keys)
        seen = self.table[slot]
        out = np.where(seen == keys, self.ranks[slot], _NONE)
        todo = np.flatnonzero((seen != keys) & (seen >= 0))
        for _ in range(self.probes):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & (len(self.table) - 1)
            seen = self.table[slot[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
        return out

    def merge(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) pre-token after all merges."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        counts = size.copy()
        row = np.arange(len(words))
        sym = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        rank = np.full(len(sym), _NONE, np.int32)
        if len(sym) > 1:
            rank[:-1] = self._rank(sym[:-1], sym[1:])
        rank[np.cumsum(size) - 1] = _NONE
        while len(row):
            start = np.cumsum(size) - size
            lowest = np.minimum.reduceat(rank, start)
            live = lowest < _NONE
            if not live.all():
                counts[row[~live]] = size[~live]
                stay = np.repeat(live, size)
                sym, rank, size, row, lowest = sym[stay], rank[stay], size[live], row[live], lowest[live]
                if not len(row):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # in a run of one symbol the pairs overlap: every second one merges
            begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            place = np.arange(len(at)) - np.repeat(begins, np.diff(begins, append=len(at)))
            at = at[place % 2 == 0]
            sym[at] = self.merged[rank[at]]
            gone = np.zeros(len(sym), bool)
            gone[at + 1] = True
            rank[at] = rank[at + 1]  # a row's end stays an end
            ends = rank == _NONE
            is_end = np.zeros(len(sym), bool)
            is_end[np.cumsum(size) - 1] = True
            is_end[at] |= is_end[at + 1]
            size = size - np.add.reduceat(gone.astype(np.int64), np.cumsum(size) - size)
            new = np.zeros(len(sym), bool)
            new[at] = True
            keep = ~gone
            sym, rank, is_end, new, ends = sym[keep], rank[keep], is_end[keep], new[keep], ends[keep]
            # ranks change at a merged symbol and at the one before it
            new[:-1] |= new[1:]
            redo = np.flatnonzero(new & ~is_end)
            rank[redo] = self._rank(sym[redo], sym[redo + 1])
            rank[is_end] = _NONE
        return counts

    def _learn(self, words: set[str]) -> None:
        if len(self.cache) + len(words) > CACHE_SIZE:
            self.cache.clear()
        todo = list(words)
        for k in range(0, len(todo), BLOCK):
            part = todo[k:k + BLOCK]
            self.cache.update(zip(part, self.merge([w.encode() for w in part]).tolist()))

    def _segments(self, text: str) -> tuple[int, list[str]]:
        """Special strings in a text count as one token each and split it."""
        if self.special is None or not self.special.search(text):
            return 0, [text]
        parts = self.special.split(text)
        return len(parts) - 1, parts

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        out: list[int] = []
        held: list[tuple[int, list[str]]] = []
        unseen: set[str] = set()

        def settle() -> None:
            if not unseen <= self.cache.keys():
                self._learn({w for _, ws in held for w in ws} if len(self.cache) + len(unseen) > CACHE_SIZE
                            else unseen - self.cache.keys())
            for k, words in held:
                out[k] += sum(map(self.cache.__getitem__, words))
            held.clear()
            unseen.clear()

        for k, text in enumerate(texts):
            n, parts = self._segments(text)
            out.append(n)
            for part in parts:
                found = (m[0] for m in self.pattern.finditer(part)) if len(part) > 5 * BLOCK else None
                while words := list(islice(found, BLOCK)) if found else self.pattern.findall(part):
                    held.append((k, words))
                    unseen.update(words)
                    if found is None:
                        break
                    settle()
        settle()
        return out


_COUNTERS: dict[str, RaggedBPE] = {}


def _counter(path: str) -> RaggedBPE:
    """A worker's counter for a vocabulary, kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = RaggedBPE(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text.

    ``path``: a byte-level BPE file of the tokenizers library, the same on all
    workers; by default the public 50k one.  No special tokens are added;
    special strings inside a text count as the library counts them.  A null
    text counts as empty (0 tokens), repeated rows and ids give a row each, an
    empty table gives no rows, other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _counter(path or public_tokenizers.path(VOCABULARY))
        for batch in batches:
            for ids, texts in text_chunks(batch.column(0), batch.column(1)):
                n = bpe.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(0).type),
                     pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
