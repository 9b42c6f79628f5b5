"""Packing documents into fixed-length sequences by cutting-stock column
generation.

1. One pass tokenises every text and keeps, per document, only its length and
   the checksums of its whole-sequence pieces and of the rest behind them.
2. The rests are counted by length class.  Filling sequences with them is a
   cutting-stock problem over that histogram (a fixed number of classes, so it
   is solved on the driver): a linear program over patterns, whose columns are
   priced by an unbounded-knapsack dynamic program until none improves it.
3. Pattern counts are rounded down.  Documents are ranked inside their class
   (range partitions, no single task) and ranks are dealt to the patterns'
   slots.
4. What rounding leaves over fills the gaps: the leftover documents' tokens
   and the sequences' gaps are two lines, cut at each other's borders.  So
   many pattern sequences are given up that the leftovers cover all gaps; what
   still remains makes whole sequences and, at the end, sequences of
   power-of-two lengths, which need no padding.
5. Only documents that were cut are tokenised again, for the pieces' checksums.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagwave.llm.common import FORGET, running_sum, text_chunks, text_key, tidied
from tagwave.llm.token_counts import byte_symbols
from tagwave.operators.joins import join_dimension
from tagwave.operators.sequence import global_row_number
from tagwave.operators.stage import stage
from tagwave.session import text_batches

VOCABULARY = "word_bpe_49k.json"
#: Distinct chunks whose numbers a worker remembers before it begins anew.
CHUNKS = 100_000
#: Words in a generation of those whose ids a worker remembers; it holds two.  A
#: full generation becomes the old one, whose members come back at their next
#: use; what a whole generation did not use is forgotten.
GENERATION = 250_000
#: Characters that Python splits at although the tokenizer keeps them.
_KEPT_BY_TOKENIZER = "\x1c\x1d\x1e\x1f"
#: The last character that Python folds and classes as the tokenizer does, whatever the version.
_FOLDED_HERE = "\u024f"
#: Signs that the tokenizer's pattern takes by themselves behind a word.
_STOPS = frozenset(".,;:!?")
#: Length of the blocks in which the two lines of step 4 are joined.
_BLOCK = 16_384


class _Numbers(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __init__(self, *args):
        super().__init__(*args)
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class WordIds:
    """Token ids of texts.  The tokenizer drops white space and never joins
    across it, so ids are looked up per white-space-delimited chunk.  A chunk
    not yet known is folded and split into words as the tokenizer file says
    (canonical composition, lower case, its pattern); each new word's ids come
    from the library's own model.  Chunks with characters beyond the Latin
    blocks, whose folding depends on the Unicode version, with control
    characters or special strings go through the library whole."""

    def __init__(self, path: str, end_id: int):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        if any(t["content"].isalnum() for t in spec["added_tokens"]):
            raise ValueError("special strings without a sign are not supported")
        self.symbols = byte_symbols()
        self.end_id = end_id
        largest = max(self.tokenizer.get_vocab_size(), end_id + 1)
        self.kind = np.dtype(np.uint16 if largest <= 1 << 16 else np.uint32)
        self._reset()

    def _reset(self) -> None:
        """Forget everything looked up."""
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self._forget_chunks()

    def _forget_chunks(self) -> None:
        self.index = _Numbers({"": 0})  # no chunk is empty: number 0 is the end id
        self.start = np.array([0, 1], np.int64)
        self.ids = np.array([self.end_id], self.kind)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _ids_of(self, chunk: str) -> bytes:
        """The ids of a chunk, as an array's bytes."""
        if chunk.isascii() and chunk.isalpha():
            return self._word(chunk.lower())
        head = chunk[:-1]
        if chunk[-1] in _STOPS and head.isascii() and head.isalpha():  # a word and a sign
            return self._word(head.lower()) + self._word(chunk[-1])
        if not chunk.isalnum() and self.special.search(chunk) or not chunk.isprintable() or not chunk.isascii() and max(chunk) > _FOLDED_HERE:
            return self._packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk)
        chunk = chunk.lower()
        if chunk.isalpha():
            return self._word(chunk)
        return b"".join([self._word(word) for word in self.pattern.findall(chunk)])

    def _word(self, word: str) -> bytes:
        """Ids of one match of the tokenizer's pattern."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.old_words.get(word)
            if ids is None:
                symbols = word if word.isascii() else "".join([self.symbols[b] for b in word.encode()])
                ids = self._packed([t.id for t in self.model.tokenize(symbols)])
            if len(self.words) >= GENERATION:
                self.old_words, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def _learn(self) -> None:
        """Ids of the chunks numbered since the last call."""
        parts = [self._ids_of(c) for c in self.index.new]
        self.index.new.clear()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.kind.itemsize
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(parts), self.kind)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with the end id."""
        if len(self.index) > CHUNKS:
            self._forget_chunks()
        whole = {k for k, t in enumerate(texts) if any(c in t for c in _KEPT_BY_TOKENIZER)}
        counts, at = [], []
        for k, t in enumerate(texts):
            words = [] if k in whole else t.split()
            words.append("")
            counts.append(len(words))
            at.append(np.fromiter(map(self.index.__getitem__, words), np.int64, len(words)))
        if self.index.new:
            self._learn()
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        first = self.start[at]
        size = self.start[at + 1] - first
        stop = np.cumsum(size)
        flat = self.ids[np.repeat(first - (stop - size), size) + np.arange(int(size.sum()))].astype(np.uint32)
        out = np.split(flat, stop[np.cumsum(counts)[:-1] - 1]) if counts else []
        for k in whole:
            ids = self.tokenizer.encode(texts[k], add_special_tokens=False).ids
            out[k] = np.array([*ids, self.end_id], np.uint32)
        return out


_ENCODERS: dict[tuple[str, int], WordIds] = {}


def _encoder(path: str | None, end_id: int) -> WordIds:
    where = path or public_tokenizers.path(VOCABULARY)
    if (where, end_id) not in _ENCODERS:
        _ENCODERS[where, end_id] = WordIds(where, end_id)
    return _ENCODERS[where, end_id]


def _forget() -> None:
    """What a task has looked up; the tokenizers stay."""
    for encoder in _ENCODERS.values():
        encoder._reset()


FORGET["packing"] = _forget


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def measure(docs: DataFrame, length: int, path: str | None, end_id: int) -> DataFrame:
    """``doc_id, rid, text_key, n, full_crcs, rest_crc``: each document's
    length in tokens, the checksums of its pieces of ``length`` and of the
    tokens behind them (0 if there are none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, end_id)
        for batch in batches:
            at = 0
            for rows, texts in text_chunks(batch.column(1), batch.column(3)):
                n, full, rest = [], [], []
                for ids in encoder.encode(texts):
                    whole = len(ids) // length
                    n.append(len(ids))
                    full.append([_crc(ids[k * length:(k + 1) * length]) for k in range(whole)])
                    rest.append(_crc(ids[whole * length:]))
                part = batch.slice(at, len(rows))
                at += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(n, pa.int64()),
                     pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.int64())],
                    ["doc_id", "rid", "text_key", "n", "full_crcs", "rest_crc"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.monotonically_increasing_id().alias("rid"),
                        text_key().alias("text_key"), "text")
            .mapInArrow(tidied(run, "packing"), f"doc_id {id_type}, rid long, text_key long, n long, "
                             "full_crcs array<long>, rest_crc long"))


def price(values: np.ndarray, units: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: copies of each item of most value in ``capacity``."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room], take[room] = best[room - 1], -1
        fit = np.flatnonzero(units <= room)
        if len(fit):
            gain = values[fit] + best[room - units[fit]]
            k = int(np.argmax(gain))
            if gain[k] > best[room] + 1e-12:
                best[room], take[room] = gain[k], fit[k]
    copies, room = np.zeros(len(units), np.int64), capacity
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            copies[take[room]] += 1
            room -= int(units[take[room]])
    return float(best[capacity]), copies


def solve_patterns(units: np.ndarray, demand: np.ndarray, capacity: int,
                   rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a row each: copies of each class) and how often the linear
    program uses them, so that every class's demand is met with the fewest
    sequences.  Revised simplex; each column comes from the knapsack."""
    basis = np.diag(capacity // units).astype(float)  # columns: patterns of one class
    used = demand / np.diag(basis)
    for _ in range(rounds):
        duals = np.linalg.solve(basis.T, np.ones(len(units)))
        worth, column = price(duals, units, capacity)
        if worth <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(step > 1e-12, used / np.where(step > 1e-12, step, 1), np.inf)
        leaves = int(np.argmin(ratio))
        used = np.maximum(used - ratio[leaves] * step, 0)
        used[leaves] = ratio[leaves]
        basis[:, leaves] = column
    return basis.T.round().astype(np.int64), used


def choose_patterns(histogram: list[tuple[int, int, int]], length: int,
                    classes: int) -> tuple[list[tuple[int, dict[int, int]]], int]:
    """From (class, documents, tokens) rows: ``[(times, {class: copies})]``
    and the number of sequences.  Counts are rounded down, then sequences with
    the largest gaps are given up until the documents left over have as many
    tokens as the gaps, and a margin."""
    units = np.array([h[0] for h in histogram], np.int64)
    demand = np.array([h[1] for h in histogram], float)
    mean = np.array([h[2] for h in histogram], float) / demand
    patterns, used = solve_patterns(units, demand, classes)
    times = np.floor(used + 1e-9).astype(np.int64)
    gap = length - patterns @ mean
    left = demand - patterns.T @ times
    short = (times * gap).sum() * 1.02 + 2 * length - (left * mean).sum()
    for k in np.argsort(-gap):
        if short <= 0:
            break
        given_up = min(int(times[k]), int(-(-short // length)))
        times[k] -= given_up
        short -= given_up * length
    chosen = [(int(t), {int(u): int(c) for u, c in zip(units, p) if c}) for t, p in zip(times, patterns) if t > 0]
    return chosen, sum(t for t, _ in chosen)


def _slots(patterns: list[tuple[int, dict[int, int]]], first_sequence: int) -> list[tuple]:
    """(class, first rank, end rank, copies, first sequence, first slot): which
    ranks of a class go to which pattern."""
    out, cursor, base = [], {}, first_sequence
    for times, copies in patterns:
        slot = 0
        for cls, n in copies.items():
            lo = cursor.get(cls, 0)
            cursor[cls] = lo + times * n
            out.append((cls, lo, cursor[cls], n, base, slot))
            slot += n
        base += times
    return out


def _blocks(lo: Column, size: Column) -> Column:
    block = F.lit(_BLOCK).cast("long")
    return F.explode(F.sequence(F.floor(lo / block), F.floor((lo + size - 1) / block)))


def _cut(rest: DataFrame, gaps: DataFrame) -> DataFrame:
    """Pieces of the leftover documents, cut where a gap or a document ends."""
    a = rest.withColumn("block", _blocks(F.col("lo"), F.col("size")))
    b = gaps.withColumn("block", _blocks(F.col("gap_lo"), F.col("gap")))
    begin = F.greatest("lo", "gap_lo")
    end = F.least(F.col("lo") + F.col("size"), F.col("gap_lo") + F.col("gap"))
    return (a.join(b, "block").where((begin < end) & (F.floor(begin / F.lit(_BLOCK).cast("long")) == F.col("block")))
            .select("doc_id", "rid", "text_key", "n",
                    (F.col("rest_start") + begin - F.col("lo")).cast("long").alias("start"),
                    (end - begin).cast("long").alias("length"), "sequence_id",
                    (F.col("fill") + begin - F.col("gap_lo")).cast("long").alias("offset")))


def _piece_crcs(docs: DataFrame, pieces: DataFrame, path: str | None, end_id: int) -> DataFrame:
    """``pieces`` with ``ids_crc32``, by tokenising the cut documents again."""
    wanted = pieces.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("cuts"))
    texts = join_dimension(docs.select("doc_id", text_key().alias("text_key"), "text"), wanted,
                           ["doc_id", "text_key"], "inner", null_safe=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, end_id)
        for batch in batches:
            at = 0
            for _, chunk in text_chunks(batch.column(1), batch.column(2)):
                part = batch.slice(at, len(chunk))
                at += len(chunk)
                rows = ([], [], [])
                source = []
                for k, (ids, cuts) in enumerate(zip(encoder.encode(chunk), part.column(3).to_pylist())):
                    for cut in cuts:
                        source.append(k)
                        rows[0].append(cut["start"])
                        rows[1].append(cut["length"])
                        rows[2].append(_crc(ids[cut["start"]:cut["start"] + cut["length"]]))
                source = pa.array(source, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(source), part.column(1).take(source),
                     *(pa.array(r, pa.int64()) for r in rows)],
                    ["doc_id", "text_key", "start", "length", "ids_crc32"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    crcs = (texts.select("doc_id", "text_key", "text", "cuts")
            .mapInArrow(tidied(run, "packing"), f"doc_id {id_type}, text_key long, start long, length long, ids_crc32 long")
            .dropDuplicates(["doc_id", "text_key", "start", "length"]))
    return join_dimension(pieces, crcs, ["doc_id", "text_key", "start", "length"], "inner", null_safe=True)


def pack(docs: DataFrame, length: int = 4096, classes: int = 64, path: str | None = None,
         end_id: int = 2) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``,
    one row per piece of a document.

    ``path``: the tokenizer's file, the same on all workers (default: the
    public 49k one).  A null or empty text is one token, the end id.  Repeated
    rows and ids are packed each by itself, null ids too; an empty table gives
    no rows; other columns are ignored.  ``length`` must be a multiple of
    ``classes``, the number of length classes of the histogram.
    """
    if length % classes:
        raise ValueError("length must be a multiple of classes")
    with text_batches(docs.sparkSession):
        return _packed(docs.select("doc_id", "text"), length, classes, path, end_id)


def _packed(docs: DataFrame, length: int, classes: int, path: str | None, end_id: int) -> DataFrame:
    spark = docs.sparkSession
    rows = stage(measure(docs, length, path, end_id), "pack-rows")
    whole = F.size("full_crcs")
    ids_of = ["doc_id", "rid", "text_key", "n"]

    # whole sequences of long documents
    long_docs = rows.where(whole > 0).select("doc_id", "rid", "n", "full_crcs", whole.cast("long").alias("k"))
    numbered = running_sum(long_docs, ["doc_id", "rid"], "k", "first")
    n_whole = rows.agg(F.sum(whole.cast("long"))).first()[0] or 0
    full = (numbered.select("doc_id", "n", "first", F.posexplode("full_crcs").alias("j", "ids_crc32"))
            .select("doc_id", (F.col("j") * F.lit(length).cast("long")).alias("start"),
                    F.lit(length).cast("long").alias("length"), "ids_crc32", F.col("n").alias("doc_tokens"),
                    (F.col("first") + F.col("j")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))

    # the rests, by class
    unit = length // classes
    rests = (rows.withColumn("rest_start", (whole * F.lit(length)).cast("long"))
             .withColumn("size", F.col("n") - F.col("rest_start")).where("size > 0")
             .withColumn("cls", F.ceil(F.col("size") / F.lit(unit)).cast("long"))
             .select(*ids_of, "rest_start", "size", "rest_crc", "cls"))
    histogram = sorted((r["cls"], r["docs"], r["tokens"]) for r in rests.groupBy("cls").agg(  # at most `classes` rows
        F.count(F.lit(1)).alias("docs"), F.sum("size").alias("tokens")).collect())
    if not histogram:
        return full
    patterns, n_patterns = choose_patterns(histogram, length, classes)
    before = dict(zip([h[0] for h in histogram], np.cumsum([0] + [h[1] for h in histogram]).tolist()))
    class_start = F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv])
    ranked = (global_row_number(rests, ["cls", "doc_id", "rid"], out="pos")
              .withColumn("rank", F.col("pos") - 1 - class_start[F.col("cls")]))
    slots = spark.createDataFrame(
        _slots(patterns, int(n_whole)),
        "cls long, rank_lo long, rank_hi long, copies long, base long, first_slot long")
    inside = (F.col("rank") >= F.col("rank_lo")) & (F.col("rank") < F.col("rank_hi"))
    dealt = stage(
        ranked.alias("r").join(F.broadcast(slots.alias("s")),  # at most classes^2 rows
                               (F.col("r.cls") == F.col("s.cls")) & inside, "left")
        .select(*(f"r.{c}" for c in [*ids_of, "rest_start", "size", "rest_crc"]),
                (F.col("base") + F.floor((F.col("rank") - F.col("rank_lo")) / F.col("copies"))).alias("sequence_id"),
                (F.col("first_slot") + (F.col("rank") - F.col("rank_lo")) % F.col("copies")).alias("slot")),
        "pack-dealt")

    # documents that stay whole, in their pattern's order
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.where(F.col("sequence_id").isNotNull())
    kept = (placed.withColumn("offset", F.coalesce(F.sum("size").over(earlier), F.lit(0)).cast("long"))
            .select("doc_id", F.col("rest_start").alias("start"), F.col("size").alias("length"),
                    F.col("rest_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id", "offset"))

    # the others fill the gaps
    gaps = (placed.groupBy("sequence_id").agg(F.sum("size").cast("long").alias("fill"))
            .withColumn("gap", F.lit(length).cast("long") - F.col("fill")).where("gap > 0"))
    gaps = running_sum(gaps, ["sequence_id"], "gap", "gap_lo")
    room = gaps.agg(F.sum("gap")).first()[0] or 0
    spare = dealt.where(F.col("sequence_id").isNull()).drop("sequence_id", "slot")
    tokens = spare.agg(F.sum("size")).first()[0] or 0
    if not tokens:
        return full.unionByName(kept)
    base, more = int(n_whole) + n_patterns, max(0, tokens - room)
    extra = spark.range(more // length).select(
        (F.col("id") + base).alias("sequence_id"), F.lit(0).cast("long").alias("fill"),
        F.lit(length).cast("long").alias("gap"), (F.lit(room) + F.col("id") * length).cast("long").alias("gap_lo"))
    last, lo, tail = base + more // length, room + more // length * length, []
    for bit in reversed(range(length.bit_length())):  # sequences of power-of-two lengths
        if more % length >> bit & 1:
            tail.append((last + len(tail), 0, 1 << bit, lo))
            lo += 1 << bit
    gaps = gaps.select("sequence_id", "fill", "gap", "gap_lo").unionByName(extra).unionByName(
        spark.createDataFrame(tail, "sequence_id long, fill long, gap long, gap_lo long"))
    line = running_sum(spare, ["doc_id", "rid"], "size", "lo")
    cut = stage(_cut(line, gaps), "pack-cuts")
    filled = stage(_piece_crcs(docs, cut, path, end_id).select(
        "doc_id", "start", "length", "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", "offset"), "pack-filled")
    return full.unionByName(kept).unionByName(filled)
