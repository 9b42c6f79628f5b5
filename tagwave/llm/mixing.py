"""Mixing sources to target weights, in blocks of words.

1. *Pack.*  Each source's documents stand one after another, ordered by id
   (and text hash), and their words are packed into blocks of ``block`` words;
   a block is a set of spans (document, first word, words).  Positions come from
   one range shuffle of narrow rows and a sum per partition.
2. *Target.*  Sources share all words by weight; a target stops at ``cap`` times
   its source's size and the excess is shared anew among the others
   (``targets``, exact fractions).
3. *Draw.*  The mix is a row of shards of ``shard`` slots, a block each.  Every
   shard draws its source counts: a multinomial draw, given that the draws of
   all shards together meet the sources' exact totals.  Such draws can be made
   top down: a range of shards is halved and the counts of its left half are
   drawn without replacement from those of the whole (a multivariate
   hypergeometric draw).  A task walks from the root to its own shards and
   needs no other task; the draw at a node depends on the seed and the node only.
4. *Map.*  The draws number the slots of a source 0, 1, 2, ...; number ``j`` is
   place ``j mod blocks`` of pass ``j div blocks`` over the source, and a
   pseudorandom permutation of the block numbers, another one for each source
   and pass, tells its block.  It is a Feistel network with cycle walking,
   computed per slot, with nothing stored.
5. *Join* slots and blocks by (source, block number).  A number is in a source
   once and in a pass once, so no key is hot, whatever a source holds.

The last slot of a source is cut to the words still missing, so a source gives
its target to the word, and no document exceeds ``cap`` times its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tagwave.llm.common import splitmix, text_key
from tagwave.operators.stage import stage

#: numpy draws without replacement from fewer than 10^9 items; larger mixes are
#: dealt out evenly, in parts of this many slots, before the draws.
PART_SLOTS = 1 << 28


@dataclass(frozen=True)
class Mix:
    """Parameters: weights by the sources' order (repeating), words per block,
    slots per shard, how often a source may be repeated, seed of the draws and
    the most sources a mix may have (their table is held by the driver)."""

    weights: Sequence[int] = (5, 2, 1)
    block: int = 1024
    shard: int = 1024
    cap: int = 3
    seed: int = 11
    max_sources: int = 100_000


def targets(sizes: Sequence[int], weights: Sequence[int], cap: int = 3) -> list[Fraction]:
    """Words each source should give: all words shared by weight, nobody above
    ``cap`` times its size, what a source cannot take shared by weight among
    those still below."""
    total, out = sum(sizes), [Fraction(0)] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        unit = Fraction(total, sum(weights[i] for i in free))
        full = [i for i in free if unit * weights[i] > cap * sizes[i]]
        if not full:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = Fraction(cap * sizes[i])
            total -= cap * sizes[i]
        full = set(full)
        free = [i for i in free if i not in full]
    return out


class Permutation:
    """A pseudorandom permutation of 0 .. n - 1 and its inverse, for arrays."""

    ROUNDS = 4

    def __init__(self, n: int, key: str):
        self.n = n
        self.half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        digest = hashlib.sha256(key.encode()).digest()
        self.keys = np.frombuffer(digest, dtype="<u8")[:self.ROUNDS]

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ (splitmix(left + k) & self.mask), left
            else:
                left, right = right, left ^ (splitmix(right + k) & self.mask)
        return (left << self.half) | right

    def __call__(self, places: np.ndarray, back: bool = False) -> np.ndarray:
        x = self._once(places.astype(np.uint64), back)
        while (out := x >= np.uint64(self.n)).any():  # at most 4 numbers per member
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)


@dataclass(frozen=True)
class Source:
    """One source of a mix: its share and how its slots are numbered."""

    name: str | None
    base: int  # words of the sources before it
    size: int
    target: Fraction
    take: int  # the target in whole words
    blocks: int
    slots: int
    last: int  # words of its last slot

    def permutation(self, seed: int, epoch: int) -> Permutation:
        return _permutation(seed, self.name, epoch, self.blocks)


def _permutation(seed: int, name: str | None, epoch: int, blocks: int) -> Permutation:
    return Permutation(blocks, f"{seed}:{epoch}:{'null' if name is None else 'source ' + name}")


def _slots(name: str | None, size: int, take: int, mix: Mix) -> tuple[int, int, int]:
    """Blocks of a source, slots that give ``take`` words, words of the last slot."""
    blocks = -(-size // mix.block)
    if not take:
        return blocks, 0, 0
    epochs, rest = divmod(take, size)
    if not rest:  # whole passes; the last place may hold the short block
        last_block = int(_permutation(mix.seed, name, epochs - 1, blocks)(np.array([blocks - 1]))[0])
        return blocks, epochs * blocks, min(mix.block, size - last_block * mix.block)
    # The place of the short block in the last pass, and the words before it.
    at = int(_permutation(mix.seed, name, epochs, blocks)(np.array([blocks - 1]), back=True)[0])
    short, before = size - (blocks - 1) * mix.block, at * mix.block
    if rest <= before:
        full = -(-rest // mix.block)
        return blocks, epochs * blocks + full, rest - (full - 1) * mix.block
    if rest <= before + short:
        return blocks, epochs * blocks + at + 1, rest - before
    over = rest - before - short
    more = -(-over // mix.block)
    return blocks, epochs * blocks + at + 1 + more, over - (more - 1) * mix.block


def plan_sources(sizes: dict[str | None, int], mix: Mix) -> list[Source]:
    """The sources in code point order, null last, with targets and slots."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(names))]
    goal = targets([sizes[n] for n in names], weights, mix.cap)
    out, base = [], 0
    for name, target in zip(names, goal):
        take = int(target + Fraction(1, 2))
        out.append(Source(name, base, sizes[name], target, take, *_slots(name, sizes[name], take, mix)))
        base += sizes[name]
    return out


class Draws:
    """Source counts of every shard, found from the root down."""

    def __init__(self, totals: Sequence[int], mix: Mix):
        self.seed, self.shard = mix.seed, mix.shard
        parts = max(1, -(-sum(totals) // PART_SLOTS))
        self.starts = [[t * p // parts for t in totals] for p in range(parts + 1)]
        slots = [sum(b) - sum(a) for a, b in zip(self.starts, self.starts[1:])]
        self.slots = slots
        self.first_shard = np.concatenate([[0], np.cumsum([-(-n // mix.shard) for n in slots])]).astype(np.int64)

    @property
    def shards(self) -> int:
        return int(self.first_shard[-1])

    def between(self, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, counts, numbers before it) by source for shards low .. high - 1."""
        for p in range(len(self.slots)):
            a, b = int(self.first_shard[p]), int(self.first_shard[p + 1])
            if a < min(high, b) and low < b:
                start = np.array(self.starts[p], dtype=np.int64)
                counts = np.array(self.starts[p + 1], dtype=np.int64) - start
                yield from self._walk(a, a, b, counts, start, max(low, a), min(high, b))

    def _walk(self, first: int, a: int, b: int, counts: np.ndarray, start: np.ndarray, low: int,
              high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if b - a == 1:
            yield a, counts, start
            return
        mid = (a + b) // 2  # every shard but a part's last is full
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([self.seed, first, a, b])))
        left = rng.multivariate_hypergeometric(counts, (mid - a) * self.shard, method="marginals")
        if low < mid:
            yield from self._walk(first, a, mid, left, start, low, min(high, mid))
        if high > mid:
            yield from self._walk(first, mid, b, counts - left, start + left, max(low, mid), high)


def draw_slots(spark: SparkSession, sources: Sequence[Source], mix: Mix) -> DataFrame:
    """``shard, slot, no, epoch, block, take``: which block of which source
    every slot of the mix holds, and how many of its words."""
    draws = Draws([s.slots for s in sources], mix)
    schema = "shard long, slot int, no int, epoch int, block long, take long"
    if not draws.shards:
        return spark.createDataFrame([], schema)
    blocks = np.array([s.blocks for s in sources], dtype=np.int64)
    sizes = np.array([s.size for s in sources], dtype=np.int64)
    ends = np.array([s.slots for s in sources], dtype=np.int64) - 1
    lasts = np.array([s.last for s in sources], dtype=np.int64)
    names = [s.name for s in sources]

    def one(shard: int, counts: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
        no = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        number = np.arange(len(no)) - first[no] + start[no]
        epoch, place = np.divmod(number, blocks[no])
        block = np.empty_like(place)
        for s in np.flatnonzero(counts):
            mine = slice(int(first[s]), int(first[s] + counts[s]))
            for e in np.unique(epoch[mine]):
                here = np.flatnonzero(epoch[mine] == e) + int(first[s])
                block[here] = _permutation(mix.seed, names[s], int(e), int(blocks[s]))(place[here])
        take = np.minimum(mix.block, sizes[no] - block * mix.block)
        take = np.where(number == ends[no], lasts[no], take)
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([mix.seed, shard])))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(no), shard)), pa.array(rng.permutation(len(no)).astype(np.int32)),
             pa.array(no.astype(np.int32)), pa.array(epoch.astype(np.int32)), pa.array(block), pa.array(take)],
            ["shard", "slot", "no", "epoch", "block", "take"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # a task's shard numbers follow each other
            ids = batch.column(0).to_numpy()
            if len(ids):
                for drawn in draws.between(int(ids[0]), int(ids[-1]) + 1):
                    yield one(*drawn)

    parallel = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    tasks = min(draws.shards, max(parallel, draws.shards // 256))
    return spark.range(0, draws.shards, 1, tasks).mapInArrow(run, schema)


def document_sizes(docs: DataFrame, texts: bool = False) -> DataFrame:
    """``doc_id, source, key, size`` (and ``text``): words
    ``[^\\x20\\x09-\\x0D]+`` of every row's whole text, null: 0."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # bytes are split at exactly these six characters
            size = [len((t.as_py() or b"").split()) for t in batch.column(3)]
            kept = [*batch.columns[:3], pa.array(size, pa.int64()), *([batch.column(3)] if texts else [])]
            yield pa.RecordBatch.from_arrays(kept, names)

    names = ["doc_id", "source", "key", "size", *(["text"] if texts else [])]
    rows = docs.select("doc_id", "source", text_key().alias("key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, source string, key long, size long" + ", text binary" * texts)


class Mixture:
    """A mix of ``docs``: its sources, its documents' places and its slots.

    Null texts have no words; a null source is a source of its own, after the
    others; null and repeated ids and rows are documents of their own; with an
    empty table, or no words at all, the mix is empty.  Other columns are
    ignored.  More than ``max_sources`` sources are an error.
    """

    def __init__(self, docs: DataFrame, mix: Mix | None = None, texts: bool = False):
        self.mix, self.spark = mix or Mix(), docs.sparkSession
        self.texts = texts
        sized = stage(document_sizes(docs, texts), "sizes")
        found = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(self.mix.max_sources + 1).collect()
        if len(found) > self.mix.max_sources:
            raise ValueError(f"more than {self.mix.max_sources} sources")
        self.sources = plan_sources({r.source: int(r.n) for r in found}, self.mix)
        self.places = self._place(sized)

    def source_table(self) -> DataFrame:
        """``no, source, base, source_size, target, planned``: a row per source
        (at most ``max_sources``, so it may be broadcast)."""
        return self.spark.createDataFrame(
            [(i, s.name, s.base, s.size, float(s.target), s.take) for i, s in enumerate(self.sources)],
            "no int, source string, base long, source_size long, target double, planned long")

    def _place(self, sized: DataFrame) -> DataFrame:
        """``row, doc_id, no, size, start`` (and ``text``): where every document
        begins among its source's words."""
        table = F.broadcast(self.source_table().select("no", F.col("source").alias("__s"), "base"))
        rows = sized.join(table, F.col("source").eqNullSafe(F.col("__s"))).drop("source", "__s")
        keys = [F.col(c) for c in ("no", "doc_id", "key")]
        ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done = 0
            for batch in batches:
                size = batch.column(batch.schema.get_field_index("size")).to_numpy()
                ends = done + np.cumsum(size)
                done = int(ends[-1]) if len(ends) else done
                yield batch.append_column("inside", pa.array(ends - size))

        schema = StructType(ranged.schema.fields + [StructField("inside", LongType())])
        laid = stage(ranged.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "places")
        # A row per partition.
        sums = laid.groupBy("part").agg(F.sum("size").alias("n"))
        ends = {r.part: int(r.n) for r in sums.collect()}
        before, offsets = 0, []
        for part in sorted(ends):
            offsets.append((part, before))
            before += ends[part]
        offset = F.broadcast(self.spark.createDataFrame(offsets, "part int, off long"))
        return (laid.join(offset, "part").withColumn("start", F.col("off") + F.col("inside") - F.col("base"))
                .select("row", "doc_id", "no", "size", "start", *(["text"] if self.texts else [])))

    def blocks(self) -> DataFrame:
        """``no, block, offset, row, doc_id, size, first, words`` (and ``text``):
        the spans that make up every block: ``words`` words of a document from its
        word ``first`` on, at ``offset`` in the block."""
        n = F.lit(self.mix.block).cast("long")
        start, size, block = F.col("start"), F.col("size"), F.col("block")
        low, high = F.expr(f"start div {self.mix.block}"), F.expr(f"(start + size - 1) div {self.mix.block}")
        spans = (self.places.where(size > 0).withColumn("block", F.explode(F.sequence(low, high)))
                 .withColumn("offset", F.greatest(start - block * n, F.lit(0)))
                 .withColumn("first", F.greatest(block * n - start, F.lit(0)))
                 .withColumn("words", F.least(size - F.col("first"), n - F.col("offset"))))
        if not self.texts:
            return spans.select("no", "block", "offset", "row", "doc_id", "size", "first", "words")
        return self._text_spans()

    def _text_spans(self) -> DataFrame:
        """As ``blocks``, with the spans' words joined by a blank: each text is
        split once and its spans leave one at a time."""
        n = self.mix.block

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row, doc_id, no, size, start, text = (c[i].as_py() for c in batch.columns)
                    words = (text or b"").split()
                    for block in range(start // n, -(-(start + size) // n) if size else 0):
                        first, offset = max(block * n - start, 0), max(start - block * n, 0)
                        part = words[first:first + n - offset]
                        values = (no, block, offset, row, doc_id, size, first, len(part), b" ".join(part))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v], f.type) for v, f in zip(values, fields)], schema=fields)

        kinds = self.places.select(F.lit(0).cast("int").alias("no"), F.lit(0).cast("long").alias("block"),
                                   F.lit(0).cast("long").alias("offset"), "row", "doc_id", "size",
                                   F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("words"), "text")
        fields = to_arrow_schema(kinds.schema)
        ordered = self.places.select("row", "doc_id", "no", "size", "start", "text")
        return ordered.mapInArrow(run, kinds.schema).withColumn("text", F.col("text").cast("string"))

    def slots(self) -> DataFrame:
        return draw_slots(self.spark, self.sources, self.mix)

    def spans(self) -> DataFrame:
        """The mix: ``shard, slot, epoch, no, block, offset, row, doc_id, size,
        first, taken`` (and ``text``), a row per span of a slot.  A cut slot's
        spans end with it."""
        # Sizes of a row function's output are not known: no broadcast of it.
        joined = self.slots().hint("merge").join(self.blocks(), ["no", "block"])
        taken = F.least(F.col("words"), F.col("take") - F.col("offset"))
        joined = joined.withColumn("taken", taken).where("taken > 0").drop("words", "take")
        if self.texts:
            cut = F.array_join(F.slice(F.split("text", " "), F.lit(1), F.col("taken").cast("int")), " ")
            joined = joined.withColumn("text", cut)
        return joined

    def slot_texts(self) -> DataFrame:
        """``shard, slot, source, epoch, n_words, text``: the mix as text, a row
        per slot (at most ``block`` words, joined by blanks).  Needs
        ``texts=True``."""
        if not self.texts:
            raise ValueError("the mixture was built without texts")
        part = F.struct("offset", "text")
        rows = (self.spans().groupBy("shard", "slot", "no", "epoch")
                .agg(F.sum("taken").alias("n_words"), F.sort_array(F.collect_list(part)).alias("parts")))
        names = F.broadcast(self.source_table().select("no", "source"))
        return rows.join(names, "no").select(
            "shard", "slot", "source", "epoch", "n_words",
            F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"))

    def document_counts(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken`` of every document: the
        words the mix takes of it, repeats counted."""
        keys = ["row", "doc_id", "no", "size"]
        all_rows = self.places.select(*keys, F.lit(0).cast("long").alias("taken"))
        counted = (all_rows.unionByName(self.spans().select(*keys, "taken"))
                   .groupBy(*keys).agg(F.sum("taken").alias("taken")))
        names = F.broadcast(self.source_table().select("no", "source_size", "target"))
        return counted.join(names, "no").select("doc_id", "size", "source_size", "target", "taken")


def mix_counts(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """``Mixture.document_counts`` of a table of documents."""
    return Mixture(docs, mix).document_counts()
