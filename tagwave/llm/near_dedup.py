"""Near-duplicate groups by one-permutation MinHash with optimal densification.

1. One scan hashes each document's distinct word shingles.  The hash space is
   cut into bins and each bin keeps its smallest hash (one permutation); an
   empty bin copies a filled one, found along the bin's own random order of all
   bins, which is the same for every document.
2. Documents with equal shingle sets form a class; only a class's
   representative goes on, so a group of copies costs one row.
3. Bands of bins are bucketed.  Each bucket gives star edges from a centre to
   its other members, never all pairs.  Pairs are dropped by size ratio and by
   their sketches where these are decisive; the rest are confirmed on the full
   shingle sets, read again from the texts of documents that share a bucket.
4. Where a bucket's members are not all connected by then, those outside its
   largest component are held against all members in blocks of bounded size:
   a task counts common shingles of two blocks by matrix products and reports,
   per document and other component, the best link only.  Blocks hold the whole
   sets, and a long set takes the room of several documents.  So no link that
   shares a bucket is lost, no bucket is capped, and no pairs are listed.
5. Links become components; a class's label goes to all its documents.

With 40 bands of 5 bins a pair at the threshold of 0.8 misses all buckets once
in about ten million cases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave.llm.common import keep_rows, splitmix, text_chunks, text_key, tidied
from tagwave.llm.components import components
from tagwave.operators.joins import Dimension, dimension, join_dimension
from tagwave.operators.stage import stage
from tagwave.session import text_batches

BANDS, BAND_ROWS = 40, 5
#: Sketches decide only between sets of at least this size, and only against a
#: pair whose share of equal bins lies this many standard deviations too low.
SKETCH_SIZE, SKETCH_SIGMAS = 200, 8
#: Units of a block, and the shingles of a unit: a document takes as many units
#: as its set fills.
BLOCK, BLOCK_SET = 256, 2_500

_WORD_SEED = 7


class Shingler:
    """Distinct shingle hashes of texts: words are runs without white space
    after lower-casing A-Z, a shingle is ``size`` words in a row; a text of
    fewer words is one shingle."""

    def __init__(self, size: int):
        self.size = size

    def sets(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Sorted distinct 64-bit hashes of each text's shingles."""
        split = [t.encode().lower().split() for t in texts]
        index: dict[bytes, int] = {}
        for words in split:
            for w in words:
                if w not in index:
                    index[w] = len(index)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, _WORD_SEED) for w in index), np.uint64, len(index))
        for words in split:
            n = len(words)
            if not n:
                yield np.zeros(0, np.uint64)
                continue
            h = hashes[np.fromiter(map(index.__getitem__, words), np.int64, n)]
            size = min(self.size, n)
            x = np.full(n - size + 1, size, np.uint64)
            for k in range(size):
                x = splitmix(x * np.uint64(0x9E3779B97F4A7C15) + h[k:n - size + 1 + k])
            yield np.unique(x)


def probe_orders(bins: int) -> np.ndarray:
    """For each bin, the random order in which an empty bin looks for a filled one."""
    return np.argsort(np.random.default_rng(11).random((bins, bins)), axis=1)


def signatures(sets: list[np.ndarray], bins: int, orders: np.ndarray) -> np.ndarray:
    """The densified one-permutation signature of each non-empty set."""
    out = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for k, s in enumerate(sets):
        at = ((s >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))  # sorted, so a bin's first hash is its smallest
        out[k, at[first]] = s[first]
        filled[k, at[first]] = True
    row, col = np.nonzero(~filled)
    for attempt in range(bins):
        if not len(row):
            break
        source = orders[col, attempt]
        hit = filled[row, source]
        out[row[hit], col[hit]] = out[row[hit], source[hit]]
        row, col = row[~hit], col[~hit]
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number included."""
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(sig), 1))
    for r in range(rows):
        keys = splitmix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, r:bands * rows:rows])
    return keys


def _sketched(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, rid, text_key, n_shingles, k1, k2, bands, sketch`` per row."""
    bins = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, orders = Shingler(shingle), probe_orders(bins)
        for batch in batches:
            at = 0
            for _, texts in text_chunks(batch.column(1), batch.column(3)):
                sets = list(shingler.sets(texts))
                full = [k for k, s in enumerate(sets) if len(s)]
                sig = signatures([sets[k] for k in full], bins, orders)
                keys = iter(band_keys(sig, bands, rows).view(np.int64).tolist())
                marks = iter(splitmix(sig).astype(np.uint8))
                ids = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([i and int.from_bytes(i[:8], "little", signed=True) for i in ids], pa.int64()),
                     pa.array([i and int.from_bytes(i[8:], "little", signed=True) for i in ids], pa.int64()),
                     pa.array([next(keys) if i else None for i in ids], pa.list_(pa.int64())),
                     pa.array([next(marks).tobytes() if i else None for i in ids], pa.binary())],
                    ["doc_id", "rid", "text_key", "n_shingles", "k1", "k2", "bands", "sketch"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.monotonically_increasing_id().alias("rid"),
                       text_key().alias("text_key"), "text").mapInArrow(
        tidied(run), f"doc_id {id_type}, rid long, text_key long, n_shingles long, k1 long, k2 long, "
             "bands array<long>, sketch binary")


def _plausible(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and sketches do not rule out; columns ``a, b``."""
    t = percent / 100
    sized = pairs.where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = np.minimum(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for c in (4, 5))
            least = t - SKETCH_SIGMAS * (t * (1 - t) / a.shape[1]) ** 0.5
            keep = (n < SKETCH_SIZE) | ((a == b).mean(axis=1) >= least)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``rep, n, sketch, members`` (the sorted hashes as bytes) of the documents
    in ``wanted`` (``rep, doc_id, text_key, n, sketch``), from their texts."""
    texts = join_dimension(docs.select("doc_id", text_key().alias("text_key"), "text"), wanted,
                           ["doc_id", "text_key"], "inner", null_safe=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in batches:
            at = 0
            for _, chunk in text_chunks(batch.column(0), batch.column(3)):
                members = [s.tobytes() for s in shingler.sets(chunk)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, len(chunk)) for c in range(3)), pa.array(members, pa.binary())],
                    ["rep", "n", "sketch", "members"])
                at += len(chunk)

    return (texts.select("rep", "n", "sketch", "text").mapInArrow(tidied(run), "rep long, n long, sketch binary, members binary")
            .dropDuplicates(["rep"]))  # a row may repeat


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity; columns ``a, b``."""
    with_b = pairs.join(sets.select(F.col("rep").alias("b"), F.col("members").alias("set_b")), "b")
    both = with_b.join(sets.select(F.col("rep").alias("a"), F.col("members").alias("set_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(tidied(run), "a long, b long")


def _first() -> Column:
    """Rows in the order in which one is kept: smallest id, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")


def near_groups(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS,
                band_rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Documents are linked when the Jaccard similarity of their distinct
    ``shingle``-word shingles reaches ``percent``; ``component_id`` is the
    smallest ``doc_id`` reachable over links and ``kept`` marks it.  A text
    without words, or null, has an empty set and is linked with nothing.  Of
    rows that repeat an id inside a component all carry ``kept``; a null id is
    never the smallest (alone, its component is null and it is kept).  An empty
    table gives no rows; other columns are ignored.
    """
    rows = near_rows(docs, shingle, percent, bands, band_rows)
    return rows.select("doc_id", "n_shingles", "component_id",
                       F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that of smallest id."""
    return keep_rows(docs, near_rows(docs, shingle, percent).select("doc_id", "text_key", "kept"))


def near_rows(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS,
              band_rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept``, where exactly one
    row of each component is ``kept``."""
    with text_batches(docs.sparkSession):
        return _linked(docs.select("doc_id", "text"), shingle, percent, bands, band_rows)


def _linked(docs: DataFrame, shingle: int, percent: int, bands: int, band_rows: int) -> DataFrame:
    rows = stage(_sketched(docs, shingle, bands, band_rows), "near-rows")
    filled = rows.where("n_shingles > 0")
    classes = stage(filled.groupBy("k1", "k2").agg(
        F.min("rid").alias("rep"), F.min(_first()).alias("least"), F.count(F.lit(1)).alias("copies"),
        F.min_by(F.struct("doc_id", "text_key", "n_shingles", "bands", "sketch"), "rid").alias("r")), "near-classes")
    banded = classes.select("rep", F.explode("r.bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = stage(join_dimension(banded, shared, ["key"], "inner"), "near-buckets")
    wanted = join_dimension(
        classes.select("rep", "r.doc_id", "r.text_key", F.col("r.n_shingles").alias("n"), "r.sketch"),
        buckets.select("rep").distinct(), ["rep"], "left_semi")
    sets = stage(_full_sets(docs, wanted, shingle), "near-sets")

    # star edges
    stars = buckets.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    about = dimension(sets.select("rep", "n", "sketch"))
    for side in "ab":
        stars = join_dimension(stars, about.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"),
                                                   F.col("sketch").alias(f"sketch_{side}")), [side], "inner")
    links = stage(_confirmed(_plausible(stars, percent), sets, percent), "near-links")
    labels = dimension(components(links, "a", "b"))

    # what star edges left apart
    more = stage(_confirmed(_across(buckets, sets, about, labels, percent), sets, percent), "near-links")
    if not more.isEmpty():
        labels = dimension(components(links.unionByName(more), "a", "b"))
    return _labelled(rows, classes, labels)


def _across(buckets: DataFrame, sets: DataFrame, about: Dimension, labels: Dimension, percent: int) -> DataFrame:
    """Likely links (``a, b``) between different components inside a bucket:
    for each document outside a bucket's largest component and each other
    component the most similar one, by blocks.  ``about`` has ``rep, n``."""
    sized = join_dimension(buckets.where("size > 2").select("key", "rep"), about.select("rep", "n"), ["rep"], "inner")
    state = (join_dimension(sized, labels.withColumnRenamed("node", "rep"), ["rep"], "left")
             .select("key", "rep", F.ceil(F.col("n") / F.lit(BLOCK_SET)).cast("long").alias("units"),
                     F.coalesce("root", "rep").alias("root")))
    parts = state.groupBy("key", "root").agg(F.sum("units").alias("units"))
    open_keys = (parts.groupBy("key").agg(F.max(F.struct("units", "root")).alias("main"), F.sum("units").alias("size"))
                 .select("key", "size", F.col("main.root").alias("main"), (F.col("size") - F.col("main.units")).alias("rest"))
                 .where("rest > 0"))
    open_rows = join_dimension(state, open_keys, ["key"], "inner")

    def blocks(size):
        return F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")

    def every(size):
        return F.explode(F.sequence(F.lit(0), blocks(size) - 1))

    here = F.xxhash64("rep", F.lit(1))
    members = open_rows.select("key", "rep", "root", F.lit(False).alias("outer"),
                               F.pmod(here, blocks("size")).cast("int").alias("j"), every("rest").alias("i"))
    outer = open_rows.where("root <> main").select(
        "key", "rep", "root", F.lit(True).alias("outer"),
        F.pmod(here, blocks("rest")).cast("int").alias("i"), every("size").alias("j"))
    # a document stands in at most one row per band and block: no hot key
    held = stage(members.unionByName(outer), "near-blocks").join(sets.select("rep", "n", "members"), "rep")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = compare_blocks(table, percent)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return held.groupBy("key", "i", "j").applyInArrow(run, "a long, b long").distinct()


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common values of each two sets, by products of incidence
    matrices over slices of the values that both sides hold."""
    out = np.zeros((len(left), len(right)))
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))

    def entries(sets):
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    sides = [entries(left), entries(right)]
    for lo in range(0, len(shared), 4096):
        width = min(4096, len(shared) - lo)
        dense = []
        for sets, (row, at) in zip((left, right), sides):
            part = slice(*np.searchsorted(at, [lo, lo + width]))
            m = np.zeros((len(sets), width), np.float32)
            m[row[part], at[part] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def compare_blocks(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block of outer documents and one of members: for each outer
    document and each component but its own, its most similar member, if the
    similarity reaches ``percent``."""
    outer = np.array(table.column("outer").to_pylist(), bool)
    o, m = np.flatnonzero(outer), np.flatnonzero(~outer)
    if not len(o) or not len(m):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rep, root, n = (table.column(c).to_numpy() for c in ("rep", "root", "n"))
    values = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
    common = common_counts([values[k] for k in o], [values[k] for k in m])
    union = n[o][:, None] + n[m][None, :] - common
    row, col = np.nonzero((root[o][:, None] != root[m][None, :]) & (common * 100 >= union * percent))
    order = np.lexsort((-(common / union)[row, col], root[m][col], row))
    row, col = row[order], col[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (root[m][col[1:]] != root[m][col[:-1]])
    a, b = rep[o[row[first]]], rep[m[col[first]]]
    return np.minimum(a, b), np.maximum(a, b)


def _labelled(rows: DataFrame, classes: DataFrame, labels: Dimension) -> DataFrame:
    """Component ids for all documents, through their classes."""
    named = classes.select("k1", "k2", "rep", "least", "copies")
    named = join_dimension(named, labels.withColumnRenamed("node", "rep"), ["rep"], "left")
    roots = named.where("root is not null").groupBy("root").agg(F.min("least").alias("root_least"))
    named = join_dimension(named, roots, ["root"], "left")
    special = named.where("root is not null or copies > 1").withColumn("least", F.coalesce("root_least", "least"))
    special = special.select("k1", "k2", F.col("least.doc_id").alias("component"), F.col("least.rid").alias("keep_rid"))
    out = join_dimension(rows.select("doc_id", "rid", "text_key", "k1", "k2", "n_shingles"),
                         special, ["k1", "k2"], "left")
    alone = F.col("keep_rid").isNull()
    return out.select("doc_id", "text_key", "n_shingles",
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                      (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"))
