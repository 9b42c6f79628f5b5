"""Document scores under an interpolated modified Kneser-Ney bigram model.

The model is counted in Spark over all training documents and kept as sorted
hash arrays in files of the shared folder, which workers map into memory.

1. Words: each task counts the words it reads and sends, per hash range, one
   block of sorted 64-bit word hashes and counts.  Range owners merge the
   blocks into files; a word's place in the sorted arrays is its id.
2. Bigrams: each task maps its words to ids and counts pairs; a pair of ids is
   one 64-bit key, spread by a bijective mix, so keys cannot collide.  Range
   owners merge again, write key and count files, and pass on, per id range,
   what the discounts need: each history's total and its numbers of words
   seen once, twice and more often, and each word's number of histories.
3. Id-range owners sum these up and write a history's total and its left-over
   mass, and the words' continuation counts.
4. Scoring maps the files and looks up a chunk's distinct words and pairs in
   sorted order.  Files on a store that cannot be mapped are first copied to
   the worker's temporary folder and unlinked there.

Tasks hold a bounded number of tokens; a word or pair that stands in a third of
all rows is one entry per block.  Owners write under fresh names and only the
names that reach the driver are read, so a repeated task does no harm.  Words
are told apart by 64-bit hashes; there may be up to 2**32 - 2 of them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave.llm.common import crc_mod, splitmix, text_chunks
from tagwave.operators.stage import stage, track
from tagwave.session import scratch_path

#: Tokens that a task counts before it sends a block; distinct words likewise.
BLOCK_TOKENS, BLOCK_WORDS = 4_000_000, 500_000
#: Training tokens per file of bigrams.
FILE_TOKENS = 4_000_000
_CHUNK = 4_000_000
#: The hash of the end token: no word is empty.
END = xxhash.xxh3_64_intdigest(b"")

_RANGE = "shard int, data binary"


# -- blocks and files ---------------------------------------------------------

def _planes(a: np.ndarray) -> bytes:
    """An array's bytes, all first bytes first, and so on."""
    return a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()


def _unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(dtype).ravel()


def pack_block(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted uint64 keys (as differences) and uint64 columns, compressed."""
    body = b"".join(map(_planes, (np.diff(keys, prepend=np.uint64(0)), *columns)))
    return len(columns).to_bytes(2, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def unpack_block(data: bytes) -> list[np.ndarray]:
    n = 1 + int.from_bytes(data[:2], "little")
    body = zstandard.ZstdDecompressor().decompress(data[2:])
    size = len(body) // n
    arrays = [_unplanes(body[k * size:(k + 1) * size], np.uint64) for k in range(n)]
    return [np.cumsum(arrays[0], dtype=np.uint64), *arrays[1:]]


def merge_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The keys of all blocks, sorted and distinct, with their columns summed."""
    parts = [unpack_block(b) for b in blocks]
    keys, *columns = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return [keys[first], *(np.add.reduceat(c[order], first) for c in columns)]


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Which of ``shards`` equal ranges of the 64-bit space a key lies in."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _blocks(keys: np.ndarray, counts: np.ndarray, shards: int) -> pa.RecordBatch:
    """Blocks of sorted ``keys`` by range, as rows (shard, data)."""
    edge = np.searchsorted(_shard_of(keys, shards), np.arange(shards + 1))
    rows = [(k, pack_block(keys[a:b], counts[a:b])) for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()),
                                       pa.array([d for _, d in rows], pa.binary())], ["shard", "data"])


def _write(folder: str, name: str, array: np.ndarray) -> str:
    """An array as a new file of the shared folder; returns its name."""
    store, path = pafs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{path}/{name}") as f:
        f.write(np.ascontiguousarray(array).tobytes())
    return name


def _map(folder: str, name: str, dtype) -> np.ndarray:
    """A file of the shared folder, mapped into memory."""
    store, path = pafs.FileSystem.from_uri(folder)
    path = f"{path}/{name}"
    if store.get_file_info(path).size == 0:
        return np.zeros(0, dtype)
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with tempfile.NamedTemporaryFile() as local:  # unlinked, and freed with the map
        pafs.copy_files(path, local.name, source_filesystem=store, destination_filesystem=pafs.LocalFileSystem())
        return np.memmap(local.name, dtype, "r")


@dataclass
class SortedFiles:
    """Files of sorted keys, one for each range of the 64-bit space (a range
    without a file is empty), and columns beside them."""

    folder: str
    shards: int
    files: dict[int, dict]  # range: {"keys": name, column: name, "n": entries}
    maps: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return (self.folder, self.shards, self.files)

    def __setstate__(self, state):
        self.folder, self.shards, self.files = state
        self.maps = {}

    @property
    def offsets(self) -> np.ndarray:
        """Place of each range's first key among all keys, and the total."""
        return np.concatenate([[0], np.cumsum([self.files.get(k, {}).get("n", 0) for k in range(self.shards)])])

    def column(self, shard: int, name: str, dtype) -> np.ndarray:
        if (shard, name) not in self.maps:
            self.maps[shard, name] = _map(self.folder, self.files[shard][name], dtype)
        return self.maps[shard, name]

    def find(self, keys: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """For sorted ``keys``: (range, its slice of keys, places in the range,
        whether found there)."""
        edge = np.searchsorted(_shard_of(keys, self.shards), np.arange(self.shards + 1))
        for k in np.flatnonzero(np.diff(edge)):
            part = slice(edge[k], edge[k + 1])
            if k not in self.files:
                yield int(k), part, np.zeros(part.stop - part.start, np.int64), np.zeros(part.stop - part.start, bool)
                continue
            held = self.column(int(k), "keys", np.uint64)
            at = np.minimum(np.searchsorted(held, keys[part]), len(held) - 1)
            yield int(k), part, at, held[at] == keys[part]

    def by_id(self, ids: np.ndarray, names: list[str], dtypes: list) -> list[np.ndarray]:
        """Columns of the entries at places ``ids`` (sorted) among all keys."""
        edge = np.searchsorted(ids, self.offsets)
        edge[-1] = len(ids)  # the place after the last key belongs to the last range
        out = [np.zeros(len(ids), t) for t in dtypes]
        for k in np.flatnonzero(np.diff(edge)):
            part = slice(edge[k], edge[k + 1])
            for o, name, t in zip(out, names, dtypes):
                o[part] = self.column(int(k), name, t)[ids[part] - self.offsets[k]]
        return out


# -- tokens -------------------------------------------------------------------

def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, split at blanks and the ASCII controls 9 to 13."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class LocalWords:
    """Words of a chunk as local numbers; number 0 is the end token."""

    def __init__(self) -> None:
        self.index: dict[bytes, int] = {b"": 0}

    def numbers(self, text: str) -> np.ndarray:
        words = words_of(text)
        index = self.index
        for w in words:
            if w not in index:
                index[w] = len(index)
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.index), np.uint64, len(self.index))


def _word_ids(vocabulary: SortedFiles, hashes: np.ndarray) -> np.ndarray:
    """Ids of word hashes; -1 for unknown ones."""
    order = np.argsort(hashes)
    out = np.full(len(hashes), -1, np.int64)
    offsets = vocabulary.offsets
    for k, part, at, hit in vocabulary.find(hashes[order]):
        out[order[part]] = np.where(hit, offsets[k] + at, -1)
    return out


def _chunk_ids(vocabulary: SortedFiles, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, id) of every token of the texts, ends included."""
    local = LocalWords()
    numbers = [np.append(local.numbers(t), 0) for t in texts]
    ids = _word_ids(vocabulary, local.hashes())
    return np.repeat(np.arange(len(texts)), [len(n) for n in numbers]), ids[np.concatenate(numbers)]


def _previous(doc: np.ndarray, ids: np.ndarray, begin: int) -> np.ndarray:
    """The token before each token; ``begin`` at a document's start."""
    before = np.concatenate([[begin], ids[:-1]])
    before[np.concatenate([[True], doc[1:] != doc[:-1]])] = begin
    return before


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash keys of pairs of ids: a bijection of the pairs."""
    return splitmix((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))


def _unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``splitmix``."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(0x319642B2D24D8EC3)
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(0x96DE1B173F119089)
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


# -- counting -----------------------------------------------------------------

def _count_words(texts: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local, counts = LocalWords(), np.zeros(0, np.int64)

        def block():
            hashes = local.hashes()
            seen = np.flatnonzero(counts)
            order = seen[np.argsort(hashes[seen])]
            return _blocks(hashes[order], counts[order].astype(np.uint64), shards)

        for batch in batches:
            for _, chunk in text_chunks(batch.column(0), batch.column(0), _CHUNK):
                numbers = [local.numbers(t) for t in chunk]
                new = np.bincount(np.concatenate(numbers), minlength=len(local.index))
                new[0] += len(chunk)
                new[:len(counts)] += counts
                counts = new
                if len(counts) > BLOCK_WORDS:
                    yield block()
                    local, counts = LocalWords(), np.zeros(0, np.int64)
        if len(counts):
            yield block()

    return texts.mapInArrow(run, _RANGE)


def _merge_words(blocks: DataFrame, folder: str) -> DataFrame:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = merge_blocks(table.column("data").to_pylist())
        shard = key[0].as_py()
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()),
                         "total": pa.array([int(counts.sum())], pa.int64()),
                         "keys": [_write(folder, f"words-{shard}", keys)],
                         "counts": [_write(folder, f"counts-{shard}", counts.astype(np.int64))]})

    return blocks.groupBy("shard").applyInArrow(run, "shard int, n long, total long, keys string, counts string")


def _count_pairs(texts: DataFrame, vocabulary: SortedFiles, shards: int) -> DataFrame:
    begin = int(vocabulary.offsets[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return _blocks(keys, counts.astype(np.uint64), shards)

        for batch in batches:
            for _, chunk in text_chunks(batch.column(0), batch.column(0), _CHUNK):
                doc, ids = _chunk_ids(vocabulary, chunk)
                held.append(pair_keys(_previous(doc, ids, begin), ids))
                n += len(ids)
                if n >= BLOCK_TOKENS:
                    yield block()
                    held, n = [], 0
        if held:
            yield block()

    return texts.mapInArrow(run, _RANGE)


_MERGED = ("kind string, shard int, data binary, n long, keys string, counts string, "
           "n1 long, n2 long, n3 long, n4 long")


def _merge_pairs(blocks: DataFrame, vocabulary: SortedFiles, folder: str) -> DataFrame:
    """Writes the pair files.  Rows of kind ``file`` describe them; ``left``
    and ``right`` rows carry, per range of ids, sums by first and second id."""
    offsets = vocabulary.offsets

    def by_id(kind, ids, *columns):
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        keys = ids[first].astype(np.uint64)
        sums = [np.add.reduceat(c[order].astype(np.uint64), first) for c in columns]
        # the begin id, after the last word, goes to the last range
        shard = np.minimum(np.searchsorted(offsets, ids[first].astype(np.int64), "right") - 1, vocabulary.shards - 1)
        edge = np.searchsorted(shard, np.arange(vocabulary.shards + 1))
        return [(kind, k, pack_block(keys[a:b], *(s[a:b] for s in sums)))
                for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = merge_blocks(table.column("data").to_pylist())
        shard = key[0].as_py()
        plain = _unmix(keys)
        left, right = plain >> np.uint64(32), plain & np.uint64(0xFFFFFFFF)
        rows = by_id("left", left, counts, counts == 1, counts == 2, counts > 2)
        rows += by_id("right", right, np.ones(len(right), np.uint64))
        of = [int((counts == c).sum()) for c in (1, 2, 3, 4)]
        names = (_write(folder, f"pairs-{shard}", keys),
                 _write(folder, f"times-{shard}", np.minimum(counts, 2**32 - 1).astype(np.uint32)))
        rows = [(*r, None, None, None, None, None, None, None) for r in rows]
        rows.append(("file", shard, None, len(keys), *names, *of))
        schema = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("data", pa.binary()), ("n", pa.int64()),
                            ("keys", pa.string()), ("counts", pa.string()), ("n1", pa.int64()), ("n2", pa.int64()),
                            ("n3", pa.int64()), ("n4", pa.int64())])
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return blocks.groupBy("shard").applyInArrow(run, _MERGED)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from the numbers of entries
    counted once to four times; halves of the counts where these are missing."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(x, 0.01), k - 0.01) for k, x in enumerate(d, 1))


def _sum_by_id(merged: DataFrame, vocabulary: SortedFiles, d: tuple, folder: str) -> DataFrame:
    """Writes, per range of ids, the histories' totals and left-over mass and
    the words' numbers of histories; rows describe the files."""
    offsets, last = vocabulary.offsets, vocabulary.shards - 1

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        size = int(offsets[shard + 1] - offsets[shard]) + (shard == last)  # and the begin id
        total, mass, before = np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
        kinds = table.column("kind").to_pylist()
        data = table.column("data").to_pylist()
        if blocks := [x for k, x in zip(kinds, data) if k == "left"]:
            ids, all_, one, two, more = merge_blocks(blocks)
            at = ids.astype(np.int64) - offsets[shard]
            total[at] = all_
            mass[at] = (d[0] * one + d[1] * two + d[2] * more) / all_
        if blocks := [x for k, x in zip(kinds, data) if k == "right"]:
            ids, n = merge_blocks(blocks)
            before[ids.astype(np.int64) - offsets[shard]] = n
        of = [int((before == c).sum()) for c in (1, 2, 3, 4)]
        return pa.table({"shard": pa.array([shard], pa.int32()), "total": [_write(folder, f"total-{shard}", total)],
                         "mass": [_write(folder, f"mass-{shard}", mass)],
                         "before": [_write(folder, f"before-{shard}", before)],
                         "n1": [of[0]], "n2": [of[1]], "n3": [of[2]], "n4": [of[3]],
                         "more": [int((before > 2).sum())], "pairs": [int(before.sum())]})

    return merged.where("kind <> 'file'").groupBy("shard").applyInArrow(
        run, "shard int, total string, mass string, before string, n1 long, n2 long, n3 long, n4 long, "
             "more long, pairs long")


# -- the model ----------------------------------------------------------------

@dataclass
class KneserNey:
    """A bigram model in files."""

    vocabulary: SortedFiles
    pairs: SortedFiles
    tokens: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    distinct_pairs: int
    word_mass: float  # left over by the word discounts, shared by all words and an unknown one

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base and model log10 probability of each text."""
        size = int(self.vocabulary.offsets[-1])
        doc, ids = _chunk_ids(self.vocabulary, texts)
        before = _previous(doc, ids, size)
        known = ids >= 0
        words, at = np.unique(ids, return_inverse=True)
        real = words >= 0
        count, histories = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if size:
            count[real], histories[real] = self.vocabulary.by_id(words[real], ["counts", "before"], [np.int64] * 2)
        base = np.log10((count + 1) / (self.tokens + size + 1))
        d = np.array([0.0, *self.word_discounts])[np.minimum(histories, 3)]
        lower = np.maximum(histories - d, 0) / max(1, self.distinct_pairs) + self.word_mass / (size + 1)
        p = lower[at]
        pasts, past_at = np.unique(before, return_inverse=True)
        real = pasts >= 0
        total, mass = np.zeros(len(pasts)), np.ones(len(pasts))
        if size:
            total[real], mass[real] = self.vocabulary.by_id(pasts[real], ["total", "mass"], [np.float64] * 2)
        mass[total == 0] = 1.0  # a word never followed by another tells nothing
        p *= mass[past_at]
        seen = np.flatnonzero(known & (total[past_at] > 0))
        keys, key_at = np.unique(pair_keys(before[seen], ids[seen]), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        for k, part, place, hit in self.pairs.find(keys):
            if hit.any():
                times[part][hit] = self.pairs.column(k, "counts", np.uint32)[place[hit]]
        d = np.array([0.0, *self.pair_discounts])[np.minimum(times, 3)]
        p[seen] += (times - d)[key_at] / total[past_at[seen]]
        n = len(texts)
        return (np.bincount(doc, minlength=n), np.bincount(doc, known, n).astype(np.int64),
                np.bincount(doc, base[at], n), np.bincount(doc, np.log10(p), n))


def train(docs: DataFrame, text_col: str = "text") -> KneserNey:
    """Count the model over every text of ``docs`` (null: empty)."""
    spark = docs.sparkSession
    folder = track(scratch_path(spark, "lm"))
    texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text"))
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = stage(_merge_words(_count_words(texts, shards), folder), "lm-words").collect()  # a row per file
    vocabulary = SortedFiles(folder, shards, {
        r["shard"]: {"keys": r["keys"], "counts": r["counts"], "n": r["n"]} for r in words})
    tokens = sum(r["total"] for r in words)
    files = max(shards, -(-tokens // FILE_TOKENS))
    merged = stage(_merge_pairs(_count_pairs(texts, vocabulary, files), vocabulary, folder), "lm-pairs")
    rows = merged.where("kind = 'file'").collect()  # a row per file
    pairs = SortedFiles(folder, files, {
        r["shard"]: {"keys": r["keys"], "counts": r["counts"], "n": r["n"]} for r in rows})
    d2 = discounts(*(sum(r[f"n{k}"] for r in rows) for k in (1, 2, 3, 4)))
    stats = stage(_sum_by_id(merged, vocabulary, d2, folder), "lm-ids").collect()  # a row per file
    for r in stats:
        vocabulary.files.setdefault(r["shard"], {"n": 0}).update(
            {"total": r["total"], "mass": r["mass"], "before": r["before"]})
    n = [sum(r[f"n{k}"] for r in stats) for k in (1, 2, 3, 4)]
    d1 = discounts(*n)
    distinct = sum(r["pairs"] for r in stats)
    mass = (d1[0] * n[0] + d1[1] * n[1] + d1[2] * sum(r["more"] for r in stats)) / distinct if distinct else 1.0
    return KneserNey(vocabulary, pairs, tokens, d2, d1, distinct, mass)


def lm_scores(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of every text of ``docs``.

    The model learns from rows that are not ``held_out`` (default: crc32 of
    the id modulo 7 is 2).  ``base_score`` is the log10 probability under
    add-one word frequencies, ``score`` under the model.  A null text counts
    as empty and has one token, the end.  Repeated rows and ids count and give
    a row each, a null id is not held out; without training rows every token
    is unknown; an empty table gives no rows; other columns are ignored.
    """
    held_out = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)) if held_out is None else held_out
    model = train(docs.where(~held_out))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in text_chunks(batch.column(0), batch.column(2), _CHUNK):
                n, known, base, score = model.score(texts)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(np.full(len(texts), model.tokens), pa.int64()), pa.array(base), pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
