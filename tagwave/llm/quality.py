"""Quality scores by a factorisation machine.

Features of a text are its hashed words (logarithms of their counts, scaled to
length 1), statistics of its structure (shares of capitals, digits, marks and
repeated lines, word and line lengths) and metadata (the table's ``n_chars``).
The model has a weight per feature and a low-rank vector per feature for the
pairwise interactions; with the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

a text is scored in time linear in its features.  It is trained by AdaGrad on
the logistic loss over a bounded sample of labelled rows; every text is scored
by batched sums in the tasks that read it, without a shuffle.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave.llm.common import crc_mod, text_chunks, tidied
from tagwave.operators.joins import join_dimension
from tagwave.operators.stage import stage, stage_measured
from tagwave.session import text_batches

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 8_000
BUCKETS, FACTORS = 4_096, 8
EPOCHS, BATCH, RATE, SHRINK = 8, 128, 0.1, 2e-5
THRESHOLD = 0.3
#: Words whose bucket a worker remembers before it starts afresh.
CACHE_SIZE = 150_000

# The classes of bytes that structure statistics count.
_BYTE_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz",
                 "digit": b"0123456789", "space": b" \t\r\x0b\x0c", "newline": b"\n", "stop": b".,;:'\"-",
                 "shout": b"!?", "bar": b"|", "sign": b"#$%&*+/<=>@\\^_`~()[]{}", "wide": bytes(range(128, 256))}
_CLASS_OF = np.zeros(256, np.int64)
for _k, _bytes in enumerate(_BYTE_CLASSES.values(), 1):
    _CLASS_OF[list(_bytes)] = _k
STATISTICS = len(_BYTE_CLASSES) + 1 + 9


def _share(a: float, b: float) -> float:
    return a / b if b else 0.0


def structure(data: bytes, words: list[bytes], n_chars: int | None) -> list[float]:
    """Statistics of a text's shape, and its metadata."""
    count = np.bincount(_CLASS_OF[np.frombuffer(data, np.uint8)], minlength=len(_BYTE_CLASSES) + 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = len(words)
    return [*(count / max(1, len(data))).tolist(),
            float(np.log1p(n)), _share(sum(map(len, words)), n), _share(len(set(words)), n),
            _share(sum(map(operator.eq, words, islice(words, 1, None))), n), _share(len(set(lines)), len(lines)), float(np.log1p(_share(n, len(lines)))),
            _share(sum(x[:1].isupper() for x in lines), len(lines)),
            float(np.log1p(n_chars or 0)), float(n_chars is None)]


class Features:
    """Sparse hashed words and dense statistics of batches of texts."""

    def __init__(self) -> None:
        self.cache: dict[bytes, int] = {}

    def __call__(self, texts: list[str], n_chars: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row of each entry, its bucket, its value, statistics per row)."""
        rows, flat, stats = [], [], []
        for k, (text, n) in enumerate(zip(texts, n_chars)):
            data = text.encode("utf-8", "surrogatepass")
            stats.append(structure(data, data.split(), n))
            words = data.lower().split()
            if len(self.cache) > CACHE_SIZE:
                self.cache.clear()
            for w in set(words).difference(self.cache):
                self.cache[w] = zlib.crc32(w) % BUCKETS
            flat.append(np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words)))
            rows.append(np.full(len(words), k, np.int64))
        keys, count = np.unique(np.concatenate(rows) * BUCKETS + np.concatenate(flat), return_counts=True)
        row, bucket, value = keys // BUCKETS, keys % BUCKETS, np.log1p(count)
        norm = np.sqrt(np.bincount(row, value * value, len(texts)))
        return row, bucket, value / norm[row], np.array(stats).reshape(len(texts), STATISTICS)


@dataclass
class FactorisationMachine:
    """Weights of the hashed words followed by the statistics, and the scaling
    of the latter."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def entries(self, row, bucket, value, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of a batch as (row, index, value) triples."""
        n = len(stats)
        dense = np.clip((stats - self.mean) / self.scale, -4, 4) / 4
        return (np.concatenate([row, np.repeat(np.arange(n), STATISTICS)]),
                np.concatenate([bucket, np.tile(BUCKETS + np.arange(STATISTICS), n)]),
                np.concatenate([value, dense.ravel()]))

    def forward(self, row, index, value, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of ``n`` rows, each row's factor sums, and the entries' terms."""
        terms = self.factors[index] * value[:, None]
        sums = np.stack([np.bincount(row, t, n) for t in terms.T], axis=1)
        squares = np.bincount(row, (terms * terms).sum(axis=1), n)
        logit = self.bias + np.bincount(row, self.linear[index] * value, n) + 0.5 * ((sums**2).sum(axis=1) - squares)
        return logit, sums, terms

    def score(self, row, bucket, value, stats) -> np.ndarray:
        """Probability of label 1 per row."""
        logit, _, _ = self.forward(*self.entries(row, bucket, value, stats), len(stats))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(parts: list[tuple], labels: np.ndarray) -> FactorisationMachine:
    """Train on the features of ``labels``' rows (tuples as ``Features`` gives
    them, one row each)."""
    stats = np.concatenate([p[3] for p in parts])
    rng = np.random.default_rng(17)
    fm = FactorisationMachine(
        float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))), np.zeros(BUCKETS + STATISTICS),
        rng.normal(0, 0.05, (BUCKETS + STATISTICS, FACTORS)), stats.mean(axis=0), stats.std(axis=0) + 1e-6)
    g_linear, g_factors, g_bias = np.full(len(fm.linear), 1e-6), np.full(fm.factors.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), BATCH):
            picked = order[lo:lo + BATCH]
            row = np.concatenate([np.full(len(parts[k][1]), j) for j, k in enumerate(picked)])
            row, index, value = fm.entries(row, np.concatenate([parts[k][1] for k in picked]),
                                           np.concatenate([parts[k][2] for k in picked]), stats[picked])
            logit, sums, terms = fm.forward(row, index, value, len(picked))
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[picked]) / len(picked)
            weight = error[row] * value
            d_linear = np.bincount(index, weight, len(fm.linear)) + SHRINK * fm.linear
            each = weight[:, None] * (sums[row] - terms)
            d_factors = np.stack([np.bincount(index, e, len(fm.linear)) for e in each.T], axis=1) + SHRINK * fm.factors
            d_bias = error.sum()
            g_linear += d_linear**2
            g_factors += d_factors**2
            g_bias += d_bias**2
            fm.linear -= RATE * d_linear / np.sqrt(g_linear)
            fm.factors -= RATE * 0.5 * d_factors / np.sqrt(g_factors)
            fm.bias -= RATE * d_bias / np.sqrt(g_bias)
    return fm


def _with_metadata(docs: DataFrame, *more) -> DataFrame:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", "text", n_chars.alias("n_chars"), *more)


def labelled_ids(labels: DataFrame, train: Column, sample: int = SAMPLE) -> DataFrame | None:
    """At most ``sample`` rows ``doc_id, quality``, ids once, those of smallest
    hash; of an id's labels the largest counts and null ids name no document.
    None without any label."""
    usable = labels.where(train & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("quality").cast("int").alias("quality"))
    total = usable.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]
    if not total:
        return None
    # somewhat more than wanted, so that the estimate leaves enough to choose from
    share = min(1.0, (1.25 * sample + 50) / total)
    mark = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    return (usable.where(mark <= int(share * (1 << 30))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .orderBy(mark, "doc_id").limit(sample))


def labelled_features(docs: DataFrame, labels: DataFrame, train: Column,
                      sample: int = SAMPLE) -> pa.Table | None:
    """Rows (buckets, values, statistics, label) of at most ``sample`` labelled
    documents, featurised in the tasks.  Of rows that repeat an id the one whose
    text and ``n_chars`` have the smallest hash is taken; they are reduced to it
    in the tasks that read them."""
    picked = labelled_ids(labels, train, sample)
    if picked is None:
        return None
    joined = join_dimension(_with_metadata(docs), picked, ["doc_id"], "inner")
    once = joined.groupBy("doc_id", "quality").agg(
        F.min_by(F.struct("text", "n_chars"), F.xxhash64("text", "n_chars")).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            at = 0
            for n_chars, texts in text_chunks(batch.column(1), batch.column(0)):
                row, bucket, value, stats = features(texts, n_chars)
                ends = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32())
                every = pa.array(np.arange(len(texts) + 1) * STATISTICS, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, pa.array(bucket, pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.array(value, pa.float64())),
                     pa.ListArray.from_arrays(every, pa.array(stats.ravel(), pa.float64())),
                     batch.column(2).slice(at, len(texts))], ["buckets", "vals", "stats", "quality"])
                at += len(texts)

    rows, _, _ = stage_measured(once.select("row.text", "row.n_chars", "quality").mapInArrow(
        tidied(run), "buckets array<long>, vals array<double>, stats array<double>, quality int"), "labelled")
    # in an order that does not depend on which task came first
    return rows.orderBy(F.xxhash64("buckets", "vals", "stats"), "quality").toArrow()


def _trained(docs: DataFrame, labels: DataFrame, train: Column, sample: int) -> FactorisationMachine | None:
    got = labelled_features(docs, labels, train, sample)
    if got is None or not got.num_rows:
        return None

    def rows(name):  # views of one flat array
        column = got.column(name).combine_chunks()
        return np.split(column.values.to_numpy(), column.offsets.to_numpy()[1:-1])

    parts = [(None, b, v, s[None, :]) for b, v, s in zip(rows("buckets"), rows("vals"), rows("stats"))]
    return fit(parts, got.column("quality").to_numpy().astype(float))


def _score(model: FactorisationMachine | None, features: Features, texts: list[str], n_chars: list) -> np.ndarray:
    return model.score(*features(texts, n_chars)) if model else np.full(len(texts), 0.5)


def _held_out() -> Column:
    return F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column | None = None,
                   sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every text of ``docs``.

    Learns ``labels.quality`` from rows that are not ``held_out`` (default:
    crc32 of the id modulo 5 is 0).  A null text scores as an empty one.
    Without any label all scores are 0.5.  Repeated rows and ids give a row
    each; an id is learned from once, by the row of smallest hash, and of its
    repeated labels the largest counts.  A null id is not held out and, as it
    names no document, not learned from: with null ids only, all scores are 0.5.
    An empty table gives no rows; other columns are ignored.
    """
    held_out = _held_out() if held_out is None else held_out
    model = _trained(docs, labels, ~held_out, sample)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            at = 0
            for n_chars, texts in text_chunks(batch.column(2), batch.column(1)):
                score = _score(model, features, texts, n_chars)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(3), pa.array(score, pa.float64()),
                     pa.array((score >= threshold).astype(np.int32), pa.int32())],
                    ["doc_id", "held_out", "score", "predicted"])

    return _with_metadata(docs, held_out.alias("held_out")).mapInArrow(
        tidied(run), f"doc_id {id_type}, held_out boolean, score double, predicted int")


def drop_low_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
                     threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose score is below ``threshold``; rows
    keep all their columns and stay in their tasks, which write them to the
    shared folder."""
    with text_batches(docs.sparkSession):
        return stage(_good(docs, _trained(docs, labels, ~_held_out(), sample), threshold), "good-quality")


def _good(docs: DataFrame, model: FactorisationMachine | None, threshold: float) -> DataFrame:
    text, n_chars = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            known = batch.column(n_chars) if n_chars is not None else pa.nulls(batch.num_rows, pa.int64())
            at = 0
            for counts, texts in text_chunks(known, batch.column(text)):
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield part.filter(pa.array(_score(model, features, texts, counts) >= threshold))

    return docs.mapInArrow(tidied(run), docs.schema)
