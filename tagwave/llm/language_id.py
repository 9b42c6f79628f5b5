"""Language identification by string kernels.

The kernel of two texts is their number of common character n-grams of all
lengths up to three (blended spectrum, presence only), normalised by the
geometric mean of their own numbers.  Characters are folded into a small
alphabet learned from the sample: frequent letters each have a class, other
letters share some, everything else is one boundary class whose runs count
once.  A text's n-grams are therefore flags in one array of fixed size.

Fitting: a bounded sample of labelled rows (``PER_LANGUAGE`` each, smallest
hashes of id and text first), whose letters are counted and whose n-grams are
found in tasks; ``LANDMARKS`` of them per language are Nyström landmarks, and
kernel ridge regression one-versus-rest is solved in their span on the driver.

Scoring: a decision value is K(text, landmarks) @ weights.  K is itself
presence @ landmark presence, so the product of landmark presence and weights
is formed once (n-grams x languages) and every batch of texts is one sparse
matrix product with it.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagwave.llm.common import crc_mod, text_chunks
from tagwave.operators.joins import join_dimension
from tagwave.operators.stage import stage

#: Bounds of the sample: texts and landmarks per language.
PER_LANGUAGE, LANDMARKS = 400, 50
RIDGE = 1e-3
UNKNOWN = "und"

_CLASSES, _OWN = 64, 47  # classes in all; letters with a class of their own
_GRAMS = _CLASSES + _CLASSES**2 + _CLASSES**3
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point the code point of its lower-case letter, 0 if it is
    no letter; built once per process."""
    if not _LETTERS:
        out = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            ch = chr(c)
            if unicodedata.category(ch)[0] == "L":
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _LETTERS.append(out)
    return _LETTERS[0]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def letter_counts(texts: list[str]) -> Counter:
    """How often each letter (as its lower-case code point) stands in ``texts``."""
    low, count = letters(), Counter()
    for t in texts:
        points, n = np.unique(low[_points(t)], return_counts=True)
        count.update(dict(zip(points.tolist(), n.tolist())))
    count.pop(0, None)
    return count


def learn_alphabet(count: Counter) -> np.ndarray:
    """The class of each code point (0: no letter); the most frequent letters
    of ``count`` have their own."""
    low = letters()
    own = [c for c, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:_OWN]]
    shared = _CLASSES - 1 - _OWN
    classes = np.where(low > 0, 1 + _OWN + low % shared, 0)
    for k, c in enumerate(own):
        classes[low == c] = 1 + k
    return classes.astype(np.uint8)


class Presence:
    """The n-grams a text holds, as sorted indices."""

    def __init__(self, alphabet: np.ndarray):
        self.alphabet = alphabet
        self.flags = np.zeros(_GRAMS, bool)

    def __call__(self, text: str) -> np.ndarray:
        c = self.alphabet[_points(text)].astype(np.int32)
        if not c.any():
            return np.zeros(0, np.int64)
        # a boundary at both ends, and each run of boundaries once
        c = np.concatenate([[0], c, [0]])
        c = c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]
        two = c[:-1] * _CLASSES + c[1:]
        self.flags[c] = True
        self.flags[_CLASSES + two] = True
        self.flags[_CLASSES + _CLASSES**2 + two[:-1] * _CLASSES + c[2:]] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found


@dataclass
class LanguageModel:
    """``weights[rows[g]]`` are n-gram g's weights for each language (rows[g]
    is -1 for an n-gram that no landmark holds)."""

    languages: list[str]
    alphabet: np.ndarray
    rows: np.ndarray
    weights: np.ndarray

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score (0 to 1) of each text."""
        presence = Presence(self.alphabet)
        found = [presence(t) for t in texts]
        own = np.array([len(f) for f in found])
        # the batch as one sparse matrix product: rows of weights, summed per text
        known = [r[r >= 0] for r in (self.rows[f] for f in found)]
        size = np.array([len(k) for k in known])
        values = np.zeros((len(texts), len(self.languages)))
        filled = np.flatnonzero(size)
        if len(filled):
            start = np.cumsum(size[filled]) - size[filled]
            values[filled] = np.add.reduceat(self.weights[np.concatenate(known)], start, axis=0)
        values /= np.sqrt(np.maximum(own, 1))[:, None]
        best = values.argmax(axis=1)
        score = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        return [(self.languages[b], float(s)) if n else (UNKNOWN, 0.0) for b, s, n in zip(best, score, own)]


def fit(alphabet: np.ndarray, sample: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS,
        ridge: float = RIDGE) -> LanguageModel | None:
    """A model from (language, n-grams present) rows; None without any n-gram."""
    held = [(lang, f) for lang, f in sample if len(f)]
    if not held:
        return None
    languages = sorted({lang for lang, _ in held})
    taken: Counter = Counter()
    marks = []
    for k, (lang, _) in enumerate(held):
        if taken[lang] < landmarks:
            taken[lang] += 1
            marks.append(k)
    grams = np.unique(np.concatenate([held[k][1] for k in marks]))
    rows = np.full(_GRAMS, -1, np.int32)
    rows[grams] = np.arange(len(grams))
    inside = np.zeros((len(grams), len(marks)), np.float32)  # landmark presence, normalised
    for j, k in enumerate(marks):
        inside[rows[held[k][1]], j] = 1 / np.sqrt(len(held[k][1]))

    def kernel(found: np.ndarray) -> np.ndarray:
        at = rows[found]
        return inside[at[at >= 0]].sum(axis=0) / np.sqrt(len(found))

    k_nm = np.array([kernel(f) for _, f in held], np.float64)
    target = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in held])
    k_mm = k_nm[marks]
    system = k_nm.T @ k_nm + ridge * len(held) * k_mm + 1e-9 * len(held) * np.eye(len(marks))
    beta = np.linalg.solve(system, k_nm.T @ target)
    return LanguageModel(languages, alphabet, rows, (inside @ beta.astype(np.float32)).astype(np.float32))


def labelled_sample(docs: DataFrame, train: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows ``lang, mark, text`` of each language, those
    of smallest hash of id and text; rows alike in both count once, and a null id
    is an id like others.  The table is staged.

    Different rows are estimated by language first, so that only about twice as
    many as wanted are ever ranked, however large a language is.
    """
    mark = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(3)), 1)
    marked = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", mark.alias("mark"), "text")
    sizes = marked.groupBy("lang").agg(F.approx_count_distinct("mark", 0.02).alias("size"))
    share = F.lit((2.0 * per_language + 50) * (1 << 63)) / F.greatest("size", F.lit(1))
    few = (join_dimension(marked, sizes, ["lang"], "inner").where(F.col("mark") <= share)
           .select("lang", "mark", "text").dropDuplicates(["lang", "mark"]))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    return stage(few.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank"), "languages")


def _letters_of(sample: DataFrame) -> Counter:
    """The sample's most frequent letters, counted in its tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = letter_counts(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int32()), pa.array(list(count.values()), pa.int64())],
                                             ["letter", "n"])

    rows = (sample.select("text").mapInArrow(run, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "letter").limit(_OWN).collect())
    return Counter({r["letter"]: r["n"] for r in rows})


def trained(docs: DataFrame, train: Column, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """A model of the ``train`` rows of ``docs``; None if they hold no letter.
    The driver gets the n-grams of the sample's texts: ``per_language`` arrays
    of at most ``_GRAMS`` numbers for each language."""
    sample = labelled_sample(docs, train, per_language)
    alphabet = learn_alphabet(_letters_of(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(alphabet)
        for batch in batches:
            found = [presence(t).astype(np.int32) for t in batch.column(2).to_pylist()]
            ends = np.cumsum([0, *map(len, found)])
            grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), grams], ["lang", "mark", "grams"])

    rows = sample.select("lang", "mark", "text").mapInArrow(run, "lang string, mark long, grams array<int>")
    got = rows.orderBy("lang", "mark").toArrow()
    return fit(alphabet, [(lang, np.asarray(g.values)) for lang, g in zip(got.column("lang").to_pylist(), got.column("grams"))])


def languages(docs: DataFrame, held_out: Column | None = None, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every text of ``docs``
    (``doc_id, text, lang``).

    Learns from rows that are not ``held_out`` (default: crc32 of the id
    modulo 4 is 2) and have a ``lang``.  A text that is null or has no letter
    is ``und`` with score 0, as is every text when nothing can be learned.
    Ties go to the alphabetically first language.  Repeated rows and ids give
    a row each; equal rows are learned from once, different texts of one id each
    by itself.  A null id is never held out and learned from like others; an empty
    table gives no rows; other columns are ignored.
    """
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)) if held_out is None else held_out
    model = trained(docs, ~held_out, per_language)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in text_chunks(batch.column(0), batch.column(2)):
                got = model.predict(texts) if model else [(UNKNOWN, 0.0)] * len(texts)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([x for x, _ in got], pa.string()),
                     pa.array([s for _, s in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
