"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwave.operators.joins import join_dimension
from tagwave.operators.stage import stage

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables by a path that only Spark opens."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, m: int) -> Column:
    """crc32 of an id's decimal text, modulo ``m`` (the folds of the contracts)."""
    return F.crc32(F.col(col).cast("string")) % m


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed.

    Pure ASCII takes the byte-wise ``lower``; other texts must not have their
    other capitals folded, so they go through ``translate``.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def text_chunks(ids: pa.Array, texts: pa.Array, limit: int = 2_000_000) -> Iterator[tuple[list, list]]:
    """An Arrow batch cut into lists of (ids, texts) of about ``limit``
    characters, so that what a task holds besides the batch is bounded; null
    texts come out as empty strings."""
    out_ids: list = []
    out: list[str] = []
    size = 0
    for i, t in zip(ids, texts, strict=True):
        s = t.as_py() or ""
        out_ids.append(i.as_py())
        out.append(s)
        size += len(s) + 100
        if size >= limit:
            yield out_ids, out
            out_ids, out, size = [], [], 0
    if out:
        yield out_ids, out


#: How to drop what each operator keeps in a worker between its tasks.
FORGET: dict[str, Callable[[], None]] = {}


def forget_others(owner: str | None) -> None:
    """Drop what other operators keep in this worker."""
    for name, forget in FORGET.items():
        if name != owner:
            forget()


def give_back() -> None:
    """Return freed memory of Arrow and, where the C library can, of everything
    else to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator], Iterator], owner: str | None = None) -> Callable:
    """A ``mapInArrow`` function that drops what operators other than ``owner``
    keep in the worker before its partition begins, and gives unused memory back
    to the system then and when it ends: workers live on between tasks and stages."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(owner)
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def running_sum(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out`` = sum of ``value`` over the rows before each row in
    ``order`` (a unique key), without moving all rows to one task.

    Rows are range-partitioned on ``order`` and staged with a partition number
    and the sum inside the partition; the per-partition totals (one row per
    partition, a proven bound) give each partition its offset.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id())
    inside = Window.partitionBy("__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    staged = stage(ranged.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0))), "runsum")
    totals = staged.groupBy("__part").agg(F.sum(value).alias("__tot"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__tot").over(before), F.lit(0)).alias("__off"))
    return (staged.join(F.broadcast(offsets), "__part")
            .withColumn(out, (F.col("__off") + F.col("__in")).cast("long"))
            .drop("__part", "__in", "__off"))


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_key(text: str = "text") -> Column:
    """With the id, what tells a row apart in a second read of its table."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keep_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (``doc_id, text_key, kept``, one
    row per row of ``docs``) keeps, with all their columns.

    An anti-join with the dropped rows' keys.  Rows that repeat both id and
    text share a group, of which one row stays at most: if one does, the
    repeats are dropped by an aggregation that collapses them in their tasks.
    """
    key = "__text_key"
    by_row = stage(decisions.groupBy("doc_id", F.col("text_key").alias(key)).agg(
        F.bool_or("kept").alias("one_stays"), F.count_if(~F.col("kept")).alias("go")).where("go > 0"), "decisions")
    keyed = docs.withColumn(key, text_key())
    out = join_dimension(keyed, by_row.select("doc_id", key), ["doc_id", key], "left_anti", null_safe=True)
    some = by_row.where("one_stays")
    if not some.isEmpty():
        repeats = join_dimension(keyed, some.select("doc_id", key), ["doc_id", key], "left_semi", null_safe=True)
        out = out.unionByName(repeats.dropDuplicates(["doc_id", key]))
    return out.drop(key).select(docs.columns)
