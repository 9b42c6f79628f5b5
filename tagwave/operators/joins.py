"""Joins of a big table (records, product rows) with a derived per-key
table (one row per tag, per deployid, per partition or split).

Spark broadcasts a join side on its own only when it can estimate the size
statically (files) or at run time (AQE, after the shuffle of both sides has
already been written).  A table derived through aggregates, windows and
explodes gets a poor static estimate, so the big side could be shuffled
first or even broadcast in its place.  Here such a table is staged once
(parquet in the shared folder) and counted while it is written:

* at most ``spark.tagwave.maxBroadcastBytes`` bytes in memory (default 64 MB)
  and ``spark.tagwave.maxBroadcastRows`` rows (default 2M): broadcast;
* more: a sort-merge join in which hot keys are salted.  The big side's rows
  per key are counted (a partial aggregate); a key holding more than twice a
  partition's fair share is hot -- there are at most about P/2 of them, a
  proven bound, so that list is broadcast.  A hot key's big-side rows are
  spread over ``spark.tagwave.saltBuckets`` buckets (default 32) by a hash of
  their own columns and its dimension rows are copied once per bucket; rows
  with a null key, which match nothing, are spread the same way; other keys
  use bucket 0.  One key holding a third of all rows is thereby split
  over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave.operators.stage import stage, stage_measured

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_SALT_BUCKETS = 32


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    v = df.sparkSession.conf.get(key, None)
    return int(v) if v else default


def max_broadcast_rows(df: DataFrame) -> int:
    return _conf_int(df, "spark.tagwave.maxBroadcastRows", DEFAULT_MAX_BROADCAST_ROWS)


@dataclass(frozen=True)
class Dimension:
    """A staged per-key table and whether it passed the broadcast size check."""

    df: DataFrame
    small: bool

    def where(self, cond: Column | str) -> Dimension:
        return Dimension(self.df.where(cond), self.small)

    def select(self, *cols) -> Dimension:
        return Dimension(self.df.select(*cols), self.small)

    def withColumnRenamed(self, old: str, new: str) -> Dimension:
        return Dimension(self.df.withColumnRenamed(old, new), self.small)

    @property
    def columns(self) -> list[str]:
        return self.df.columns


def dimension(df: DataFrame | Dimension, max_rows: int | None = None) -> Dimension:
    """Stage ``df`` and size-check it (a ``Dimension`` passes through)."""
    if isinstance(df, Dimension):
        return df
    limit = max_rows if max_rows is not None else max_broadcast_rows(df)
    staged, rows, size = stage_measured(df, "dim")
    most = _conf_int(df, "spark.tagwave.maxBroadcastBytes", DEFAULT_MAX_BROADCAST_BYTES)
    return Dimension(staged, rows <= limit and size <= most)


def _col(name: str) -> Column:
    """A column by its exact name (names may contain dots)."""
    return F.col(f"`{name}`")


def _null_safe_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Replace each key by (is null, value as text, '' for null): an equi-join
    on these matches null to null, like ``<=>``."""
    out, names = df, []
    for i, k in enumerate(keys):
        out = out.withColumns({f"__nk{i}": _col(k).isNull(),
                               f"__kv{i}": F.coalesce(_col(k).cast("string"), F.lit(""))})
        names += [f"__nk{i}", f"__kv{i}"]
    return out, names


def join_dimension(big: DataFrame, dim: DataFrame | Dimension, keys: Sequence[str],
                   how: str = "inner", null_safe: bool = False) -> DataFrame:
    """``big`` joined with a per-key table on ``keys`` (same names on both
    sides; the dimension's key columns are dropped from the result).

    Broadcast when the dimension passed the size check, else a sort-merge
    join with hot keys salted (see the module notes).
    """
    d = dimension(dim)
    small = d.df
    keys = list(keys)
    if null_safe:
        big, jkeys = _null_safe_keys(big, keys)
        small, _ = _null_safe_keys(small, keys)
        small = small.drop(*keys)
    else:
        jkeys = keys
    if d.small:
        out = big.join(F.broadcast(small), jkeys, how)
    else:
        out = _salted_join(big, small, jkeys, how)
    return out.drop(*[k for k in jkeys if k not in keys])


def _salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    buckets = _conf_int(big, "spark.tagwave.saltBuckets", DEFAULT_SALT_BUCKETS)
    parts = _conf_int(big, "spark.sql.shuffle.partitions", 200)
    counts = stage(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), "keycounts")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    threshold = max(1, 2 * total // max(1, parts))
    # at most total / threshold = P/2 hot keys: a proven bound
    hot = F.broadcast(stage(counts.where(F.col("__n") > threshold).select(*keys)
                            .withColumn("__hot", F.lit(True)), "hotkeys"))
    row_hash = F.xxhash64(*[_col(c) for c in big.columns])
    # a null key equals no key, so its rows may lie in any bucket
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | _col(k).isNull()
    big_s = (big.join(hot, keys, "left")
             .withColumn("__salt", F.when(F.col("__hot") | no_key, F.pmod(row_hash, F.lit(buckets)))
                         .otherwise(F.lit(0).cast("long")))
             .drop("__hot"))
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))) \
              .otherwise(F.array(F.lit(0).cast("long")))
    small_s = (small.join(hot, keys, "left")
               .withColumn("__salt", F.explode(copies)).drop("__hot"))
    return big_s.join(small_s, [*keys, "__salt"], how).drop("__salt")
