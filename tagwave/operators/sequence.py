"""Global row numbering and surrogate ids without a single-task sort.

`row_number() over (order by k)` with no PARTITION BY makes Spark move every
row into one task.  Here the keys are cut into ranges first (``key_ranges``):
a random sample of the key columns, bounded by the number of ranges, gives
bounds that become literals, so every later pass -- also one recomputed after
an executor is lost -- sees the same ranges.  Even one deployment holding a
third of all rows is split over many ranges by its second key.

* A narrow pass counts the rows per range; it reads the key columns only and
  aggregates in the map tasks.  One row per range, a proven bound, comes back
  and becomes a literal array of offsets.
* The full rows then cross the network once, straight to their range
  (``repartitionById``), are sorted there and numbered by a window over the
  range, which that partitioning satisfies: no second exchange, no staged copy
  of the rows, and the output files follow the order of the ids.

Three numberings are built on it:

* ``global_row_number`` -- WIN-1: 1-based position in a total order.
* ``surrogate_ids`` -- WIN-2: the ids the per-tag load loop produces.  The loop
  reads ``max(id)`` before each tag (1 when the table is empty, else max+1)
  and assigns ``1..n + base``; its closed form is
  ``id = global position + rank of the tag among tags that have rows``, so
  the first id is 2 and one value is skipped between consecutive tags.
  ``keyed_ids`` gives the same ids to rows that are dear to make or to hold.
* ``file_row_number`` -- WIN-3: position in file order, without any shuffle.

The passes read the input anew, so it must give the same rows each time (a
table scan does; stage anything that depends on task layout).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagwave.operators.joins import join_dimension
from tagwave.operators.stage import stage, stage_measured

RANGE = "__range"
_SAMPLE_PER_RANGE = 40
_MAX_SAMPLE = 1_000_000
#: Rows of a range that ``keyed_ids`` fills, where Spark's partitions would take
#: more: wide rows of a range are sorted in a task's memory.
MAX_RANGE_ROWS = 250_000


def _ordered(names: Sequence[str]) -> list[Column]:
    """Ascending with nulls last: the database order the numbering follows."""
    return [F.col(c).asc_nulls_last() for c in names]


def _comparable(values: Sequence[Column]) -> Column:
    """A struct that compares like the keys, nulls last."""
    return F.struct(*[part for v in values for part in (v.isNull(), v)])


@dataclass(frozen=True)
class KeyRanges:
    """Ranges of a key: ``bounds`` are texts of the first key of every range
    but the first, in ascending order."""

    types: tuple[str, ...]
    bounds: tuple[tuple[str | None, ...], ...]

    @property
    def count(self) -> int:
        return len(self.bounds) + 1

    def index(self, *key: Column) -> Column:
        """Range of a key, from 0: how many bounds are at most the key (a
        binary search in a literal array)."""
        if not self.bounds:
            return F.lit(0)

        def literal(bound: tuple[str | None, ...]) -> Column:
            return _comparable([_from_text(v, t) for v, t in zip(bound, self.types)])

        bounds = F.array(*[literal(b) for b in self.bounds])
        own = _comparable([k.cast(t) for k, t in zip(key, self.types)])
        steps = [1 << b for b in reversed(range(len(self.bounds).bit_length()))]
        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                           lambda at, step: F.when(F.get(bounds, at + step - 1) <= own, at + step).otherwise(at))


def _as_text(name: str, kind: str) -> Column:
    c = F.col(name)
    return (F.unix_micros(c) if kind == "timestamp" else c).cast("string")


def _from_text(value: str | None, kind: str) -> Column:
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(value).cast("long"))
    return F.lit(value).cast(kind)


def range_count(df: DataFrame) -> int:
    """Ranges to cut keys into: Spark's own number of shuffle partitions."""
    conf = df.sparkSession.conf
    n = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(1, int(n or conf.get("spark.sql.shuffle.partitions", "200")))


def key_ranges(df: DataFrame, keys: Sequence[str], ranges: int | None = None) -> KeyRanges:
    """Ranges of about equal row counts over ``keys`` (ascending, nulls last),
    from one narrow pass: a random sample of at most ``_MAX_SAMPLE`` keys."""
    kinds = dict(df.dtypes)
    ranges = ranges or range_count(df)
    types = tuple(kinds[k] for k in keys)
    if ranges == 1:
        return KeyRanges(types, ())
    size = min(_MAX_SAMPLE, _SAMPLE_PER_RANGE * ranges)
    sample = df.select(*keys).withColumn("__r", F.rand(17)).orderBy("__r").limit(size)
    rows = [tuple(r) for r in sample.orderBy(*_ordered(keys)).select(
        *[_as_text(k, t).alias(f"__k{i}") for i, (k, t) in enumerate(zip(keys, types))]).collect()]
    bounds = dict.fromkeys(rows[len(rows) * i // ranges] for i in range(1, ranges) if len(rows) * i // ranges)
    bounds.pop(rows[0] if rows else None, None)
    return KeyRanges(types, tuple(bounds))


def at_range(values: Sequence[int]) -> Column:
    """The value of a row's range."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col(RANGE) + 1)


def to_ranges(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """Rows, with their range in ``__range``, each range in one partition."""
    return df.repartitionById(ranges.count, F.col(RANGE))


def position(order: Sequence[str]) -> Column:
    """1-based position of a row inside its range."""
    return F.row_number().over(Window.partitionBy(RANGE).orderBy(*_ordered(order))).cast("long")


def offsets(counts: dict[int, int], ranges: int) -> list[int]:
    """Rows in the ranges before each range."""
    out, before = [], 0
    for r in range(ranges):
        out.append(before)
        before += counts.get(r, 0)
    return out


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "row_number",
                      partitions: int | None = None, distinct: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (ascending,
    nulls last), like ``row_number() over (order by ...)``; with
    ``distinct=True`` duplicates are dropped first (``UNION`` semantics).

    The order must be total (unique keys) for the numbering to be
    reproducible; add tie-breaking columns otherwise.
    """
    kinds = dict(df.dtypes)
    # Spark groups floating-point keys on a normalized value, so ranges end
    # before the first of them: equal rows meet in one range.
    lead = [c for i, c in enumerate(order) if not any(kinds[o] in ("double", "float") for o in order[:i + 1])]
    if not lead:  # nothing but floating-point keys in front
        if distinct:
            df, distinct = stage(df.distinct(), "distinct"), False
        lead = list(order)
    ranges = key_ranges(df, lead, partitions)
    ranged = df.withColumn(RANGE, ranges.index(*[F.col(c) for c in lead]))
    if distinct:
        return number_in_ranges(to_ranges(ranged, ranges).distinct(), order, out)
    counts = {r[RANGE]: r["count"] for r in ranged.groupBy(RANGE).count().collect()}
    return (to_ranges(ranged, ranges)
            .withColumn(out, at_range(offsets(counts, ranges.count)) + position(order)).drop(RANGE))


def number_in_ranges(ranged: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Position of rows that were already brought to their range and changed
    there (rows dropped or made), so that only the rows themselves tell the
    counts.  Both readers of ``ranged`` share its exchange: the rows cross the
    network once.  The counts have a row per range, so they are broadcast."""
    counts = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select(RANGE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # A left join: an inner one would filter one reader only and part the exchange.
    return (ranged.join(F.broadcast(offset), RANGE, "left")
            .withColumn(out, (F.col("__off") + position(order)).cast("long")).drop(RANGE, "__off"))


def _shifts(per: DataFrame, tags: Sequence[str], ranges: int) -> list[int]:
    """Rows and tags before each range, from the rows ``n`` per range and tag;
    a tag that goes on into a range began before it."""
    own = _comparable([F.col(c) for c in tags])
    rows = (per.groupBy(RANGE).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("tags"),
                                   F.min(own).alias("low"), F.max(own).alias("high")).collect())
    stats = {r[RANGE]: r for r in rows}  # a row per range
    shift, before, begun, last = [], 0, 0, None
    for i in range(ranges):
        r = stats.get(i)
        goes_on = int(r is not None and r.low == last)
        shift.append(before + begun - goes_on)
        if r is not None:
            before, begun, last = before + r.n, begun + r.tags - goes_on, r.high
    return shift


def surrogate_ids(df: DataFrame, tag: str | Sequence[str], order: Sequence[str], out: str = "id",
                  partitions: int | None = None) -> DataFrame:
    """Ids the per-tag append loop would give: tags processed in ascending
    ``tag`` order, rows of a tag in ``order``; ``id = position + tag rank``.

    A tag's rank is the number of tags that begin in earlier ranges plus its
    rank among the tags of its range, less one where the range begins inside a
    tag.  Both that and the row offset depend on the range only: one literal
    array holds their sum.
    """
    tags = [tag] if isinstance(tag, str) else list(tag)
    keys = [*tags, *order]
    ranges = key_ranges(df, keys, partitions)
    ranged = df.withColumn(RANGE, ranges.index(*[F.col(c) for c in keys]))
    per = ranged.groupBy(RANGE, *tags).agg(F.count(F.lit(1)).alias("n"))
    shift = _shifts(per, tags, ranges.count)
    rank = F.dense_rank().over(Window.partitionBy(RANGE).orderBy(*_ordered(tags)))
    return (to_ranges(ranged, ranges)
            .withColumn(out, (at_range(shift) + position(keys) + rank).cast("long")).drop(RANGE))


def keyed_ids(df: DataFrame, keys: DataFrame, tags: Sequence[str], order: Sequence[str], out: str = "id") -> DataFrame:
    """``surrogate_ids`` of rows whose keys ``keys`` gives alone: the same rows
    in any order, of nothing but ``tags`` (never null) and ``order``.

    The keys are staged and only they are sampled and counted, so ``df`` is made
    once.  A table with a row per tag (``join_dimension``) tells the ranges the
    tag lies in and the id before its first row there: only rows of a tag in
    several ranges are compared with bounds.  Rows are numbered inside their tag
    and range, so no window holds a whole range of wide rows.
    """
    names = [*tags, *order]
    staged, rows, _size = stage_measured(keys.select(*names), "keys")
    ranges = key_ranges(staged, names, max(range_count(df), -(-rows // MAX_RANGE_ROWS)))
    own = _comparable([F.col(c) for c in order])
    per = stage(staged.withColumn(RANGE, ranges.index(*[F.col(c) for c in names]))
                .groupBy(RANGE, *tags).agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("low")), "tag-rows")
    inside = Window.partitionBy(RANGE).orderBy(*_ordered(tags))
    earlier = F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = at_range(_shifts(per, tags, ranges.count)) + earlier + F.row_number().over(inside)
    parts = (per.select(*tags, F.struct(RANGE, first.cast("long").alias("first"), "low").alias("part")).groupBy(*tags)
             .agg(F.sort_array(F.collect_list("part")).alias("__parts")))
    at = F.when(F.size("__parts") == 1, F.col("__parts")[0]).otherwise(
        F.element_at(F.filter("__parts", lambda part: part["low"] <= own), -1))
    placed = join_dimension(df, parts, tags, "inner").withColumns({RANGE: at[RANGE], "__first": at["first"]}).drop("__parts")
    number = F.row_number().over(Window.partitionBy(RANGE, *tags).orderBy(*_ordered(order)))
    return to_ranges(placed, ranges).withColumn(out, F.col("__first") + number).drop(RANGE, "__first")


def file_row_number(df: DataFrame, out: str = "row_number") -> DataFrame:
    """1-based position of each row in its files' order (R's ``1:n()`` right
    after reading: files by path, then by byte offset, then line order),
    without moving any row.

    Each input split is read by one task from start to end, so its rows get
    consecutive ``monotonically_increasing_id`` values.  Rows are staged once
    with path, block start and id: how splits are packed into tasks depends on
    the cores registered at the time, so a second scan could give other ids.
    From the staged rows, a table with one row per split -- path, block start,
    first id, row count; bounded by the number of splits, not rows -- gives
    every split its offset (a running sum in path order), and a row's position
    is offset + (id - first id) + 1.  The files are parsed once.  Must be
    applied to the scan output, before any shuffle.
    """
    keyed = stage(file_order_key(df).withColumn("__fkey", F.xxhash64("__file")), "file-rows")
    splits = (keyed.groupBy("__fkey", "__file", "__block")
              .agg(F.min("__mono").alias("__first"), F.count(F.lit(1)).alias("__n")))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("__fkey", "__block", "__first",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (join_dimension(keyed.drop("__file"), offsets, ["__fkey", "__block"], "inner")
            .withColumn(out, (F.col("__off") + F.col("__mono") - F.col("__first") + 1).cast("long"))
            .drop("__fkey", "__block", "__mono", "__first", "__off"))


def file_order_key(df: DataFrame) -> DataFrame:
    """Columns that reproduce the order rows have in their source files
    (path, byte offset of the split, then the reading order inside it), for
    R's ``1:n()`` over a freshly read text file (WIN-3).  Must be applied right
    after the scan, before any shuffle; another scan may pack its splits
    otherwise, so stage the rows with them."""
    return (df.withColumn("__file", F.col("_metadata.file_path"))
              .withColumn("__block", F.col("_metadata.file_block_start"))
              .withColumn("__mono", F.monotonically_increasing_id()))


def parquet_order_key(df: DataFrame) -> DataFrame:
    """Path and row number in the file of freshly scanned parquet rows: the
    same in every scan."""
    return (df.withColumn("__file", F.col("_metadata.file_path"))
              .withColumn("__row", F.col("_metadata.row_index")))


FILE_ORDER = ["__file", "__row"]


def parquet_position(df: DataFrame, out: str = "position") -> DataFrame:
    """1-based position of freshly scanned parquet rows in the order of their
    files' names and of the rows in them; one row per file tells the offsets."""
    keyed = parquet_order_key(df)
    sizes = keyed.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (join_dimension(keyed, offset, ["__file"], "inner")
            .withColumn(out, (F.col("__off") + F.col("__row") + 1).cast("long")).drop("__file", "__row", "__off"))
