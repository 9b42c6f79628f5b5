"""Wide 24-bin histograms to hourly timelines (RSH-1, RSH-2).

Upstream the reshape is a 24-branch ``UNION`` (24 scans of the wide table,
one per bin) numbered by a global ``row_number()``.  Here it is one scan, and
the wide rows are what crosses the network: they go to the ranges of
(tag, hour) their 24 hours fall in -- a row whose day meets a range border goes
to both sides -- and become hourly rows there, each range keeping its own
hours.  ``UNION`` de-duplication and numbering then run inside the ranges
without another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.functions.casts import r_as_integer
from tagwave.functions.timefmt import add_hours
from tagwave.operators.sequence import RANGE, key_ranges, number_in_ranges, to_ranges

TIME = "timeline_start_dt"


def _bin_array(bins: Sequence[str]) -> Column:
    return F.array(*[F.col(b).cast("double") for b in bins])


def explode_bins(wide: DataFrame, keep: list[str], start: str = "hist_dt",
                 bins: list[str] = S.BIN_COLUMNS, value: str = "percent_dry") -> DataFrame:
    """One row per (wide row, bin): ``timeline_start_dt = start + (bin-1) h``,
    ``value`` = the bin (nulls kept)."""
    exploded = wide.select(*keep, start, F.posexplode(_bin_array(bins)).alias("__h", value))
    return exploded.select(*keep, add_hours(F.col(start), F.col("__h")).alias(TIME), value)


def hourly_in_ranges(wide: DataFrame, lead: Sequence[str], keep: Sequence[str] = (), start: str = "hist_dt",
                     bins: Sequence[str] = S.BIN_COLUMNS, value: str = "percent_dry",
                     ranges: int | None = None) -> DataFrame:
    """``explode_bins`` after the shuffle: ``__range, *lead, *keep,
    timeline_start_dt, value``, each range of ``(*lead, timeline_start_dt)``
    in one partition."""
    last_hour = len(bins) - 1
    keys = [*lead, TIME]
    cut = key_ranges(wide.select(*lead, F.col(start).alias(TIME)), keys, ranges)

    def at(time: Column) -> Column:
        return cut.index(*[F.col(c) for c in lead], time)

    spread = (wide.select(*lead, *keep, F.col(start).alias("__start"), _bin_array(bins).alias("__bins"))
              .withColumns({"__low": at(F.col("__start")),
                            "__high": at(add_hours(F.col("__start"), F.lit(last_hour)))})
              .withColumn(RANGE, F.explode_outer(F.sequence("__low", "__high"))))
    moved = to_ranges(spread, cut)
    hours = moved.select(RANGE, *lead, *keep, "__start", "__low", "__high", F.posexplode_outer("__bins").alias("__h", value))
    hours = hours.withColumn(TIME, add_hours(F.col("__start"), F.col("__h")))
    mine = (F.col("__low") == F.col("__high")) | (at(F.col(TIME)) == F.col(RANGE))
    return hours.where(mine).select(RANGE, *lead, *keep, TIME, value)


def timeline_unpivot(wide: DataFrame, hist_type: str = S.HIST_TYPE_PERCENT, ranges: int | None = None) -> DataFrame:
    """``id, deploy_id, deployid, hist_type, timeline_start_dt, percent_dry``.

    Rows equal in every column collapse to one (``UNION``); ids follow
    ``(deploy_id, timeline_start_dt)`` ascending with nulls last, with
    ``deployid, percent_dry`` breaking ties so the ids are reproducible.
    The output partitions follow each other in the order of the ids.
    """
    long = hourly_in_ranges(wide, ["deploy_id"], ["deployid"], ranges=ranges).distinct()
    order = ["deploy_id", TIME, "deployid", "percent_dry"]
    return number_in_ranges(long, order, "id").select(
        "id", "deploy_id", "deployid", F.lit(hist_type).alias("hist_type"), TIME, "percent_dry")


def tidy_timeline(histos: DataFrame, id_col: str = "deployid", ranges: int | None = None) -> DataFrame:
    """``id, deployid, hist_type, timeline_start_dt, percent_dry`` from a
    histogram file: every bin of every type becomes an hourly row, the tag id
    is made an integer the way R's ``as.integer`` does (NA on failure,
    decimals truncated), and rows are numbered in
    ``(deployid, hist_type, timeline_start_dt)`` order."""
    wide = histos.withColumn(id_col, r_as_integer(F.col(id_col))).withColumnRenamed(id_col, "deployid")
    long = hourly_in_ranges(wide, ["deployid", "hist_type"], ranges=ranges)
    order = ["deployid", "hist_type", TIME, "percent_dry"]
    return number_in_ranges(long, order, "id").select("id", "deployid", "hist_type", TIME, "percent_dry")
