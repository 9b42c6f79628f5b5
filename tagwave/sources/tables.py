"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``<base_dir>/<name>.parquet`` (a file or a folder of parts).  Column
    pruning and filter pushdown come from Catalyst once the caller selects
    and filters; nothing is read eagerly."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
