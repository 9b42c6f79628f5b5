"""Intermediate tables written to the shared folder.

A staged table is written as parquet under ``spark.checkpoint.dir`` (the
folder the cluster shares) and read back, which

* cuts the lineage: later reads never recompute it, also after executor loss;
* fixes anything decided at run time (range bounds, partition indexes) once
  for every later reader;
* keeps it columnar, so a later pass that needs two columns (per-partition
  counts, first partition per tag) reads only those, and Spark knows its
  size from the files.

Staged tables live until removed.  A job that writes its own outputs wraps
its work in ``staging_scope``, which deletes the tables staged inside it when
the job ends; a lazily returned DataFrame (a registered query) still reads
its staged files, so those stay for the shared folder's retention policy.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagwave.session import scratch_path

_SCOPES: list[list[str]] = []
# When a list is placed here (tools/plans.py), every staged DataFrame's
# (name, DataFrame) is appended before it is written, to show its plan.
PLAN_SINK: list | None = None


def _register(path: str) -> None:
    if _SCOPES:
        _SCOPES[-1].append(path)


def track(path: str) -> str:
    """Put another intermediate folder (e.g. a landed CSV) under the
    current ``staging_scope``; returns the path."""
    _register(path)
    return path


def _record(df: DataFrame, name: str) -> None:
    if PLAN_SINK is not None:
        PLAN_SINK.append((name, df))


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to a new folder in the shared directory; return the read."""
    _record(df, name)
    path = scratch_path(df.sparkSession, name)
    _register(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row as Spark holds it in memory: a word per column and the
    null bits, plus the bytes of its texts and binary values (arrays and
    structs count as their JSON text)."""
    size = F.lit(8 * (len(df.columns) + 2)).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size


def stage_measured(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int, int]:
    """``stage`` plus the rows written and their bytes in memory, observed
    during the write (no separate counting job)."""
    _record(df, name)
    obs = Observation()
    path = scratch_path(df.sparkSession, name)
    _register(path)
    (df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes"))
     .write.mode("overwrite").parquet(path))
    got = obs.get
    return df.sparkSession.read.schema(df.schema).parquet(path), int(got["rows"]), int(got["bytes"] or 0)


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through the cluster's file system (best effort; not
    available on sessions without a JVM gateway)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # cleanup must never fail the job
        pass


@contextlib.contextmanager
def staging_scope(spark: SparkSession):
    """Delete every table staged inside the ``with`` block when it ends.
    Use it around work whose results are written before the block ends."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.pop()
        for path in paths:
            _delete(spark, path)
