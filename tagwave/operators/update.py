"""Conditional updates of a parquet table, file by file.

Parquet tables take no ``UPDATE``.  The loaders write a table's files as ranges
of ids, so rows that change together mostly lie together: an aggregate over the
narrow columns the rules read tells which files hold a changed row, and only
those are written anew, each as one file with its rows in their old order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwave.operators.sequence import parquet_order_key


def rewrite_changed(spark: SparkSession, table: str, aside: str, columns: Sequence[str],
                    update: Callable[[DataFrame], DataFrame]) -> list[tuple[str, str]]:
    """Write anew, under ``aside``, the files of ``table`` in which ``update``
    changes one of ``columns`` in some row (null equals null).

    ``update`` takes the table's rows (with further columns, which it keeps)
    and returns them with ``columns`` set.  Returns (new file, file it stands
    for) by name, one pair per changed file; nothing is moved.
    """
    old = spark.read.parquet(table)
    was = F.struct(*[F.col(c) for c in columns])
    changed = ~F.struct(*[F.col(c) for c in columns]).eqNullSafe(F.col("__was"))
    flagged = update(parquet_order_key(old).withColumn("__was", was))
    # A row per file, as Spark's own listing of the table.
    files = sorted(r["__file"] for r in flagged.where(changed).select("__file").distinct().collect())
    if not files:
        return []
    number = spark.createDataFrame(list(enumerate(files)), "__n int, __file string")
    rows = update(parquet_order_key(spark.read.schema(old.schema).parquet(*files)))
    rows = rows.join(F.broadcast(number), "__file").repartitionById(len(files), F.col("__n"))
    rows.sortWithinPartitions("__n", "__row").select(old.columns).write.parquet(aside)
    parts = {}
    for r in spark.read.parquet(aside).select("_metadata.file_name").distinct().collect():
        parts[int(r.file_name.split("-")[1])] = r.file_name
    return [(parts[i], f.rpartition("/")[2]) for i, f in enumerate(files)]
