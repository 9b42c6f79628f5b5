"""Partner CSV files, read the way R's ``read.csv(stringsAsFactors=FALSE)``
sees them.

* Every column is read as text (no schema inference, no ``nullValue``); the
  typed projection happens later with ``try_*`` casts, so a bad value gives
  null instead of failing the job (ANSI mode is on).
* Header names go through R's ``make.names`` (spaces, hyphens and other
  invalid characters become dots), because the cleanup rules are written
  against those names.  Spark columns never keep the dots: they are renamed
  by the cleanup step.
* Spark returns an empty field as null; R returns ``""`` for text and NA for
  the literal ``NA``.  ``functions.text.r_text`` restores that.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagwave.operators.commit import Tables
from tagwave.operators.stage import track
from tagwave.session import scratch_path


def r_make_name(name: str) -> str:
    """R's ``make.names`` for one header: invalid characters become ``.``,
    a leading digit or underscore gets an ``X`` prefix."""
    out = re.sub(r"[^0-9A-Za-z._]", ".", name)
    if not out or re.match(r"^([0-9_]|\.[0-9])", out):
        out = "X" + out
    return out


def text_schema(header: list[str]) -> StructType:
    return StructType([StructField(h, StringType(), True) for h in header])


def read_text_csv(spark: SparkSession, path: str, header: list[str] | None = None,
                  multiline: bool = False) -> DataFrame:
    """All fields as strings, columns named by ``make.names`` of the header.

    Pass ``header`` (the file's header line, in order) to skip the extra
    pass Spark needs to read the header names; the first line of every file
    is still skipped as a header.  ``multiline=True`` accepts quoted fields
    that contain line breaks (as ``read.csv`` does) at the price of reading
    each file whole in one task; the default splits large files on lines.
    """
    reader = (spark.read.option("header", True).option("multiLine", multiline)
              .option("escape", '"').option("mode", "PERMISSIVE"))
    if header is not None:
        reader = reader.schema(text_schema(header))
    df = reader.csv(path)
    return df.toDF(*[r_make_name(c) for c in df.columns])


def write_text_csv(df: DataFrame, path: str) -> None:
    """Write with a header, R-style ``NA`` for nulls, quoting only where
    needed, and times as R prints them (``2021-07-01 07:00:00``)."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", "NA")
       .option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def _r_field(df: DataFrame, name: str) -> F.Column:
    """A field as ``write.csv`` prints it."""
    c, kind = col(name), dict(df.dtypes)[name]
    if kind == "string":
        c = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    elif kind.startswith("timestamp"):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif kind == "boolean":
        c = F.upper(c.cast("string"))
    elif kind in ("double", "float"):  # whole numbers without a decimal point
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        c = F.when(whole, F.floor(c).cast("string")).otherwise(c.cast("string"))
    return F.coalesce(c.cast("string"), F.lit("NA"))


def _r_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws(",", *[_r_field(df, c) for c in df.columns]).alias("value"))


def _r_header(df: DataFrame) -> str:
    return ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)


def write_r_csv(df: DataFrame, path: str) -> None:
    """Part files, each with the header, as ``write.csv(row.names = FALSE)``
    prints them: written in parallel and put in the place of ``path`` as one.
    A partition without rows leaves no file; without any row there is one file
    with the header."""
    spark, header = df.sparkSession, _r_header(df)
    # The header goes before the first row of each partition (index 0 in it).
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = _r_lines(df)
    lines = lines.select(F.when(first, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value")).alias("value"))
    folder, _, name = path.rstrip("/").rpartition("/")
    tables = Tables(spark, folder)
    aside = tables.aside()
    rows = Observation()
    lines.observe(rows, F.count(F.lit(1)).alias("n")).write.text(f"{aside}/{name}")
    if not rows.get["n"]:
        spark.range(1).select(F.lit(header).alias("value")).coalesce(1).write.mode("overwrite").text(f"{aside}/{name}")
    for part in tables.names(f"{aside}/{name}"):
        if tables.size(f"{aside}/{name}/{part}") == 0:  # of a partition without rows, or a success marker
            tables.delete(f"{aside}/{name}/{part}")
        elif part.endswith(".txt"):
            tables.rename(f"{aside}/{name}/{part}", f"{aside}/{name}/{part[:-4]}.csv")
    tables.commit(aside, [(f"{aside}/{name}", path.rstrip("/"))])


def write_r_csv_file(df: DataFrame, path: str, name: str) -> None:
    """One CSV file ``name`` in the folder ``path``: the rows are written as
    parts in parallel beside it and joined, in order, by the cluster's file
    system in the driver's JVM with a fixed buffer.  Needs a JVM gateway."""
    spark = df.sparkSession
    parts = track(scratch_path(spark, "export-parts"))
    _r_lines(df).write.text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    source, target = hadoop(parts), hadoop(path)
    fs_in, fs_out = source.getFileSystem(conf), target.getFileSystem(conf)
    fs_out.delete(target, True)
    out = fs_out.create(hadoop(target, name))
    try:
        out.write(bytearray((_r_header(df) + "\n").encode()))
        for f in sorted(str(s.getPath()) for s in fs_in.listStatus(source) if s.getPath().getName().startswith("part-")):
            part = fs_in.open(hadoop(f))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 65536, False)
            finally:
                part.close()
    finally:
        out.close()


def col(name: str) -> F.Column:
    """A column whose R name may contain dots."""
    return F.col(f"`{name}`")
