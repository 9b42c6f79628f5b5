"""Optional products, landed as a CSV file per tag (DIS-2, DIS-3, DIS-4).

They stand outside the load order: each is tried by itself, so a failure
concerns one tag and one product.  Headers are cleaned to snake case per file;
files whose header lacks a column the table needs fail their tag.  All files of
a product are read in one scan by position, and every distinct header tells
which position holds which column.  Packed files (``sources.landed``) are cut
into lines and fields in the tasks; lines with quotes, escapes or another number
of fields than the header go through Spark's CSV parser, one by one.
"""

from __future__ import annotations

import csv
import dataclasses
import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.functions.names import snake_names
from tagwave.functions.text import r_text
from tagwave.functions.timefmt import parse_r_time
from tagwave.operators.joins import dimension, join_dimension
from tagwave.operators.load import KeyedRows, load_product
from tagwave.operators.sequence import file_row_number
from tagwave.operators.stage import stage
from tagwave.operators.status import product_status
from tagwave.session import many_columns
from tagwave.sources.csv import r_make_name
from tagwave.sources.landed import packed_files, read_product

#: Distinct headers of a product's files; more is an error of the landing.
MAX_HEADERS = 64
#: Order of a tag's rows: file (one name for all that lie by themselves), then place.
ROW_ORDER = ["__file", "__pos"]
#: What gives a comma or a line another meaning; rows cut at a time.
_SPECIAL = (b'"', b"\\", b"\0")
_BATCH_ROWS = 10_000


def clean_header(line: str) -> list[str]:
    """Column names of a CSV header line."""
    return snake_names([r_make_name(h) for h in next(csv.reader([line]))])


def landed_names(product: S.Product) -> dict[str, str]:
    """Output column -> cleaned header of everything a file must hold."""
    back = {new: old for old, new in product.renames.items()}
    return {c: back.get(c, c) for c in product.columns if c not in ("id", "deploy_id", "deployid")}


@dataclass(frozen=True)
class ExtraFiles:
    """A product's files: ``headers`` (``deployid, header, fits``), a row per
    tag that landed one, and ``rows``, of the tags whose header fits."""

    headers: DataFrame
    rows: KeyedRows | None


def _value(c: Column, name: str) -> Column:
    kind = S.column_type(name)
    if kind == "timestamp_ntz":
        return parse_r_time(c, S.EXTRA_TIME_FORMAT)
    return r_text(c) if kind == "string" else r_text(c).try_cast(kind)


def _fields(batches: Iterator[pa.RecordBatch], widths: dict[int, int], at: dict[int, list[int]],
            names: list[str]) -> Iterator[pa.RecordBatch]:
    """Lines of packed files behind the header, by column (``at``: the columns'
    places under a header).  Lines without a quote or an escape and with a field
    for every name of the header are cut here; all others are handed on whole, as
    ``__line``."""
    schema = pa.schema([("deployid", pa.string()), ("__file", pa.string()), ("__pos", pa.int64()), ("__header", pa.int32()),
                        ("__line", pa.string()), *((c, pa.string()) for c in names)])

    def rows(of: list[tuple], header: int, lines: pa.Array | None, fields: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        tags, files, places = zip(*of)  # a file's tag and name, and the places of its lines
        n = [len(x) for x in places]
        which, total = pa.array(np.repeat(np.arange(len(of)), n)), sum(n)
        cols = [pa.array(tags, pa.string()).take(which), pa.array(files, pa.string()).take(which),
                pa.array(np.concatenate(places), pa.int64()), pa.repeat(pa.scalar(header, pa.int32()), total),
                pa.nulls(total, pa.string()) if lines is None else lines, *fields]
        cols += [pa.nulls(total, pa.string())] * (len(schema) - len(cols))
        yield from pa.Table.from_arrays(cols, schema=schema).combine_chunks().to_batches()

    def whole(of: list[tuple], header: int, lines: list[bytes]) -> Iterator[pa.RecordBatch]:
        yield from rows(of, header, pa.array([x.decode(errors="replace") for x in lines]), [])

    def cut(of: list[tuple], header: int, lines: list[bytes]) -> Iterator[pa.RecordBatch]:
        text, places = b"\n".join(lines) + b"\n", [str(i) for i in range(widths[header])]
        try:
            table = pacsv.read_csv(
                pa.BufferReader(text), pacsv.ReadOptions(use_threads=False, block_size=len(text) + 1, column_names=places),
                pacsv.ParseOptions(quote_char=False, double_quote=False, escape_char=False, ignore_empty_lines=False),
                pacsv.ConvertOptions(column_types=dict.fromkeys(places, pa.string()), strings_can_be_null=False))
        except pa.ArrowInvalid:  # no UTF-8
            yield from whole(of, header, lines)
        else:
            yield from rows(of, header, None, [table.column(i) for i in at[header]])

    held: dict[tuple, tuple[list, list]] = {}  # (how, header) -> files and lines
    for batch in batches:
        for i in range(batch.num_rows):  # a file at a time
            tag, name, content, header = (batch.column(c)[i].as_py() for c in range(4))
            lines = re.split(rb"\r\n|\r|\n", content) if b"\r" in content else content.split(b"\n")
            special, commas = any(x in content for x in _SPECIAL), widths[header] - 1
            parts: dict = {cut: ([], []), whole: ([], [])}
            for place, line in enumerate(lines[1:], 1):
                if line.strip(b" "):
                    plain = line.count(b",") == commas and not (special and any(x in line for x in _SPECIAL))
                    places, kept = parts[cut if plain else whole]
                    places.append(place)
                    kept.append(line)
            for how, (places, kept) in parts.items():
                if kept:
                    files, found = held.setdefault((how, header), ([], []))
                    files.append((tag, name, places))
                    found += kept
                    if len(found) >= _BATCH_ROWS:
                        yield from how(files, header, found)
                        del held[how, header]
    for (how, header), (files, found) in held.items():
        yield from how(files, header, found)


def _first_lines(lines: DataFrame) -> DataFrame:
    """``deployid, header`` of each file that lies by itself."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return (lines.select("deployid", "value", F.col("_metadata.file_path").alias("f"), place.alias("p"))
            .groupBy("deployid", "f").agg(F.min_by("value", "p").alias("header")).drop("f"))


def read_extra(spark: SparkSession, root: str, product: S.Product) -> ExtraFiles:
    """The files ``<root>/<product>/deployid=<tag>/*.csv`` of every tag, and
    the packed ones, with the table's columns and ``ROW_ORDER``."""
    empty = spark.createDataFrame([], "deployid string, header string, fits boolean")
    lines, packed = read_product(spark, root, product.name, "value string", fmt="text"), packed_files(spark, root, product.name)
    first = [_first_lines(lines)] if lines is not None else []
    if packed is not None:
        packed = packed.where("content is not null")
        line = F.substring_index(F.substring_index(F.col("content").cast("string"), "\n", 1), "\r", 1)
        # Split once more for its decoding: bytes that are no text are replaced.
        first.append(packed.select("deployid", F.split(line, "\n")[0].alias("header")))
    if not first:
        return ExtraFiles(empty, None)
    # The first line of each file; tags with files of different headers fail.
    per_tag = stage(functools.reduce(DataFrame.unionByName, first).groupBy("deployid").agg(
        F.min("header").alias("header"), F.max("header").alias("other")), "headers")
    found = [r.header for r in per_tag.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers among the files of {product.name}")
    names = landed_names(product)
    good = {h: at for h in found if set(names.values()) <= set(at := clean_header(h))}
    headers = per_tag.select("deployid", "header", (F.col("header").isin(*good) & (F.col("header") == F.col("other")))
                             .alias("fits")) if good else per_tag.select("deployid", "header", F.lit(False).alias("fits"))
    if not good:
        return ExtraFiles(headers, None)
    width = max(len(next(csv.reader([h]))) for h in found)
    by_place = ", ".join(f"c{i} string" for i in range(width))
    # A tag's header goes to its rows as a number: the texts are long.
    number = {h: i for i, h in enumerate(good)}
    which = F.lit(None).cast("int")
    for h, i in number.items():
        which = F.when(F.col("header") == h, i).otherwise(which)
    fitting = dimension(headers.where("fits").select("deployid", which.alias("__header")))

    def by_header(cell: Callable[[str], Column], name: str) -> Column:
        out = F.lit(None).cast("string")
        for h, at in good.items():
            out = F.when(F.col("__header") == number[h], cell(f"c{at.index(names[name])}")).otherwise(out)
        return out

    rows = []
    if lines is not None:
        raw = file_row_number(read_product(spark, root, product.name, by_place, fmt="csv"), "__pos")
        raw = join_dimension(raw.withColumn("__file", F.lit("")), fitting, ["deployid"], "inner")
        rows.append(raw.select("deployid", *ROW_ORDER, *[by_header(F.col, c).alias(c) for c in names]))
    if packed is not None:
        files = join_dimension(packed, fitting, ["deployid"], "inner").select("deployid", "name", "content", "__header")
        cut = files.mapInArrow(
            functools.partial(_fields, widths={i: len(good[h]) for h, i in number.items()}, names=list(names),
                              at={i: [good[h].index(name) for name in names.values()] for h, i in number.items()}),
            "deployid string, __file string, __pos long, __header int, __line string, " + ", ".join(f"`{c}` string" for c in names))
        cut = cut.withColumn("__parsed", F.when(F.col("__line").isNotNull(), F.from_csv("__line", by_place)))
        text = {c: F.when(F.col("__line").isNull(), F.col(c)).otherwise(by_header(F.col("__parsed").__getitem__, c)) for c in names}
        rows.append(cut.select("deployid", *ROW_ORDER, *[t.alias(c) for c, t in text.items()]))
    joined = functools.reduce(DataFrame.unionByName, rows)

    # Parsed once: the numbering reads their keys by themselves.
    with many_columns(spark):
        rows = stage(joined.select("deployid", *ROW_ORDER, *[_value(F.col(c), c).alias(c) for c in names]), "extra-rows")
    return ExtraFiles(headers, KeyedRows(rows, rows.select("deployid", *ROW_ORDER)))


def load_extra(files: ExtraFiles, tags: DataFrame, product: S.Product) -> DataFrame:
    """The product's table: ids as the load loop gives them, rows in file order."""
    if files.rows is None:
        spark = tags.sparkSession
        return spark.createDataFrame([], ", ".join(f"`{c}` {S.column_type(c)}" for c in product.columns))
    # The rows carry the table's names already.
    return load_product(files.rows, tags, dataclasses.replace(product, renames={}), ROW_ORDER)


def extra_status(files: ExtraFiles, tags: DataFrame, loaded: DataFrame, product: S.Product) -> DataFrame:
    """``data_type, deployid, status`` (DIS-8): imported, no file, or failed."""
    missing = tags.select("deployid").join(files.headers.select("deployid"), "deployid", "left_anti")
    return product_status(tags, loaded, missing, product.name, product.missing_text)
