"""Landed tag products.

Upstream, each tag's products are fetched one tag at a time from a web portal
as a named list of data frames.  Here the products are landed as parquet
files, one folder per product and ``deployid=<tag>`` sub-folders, so a single
scan per product covers every tag.

A file per tag and product soon means hundreds of thousands of small files,
whose creation, listing and opening take longer than their rows.  Such files
can be landed packed instead (``land_files``): whole, byte by byte, many of
them as the rows of one table under ``<root>/packed/product=<product>``.  A
packed file is judged and read like one that lies by itself.

What landed is judged before it is read: Spark lists the files, and tasks
read their footers (columns, types, rows), so a tag whose file lacks a
column, holds another type, or cannot be read at all is an error of that tag
alone (``landed_products``).  The scans themselves use the declared schema of
the product, so column types never depend on what landed.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagwave import schemas as S

_INFER = "spark.sql.sources.partitionColumnTypeInference.enabled"
#: File systems whose files a Python task opens itself, to read a footer's bytes
#: only.  Elsewhere the files come through Spark's reader, whole.
DIRECT_SCHEMES = ("file", "s3", "gs")
#: Tags of one product that may hold files no scan can read (left out by name).
MAX_UNREADABLE = 10_000

#: Folder of the packed files, their columns, and how many go into one file of
#: the pack: what a task holds at a time stays small.
PACKED = "packed"
PACK_SCHEMA = "deployid string, name string, content binary"
FILES_PER_PACK = 512
#: Rows of a packed file; a tag with more lands several.
MAX_FILE_ROWS = 100_000
#: Bytes of files a task hands back at a time when it packs them.
_PACK_BYTES = 4 << 20
_PACK_ARROW = pa.schema([("deployid", pa.string()), ("name", pa.string()), ("content", pa.binary())])
#: Rows a task hands back at a time when it reads packed files.
_BATCH_ROWS = 10_000
#: What a folder ``deployid=`` is called for a null.
NO_TAG = "__HIVE_DEFAULT_PARTITION__"

_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "timestamp_ntz": pa.timestamp("us")}

# Landed types that Spark's parquet reader turns into a declared type.
FITS = {
    "string": {"string", "large_string"},
    "long": {"int8", "int16", "int32", "int64"},
    "double": {"float", "double", "int8", "int16", "int32"},
    "timestamp_ntz": {"timestamp"},
}

PRESENT, ERROR, ABSENT = "present", "error", "absent"


def read_product(spark: SparkSession, root: str, product: str,
                 schema: StructType | str | None = None, fmt: str = "parquet",
                 without: list[str] | None = None) -> DataFrame | None:
    """All tags' rows of one product: ``<root>/<product>/deployid=*/``, with
    ``deployid`` kept as text (``007`` stays ``007``).  ``None`` when no tag
    landed the product at all.  ``schema``: the declared columns (a column a
    file lacks is null); without it the columns are those of some file.  Tags
    named in ``without`` are left out before any of their files is opened."""
    base = f"{root.rstrip('/')}/{product}"
    reader = spark.read.format(fmt).option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    before = spark.conf.get(_INFER, "true")
    spark.conf.set(_INFER, "false")  # partition values resolve when the DataFrame is created
    try:
        df = reader.load(f"{base}/deployid=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    finally:
        spark.conf.set(_INFER, before)
    return df.where(~F.col("deployid").isin(without)) if without else df


def write_product(df: DataFrame, root: str, product: str, mode: str = "overwrite") -> None:
    """Land one product for many tags at once, partitioned by ``deployid``."""
    df.write.mode(mode).partitionBy("deployid").parquet(f"{root.rstrip('/')}/{product}")


def parquet_file(table: pa.Table, **options) -> bytes:
    """The bytes of a parquet file."""
    out = io.BytesIO()
    pq.write_table(table, out, **options)
    return out.getvalue()


def empty_parquet_file(types: dict[str, str]) -> bytes:
    """The bytes of a parquet file without rows."""
    return parquet_file(pa.schema([(c, _ARROW[t]) for c, t in types.items()]).empty_table())


def csv_file(header: str, table: pa.Table) -> bytes:
    """The bytes of a CSV file, from its header and a column of lines."""
    return "".join(f"{line}\n" for line in [header, *table.column(0).to_pylist()]).encode()


def _pack(batches: Iterator[pa.RecordBatch], encode: Callable[[pa.Table], bytes],
          suffix: str) -> Iterator[pa.RecordBatch]:
    """A file per run of equal tags (the first column); another one begins
    after ``MAX_FILE_ROWS`` rows."""
    tag, part, held, rows = None, 0, [], 0
    files, size = [], 0

    def file() -> dict:
        content = encode(pa.Table.from_batches(held).drop_columns(["deployid"]))
        return {"deployid": tag, "name": f"part-{part:05d}.{suffix}", "content": content}

    for batch in batches:
        tags = batch.column(0).to_numpy(zero_copy_only=False)
        begins = [0, *(np.flatnonzero(tags[1:] != tags[:-1]) + 1).tolist(), len(tags)]
        for at, end in zip(begins, begins[1:]):
            while at < end:
                if held and (tags[at] != tag or rows == MAX_FILE_ROWS):
                    files.append(file())
                    size += len(files[-1]["content"])
                    part, held, rows = (part + 1 if tags[at] == tag else 0), [], 0
                if size >= _PACK_BYTES:
                    yield pa.RecordBatch.from_pylist(files, _PACK_ARROW)
                    files, size = [], 0
                tag = tags[at]
                n = min(end - at, MAX_FILE_ROWS - rows)
                held.append(batch.slice(at, n))
                at, rows = at + n, rows + n
    if held:
        files.append(file())
    if files:
        yield pa.RecordBatch.from_pylist(files, _PACK_ARROW)


def land_files(files: DataFrame, root: str, product: str) -> None:
    """Land files (``deployid, name, content``) of one product, packed."""
    (files.select("deployid", "name", "content").write.mode("append").option("maxRecordsPerFile", FILES_PER_PACK)
     .parquet(f"{root.rstrip('/')}/{PACKED}/product={product}"))


def land_rows(rows: DataFrame, order: list[str], columns: list[Column], root: str, product: str,
              encode: Callable[[pa.Table], bytes] = parquet_file, suffix: str = "parquet") -> None:
    """Land ``columns`` of the rows as a packed file per tag, in ``order``."""
    rows = rows.withColumn("deployid", F.coalesce("deployid", F.lit(NO_TAG)))
    # A given number: merging small partitions would leave cores idle.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = rows.repartition(parts, "deployid").sortWithinPartitions("deployid", *order).select("deployid", *columns)
    land_files(rows.mapInArrow(functools.partial(_pack, encode=encode, suffix=suffix), PACK_SCHEMA), root, product)


def packed_files(spark: SparkSession, root: str, product: str | None = None) -> DataFrame | None:
    """``product, deployid, name, content`` of the packed files (of a product);
    ``None`` when there are none."""
    base = f"{root.rstrip('/')}/{PACKED}"
    reader = spark.read.schema(f"{PACK_SCHEMA}, product string").option("basePath", base)
    try:
        files = reader.parquet(f"{base}/product={product}" if product else base)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return files.select("product", "deployid", "name", "content")


def _rows_of(file: pq.ParquetFile, wanted: list[str]) -> Iterator[pa.Table]:
    """A file's rows, ``_BATCH_ROWS`` at a time."""
    if not wanted:  # none of the columns: rows all the same
        for at in range(0, file.metadata.num_rows, _BATCH_ROWS):
            yield pa.table({"": pa.nulls(min(_BATCH_ROWS, file.metadata.num_rows - at))})
    elif file.metadata.num_rows <= _BATCH_ROWS:  # much faster than in batches
        yield file.read(columns=wanted, use_threads=False)
    else:
        yield from (pa.Table.from_batches([b]) for b in file.iter_batches(_BATCH_ROWS, columns=wanted, use_threads=False))


def _unpack(batches: Iterator[pa.RecordBatch], types: dict[str, str], order: bool) -> Iterator[pa.RecordBatch]:
    """Rows of packed parquet files with the declared columns (a column a file
    lacks is null) and, if asked for, their file and place in it."""
    schema = pa.schema([("deployid", pa.string()), *((c, _ARROW[t]) for c, t in types.items()),
                        *([("__file", pa.string()), ("__row", pa.int64())] if order else [])])
    held, rows = [], 0  # rows of files with the same columns, with their tag, file and first place

    def together() -> Iterator[pa.RecordBatch]:
        tags, names, places, tables = zip(*held)
        sizes = [t.num_rows for t in tables]
        table = pa.concat_tables(tables).combine_chunks()
        of = np.repeat(np.arange(len(held)), sizes)
        at = {c.lower(): i for i, c in enumerate(table.column_names)}
        cols = [pa.array(tags, pa.string()).take(pa.array(of))]
        for c, t in types.items():
            if c.lower() not in at:
                cols.append(pa.nulls(len(of), _ARROW[t]))
            else:
                col = table.column(at[c.lower()])
                cols.append(col if col.type == _ARROW[t] else col.cast(_ARROW[t]))
        if order:
            files = [f"deployid={t}/{n}" for t, n in zip(tags, names)]
            begins = np.cumsum([0, *sizes[:-1]])
            cols += [pa.array(files, pa.string()).take(pa.array(of)),
                     pa.array(np.arange(len(of)) - begins[of] + np.array(places, np.int64)[of])]
        return iter(pa.Table.from_arrays(cols, schema=schema).combine_chunks().to_batches())

    for batch in batches:
        for i in range(batch.num_rows):  # a file at a time
            tag, name, at = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), 0
            file = pq.ParquetFile(pa.BufferReader(batch.column(2)[i].as_buffer()))
            names = {c.lower(): c for c in file.schema_arrow.names}
            for part in _rows_of(file, [names[c.lower()] for c in types if c.lower() in names]):
                part = part.replace_schema_metadata()
                if held and (rows >= _BATCH_ROWS or part.schema != held[0][3].schema):
                    yield from together()
                    held, rows = [], 0
                held.append((tag, name, at, part))
                at, rows = at + part.num_rows, rows + part.num_rows
    if held:
        yield from together()


def read_packed(spark: SparkSession, root: str, product: str, types: dict[str, str], landed: DataFrame,
                order: bool = False) -> DataFrame | None:
    """All tags' rows of one product from its packed files, like ``read_product``;
    tags whose files cannot be scanned (by ``landed_products``) are left out
    before any of them is opened.  ``order``: with ``sequence.FILE_ORDER``."""
    files = packed_files(spark, root, product)
    if files is None:
        return None
    cannot = landed.where((F.col("product") == product) & ~F.col("scannable")).select("deployid")
    files = files.join(cannot, "deployid", "left_anti").select("deployid", "name", "content")
    schema = declared_schema({"deployid": "string", **types, **({"__file": "string", "__row": "long"} if order else {})})
    return files.mapInArrow(functools.partial(_unpack, types=types, order=order), schema)


def declared_schema(types: dict[str, str]) -> str:
    """DDL of a product's declared columns."""
    return ", ".join(f"`{c}` {t}" for c, t in types.items())


def landed_files(spark: SparkSession, root: str, content: bool = False) -> DataFrame | None:
    """``product, deployid, path`` (and ``content``) of every parquet file under
    ``root``, from a listing; ``None`` when there is no such folder."""
    reader = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet"))
    try:
        files = reader.load(root.rstrip("/"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    at = r"/([^/]+)/deployid=([^/]*)/[^/]+$"
    # Folder names escape special characters as %XX; a plus sign is itself.
    escaped = F.replace(F.regexp_extract("path", at, 2), F.lit("+"), F.lit("%2B"))
    files = files.select(F.regexp_extract("path", at, 1).alias("product"), F.coalesce(F.try_url_decode(escaped), F.regexp_extract("path", at, 2)).alias("deployid"),
                         "path", *(["content"] if content else []))
    return files.where("product <> ''")


def _open(path: str) -> pa.NativeFile:
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    fs, inside = pafs.FileSystem.from_uri(path.replace("s3a:", "s3:").replace("s3n:", "s3:"))
    return fs.open_input_file(inside)


def _type_name(t: pa.DataType) -> str:
    return "timestamp" if pa.types.is_timestamp(t) else str(t)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.map_(pa.string(), pa.string())
    for batch in batches:
        direct = "content" not in batch.schema.names
        counts, found = [], []
        for i in range(batch.num_rows):  # a file at a time: contents may be large
            rows, columns = None, None
            try:
                with _open(batch.column(2)[i].as_py()) if direct else pa.BufferReader(batch.column(3)[i].as_buffer()) as f:
                    meta = pq.read_metadata(f)
                    rows = meta.num_rows
                    columns = [(c.name.lower(), _type_name(c.type)) for c in meta.schema.to_arrow_schema()]
            except (pa.ArrowException, OSError):
                pass  # no parquet file: no columns
            counts.append(rows)
            found.append(columns)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(found, kind)],
                                         ["product", "deployid", "rows", "columns"])


def landed_footers(spark: SparkSession, root: str) -> DataFrame:
    """``product, deployid, rows, columns`` of every landed file, packed or by
    itself, ``columns`` mapping lower-case names to types; both null for a file that is no
    readable parquet."""
    schema = "product string, deployid string, rows long, columns map<string, string>"
    parts = []
    listed = landed_files(spark, root)
    one = listed.select("path").first() if listed is not None else None
    if one:
        scheme = one.path.split(":", 1)[0].replace("s3a", "s3").replace("s3n", "s3")
        parts.append(listed if scheme in DIRECT_SCHEMES else landed_files(spark, root, content=True))
    packed = packed_files(spark, root)
    if packed is not None:
        parts.append(packed)
    footers = [files.mapInArrow(_footers, schema) for files in parts]
    return functools.reduce(DataFrame.unionByName, footers) if footers else spark.createDataFrame([], schema)


def _reason(types: dict[str, str]) -> Column:
    """Why a file cannot be a product's: the first column it lacks or whose
    type does not fit, else null."""
    reasons = []
    for name, kind in types.items():
        landed = F.col("columns")[name.lower()]
        reasons.append(F.when(landed.isNull(), F.lit(f"lacks {name}"))
                       .when(~landed.isin(*FITS[kind]), F.concat(F.lit(f"{name} is "), landed)))
    first = F.get(F.array_compact(F.array(*reasons)), F.lit(0))
    return F.when(F.col("columns").isNull(), F.lit("unreadable")).otherwise(first)


def landed_products(footers: DataFrame, declared: dict[str, dict[str, str]]) -> DataFrame:
    """``product, deployid, rows, state, reason, scannable`` per tag and landed
    product, of the products in ``declared`` (landed column -> declared type).

    ``state`` is ``present``, or ``error`` when some file of the tag does not
    fit the declared columns (``reason``); such a file is ``scannable`` when only
    columns are missing.  ``rows`` counts rows by the footers: 0 for a file
    without rows, which is present all the same.
    """
    reason = F.lit(None).cast("string")
    for product, types in declared.items():
        reason = F.when(F.col("product") == product, _reason(types)).otherwise(reason)
    files = footers.where(F.col("product").isin(*declared)).withColumn("reason", reason)
    cannot = F.col("reason").isNotNull() & ~F.col("reason").startswith("lacks ")
    return (files.groupBy("product", "deployid")
            .agg(F.sum("rows").alias("rows"), F.min("reason").alias("reason"),
                 (~F.bool_or(cannot)).alias("scannable"))
            .select("product", "deployid", F.coalesce("rows", F.lit(0)).alias("rows"),
                    F.when(F.col("reason").isNull(), PRESENT).otherwise(ERROR).alias("state"), "reason", "scannable"))


def unreadable_tags(landed: DataFrame, product: str) -> list[str]:
    """Tags whose files of ``product`` would fail a scan; a landing with more
    than ``MAX_UNREADABLE`` of them is an error of its own."""
    rows = (landed.where((F.col("product") == product) & ~F.col("scannable")).select("deployid")
            .limit(MAX_UNREADABLE + 1).collect())
    if len(rows) > MAX_UNREADABLE:
        raise ValueError(f"more than {MAX_UNREADABLE} tags landed unreadable files of {product}")
    return [r.deployid for r in rows]


def load_positions(landed: DataFrame) -> DataFrame:
    """``deployid, pos, source, state, rows`` per tag and position of the load
    order (FLOW-1, FLOW-2): a position's landed product, for locations the more
    preferred source that landed at all -- by presence, so an empty
    ``all_locations`` hides filled ``locations``."""
    sources = [(name, S.PRODUCTS[p].pos, 1) for p, name in S.LANDED_NAMES.items()]
    sources += [(name, S.LOCS.pos, pref) for pref, name in enumerate(S.LOCATION_SOURCES, 1)]
    spark = landed.sparkSession
    order = F.broadcast(spark.createDataFrame(sources, "product string, pos long, pref int"))
    best = F.min_by(F.struct("product", "state", "rows"), "pref").alias("b")
    return (landed.join(order, "product").groupBy("deployid", "pos").agg(best)
            .select("deployid", "pos", F.col("b.product").alias("source"), F.col("b.state").alias("state"),
                    F.col("b.rows").alias("rows")))
