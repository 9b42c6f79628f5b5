"""Exact duplicates through an extendible-hash index on shared files.

1. One scan gives every row a 64-bit key of its normalised text, the text's
   SHA-256 and its length; these narrow rows are staged.
2. The directory begins with as many leading bits of the key as an even spread
   needs.  Buckets that are overfull are split by one more bit -- the directory
   doubles, and only their keys are counted again -- until all fit; a bucket of
   one key cannot be split and stays a chained, overfull one.
3. Buckets stand in key order and are dealt, a key range each, to owner tasks
   of about equal row counts.  Rows go to their owner in one shuffle by its
   number; the owner sorts its range, so equal keys follow each other, chains
   the texts under one key by SHA-256, counts each chain and finds the row that
   stays.  The rows with these results are the index file of that owner.
4. A hot key's chain goes to several owners; their partial results (a row per
   owner and chain) are merged.
5. Chains of more than one row have their bytes compared: the texts of repeated
   keys (and only those) are grouped by their bytes, equal copies collapsing
   inside each map task.

Only DataFrame functions are used.  Nothing but staged files in the shared
folder carries state, so lost executors cost recomputed tasks only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagwave.llm.common import keep_rows, lower_ascii, text_key
from tagwave.operators.joins import join_dimension
from tagwave.operators.sequence import range_count
from tagwave.operators.stage import stage, stage_measured

#: Rows that a bucket holds before it is split.
BUCKET_ROWS = 250_000
#: Doublings beyond an even spread after which a bucket is left as it is.
MAX_DOUBLINGS = 16


def normalised(text: Column) -> Column:
    """What two texts must have in common: the bytes after lower-casing A-Z."""
    return lower_ascii(F.coalesce(text, F.lit("")))


def _key(norm: Column, bits: int) -> Column:
    return F.xxhash64(norm) if bits == 64 else F.shiftleft(F.xxhash64(norm), 64 - bits)


def _leading(depth: int) -> Column:
    """The slot of a key: its ``depth`` leading bits."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def _buckets(narrow: DataFrame, rows: int, capacity: int) -> tuple[DataFrame, int]:
    """``slot, depth, n``: the buckets (a slot is a key's ``depth`` leading
    bits) after all splits, and the greatest depth."""
    even = (max(1, -(-rows // max(1, capacity))) - 1).bit_length()
    keys, depth, done = narrow.select("key"), even, []
    while True:
        counts = stage(keys.groupBy(_leading(depth).alias("slot")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")), "dedup-slots")
        splits = (F.col("n") > capacity) & (F.col("low") != F.col("high"))
        overfull = counts.where(splits) if depth < min(64, even + MAX_DOUBLINGS) else counts.limit(0)
        last = overfull.isEmpty()
        done.append((counts if last else counts.where(~splits)).select("slot", F.lit(depth).alias("depth"), "n"))
        if last:
            break
        keys = join_dimension(keys.withColumn("slot", _leading(depth)), overfull.select("slot"), ["slot"],
                              "left_semi").select("key")
        depth += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, depth


def _directory(narrow: DataFrame, rows: int, capacity: int, owners: int) -> tuple[DataFrame, int]:
    """``__slot, bucket, owner, parts``: for each slot of the full directory the
    first key of its bucket, the first owner of that bucket and how many owners
    share it (1 but for chains beyond an owner's share); and the full depth."""
    buckets, depth = _buckets(narrow, rows, capacity)
    share = max(1, -(-rows // owners))
    # buckets are rows / capacity and a few: a small table, in order of the keys
    slots = F.lit(1).cast("long") * F.expr(f"shiftleft(1L, {depth} - depth)")
    ordered = buckets.withColumn("first", F.col("slot") * slots)
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    dealt = (ordered.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .withColumn("owner", F.floor(F.col("before") / F.lit(share)).cast("int"))
             .withColumn("end", F.floor((F.col("before") + F.col("n") - 1) / F.lit(share)).cast("int"))
             .withColumn("parts", F.when(F.col("n") > F.greatest(F.lit(share), F.lit(capacity)),
                                         F.col("end") - F.col("owner") + 1).otherwise(F.lit(1))))
    of_slot = F.explode(F.sequence(F.col("first"), F.col("first") + slots - 1)).alias("__slot")
    bucket = (F.shiftleft("first", 64 - depth) if depth else F.lit(0).cast("long")).alias("bucket")
    return dealt.select(of_slot, bucket, "owner", "parts"), depth


def dedup_index(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, key_bits: int = 64,
                id_col: str = "doc_id", text_col: str = "text", owners: int | None = None) -> DataFrame:
    """The staged index, one row per document: ``doc_id, rid, key, text_sha256,
    n_bytes, text_key, bucket, owner, parts`` and, as its owner found them in the
    row's chain, ``chained`` (rows) and ``keep`` (id and row that stays).

    ``key_bits`` below 64 weakens the key, to make keys collide in tests.
    """
    norm = normalised(F.col(text_col))
    narrow, rows, _ = stage_measured(
        docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                    _key(norm, key_bits).alias("key"), F.sha2(norm, 256).alias("text_sha256"),
                    F.octet_length(norm).cast("long").alias("n_bytes"),
                    text_key(text_col).alias("text_key")), "dedup-rows")
    owners = owners or range_count(narrow)
    directory, depth = _directory(narrow, rows, bucket_rows, owners)
    slotted = narrow.withColumn("__slot", _leading(depth))
    indexed = join_dimension(slotted, directory, ["__slot"], "inner").drop("__slot")
    # the owners of a shared bucket take its rows in turn
    owner = F.col("owner") + F.pmod(F.col("rid"), F.col("parts")).cast("int")
    owned = indexed.withColumn("owner", owner).repartitionById(owners, F.col("owner"))
    chain = Window.partitionBy("owner", "key", "text_sha256")
    return stage(owned.withColumns({"chained": F.count(F.lit(1)).over(chain),
                                    "keep": F.max(F.struct("doc_id", "rid")).over(chain)}), "dedup-index")


def compare_bytes(docs: DataFrame, groups: DataFrame, key_bits: int = 64, text_col: str = "text") -> DataFrame:
    """``key, text_sha256, texts``: how many different texts (by their bytes)
    stand under each (key, SHA-256) of ``groups``, whose copies are counted
    together; ``texts`` must be 1."""
    norm = normalised(F.col(text_col))
    texts = docs.select(norm.alias("norm"), _key(norm, key_bits).alias("key"))
    repeated = join_dimension(texts, groups.select("key").distinct(), ["key"], "inner")
    distinct = repeated.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("copies"))
    return (distinct.groupBy("key", F.sha2("norm", 256).alias("text_sha256"))
            .agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("copies")))


def exact_dedup(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, key_bits: int = 64,
                id_col: str = "doc_id", text_col: str = "text", with_key: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs``
    (and ``text_key``, for ``common.keep_rows``).

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  The row with the largest ``doc_id`` stays (null ids lose; of
    rows that repeat an id, one stays).  An empty table gives no rows, other
    columns are ignored.  Two texts of one SHA-256 with different bytes would
    raise an error.
    """
    index = dedup_index(docs, bucket_rows, key_bits, id_col, text_col)
    ends = index.where(F.col("rid") == F.col("keep.rid"))  # a row per owner and chain
    shared = stage(ends.where("parts > 1").groupBy("key", "text_sha256").agg(
        F.sum("chained").alias("all_chained"), F.max("keep").alias("all_keep")), "dedup-chains")
    repeated = (ends.where("parts = 1 and chained > 1").select("key")
                .unionByName(shared.where("all_chained > 1").select("key")))
    compared = compare_bytes(docs, stage(repeated.distinct(), "dedup-keys"), key_bits, text_col).where("texts > 1")
    if not compared.isEmpty():
        raise ValueError("texts with different bytes share a SHA-256")
    joined = index if shared.isEmpty() else join_dimension(index, shared, ["key", "text_sha256"], "left")
    if "all_keep" in joined.columns:
        joined = joined.withColumns({"keep": F.coalesce("all_keep", "keep"),
                                     "chained": F.coalesce("all_chained", "chained")})
    return joined.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("chained").alias("group_size"),
        (F.col("rid") == F.col("keep.rid")).alias("kept"),
        "text_sha256", *(["text_key"] if with_key else []))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    return keep_rows(docs, exact_dedup(docs, with_key=True))


#: The result as DuckDB SQL.
ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""
