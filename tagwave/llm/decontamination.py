"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is short and a document may be long, so what counts is containment:
the share of the item's distinct word shingles that the document holds.

* Items are partitioned by size, in powers of two.  In a partition an item may
  miss at most m = floor((1 - threshold) * largest size) shingles, so its m + 1
  smallest hashes -- its MinHash sketch -- cannot all be missing: a document
  that contains the item shares at least one of them.  Larger items need larger
  sketches; the partition sets the size.
* Documents are probed shingle by shingle against the sketches (broadcast when
  small by bytes, else a sort-merge join with hot hashes salted), which gives
  candidate pairs.
* Candidates alone are read again and confirmed on the shingles' words.

Only DataFrame functions are used.  A passage that very many documents share
stays one row per document and item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave.llm.common import keep_rows, text_key
from tagwave.operators.joins import join_dimension
from tagwave.operators.stage import stage

SHINGLE = 5
PERCENT = 80


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _windows(w: str, size: int, of) -> Column:
    """``of`` the words of each window of ``size`` words; none in shorter texts."""
    last = F.size(w) - size
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: of(*[F.get(F.col(w), i + k) for k in range(size)]))).otherwise(F.array())


def _shingles(df: DataFrame, text: str, size: int, out: str) -> DataFrame:
    """Distinct shingles as text."""
    return (df.withColumn("__w", words(F.col(text)))
            .withColumn(out, F.array_distinct(_windows("__w", size, lambda *ws: F.concat_ws(" ", *ws))))
            .drop("__w"))


def unsearched_items(items: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``item_id, n_words`` of the benchmark items that no search covers: those
    of fewer words than a shingle, null texts included.  Repeated rows give a
    row each."""
    return (items.select("item_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
            .where(F.col("n_words") < shingle))


def item_sketches(items: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``item, item_id, shingles, n, size_class, sketch`` of every benchmark
    item with at least one shingle."""
    sized = (_shingles(items.select("item_id", "text"), "text", shingle, "shingles").drop("text").distinct()
             .withColumn("n", F.size("shingles")).where("n > 0")
             .withColumn("size_class", F.floor(F.log2("n")).cast("int")))
    largest = F.pow(F.lit(2), F.col("size_class") + 1) - 1
    sketch_size = F.floor(largest * (100 - percent) / 100) + 1
    hashes = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s)))
    return stage(sized.withColumn("sketch", F.slice(hashes, F.lit(1), F.least(sketch_size, F.col("n")).cast("int")))
                 .withColumn("item", F.monotonically_increasing_id()), "items")


def matches(docs: DataFrame, items: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, text_key, item_id, n_item, n_shared``: confirmed pairs."""
    docs = docs.select("doc_id", "text")
    known = item_sketches(items, shingle, percent)
    sketches = known.select("item", F.explode("sketch").alias("hash"))
    probes = (docs.where("text is not null").select("doc_id", text_key().alias("text_key"), words(F.col("text")).alias("w"))
              .select("doc_id", "text_key",
                      F.explode(_windows("w", shingle, lambda *ws: F.xxhash64(F.concat_ws(" ", *ws)))).alias("hash")))
    pairs = stage(join_dimension(probes, sketches, ["hash"], "inner")
                  .select("doc_id", "text_key", "item").distinct(), "candidates")
    texts = stage(join_dimension(docs.select("doc_id", text_key().alias("text_key"), "text"),
                                 pairs.select("doc_id", "text_key").distinct(),
                                 ["doc_id", "text_key"], "inner", null_safe=True)
                  .dropDuplicates(["doc_id", "text_key"]), "candidate-texts")
    whole = _shingles(texts, "text", shingle, "doc_shingles").drop("text")
    both = join_dimension(pairs, known.select("item", "item_id", "shingles"), ["item"], "inner")
    null_safe = whole.alias("d").join(both.alias("p"), (F.col("d.text_key") == F.col("p.text_key"))
                                      & F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")))
    shared = null_safe.select("d.doc_id", "d.text_key", "p.item_id", F.size("p.shingles").cast("long").alias("n_item"),
                              F.size(F.array_intersect("p.shingles", "d.doc_shingles")).cast("long").alias("n_shared"))
    return shared.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment``: a row for each
    document and benchmark item of which it holds ``percent`` of the distinct
    ``shingle``-word shingles or more.

    Words are lower-cased runs of letters and digits.  An item or document of
    fewer words than a shingle, or null, matches nothing; ``unsearched_items``
    lists such items.  Rows that repeat
    give one row; under a repeated id the largest overlap counts; null ids are
    kept as such.  Empty tables give no rows; other columns are ignored.
    """
    return (matches(docs, items, shingle, percent).groupBy("doc_id", "item_id")
            .agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_item", "n_shared"))
                 .alias("best"))
            .select("doc_id", "item_id", "best.n_item", "best.n_shared", "best.containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item."""
    found = matches(docs, items, shingle, percent).select("doc_id", "text_key").distinct()
    return keep_rows(docs, found.withColumn("kept", F.lit(False)))


#: The result as DuckDB SQL (one text per id).
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM d WHERE len(w) >= 5),
b AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
bs AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM b WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_item) AS n_item, count(*) AS n_shared,
       count(*)::DOUBLE / any_value(n_item) AS containment
FROM ds JOIN bs USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id
HAVING count(*) * 100 >= any_value(n_item) * 80
"""
