"""Exact dedup against a dictionary, with colliding keys and split buckets."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tagwave.llm import exact_dedup as ED


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[lower(t)]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("key_bits,bucket_rows", [(64, 250_000), (64, 5), (3, 5), (1, 1000)])
def test_equal_to_brute_force(make_docs, odd_rows, key_bits, bucket_rows):
    rows = odd_rows + [(100 + k, f"Text {k % 17}") for k in range(120)] + [(300, "Ä"), (301, "ä")]
    got = ED.exact_dedup(make_docs(rows), bucket_rows, key_bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({lower(t) for _, t in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_directory_splits_overfull_buckets(make_docs):
    docs = make_docs([(k, f"text {k}") for k in range(400)] + [(1000 + k, "hot") for k in range(200)])
    index = ED.dedup_index(docs, bucket_rows=50)
    sizes = index.groupBy("bucket").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys")).collect()
    assert len(sizes) > 8 and sum(r.n for r in sizes) == 600
    assert all(r.n <= 50 for r in sizes if r.n < 200)  # all but the bucket of the hot key
    # a bucket is a range of keys: ranges do not overlap (keys as unsigned)
    spans = sorted((min(k), max(k)) for k in [
        [r.key % 2**64 for r in index.where(F.col("bucket") == b.bucket).select("key").collect()] for b in sizes])
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_owners_hold_key_ranges_and_share_hot_chains(make_docs):
    """Fails where the directory is replaced by one bucket, or rows by hash."""
    docs = make_docs([(k, f"text {k}") for k in range(600)] + [(1000 + k, "hot") for k in range(400)])
    index = ED.dedup_index(docs, bucket_rows=20, owners=10)
    hot = index.where("parts > 1")
    assert hot.select("key").distinct().count() == 1 and hot.count() == 400  # nothing else is shared
    sizes = {r.owner: r["count"] for r in index.groupBy("owner").count().collect()}
    assert len(sizes) >= 9 and max(sizes.values()) <= 200  # twice an even share
    files = index.select("owner", F.input_file_name().alias("f")).distinct()
    assert files.count() == len(sizes) == files.select("f").distinct().count()
    spans = sorted((min(k), max(k)) for k in [
        [r.key % 2**64 for r in index.where((F.col("owner") == o) & (F.col("parts") == 1)).select("key").collect()]
        for o in sizes] if k)
    assert len(spans) > 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert index.where("parts = 1 and chained > 1").count() == 0
    assert sum(r.chained for r in hot.where("rid = keep.rid").collect()) == 400


def test_doubling_counts_only_overfull_buckets(make_docs, monkeypatch):
    narrow = make_docs([(0, "x")]).sparkSession.range(1000).select(
        F.when(F.col("id") < 900, F.shiftleft(F.col("id"), 40)).otherwise(F.col("id") * (1 << 50)).alias("key"))
    buckets, depth = ED._buckets(narrow, 1000, 100)
    found = buckets.collect()
    assert depth > 14 and sum(r.n for r in found) == 1000 and all(r.n <= 100 for r in found)
    assert len({r.depth for r in found}) >= 3
    monkeypatch.setattr(ED, "MAX_DOUBLINGS", 2)
    assert max(r.n for r in ED._buckets(narrow, 1000, 100)[0].collect()) > 100


def test_no_exchange_of_the_index_but_to_its_owners(make_docs, monkeypatch):
    plans = []
    real = ED.stage
    monkeypatch.setattr(ED, "stage", lambda df, name="stage": (
        plans.append((name, df._jdf.queryExecution().executedPlan().toString())), real(df, name))[1])
    ED.exact_dedup(make_docs([(k, f"text {k % 50}") for k in range(200)])).collect()
    index = next(p for n, p in plans if n == "dedup-index")
    assert index.count("shufflepartitionidpassthrough") == 1 and "hashpartitioning(key" not in index


def test_different_bytes_are_told_apart(make_docs):
    docs = make_docs([(1, "a"), (2, "A"), (3, "b")])
    groups = ED.dedup_index(docs, key_bits=1).select("key", "text_sha256").distinct()
    texts = {r.text_sha256: (r.texts, r.copies) for r in ED.compare_bytes(docs, groups, key_bits=1).collect()}
    assert texts == {hashlib.sha256(b"a").hexdigest(): (1, 2), hashlib.sha256(b"b").hexdigest(): (1, 1)}


def test_dropping_keeps_columns_and_one_row(make_docs, odd_rows):
    docs = make_docs(odd_rows).withColumn("kept", F.lit("clash")).withColumn("key", F.lit(1))
    out = ED.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([None, 2, 3, 5, 7, 8, 9, 10, 11], key=str)
    assert ED.drop_exact_duplicates(docs.limit(0)).count() == 0


def test_main_path_is_native(make_docs):
    plan = ED.exact_dedup(make_docs([(1, "a"), (2, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
