"""Distributed numbering: equals a sort, equals the per-tag id loop, and
splits a hot key across tasks."""

import random

from pyspark.sql import functions as F

from tagwave.operators import sequence as SEQ
from tagwave.operators.sequence import global_row_number, surrogate_ids


def _loop_ids(rows):
    """The upstream loop: tags in order; base = 1 if the table is empty, else
    max(id)+1; ids 1..n + base."""
    out, table_max = {}, None
    for tag in sorted({t for t, _ in rows}):
        mine = sorted(s for t, s in rows if t == tag)
        base = 1 if table_max is None else table_max + 1
        for i, s in enumerate(mine, start=1):
            out[(tag, s)] = i + base
        table_max = len(mine) + base
    return out


def test_closed_form_ids_equal_loop(spark):
    rnd = random.Random(3)
    for case in range(4):
        rows = [(rnd.choice("abcdefg")[: 1 + case % 2] + str(rnd.randint(0, 3)), i)
                for i in range(rnd.randint(1, 400))]
        df = spark.createDataFrame(rows, "tag string, seq long")
        got = {(r.tag, r.seq): r.id for r in surrogate_ids(df, "tag", ["seq"], partitions=5).collect()}
        assert got == _loop_ids(rows)


def test_fixture_tags_with_3_0_2_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("c", 1), ("c", 2)], "tag string, seq long")
    assert [r.id for r in surrogate_ids(df, "tag", ["seq"]).orderBy("id").collect()] == [2, 3, 4, 6, 7]


def test_global_row_number_is_a_sort(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    out = global_row_number(df, ["k"], out="rn", partitions=7).collect()
    assert sorted((r.rn, r.k) for r in out) == [(i + 1, i) for i in range(5000)]


def test_nulls_last_and_distinct(spark):
    df = spark.createDataFrame([(None,), (2,), (1,), (2,), (None,)], "k int")
    out = global_row_number(df, ["k"], out="rn", distinct=True).orderBy("rn").collect()
    assert [(r.rn, r.k) for r in out] == [(1, 1), (2, 2), (3, None)]


def test_hot_key_is_split_across_partitions(spark):
    # one tag holds half the rows: its rows must land in several range partitions
    hot = spark.range(0, 20000).select(F.lit("hot").alias("tag"), F.col("id").alias("seq"))
    cold = spark.range(0, 20000).select((F.col("id") % 50).cast("string").alias("tag"),
                                        (F.col("id") + 100000).alias("seq"))
    df = hot.unionByName(cold)
    ids = surrogate_ids(df, "tag", ["seq"], partitions=16)
    parts = (ids.where(F.col("tag") == "hot").select(F.spark_partition_id().alias("p"))
             .distinct().count())
    assert parts > 1
    r = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.countDistinct("id").alias("n")).first()
    assert r.n == 40000 and r.lo == 2 and r.hi == 40000 + 51


def test_distinct_numbering_with_float_keys_many_partitions(spark):
    # duplicates, nulls and a double in the key: ids must follow the full order
    # however many partitions are used (the de-duplication must not re-shuffle)
    base = spark.range(0, 3000).select(
        (F.col("id") % 37).alias("a"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") % 7) / 2.0).alias("x"),
        (F.col("id") % 5).cast("string").alias("s"))
    df = base.unionByName(base)
    got = global_row_number(df, ["a", "s", "x"], out="rn", partitions=64, distinct=True)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("a").asc_nulls_last(), F.col("s").asc_nulls_last(), F.col("x").asc_nulls_last())
    expected = df.distinct().withColumn("rn", F.row_number().over(w).cast("long"))
    assert got.count() == expected.count()
    assert got.exceptAll(expected.select(got.columns)).count() == 0


def test_numbering_with_aqe_merged_ranges(spark):
    """No fixed partition count: AQE merges many small ranges; ids still
    follow the total order."""
    keys = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k, None) for k in keys]
    spark.conf.set(keys[0], "300")
    spark.conf.set(keys[1], "8k")
    try:
        df = spark.range(0, 20000).select(((F.col("id") * 7919) % 20000).alias("k"),
                                          (F.col("id") % 7).cast("string").alias("t"))
        out = global_row_number(df, ["t", "k"], out="rn").collect()
        ids = surrogate_ids(df, "t", ["k"]).collect()
    finally:
        for k, v in zip(keys, before):
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert sorted((r.rn, r.t, r.k) for r in out) == [
        (i + 1, t, k) for i, (t, k) in enumerate(sorted((r.t, r.k) for r in out))]
    assert {(r.t, r.k): r.id for r in ids} == _loop_ids([(r.t, r.k) for r in ids])


def test_ids_by_keys_alone(spark, monkeypatch):
    """as many ranges as the rows need, one tag in most of them; the ids are
    those of the plain numbering."""
    monkeypatch.setattr(SEQ, "MAX_RANGE_ROWS", 50)
    rows = spark.range(1500).selectExpr("if(id % 3 = 0, concat('t', id % 40), 'hot') as tag", "cast(id % 2 as int) as fetch",
                                        "nullif(id, 77) as seq", "concat('row ', id) as text")
    want = surrogate_ids(rows, ["tag", "fetch"], ["seq"])
    got = SEQ.keyed_ids(rows, rows.select("seq", "tag", "fetch"), ["tag", "fetch"], ["seq"])
    assert got.rdd.getNumPartitions() > 20
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    none = rows.where("false")
    assert SEQ.keyed_ids(none, none, ["tag", "fetch"], ["seq"]).count() == 0
