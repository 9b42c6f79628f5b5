"""Size-checked dimension joins: the salted fallback equals a plain join."""

import pytest
from pyspark.sql import functions as F

from tagwave.operators.joins import dimension, join_dimension


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.tagwave.maxBroadcastRows", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in keys]
    spark.conf.set(keys[0], "0")
    spark.conf.set(keys[1], "-1")
    yield
    for k, v in zip(keys, before):
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _big(spark):
    # key "h" holds half the rows; some keys are null or have no dimension row
    return spark.range(0, 6000).select(
        F.when(F.col("id") % 2 == 0, F.lit("h"))
         .when(F.col("id") % 97 == 0, F.lit(None))
         .otherwise((F.col("id") % 40).cast("string")).alias("k"),
        F.col("id").alias("v"))


def _dim(spark):
    rows = [(str(i), i * 10) for i in range(30)] + [("h", -1), ("h", -2), (None, 99)]
    return spark.createDataFrame(rows, "k string, w long")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_fallback_equals_plain_join(spark, no_broadcast, how, null_safe):
    big, dim = _big(spark), _dim(spark)
    d = dimension(dim)
    assert not d.small
    got = join_dimension(big, d, ["k"], how, null_safe=null_safe)
    if null_safe:
        want = big.join(dim.withColumnRenamed("k", "k2"), big["k"].eqNullSafe(F.col("k2")), how).drop("k2")
    else:
        want = big.join(dim, ["k"], how)
    got, want = got.select("k", "v", "w"), want.select("k", "v", "w")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_broadcast_path_when_small(spark):
    d = dimension(_dim(spark))
    assert d.small
    plan = join_dimension(_big(spark), d, ["k"], "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
