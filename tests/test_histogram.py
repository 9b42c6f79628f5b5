"""Wide-to-long reshape: equals the 24-branch UNION; null bins kept;
duplicates collapse; ids follow (deploy_id, time)."""

import datetime as dt

from tagwave import schemas as S
from tagwave.operators.histogram import timeline_unpivot, tidy_timeline
from tagwave.plans.bindings import wide_histograms

SF = "/root/testdata/sf0.001"


def test_equals_24_way_union(spark):
    wide = wide_histograms(spark, SF).where("hist_type = 'click'").drop("hist_type")
    wide.createOrReplaceTempView("wide_t")
    union = " union ".join(
        f"select deploy_id, deployid, 'Percent' as hist_type, "
        f"hist_dt + make_dt_interval(0, {h}) as timeline_start_dt, "
        f"cast(bin{h + 1:02d} as double) as percent_dry from wide_t" for h in range(24))
    expected = spark.sql(union)
    got = timeline_unpivot(wide).drop("id")
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_nulls_kept_duplicates_collapse_and_ids(spark):
    base = dt.datetime(2020, 1, 1)
    bins = [None] * 24
    bins[0] = 5.0
    row = (7, "7", base, *bins)
    schema = "deploy_id long, deployid string, hist_dt timestamp_ntz, " + ", ".join(
        f"{b} double" for b in S.BIN_COLUMNS)
    wide = spark.createDataFrame([row, row], schema)  # duplicate wide row
    out = timeline_unpivot(wide).orderBy("id").collect()
    assert len(out) == 24
    assert [r.id for r in out] == list(range(1, 25))
    assert out[0].percent_dry == 5.0 and out[1].percent_dry is None
    assert out[23].timeline_start_dt == base + dt.timedelta(hours=23)
    assert {r.hist_type for r in out} == {"Percent"}


def test_tidy_timeline_casts_like_as_integer(spark):
    schema = "deployid string, hist_type string, hist_dt timestamp_ntz, " + ", ".join(
        f"{b} double" for b in S.BIN_COLUMNS)
    rows = [("12.7", "Percent", dt.datetime(2020, 1, 1), *([1.0] * 24)),
            ("abc", "Percent", dt.datetime(2020, 1, 1), *([2.0] * 24))]
    out = tidy_timeline(spark.createDataFrame(rows, schema)).collect()
    assert {r.deployid for r in out} == {12, None}
    assert len(out) == 48


def _random_wide(spark, n, seed):
    import random
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    schema = "deploy_id long, deployid string, hist_type string, hist_dt timestamp_ntz, " + ", ".join(
        f"{b} double" for b in S.BIN_COLUMNS)
    rows = []
    for _ in range(n):
        tag = rnd.choice([1] * 6 + [2, 3, None])  # one tag holds most rows
        start = rnd.choice([None] + [base + dt.timedelta(hours=rnd.randrange(0, 400))] * 20)
        row = (tag, str(tag), "Percent", start, *[rnd.choice([None, 0.0, 5.5, 100.0]) for _ in S.BIN_COLUMNS])
        rows += [row] * rnd.choice([1, 1, 2])
    return spark.createDataFrame(rows, schema)


def test_days_that_meet_range_borders(spark):
    """Starts at any hour, overlapping days, a hot tag, many ranges: as the
    24-way UNION numbered by one sort."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from tagwave.operators.histogram import explode_bins
    wide = _random_wide(spark, 300, 5)
    plain = explode_bins(wide, ["deploy_id", "deployid"]).distinct()
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in ("deploy_id", "timeline_start_dt", "deployid", "percent_dry")])
    want = plain.withColumn("id", F.row_number().over(w).cast("long"))
    for ranges in (1, 7, 64):
        got = timeline_unpivot(wide.drop("hist_type"), ranges=ranges).drop("hist_type").select(want.columns)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    tidy = explode_bins(wide, ["deployid", "hist_type"])
    got = tidy_timeline(wide.drop("deploy_id"), ranges=29)
    assert got.count() == tidy.count()
    assert got.agg(F.max("id")).first()[0] == got.select("id").distinct().count() == tidy.count()


def test_wide_rows_cross_the_network_once(spark):
    """The wide rows are exchanged below the explode, once for both readers, and
    no hourly row is."""
    out = timeline_unpivot(_random_wide(spark, 50, 6).drop("hist_type"), ranges=5)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in plan.splitlines() if "shufflepartitionidpassthrough" in line]
    assert len([line for line in moved if "ReusedExchange" not in line]) == 1 and "ReusedExchange" in plan
    assert not any("percent_dry" in line for line in plan.splitlines() if "Exchange hash" in line)
    assert plan.index("Generate posexplode") < plan.index("shufflepartitionidpassthrough")
