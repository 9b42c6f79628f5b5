"""Telemetry-domain tables derived from the driver's test tables.

The test data is a TPC-H-like star schema plus an ``events`` table; the
pipeline works on deployments, per-tag records, wide histograms and a
landing log.  These functions derive the latter from the former with Spark
expressions only, so every query's work grows with the input tables.
The same derivations are written in SQL in ``tagwave.plans.oracle``.

* deployments <- customer: ``id = c_custkey``, ``deployid`` its text; start,
  end and gaps follow fixed arithmetic rules so that null starts, open
  deployments and zero-length deployments all occur.  Every 11th customer is
  a second deployment of the tag before it -- half of them of length zero, half
  eligible, so that some tags are listed twice -- and some records have no
  deployment.  One deployid is blank.
* tag records <- events: ``seq = event_id`` (arrival order), ``deployid =
  user_id`` as text (a few numbers stand for the tags of the fault list),
  ``dt = ts``, ``type = event_type``; of locations every fifth is a ``User``
  one, some have no type, and half of those of the listed location fault's tag
  lie at its instant.
* products <- events by type: messages = every event, dive depths = click,
  dive durations = view, time at depth = purchase, timelines = signup,
  all_locations = error events of every third tag, locations = view events
  and all other error events.  Columns that events do not have are filled by
  a rule, so every product has its full width.
* wide histograms <- events per (user, day, type): bin h = max value in hour
  h-1 (null when the hour has no event).
* landing log <- customer x six product positions: present / absent / error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.sources.tables import read_table

BASE_DAY = "2024-01-03"
END_DAY = "2024-01-20"


def _days(base: str, n) -> F.Column:
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(days=n.cast("int"))


# Key numbers that stand for the tags with known timeline faults.
FAULT_TAGS = {21 + k: rule[1] for k, rule in
              enumerate(r for r in S.KNOWN_ISSUES if r[0] == "timeline")}
# The one that stands for the tag of the location fault, and its instant.
LOCATION_FAULT = next(r for r in S.KNOWN_ISSUES if r[0] == "locs")
LOCATION_FAULT_TAG = 14
FAULT_TAGS[LOCATION_FAULT_TAG] = LOCATION_FAULT[1]
# A deployment whose deployid is blank (no record is of that tag).
BLANK_TAG = 35


def tag_id(number: Column) -> Column:
    """The deployid of a key number."""
    out = number.cast("string")
    for n, name in FAULT_TAGS.items():
        out = F.when(number == n, F.lit(name)).otherwise(out)
    return out


def deployment_tag(number: Column) -> Column:
    """The deployid of a key number among deployments and downloads."""
    return F.when(number == BLANK_TAG, F.lit("")).otherwise(tag_id(number))


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, deployid, deploy_dt, end_dt, capture_event_id`` (one row per
    customer; every 11th is a second deployment of the tag before it, every
    22nd an eligible one)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    second = k % 11 == 0
    again = _days(BASE_DAY, k % 7 + 1)
    deploy_dt = F.when(second, again).when(k % 13 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(_days(BASE_DAY, k % 5))
    end_dt = (F.when(k % 22 == 0, _days(END_DAY, k % 9)).when(second, again).when(k % 7 == 0, F.lit(None).cast("timestamp_ntz"))
               .when(k % 17 == 0, _days(BASE_DAY, k % 5))
               .otherwise(_days(END_DAY, k % 9)))
    return c.select(k.alias("id"), deployment_tag(F.when(second, k - 1).otherwise(k)).alias("deployid"),
                    deploy_dt.alias("deploy_dt"), end_dt.alias("end_dt"),
                    F.col("c_nationkey").cast("long").alias("capture_event_id"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq, deployid, dt, type, value, tag``: one row per tag record."""
    e = read_table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("seq"),
                    tag_id(F.col("user_id")).alias("deployid"),
                    F.col("ts").alias("dt"), F.col("event_type").alias("type"),
                    F.col("value"), F.col("user_id").alias("tag"))


# product -> event types standing in for it
PRODUCT_TYPES = {
    "allmsg": None,
    "histos_divedepth": ("click",),
    "histos_diveduration": ("view",),
    "histos_timeatdepth": ("purchase",),
    "histos_timeline": ("signup",),
}
ALL_LOCATIONS_TYPE = "error"
LOCATIONS_TYPE = "view"


# What the stand-in takes from an event, by landed column name.
TAKEN = {
    "allmsg": {"msg_date": "dt", "msg": "type"},
    "histos_divedepth": {"divedepth_dt": "dt", "num_dives": "value"},
    "histos_diveduration": {"diveduration_dt": "dt", "num_dives": "value"},
    "histos_timeatdepth": {"tad_start_dt": "dt", "pct_tad": "value"},
    "histos_timeline": {"timeline_start_dt": "dt", "percent_dry": "value"},
    "locs": {"date_time": "loc_dt", "type": "loc_type"},
    "behav": {"start": "dt"},
}
MADE = ("id", "deploy_id", "deployid", "qa_status", "data_status", "data_explain")


def landed_columns(product: S.Product) -> list[tuple[str, str]]:
    """(output column, landed column) of everything a tag's file holds."""
    back = {new: old for old, new in product.renames.items()}
    return [(c, back.get(c, c)) for c in product.columns if c not in MADE]


def filler(product: S.Product, out: str) -> tuple[str, int]:
    """Kind and period of the rule that fills a column events do not have."""
    kind = {"latitude": "lat", "longitude": "long", "hist_type": "percent"}.get(
        out, "time" if out.endswith("_dt") else "text")
    return kind, 7 + product.columns.index(out)


def _landed(r: DataFrame, product: S.Product, *more) -> DataFrame:
    """A product's landed columns from records ``r``."""
    seq, cols = F.col("seq"), []
    for out, name in landed_columns(product):
        kind, period = filler(product, out)
        if name in TAKEN[product.name]:
            c = F.col(TAKEN[product.name][name])
        elif name in r.columns:
            c = F.col(name)
        elif kind == "percent":
            c = F.lit(S.HIST_TYPE_PERCENT)
        elif kind == "time":
            c = F.timestamp_add("MINUTE", seq % period, F.col("dt"))
        elif kind in ("lat", "long"):
            c = (F.when(seq % 29 != 0, seq % (179 if kind == "lat" else 359) - (89 if kind == "lat" else 179))
                 .cast("double"))
        else:
            c = F.concat(F.lit(f"{out} "), (seq % period).cast("string"))
        cols.append(c.alias(name))
    return r.select("seq", "deployid", *cols, *more)


def product_rows(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """Landed rows of one product for every tag, in the product's own
    column names (before the loader's renames)."""
    if product == "locs":
        return location_sources(spark, sf_dir)
    r = records(spark, sf_dir)
    types = PRODUCT_TYPES[product]
    return _landed(r.where(F.col("type").isin(*types)) if types else r, S.PRODUCTS[product])


def _preference() -> Column:
    """Which location source a record stands in for: 1 ``all_locations``
    (error events of every third tag), 2 ``locations`` (view events and the
    other error events), null neither."""
    error = F.col("type") == ALL_LOCATIONS_TYPE
    return (F.when(error & (F.col("tag") % 3 == 0), F.lit(1))
            .when(error | (F.col("type") == LOCATIONS_TYPE), F.lit(2)))


def location_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both location products with their preference ``pref``, from one scan."""
    r = records(spark, sf_dir).withColumn("pref", _preference()).where("pref is not null")
    seq = F.col("seq")
    bad = (F.col("tag") == LOCATION_FAULT_TAG) & (seq % 2 == 0)
    r = r.withColumns({
        "loc_type": F.when(seq % 5 == 0, F.lit("User")).when(seq % 7 != 0, F.col("type")),
        "loc_dt": F.when(bad, F.lit(LOCATION_FAULT[3]).cast("timestamp_ntz")).otherwise(F.col("dt"))})
    return _landed(r, S.LOCS, "pref")


def location_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deployid, pref``: the location products each tag landed -- ``locations``
    (2) always, ``all_locations`` (1) for every third tag, with rows or without."""
    tags = read_table(spark, sf_dir, "events").select("user_id").distinct()
    held = F.when(F.col("user_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    return tags.select(tag_id(F.col("user_id")).alias("deployid"), F.explode(held).alias("pref"))


def product_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(deployid, pos, has_rows)``: which products have rows for which tag,
    for all products from one scan."""
    r = records(spark, sf_dir)
    held = [F.when(F.col("type").isin(*types) if types else F.lit(True), F.lit(S.PRODUCTS[p].pos).cast("long"))
            for p, types in PRODUCT_TYPES.items()]
    chosen = F.when(F.col("tag") % 3 == 0, 1).otherwise(2)  # by what landed
    held.append(F.when(_preference() == chosen, F.lit(S.LOCS.pos).cast("long")))
    return (r.select("deployid", F.explode(F.array_compact(F.array(*held))).alias("pos"))
            .distinct().withColumn("has_rows", F.lit(True)))


def behaviour_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour records (purchase events), ``end = start + floor(value)``
    minutes, ``count`` the minutes."""
    r = records(spark, sf_dir).where(F.col("type") == "purchase")
    minutes = F.floor("value")
    r = r.withColumn("count", minutes).withColumn(
        "end", F.col("dt") + F.make_dt_interval(mins=minutes.cast("int")))
    return _landed(r, S.BEHAV)


def wide_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deploy_id, deployid, hist_dt, hist_type, bin01..bin24``: one row per
    (tag, day, type); bin h holds the largest value seen in hour h-1."""
    e = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    hour = F.hour("ts")
    bins = [F.max(F.when(hour == h, F.col("value"))).alias(S.BIN_COLUMNS[h]) for h in range(S.N_BINS)]
    return (e.groupBy(F.col("user_id").alias("deploy_id"),
                      F.to_date("ts").cast("timestamp_ntz").alias("hist_dt"),
                      F.col("event_type").alias("hist_type"))
            .agg(*bins)
            .withColumn("deployid", F.col("deploy_id").cast("string"))
            .select("deploy_id", "deployid", "hist_dt", "hist_type", *S.BIN_COLUMNS))


def landing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deployid, pos, state`` for every customer and product position 1..6:
    what the download of that tag held (present / absent / error)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    pos = F.explode(F.sequence(F.lit(1), F.lit(len(S.LOAD_ORDER)))).alias("pos")
    g = c.select("c_custkey", pos)
    k, p = F.col("c_custkey"), F.col("pos")
    state = (F.when((k * 7 + p) % 23 == 0, F.lit("error"))
              .when((k + p) % 9 == 0, F.lit("absent"))
              .otherwise(F.lit("present")))
    return g.select(deployment_tag(k).alias("deployid"), p.cast("long").alias("pos"), state.alias("state"))


def tag_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export metadata (one row per order): ``action_lku`` I/U/D from the
    order status, times as zone-less Vancouver wall times."""
    o = read_table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    stop = F.timestamp_add("HOUR", (k % 24) + F.lit(720), start)
    return o.select(
        F.when(F.col("o_orderstatus") == "F", "I").when(F.col("o_orderstatus") == "O", "U")
         .otherwise("D").alias("action_lku"),
        F.concat(F.lit("pi"), (c % 10).cast("string"), F.lit("@example.org")).alias("piemail"),
        F.lit("data@example.org").alias("datamanageremail"),
        F.concat(F.lit("maker "), (k % 3).cast("string")).alias("tagmanufacturer"),
        F.col("o_orderpriority").alias("tagmodel"),
        F.concat(F.lit("SN"), k.cast("string")).alias("tagserialnumber"),
        F.lit("pressure, wet/dry").alias("sensors"),
        c.alias("pttid"),
        (c % 7 + 1000).alias("argosprogramnum"),
        k.cast("string").alias("deploymentid"),
        start.alias("deploymentstartdate"),
        stop.alias("deploymentstopdate"),
        (F.col("o_totalprice") / 10000.0).alias("deploymentlatitude"),
        F.lit(-150.5).alias("deploymentlongitude"),
        F.lit("Eb").alias("species"),
        F.concat(F.lit("A"), c.cast("string")).alias("animalid"),
    )
