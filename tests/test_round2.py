"""Cases the stand-in tables do not reach: changing split packing, text tag
numbers, instants in another session zone, unreadable files, null keys."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tagwave import jobs
from tagwave import schemas as S
from tagwave.operators import cleanup as C
from tagwave.operators import qa as Q
from tagwave.operators.joins import dimension, join_dimension
from tagwave.functions.names import snake_names
from tagwave.functions.timefmt import parse_r_time
from tagwave.operators import extras as EX
from tagwave.operators.load import load_product
from tagwave.operators.sequence import file_row_number
from tagwave.session import local_scratch
from tagwave.sources import landed as LD
from tagwave.sources.csv import read_text_csv, write_r_csv
from tagwave.sources.landed import read_product

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def conf(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_row_numbers_survive_another_split_packing(spark, conf):
    d = local_scratch()
    with open(os.path.join(d, "rows.csv"), "w") as f:
        f.write("v\n" + "".join(f"{k}\n" for k in range(100_000)))
    conf("spark.sql.files.maxPartitionBytes", "50000")
    conf("spark.sql.files.openCostInBytes", "1")
    conf("spark.sql.files.minPartitionNum", "2")
    out = file_row_number(read_text_csv(spark, d))
    conf("spark.sql.files.minPartitionNum", "16")
    got = out.select(F.count("*"), F.sum((F.col("v").cast("long") + 1 == F.col("row_number")).cast("int"))).first()
    assert tuple(got) == (100_000, 100_000)


HISTOS = ["DeployID", "Ptt", "Source", "HistType", "Date", "Time.Offset", "Count", "NumBins", "Sum",
          *[f"Bin{k}" for k in range(1, 25)]]


def _joined(spark, rows, deployments):
    h = spark.createDataFrame([(str(k), t, *["1"] * (len(HISTOS) - 2)) for k, t in enumerate(rows)],
                              ", ".join(f"`{c}` string" for c in HISTOS)).withColumn(C.FILE_ROW, F.col("DeployID").cast("long"))
    d = spark.createDataFrame([(k, t) for k, t in enumerate(deployments, 100)], f"{C.FILE_ROW} long, PTT string")
    got = C.nsb_histos_raw(h, d).select("deployid", "deploy_id").collect()
    return sorted(((rows[int(r.deployid)], r.deploy_id) for r in got), key=str)


def test_text_tag_numbers_meet_only_themselves(spark):
    assert _joined(spark, ["07U100", "07U200", "12", "NA"], ["07U200", "07U300", "12.0", "NA"]) == [
        ("07U100", None), ("07U200", 100), ("12", None), ("NA", 103)]


def test_numeric_tag_numbers_are_compared_as_numbers(spark):
    assert _joined(spark, ["12", "12345.5", "12345", ""], ["12.0", "12345"]) == [
        ("", None), ("12", 100), ("12345", 101), ("12345.5", None)]


@pytest.mark.parametrize("zone", ["UTC", "America/Anchorage", "Asia/Tokyo"])
def test_fault_list_in_any_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    at = dt.datetime(2010, 5, 11, 12, 49, 1, tzinfo=dt.timezone.utc)
    rows = [("HF2010_1007_06L0129", at, "Argos"), ("HF2010_1007_06L0129", at + dt.timedelta(hours=1), "Argos"),
            ("t", at, "User"), ("t", at, None), ("t", at, "Argos"), ("u", at, "Argos")]
    recs = spark.createDataFrame(rows, "deployid string, locs_dt timestamp, type string")
    deps = spark.createDataFrame(
        [(1, "t", at + dt.timedelta(minutes=1), None), (2, "t", at - dt.timedelta(days=9), at + dt.timedelta(days=1)),
         (3, "u", at - dt.timedelta(days=9), at - dt.timedelta(seconds=1)), (4, "HF2010_1007_06L0129", None, at + dt.timedelta(days=1))],
        "id long, deployid string, deploy_dt timestamp, end_dt timestamp")
    got = [r.data_explain for r in Q.qa_table(recs, deps, S.LOCS).orderBy("deployid", "locs_dt", F.col("type").asc_nulls_first()).collect()]
    assert got == [S.EXPLAIN_BAD_LOCATION, S.EXPLAIN_UNREVIEWED, S.EXPLAIN_UNREVIEWED, S.EXPLAIN_BEFORE,
                   S.EXPLAIN_UNREVIEWED, S.EXPLAIN_AFTER]


def test_unknown_rule_operator_is_an_error(spark):
    with pytest.raises(ValueError):
        Q.known_issue_explain([("locs", "a", "<", "2020-01-01 00:00:00", "x")], "dt")


def _deployed(spark, *tags):
    rows = [(i, t, dt.datetime(2020, 1, 1), None) for i, t in enumerate(tags, 1)]
    return spark.createDataFrame(rows, "id long, deployid string, deploy_dt timestamp_ntz, end_dt timestamp_ntz")


def _messages(spark, root, tag, seqs=(1, 2), **changed):
    """A tag's messages file with the declared columns, some replaced or left out (None)."""
    types = S.landed_types(S.ALLMSG) | {k: v for k, v in changed.items() if v}
    cols = [F.lit("1").cast(t).alias(c) if t != "timestamp_ntz" else F.lit("2020-02-01").cast(t).alias(c)
            for c, t in types.items() if changed.get(c, t)]
    df = spark.createDataFrame([(s,) for s in seqs], "seq long").select("seq", *cols).coalesce(1)
    df.write.parquet(f"{root}/messages/deployid={tag.replace('%', '%25')}")


def test_a_bad_file_fails_its_tag_only(spark):
    """A missing column, another type, no parquet file: those tags fail, the
    others load with the declared types, and the report says so."""
    root, out = local_scratch(), local_scratch()
    _messages(spark, root, "A")
    _messages(spark, root, "B+ %", (3, 4, 5))
    _messages(spark, root, "lacks", gdop=None)
    _messages(spark, root, "typed", ptt="long")
    _messages(spark, root, "small", latitude="float")
    _messages(spark, root, "upper", seqs=())
    os.makedirs(f"{root}/messages/deployid=torn")
    with open(f"{root}/messages/deployid=torn/part-0.parquet", "w") as f:
        f.write("no parquet file")
    tags = ["A", "B+ %", "lacks", "typed", "small", "upper", "torn", "gone"]
    paths = jobs.load_job(spark, _deployed(spark, *tags), root, None, out)
    table = spark.read.parquet(paths[S.ALLMSG.table])
    assert table.columns == list(S.ALLMSG.columns)
    assert {c: t.replace("bigint", "long") for c, t in table.dtypes} == {c: S.column_type(c) for c in S.ALLMSG.columns}
    got = {}
    for r in table.collect():
        got.setdefault(r.deployid, []).append(r.id)
    assert {t: sorted(v) for t, v in got.items()} == {"A": [2, 3], "B+ %": [5, 6, 7], "small": [9, 10]}
    report = {r.deployid: r.status for r in spark.read.parquet(paths[jobs.STATUS_TABLE]).where("data_type = 'allmsg'").collect()}
    assert report == {**dict.fromkeys(["A", "B+ %", "small"], S.STATUS_IMPORTED), "gone": S.MISSING_CSV,
                      **dict.fromkeys(["lacks", "typed", "upper", "torn"], S.STATUS_FAILED)}
    reasons = {r.deployid: r.reason for r in jobs.Landing(spark, root).products.collect()}
    assert reasons == {"A": None, "B+ %": None, "small": None, "upper": None, "lacks": "lacks gdop",
                       "typed": "ptt is int64", "torn": "unreadable"}


def test_footers_through_spark_where_python_cannot_open(spark, monkeypatch):
    root = local_scratch()
    _messages(spark, root, "A")
    direct = LD.landed_footers(spark, root).collect()
    monkeypatch.setattr(LD, "DIRECT_SCHEMES", ())
    assert LD.landed_footers(spark, root).collect() == direct and direct[0].rows == 2


def test_too_many_unreadable_tags_are_an_error(spark, monkeypatch):
    root = local_scratch()
    _messages(spark, root, "A", ptt="long")
    _messages(spark, root, "B", ptt="long")
    landing = jobs.Landing(spark, root)
    assert sorted(LD.unreadable_tags(landing.products, "messages")) == ["A", "B"]
    monkeypatch.setattr(LD, "MAX_UNREADABLE", 1)
    with pytest.raises(ValueError):
        LD.unreadable_tags(landing.products, "messages")


def test_an_empty_preferred_source_hides_the_other(spark):
    """all_locations without rows beside filled locations: the tag fails."""
    root, out = local_scratch(), local_scratch()
    types = S.landed_types(S.LOCS)
    row = spark.range(1).select(F.lit(1).cast("long").alias("seq"), *[F.lit(None).cast(t).alias(c) for c, t in types.items()])
    for tag in ("A", "B"):
        row.coalesce(1).write.parquet(f"{root}/locations/deployid={tag}")
    row.limit(0).coalesce(1).write.parquet(f"{root}/all_locations/deployid=B")
    paths = jobs.load_job(spark, _deployed(spark, "A", "B"), root, None, out)
    assert [r.deployid for r in spark.read.parquet(paths[S.LOCS.table]).collect()] == ["A"]
    report = {r.deployid: r.status for r in spark.read.parquet(paths[jobs.STATUS_TABLE]).where("data_type = 'locs'").collect()}
    assert report == {"A": S.STATUS_IMPORTED, "B": S.STATUS_FAILED}


def test_a_tag_listed_twice_shares_ids(spark):
    """Two fetches, each joined to both listed rows: ids 2, 3 and 5, 6, all twice."""
    rows = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z")], "deployid string, seq long, msg string")
    tags = spark.createDataFrame([(10, "A"), (11, "A"), (12, "B")], "deploy_id long, deployid string")
    got = [tuple(r) for r in load_product(rows, tags, S.ALLMSG).select("id", "deploy_id", "deployid", "msg")
           .orderBy("id", "deploy_id").collect()]
    assert got == [(2, 10, "A", "x"), (2, 11, "A", "x"), (3, 10, "A", "y"), (3, 11, "A", "y"),
                   (5, 10, "A", "x"), (5, 11, "A", "x"), (6, 10, "A", "y"), (6, 11, "A", "y"), (8, 12, "B", "z")]


def test_columns_that_differ_in_case_are_one_column(spark):
    root = local_scratch()
    spark.createDataFrame([("1",)], "ptt string").write.parquet(f"{root}/messages/deployid=A")
    spark.createDataFrame([("2",)], "PTT string").write.parquet(f"{root}/messages/deployid=B")
    got = read_product(spark, root, "messages", "ptt string").select("deployid", "ptt").collect()
    assert sorted(map(tuple, got)) == [("A", "1"), ("B", "2")]


def test_snake_names():
    assert snake_names(["DeployID", "FastGPS Power", "FastGPSPower", "Byte #0", "SW", "PreReleaseTiltSd", "Time.Offset", "",
                        "Time Offset", "time_offset"]) == [
        "deploy_id", "fast_gps_power", "fast_gps_power_2", "byte_0", "sw", "pre_release_tilt_sd", "time_offset", "x",
        "time_offset_2", "time_offset_3"]


def test_month_name_times(spark):
    texts = ["12:49:01 11-May-2010 ", "1:2:3 1-jan-2010", "12:49:01 11-September-2010  x", "12:49:01 31-Feb-2010", "", None,
             "12:49:01 11-Mai-2010", "NA"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_r_time(F.col("t"), S.EXTRA_TIME_FORMAT)).collect()]
    assert got == [dt.datetime(2010, 5, 11, 12, 49, 1), dt.datetime(2010, 1, 1, 1, 2, 3), dt.datetime(2010, 9, 11, 12, 49, 1),
                   None, None, None, None, None]


def test_optional_products_by_header(spark):
    """Columns in another order, a short header, a file without rows, no file."""
    root = local_scratch()
    heads = {"A": "DeployID,Ptt,Instr,ID,Start,End,Duration,Location Quality",
             "B": "Location Quality,Duration,End,Start,ID,Instr,Ptt,DeployID,Extra",
             "C": "DeployID,Ptt,ID,Start,End,Duration,Location Quality", "D": "DeployID,Ptt,Instr,ID,Start,End,Duration,Location Quality"}
    rows = {"A": ["A,1,i,h1,10:00:00 01-May-2010 ,11:00:00 01-May-2010 ,60,NA", "A,1,i,h2,,,,3"],
            "B": ["2,30,11:00:00 02-May-2010 ,10:00:00 02-May-2010 ,h9,i,1,B,e"], "C": ["C,1,h1,,,,"], "D": []}
    for tag, head in heads.items():
        os.makedirs(f"{root}/haulout/deployid={tag}")
        with open(f"{root}/haulout/deployid={tag}/x-HaulOut.csv", "w") as f:
            f.write("\n".join([head, *rows[tag]]) + "\n")
    tags = spark.createDataFrame([(i, t) for i, t in enumerate("ABCDE")], "deploy_id long, deployid string")
    files = EX.read_extra(spark, root, S.HAULOUT)
    table = EX.load_extra(files, tags, S.HAULOUT)
    assert table.columns == list(S.HAULOUT.columns)
    got = [tuple(r) for r in table.select("id", "deployid", "haulout_identifier", "haulout_start_dt", "duration", "location_quality")
           .orderBy("id").collect()]
    assert got == [(2, "A", "h1", dt.datetime(2010, 5, 1, 10), "60", None), (3, "A", "h2", None, "", "3"),
                   (5, "B", "h9", dt.datetime(2010, 5, 2, 10), "30", "2")]
    report = {r.deployid: r.status for r in EX.extra_status(files, tags, table, S.HAULOUT).collect()}
    assert report == {"A": S.STATUS_IMPORTED, "B": S.STATUS_IMPORTED, "C": S.STATUS_FAILED, "D": S.STATUS_FAILED,
                      "E": S.MISSING_CSV}


def test_export_parts_on_any_partitioning(spark):
    """Rows in the last of many partitions, and no rows at all."""
    rows = spark.range(8).repartition(8).where("id = 5").select("id", F.lit('a "b"').alias("t"))
    path = os.path.join(local_scratch(), "export")
    for df, want in ((rows, ['"id","t"\n5,"a ""b"""\n']), (rows.limit(0), ['"id","t"\n'])):
        write_r_csv(df, path)  # the second time in the place of the first
        assert [open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv")] == want


def test_null_keys_are_spread(spark, conf):
    conf("spark.tagwave.maxBroadcastRows", "0")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    big = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 500).alias("k"), "id")
    dim = dimension(spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")))
    out = join_dimension(big, dim, ["k"], "left").withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 6_000


def test_broadcast_size_is_checked_in_bytes(spark, conf):
    conf("spark.tagwave.maxBroadcastBytes", "100000")
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 2000).alias("t"))
    assert not dimension(wide).small and dimension(wide.select("id")).small


def test_jobs_keep_the_submitted_master_and_partitions():
    code = ("from tagwave.session import job_session; s = job_session();"
            "print(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    env = {**os.environ, "PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS":
           "--master local[2] --conf spark.sql.shuffle.partitions=37 --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=local_scratch(), capture_output=True, text=True, timeout=300)
    assert out.stdout.split()[-3:] == ["local[2]", "37", "UTC"], out.stderr[-800:]
