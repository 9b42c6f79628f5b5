"""CSV reading the R way, export sink."""

import datetime as dt
import os

from tagwave.operators.cleanup import blank_rules, number_file_rows
from tagwave.operators.export import export_rows, write_export
from tagwave.session import local_scratch
from tagwave.sources.csv import r_make_name, read_text_csv


def test_make_names():
    assert r_make_name("tag-local-identifier") == "tag.local.identifier"
    assert r_make_name("Time Offset") == "Time.Offset"
    assert r_make_name("1st") == "X1st"


def test_blank_and_na_fields(spark):
    d = local_scratch()
    with open(os.path.join(d, "f.csv"), "w") as f:
        f.write('a,b,c d\n,"",x\nNA,NA,"y"\n"q",,NA\n')
    df = read_text_csv(spark, d)
    assert df.columns == ["a", "b", "c.d"]
    rows = blank_rules(df, ["b"]).collect()
    assert [tuple(r) for r in rows] == [("", None, "x"), (None, None, "y"), ("q", None, None)]


def test_file_order_ids(spark):
    d = local_scratch()
    for i, name in enumerate(["part-00000.csv", "part-00001.csv"]):
        with open(os.path.join(d, name), "w") as f:
            f.write("v\n" + "".join(f"{i * 100 + j}\n" for j in range(50, 0, -1)))
    out = number_file_rows(read_text_csv(spark, d)).orderBy("id").collect()
    assert [int(r.v) for r in out] == list(range(50, 0, -1)) + list(range(150, 100, -1))
    assert [r.id for r in out] == list(range(1, 101))


def test_export_filter_zone_and_csv(spark):
    cols = ["action_lku", "piemail", "datamanageremail", "tagmanufacturer", "tagmodel",
            "tagserialnumber", "sensors", "pttid", "argosprogramnum", "deploymentid",
            "deploymentstartdate", "deploymentstopdate", "deploymentlatitude",
            "deploymentlongitude", "species", "animalid"]
    t = dt.datetime(2021, 7, 1)
    rows = [("I", "p", "d", "m", "t", "s", "x", 1, 2, "D1", t, None, 1.0, 2.0, "Eb", "A"),
            ("U", "p", "d", "m", "t", "s", "x", 1, 2, "D2", t, t, 1.0, 2.0, "Eb", "A")]
    schema = ", ".join(f"{c} {'timestamp_ntz' if c.endswith('date') else 'long' if c in ('pttid', 'argosprogramnum') else 'double' if c.startswith('deploymentl') else 'string'}" for c in cols)
    out = export_rows(spark.createDataFrame(rows, schema))
    got = out.collect()
    assert len(got) == 1 and got[0].deploymentstartdate == dt.datetime(2021, 7, 1, 7)
    assert out.columns == cols[1:]
    path = os.path.join(local_scratch(), "export")
    write_export(out, path, single_file=True)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert text.splitlines()[0].startswith('"piemail","datamanageremail"')
    assert text.splitlines()[1] == '"p","d","m","t","s","x",1,2,"D1",2021-07-01 07:00:00,NA,1,2,"Eb","A"'
    write_export(out, path + "-parts")
    parts = [open(os.path.join(path + "-parts", f)).read() for f in os.listdir(path + "-parts") if f.endswith(".csv")]
    assert [p for p in parts if p] == [text]


def test_file_order_ids_across_blocks_and_files(spark):
    d = local_scratch()
    expected = []
    for i in range(3):  # three files; the big one is split into many blocks
        n = 20000 if i == 1 else 300
        vals = [f"{i}-{j:06d}" for j in range(n)][::-1]
        expected += vals
        with open(os.path.join(d, f"part-{i:05d}.csv"), "w") as f:
            f.write("v\n" + "".join(v + "\n" for v in vals))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_text_csv(spark, d)
        assert df.rdd.getNumPartitions() > 5
        out = number_file_rows(df).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.v for r in out] == expected
    assert [r.id for r in out] == list(range(1, len(expected) + 1))


def test_shared_dir_when_cluster_names_none():
    """Without ``spark.checkpoint.dir`` a test folder is chosen and reused."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "from tagwave.session import shared_dir\n"
            "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "a, b = shared_dir(s), shared_dir(s)\n"
            "assert a == b and s.sparkContext.getCheckpointDir() is not None\n"
            "print('OK')\n") % root
    env = dict(os.environ, SPARK_CONF_DIR=local_scratch())
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.stdout.strip().endswith("OK"), out.stderr[-2000:]


def test_multiline_fields_and_file_order(spark):
    d = local_scratch()
    with open(os.path.join(d, "f.csv"), "w") as f:
        f.write('k,note\n1,"first\nline"\n2,plain\n3,"a ""quoted"" word"\n')
    df = read_text_csv(spark, d, multiline=True)
    out = number_file_rows(df).orderBy("id").collect()
    assert [(r.id, r.k, r.note) for r in out] == [
        (1, "1", "first\nline"), (2, "2", "plain"), (3, "3", 'a "quoted" word')]
