"""Scalar rules: first-match replace, code chains, blanks, casts, times,
points."""

import datetime as dt

from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.functions.casts import r_as_integer
from tagwave.functions.geo import make_point, point_ewkt
from tagwave.functions.text import blank_to_null, exact_fix, r_text, replace_first, replace_first_chain
from tagwave.functions.timefmt import parse_r_time, wall_time_to_utc


def _one(spark, expr, values, t="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {t}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_replace_first_only(spark):
    assert _one(spark, lambda c: replace_first(c, "Mk10", "MK10"), ["Mk10 Mk10", "x", None, ""]) == \
        ["MK10 Mk10", "x", None, ""]
    # regex characters in the pattern are literal; $ in the replacement too
    assert _one(spark, lambda c: replace_first(c, "a.b", "$1"), ["axb a.b a.b"]) == ["axb $1 a.b"]
    # newlines before the match are kept
    assert _one(spark, lambda c: replace_first(c, "o", "0"), ["line\nfoo"]) == ["line\nf0o"]


def test_age_class_chain_keeps_order(spark):
    got = _one(spark, lambda c: blank_to_null(replace_first_chain(c, S.AGE_CLASS_RULES)),
               ["Pup/Juv", "Juv", "Adult", "Pup", ""])
    assert got == ["PUP/SUB", "SUB", "ADT", "PUP", None]


def test_species_and_family(spark):
    assert _one(spark, lambda c: replace_first_chain(c, S.SPECIES_RULES),
                ["BeardedSeal", "RingedSeal", "SpottedSeal", "BeardedSeal/BeardedSeal"]) == \
        ["Eb", "Ph", "Pl", "Eb/BeardedSeal"]
    assert _one(spark, lambda c: replace_first_chain(c, S.TAG_FAMILY_RULES),
                ["Mk10-A", "Splash10", "SPOT"]) == ["MK10-A", "SPLA10", "SPOT"]


def test_blank_na_and_exact_fix(spark):
    assert _one(spark, r_text, [None, "", "NA", "x"]) == ["", "", None, "x"]
    assert _one(spark, lambda c: exact_fix(c, "open wate", "open water"),
                ["open wate", "open waters", None]) == ["open water", "open waters", None]


def test_r_as_integer(spark):
    assert _one(spark, r_as_integer, ["12", "12.7", "-12.7", "x", "", None, "3e9"]) == \
        [12, 12, -12, None, None, None, None]


def test_parse_r_time(spark):
    got = _one(spark, lambda c: parse_r_time(c, S.NSB_DEPLOY_TIME_FORMAT),
               ["4/1/2016 1:01:11", "04/01/2016 01:01:11.000", "", "bad", None])
    assert got[:2] == [dt.datetime(2016, 4, 1, 1, 1, 11)] * 2 and got[2:] == [None, None, None]
    got = _one(spark, lambda c: parse_r_time(c, S.NSB_LOCS_TIME_FORMAT),
               ["2019-3-5 7:08:09", "2019-03-05 07:08:09 UTC"])
    assert got == [dt.datetime(2019, 3, 5, 7, 8, 9)] * 2


def test_vancouver_wall_time_to_utc(spark):
    D = dt.datetime
    got = _one(spark, lambda c: wall_time_to_utc(c, "America/Vancouver"),
               [D(2021, 7, 1, 0, 0), D(2021, 1, 1, 0, 0),
                D(2000, 10, 29, 1, 0), D(2000, 10, 29, 1, 59), D(2000, 10, 29, 0, 30),
                D(2000, 10, 29, 2, 0), D(2021, 3, 14, 2, 30), D(2021, 3, 14, 1, 30), None],
               "timestamp_ntz")
    assert got == [D(2021, 7, 1, 7, 0), D(2021, 1, 1, 8, 0),
                   D(2000, 10, 29, 9, 0), D(2000, 10, 29, 9, 59),   # repeated hour: standard time
                   D(2000, 10, 29, 7, 30), D(2000, 10, 29, 10, 0),
                   D(2021, 3, 14, 10, 30), D(2021, 3, 14, 9, 30),   # skipped hour moves forward
                   None]


def test_point(spark):
    df = spark.createDataFrame([(-150.5, 70.25), (None, 70.0), (1.0, None)], "lon double, lat double")
    rows = df.select(make_point(F.col("lon"), F.col("lat")).alias("p")).collect()
    assert (rows[0].p.x, rows[0].p.y, rows[0].p.srid) == (-150.5, 70.25, 4326)
    assert rows[1].p is None and rows[2].p is None
    txt = df.select(point_ewkt(make_point(F.col("lon"), F.col("lat")))).first()[0]
    assert txt == "SRID=4326;POINT(-150.5 70.25)"


def test_parse_ignores_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = _one(spark, lambda c: parse_r_time(c, S.NSB_DEPLOY_TIME_FORMAT),
                   ["3/13/2016 2:30:00", "2/30/2016 1:00:00", "13/1/2016 1:00:00", "1/2/2016 3:4:5"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2016, 3, 13, 2, 30), None, None, dt.datetime(2016, 1, 2, 3, 4, 5)]


def test_replace_first_property(spark):
    """First-match replace equals Python's ``str.replace(p, r, 1)`` on strings
    full of regex metacharacters (one Spark job for all cases)."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = "ab.$*\\()[]{}^|?+/ \n"
    cases = []

    @settings(max_examples=150, deadline=None, derandomize=True)
    @given(st.text(alphabet, max_size=12), st.text(alphabet, min_size=1, max_size=3),
           st.text(alphabet, max_size=3))
    def collect(s, pat, rep):
        cases.append((s, pat, rep))

    collect()
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, s string")
    expr = F.coalesce(*[F.when(F.col("i") == i, replace_first(F.col("s"), pat, rep))
                        for i, (_s, pat, rep) in enumerate(cases)])
    got = {r.i: r.out for r in df.select("i", expr.alias("out")).collect()}
    for i, (text, pat, rep) in enumerate(cases):
        assert got[i] == text.replace(pat, rep, 1), (text, pat, rep)


def test_point_ewkb(spark):
    import struct
    from tagwave.functions.geo import point_ewkb
    df = spark.createDataFrame([(-150.5, 70.25), (None, 1.0), (12.0, -3.5)], "lon double, lat double")
    got = [r[0] for r in df.select(point_ewkb(make_point(F.col("lon"), F.col("lat")))).collect()]
    want = [struct.pack("<BIidd", 1, 0x20000001, 4326, -150.5, 70.25), None,
            struct.pack("<BIidd", 1, 0x20000001, 4326, 12.0, -3.5)]
    assert [bytes(g) if g is not None else None for g in got] == want
    assert want[0].hex().upper().startswith("0101000020E6100000")
