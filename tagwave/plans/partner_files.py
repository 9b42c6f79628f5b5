"""Partner CSV files derived from the test tables.

The partner pipeline reads three CSV files (deployments, histograms,
locations).  Their content is derived from ``customer``, the wide
histograms and ``events`` by fixed per-row rules that produce blanks,
``NA`` fields, first-match cases (``Mk10 Mk10``), the ``open wate`` typo,
one-digit date fields and trailing text after times.  Each column is one
SQL expression, shared by the Spark writer and the DuckDB oracle; only date
arithmetic and formatting differ between the two engines.

The files are written into the shared folder (``spark.checkpoint.dir``) in
key order, so a row's position in the files is its key order: that is what
the file-order ids of the cleanup are checked against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagwave.operators.stage import track
from tagwave.plans.bindings import wide_histograms
from tagwave.session import scratch_path
from tagwave.sources.csv import read_text_csv, write_text_csv
from tagwave.sources.tables import read_table

# Deployment time: a fixed start plus 3671 s per key, then 200 days for the end.
_START = {"spark": "timestampadd(SECOND, c_custkey * 3671, timestamp_ntz'2016-04-01 00:00:00')",
          "duck": "(timestamp '2016-04-01 00:00:00' + to_seconds(c_custkey * 3671))"}
_END = {"spark": f"timestampadd(DAY, 200, {_START['spark']})",
        "duck": f"({_START['duck']} + to_days(200))"}


def _fmt(engine: str, ts: str, padded: bool) -> str:
    if engine == "spark":
        return f"date_format({ts}, '{'MM/dd/yyyy HH:mm:ss' if padded else 'M/d/yyyy H:mm:ss'}')"
    return f"strftime({ts}, '{'%m/%d/%Y %H:%M:%S' if padded else '%-m/%-d/%Y %-H:%M:%S'}')"


def _iso(engine: str, ts: str) -> str:
    if engine == "spark":
        return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')"
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def deploy_columns(engine: str) -> list[tuple[str, str]]:
    """(header, expression over ``customer``) of the deployment file."""
    s, e = _START[engine], _END[engine]
    k = "c_custkey"
    return [
        ("PTT", f"cast({k} as string)"),
        ("Animal_ID", "c_name"),
        ("Species", "case c_mktsegment when 'BUILDING' then 'BeardedSeal' "
                    "when 'MACHINERY' then 'RingedSeal' when 'FURNITURE' then 'SpottedSeal' "
                    "when 'HOUSEHOLD' then 'BeardedSeal-RingedSeal' else 'RibbonSeal' end"),
        ("Fate", f"case {k} % 3 when 0 then 'released' when 1 then '' else 'NA' end"),
        ("animal_sex", f"case {k} % 2 when 0 then 'F' else 'M' end"),
        ("animal_life_stage", f"case {k} % 5 when 0 then 'Juv' when 1 then 'Adult' "
                              f"when 2 then 'Pup' when 3 then 'Pup/Juv' else '' end"),
        ("animal_mass_kg", f"case when {k} % 17 = 0 then 'NA' else "
                           f"cast({k} % 300 + 20 as string) || '.' || cast(c_nationkey % 10 as string) end"),
        ("CLAW_BANDS", f"case {k} % 4 when 0 then '' else cast(c_nationkey as string) || ' bands' end"),
        ("LENGTH_STRAIGHT", f"cast(100 + {k} % 50 as string)"),
        ("LENGTH_CURVED", f"case when {k} % 9 = 0 then '' else cast(110 + {k} % 40 as string) end"),
        ("GIRTH_AX", "cast(c_nationkey * 3 + 80 as string)"),
        ("CAPTURE_AREA", "case c_mktsegment when 'BUILDING' then 'open wate' "
                         "when 'AUTOMOBILE' then 'open water' when 'MACHINERY' then 'open waters' "
                         "else 'shore ice' end"),
        ("CAPTURE_METHOD", f"case {k} % 2 when 0 then 'net' else 'hoop net' end"),
        ("FLIPPER_ID_TAG", f"'FT' || cast({k} as string)"),
        ("FLIPPER_ID_TAG_COLOR", f"case {k} % 3 when 0 then '' else 'yellow' end"),
        ("FLIPPER_ID_TAG_SIDE", f"case {k} % 6 when 0 then 'NA' when 1 then '' else 'left' end"),
        ("UME", f"case {k} % 4 when 0 then '' else 'N' end"),
        ("AGENCY", "'agency ' || cast(c_nationkey as string)"),
        ("CREW", "c_mktsegment"),
        ("PHOTOS", f"case {k} % 3 when 0 then '' when 1 then 'NA' else 'Y' end"),
        ("ADDITIONAL_NOTES", "c_name"),
        ("tag_model", f"case {k} % 4 when 0 then 'Mk10-AF' when 1 then 'Splash10-Splash' "
                      f"when 2 then 'Mk10 Mk10' else 'SPOT6' end"),
        ("tag_manufacturer_name", f"'maker ' || cast({k} % 3 as string)"),
        ("power_source", f"case {k} % 2 when 0 then 'battery' else 'solar' end"),
        ("location_algorithms", f"case {k} % 2 when 0 then 'least squares' else 'kalman' end"),
        ("deploy_on_timestamp", f"case {k} % 10 when 0 then '' "
                                f"when 1 then {_fmt(engine, s, False)} "
                                f"when 2 then {_fmt(engine, s, True)} || '.000' "
                                f"else {_fmt(engine, s, True)} end"),
        ("deploy_location", "'site ' || cast(c_nationkey as string)"),
        ("deploy_on_latitude", f"case when {k} % 8 = 0 then 'NA' else cast(55 + c_nationkey as string)"
                               f" || '.' || lpad(cast({k} % 100 as string), 2, '0') end"),
        ("deploy_on_longitude", f"case when {k} % 8 = 0 then '' else "
                                f"'-' || cast(140 + {k} % 30 as string) || '.5' end"),
        ("attachment_type", "'glue'"),
        ("deploy_off_timestamp", f"case when {k} % 7 = 0 then '' else {_fmt(engine, e, True)} end"),
        ("deployment_end_type", f"case when {k} % 7 = 0 then '' else 'transmissions ended' end"),
        ("mortality_type", f"case {k} % 5 when 0 then 'unknown' else '' end"),
    ]


def _tag_number(key: str) -> str:
    """Tag numbers as partners write them: some with a letter or a fraction."""
    return (f"case {key} % 25 when 9 then 'P' || cast({key} as string)"
            f" when 14 then cast({key} as string) || '.5' else cast({key} as string) end")


def histos_columns(engine: str) -> list[tuple[str, str]]:
    """(header, expression over the wide histograms) of the histogram file."""
    bins = [(f"Bin{i}", f"cast(bin{i:02d} as string)") for i in range(1, 25)]
    return [
        ("DeployID", "case deploy_id % 10 when 3 then 'T' || cast(deploy_id as string)"
                     " when 7 then cast(deploy_id as string) || '.5' else cast(deploy_id as string) end"),
        ("Ptt", _tag_number("deploy_id")),
        ("Source", "case when deploy_id % 2 = 0 then 'transmission' else '' end"),
        ("HistType", "hist_type"),
        ("Date", _iso(engine, "hist_dt")),
        ("Time Offset", "'0'"),
        ("Count", "cast(day(hist_dt) as string)"),
        ("NumBins", "'24'"),
        ("Sum", "cast(length(hist_type) as string)"),
        *bins,
    ]


def locs_columns(engine: str) -> list[tuple[str, str]]:
    """(header, expression over ``events``) of the location file."""
    e = "event_id"
    lc = "element_at(array('3', '2', '1', '0', 'A', 'B', 'Z'), cast(event_id % 7 as int) + 1)"
    if engine == "duck":
        lc = "list_extract(['3', '2', '1', '0', 'A', 'B', 'Z'], cast(event_id % 7 as int) + 1)"
    return [
        ("tag-local-identifier", _tag_number("user_id")),
        ("timestamp", f"{_iso(engine, 'ts')} || case when {e} % 5 = 0 then '.000' else '' end"),
        ("location-lat", f"case when {e} % 11 = 0 then 'NA' else cast(60 + user_id % 20 as string)"
                         f" || '.' || lpad(cast({e} % 1000 as string), 3, '0') end"),
        ("location-long", f"case when {e} % 13 = 0 then '' else '-' || cast(150 + user_id % 30 as string)"
                          f" || '.' || lpad(cast({e} % 100 as string), 2, '0') end"),
        ("algorithm-marked-outlier", f"case {e} % 6 when 0 then '' when 1 then 'NA' else event_type end"),
        ("argos-altitude", "'0'"),
        ("argos-best-level", f"cast(-120 - {e} % 20 as string)"),
        ("argos-calcul-freq", "'401.65'"),
        ("argos-iq", f"cast({e} % 100 as string)"),
        ("argos-lat1", f"cast(60 + user_id % 20 as string) || '.5'"),
        ("argos-lon1", f"'-' || cast(150 + user_id % 30 as string) || '.25'"),
        ("argos-lat2", f"cast(61 + user_id % 20 as string) || '.5'"),
        ("argos-lon2", f"'-' || cast(151 + user_id % 30 as string) || '.25'"),
        ("argos-lc", lc),
        ("argos-nb-mes", f"cast({e} % 9 + 1 as string)"),
        ("argos-nb-mes-120", f"cast({e} % 3 as string)"),
        ("argos-nopc", f"cast({e} % 5 as string)"),
        ("argos-pass-duration", f"cast(100 + {e} % 500 as string)"),
        ("argos-sensor-1", f"cast({e} % 256 as string)"),
        ("argos-sensor-2", f"cast(({e} + 1) % 256 as string)"),
        ("argos-sensor-3", f"cast(({e} + 2) % 256 as string)"),
        ("argos-sensor-4", f"case when {e} % 4 = 0 then '' else cast(({e} + 3) % 256 as string) end"),
        ("argos-valid-location-algorithm", f"cast({e} % 2 + 1 as string)"),
        ("manually-marked-valid", f"case {e} % 4 when 0 then '' else 'true' end"),
        ("sensor-type", "'argos'"),
    ]


# ---------------------------------------------------------------------------
# Spark side: build, land in the shared folder in key order, read back.
# ---------------------------------------------------------------------------

def _land(df: DataFrame, spark: SparkSession, name: str, order: list[str]) -> str:
    path = track(scratch_path(spark, name))
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order).drop(*order)
    write_text_csv(ordered, path)
    return path


def _frame(src: DataFrame, columns: list[tuple[str, str]], order: list[str]) -> DataFrame:
    return src.selectExpr(*[f"{expr} as `{h}`" for h, expr in columns],
                          *[f"{o} as __ord_{o}" for o in order])


def deploy_file(spark: SparkSession, sf_dir: str) -> str:
    src = read_table(spark, sf_dir, "customer")
    return _land(_frame(src, deploy_columns("spark"), ["c_custkey"]), spark, "deploy",
                 ["__ord_c_custkey"])


def histos_file(spark: SparkSession, sf_dir: str) -> str:
    order = ["deploy_id", "hist_dt", "hist_type"]
    df = _frame(wide_histograms(spark, sf_dir), histos_columns("spark"), order)
    return _land(df, spark, "histos", [f"__ord_{o}" for o in order])


def locs_file(spark: SparkSession, sf_dir: str) -> str:
    src = read_table(spark, sf_dir, "events")
    return _land(_frame(src, locs_columns("spark"), ["event_id"]), spark, "locs",
                 ["__ord_event_id"])


def read_deploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_text_csv(spark, deploy_file(spark, sf_dir))


def read_histos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_text_csv(spark, histos_file(spark, sf_dir))


def read_locs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_text_csv(spark, locs_file(spark, sf_dir))
