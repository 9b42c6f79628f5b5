"""Partner-CSV cleanup into deployment, capture, histogram and location
tables (PRJ-8..PRJ-12, FN-1..FN-9, JOIN-2, JOIN-3, WIN-3).

Inputs are text DataFrames as ``sources.csv.read_text_csv`` returns them
(R-style header names).  Row ids are the row's position in its file
(R's ``1:n()`` right after the read), computed without a shuffle by
``operators.sequence.file_row_number``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.functions.casts import r_as_integer, try_double
from tagwave.functions.geo import make_point
from tagwave.functions.text import blank_to_null, exact_fix, r_text, replace_first_chain
from tagwave.functions.timefmt import parse_r_time
from tagwave.operators.joins import dimension, join_dimension
from tagwave.operators.sequence import file_row_number
from tagwave.sources.csv import col

# ---------------------------------------------------------------------------
# Partner header (as R names it) -> output column, in file order.
# ---------------------------------------------------------------------------
DEPLOY_RENAMES = {
    "PTT": "ptt",
    "tag_model": "tag_family_lku",
    "tag_manufacturer_name": "tag_manufacturer",
    "power_source": "tag_power",
    "location_algorithms": "location_alg",
    "deploy_on_timestamp": "deploy_dt",
    "deploy_location": "deploy_loc",
    "deploy_on_latitude": "deploy_lat",
    "deploy_on_longitude": "deploy_long",
    "attachment_type": "attachment_type",
    "deploy_off_timestamp": "end_dt",
    "deployment_end_type": "end_type",
    "mortality_type": "end_mortality_type",
}
CAPTURE_RENAMES = {
    "Animal_ID": "speno",
    "Species": "species_lku",
    "Fate": "fate",
    "animal_sex": "sex_lku",
    "animal_life_stage": "age_class_lku",
    "animal_mass_kg": "final_mass_kg",
    "CLAW_BANDS": "claw_bands",
    "LENGTH_STRAIGHT": "std_length_cm",
    "LENGTH_CURVED": "curv_length_cm",
    "GIRTH_AX": "ax_girth_cm",
    "CAPTURE_AREA": "capture_area",
    "CAPTURE_METHOD": "capture_method",
    "FLIPPER_ID_TAG": "flipper_tag",
    "FLIPPER_ID_TAG_COLOR": "flipper_tag_color",
    "FLIPPER_ID_TAG_SIDE": "flipper_tag_side",
    "UME": "ume",
    "AGENCY": "agency",
    "CREW": "crew",
    "PHOTOS": "photos",
    "ADDITIONAL_NOTES": "capture_notes",
}
HISTOS_RENAMES = {
    "DeployID": "deployid",
    "Source": "source",
    "HistType": "hist_type",
    "Date": "hist_dt",
    "Time.Offset": "time_offset",
    "Count": "hist_count",
    "NumBins": "num_bins",
    "Sum": "hist_sum",
    **{f"Bin{i}": f"bin{i:02d}" for i in range(1, S.N_BINS + 1)},
}
LOCS_RENAMES = {
    "tag.local.identifier": "deployid",
    "timestamp": "loc_dt",
    "location.lat": "loc_lat",
    "location.long": "loc_long",
    "algorithm.marked.outlier": "alg_marked_outlier",
    "argos.altitude": "argos_altitude",
    "argos.best.level": "argos_best_level",
    "argos.calcul.freq": "argos_calc_freq",
    "argos.iq": "argos_iq",
    "argos.lat1": "argos_lat1",
    "argos.lon1": "argos_long1",
    "argos.lat2": "argos_lat2",
    "argos.lon2": "argos_long2",
    "argos.lc": "argos_lc",
    "argos.nb.mes": "argos_nb_mes",
    "argos.nb.mes.120": "argos_nb_mes_120",
    "argos.nopc": "argos_nopc",
    "argos.pass.duration": "argos_pass_duration",
    "argos.sensor.1": "argos_sensor1",
    "argos.sensor.2": "argos_sensor2",
    "argos.sensor.3": "argos_sensor3",
    "argos.sensor.4": "argos_sensor4",
    "argos.valid.location.algorithm": "argos_valid_loc_alg",
    "manually.marked.valid": "manual_valid",
    "sensor.type": "sensor_type",
}

# Output columns, in order.
DEPLOY_COLUMNS = ["id", "capture_id", "deployid", "ptt", "tag_family_lku", "tag_manufacturer",
                  "tag_power", "location_alg", "deploy_dt", "deploy_loc", "deploy_lat",
                  "deploy_long", "attachment_type", "end_dt", "end_type", "end_mortality_type"]
CAPTURE_COLUMNS = ["id", "speno", "species_lku", "sex_lku", "age_class_lku", "fate",
                   "final_mass_kg", "claw_bands", "std_length_cm", "curv_length_cm",
                   "ax_girth_cm", "capture_area", "capture_method", "flipper_tag",
                   "flipper_tag_color", "flipper_tag_side", "ume", "agency", "crew", "photos",
                   "capture_notes"]
HISTOS_COLUMNS = ["id", "deploy_id", "deployid", "source", "hist_type", "hist_dt", "time_offset",
                  "hist_count", "num_bins", "hist_sum", *S.BIN_COLUMNS]
LOCS_COLUMNS = ["id", "deploy_id", "deployid", "loc_dt", "loc_lat", "loc_long",
                "alg_marked_outlier", "argos_altitude", "argos_best_level", "argos_calc_freq",
                "argos_iq", "argos_lat1", "argos_long1", "argos_lat2", "argos_long2", "argos_lc",
                "argos_nb_mes", "argos_nb_mes_120", "argos_nopc", "argos_pass_duration",
                "argos_sensor1", "argos_sensor2", "argos_sensor3", "argos_sensor4",
                "argos_valid_loc_alg", "manual_valid", "sensor_type"]

# Typed columns (R's read.csv would infer these as numbers); the rest stay text.
_DOUBLE = {"deploy_lat", "deploy_long", "final_mass_kg", "std_length_cm", "curv_length_cm",
           "ax_girth_cm", "time_offset", "hist_sum", *S.BIN_COLUMNS, "loc_lat", "loc_long",
           "argos_altitude", "argos_calc_freq", "argos_lat1", "argos_long1", "argos_lat2",
           "argos_long2"}
_INT = {"ptt", "hist_count", "num_bins", "argos_best_level", "argos_iq", "argos_nb_mes",
        "argos_nb_mes_120", "argos_nopc", "argos_pass_duration", "argos_sensor1",
        "argos_sensor2", "argos_sensor3", "argos_sensor4", "argos_valid_loc_alg"}


def _typed(name: str, c: Column) -> Column:
    t = r_text(c)
    if name in _DOUBLE:
        return try_double(t)
    if name in _INT:
        return r_as_integer(t)
    return t


def _renamed(df: DataFrame, renames: dict, keep: list[str] | None = None) -> DataFrame:
    """Rename R-named text columns and type them; ``keep`` lists extra
    columns passed through unchanged."""
    cols = [_typed(new, col(old)).alias(new) for old, new in renames.items() if old in df.columns]
    return df.select(*(keep or []), *cols)


FILE_ROW = "__file_row"


def number_file_rows(df: DataFrame, out: str = "id") -> DataFrame:
    """``mutate(id = 1:n())`` on a freshly read file (WIN-3).  Apply to the
    scan output, before any shuffle.  A frame already numbered with
    ``out=FILE_ROW`` (e.g. staged once for several tables) keeps its numbers."""
    if FILE_ROW in df.columns:
        return df if out == FILE_ROW else df.withColumnRenamed(FILE_ROW, out)
    return file_row_number(df, out=out)


def _all_numbers(df: DataFrame, tag: str) -> bool:
    """Whether R reads a column as numbers: every filled field parses."""
    t = r_text(col(tag))
    number = t.isNull() | (F.trim(t) == "") | try_double(t).isNotNull()
    return bool(df.agg(F.coalesce(F.bool_and(number), F.lit(True))).first()[0])


def join_deployments(rows: DataFrame, tag: str, renames: dict, deploy_text: DataFrame) -> DataFrame:
    """Rows of a partner file with the ``deploy_id`` (row id) of the deployments
    of their tag number: a left join in which a missing number matches a
    missing one, as dplyr does.

    Tag numbers are compared as numbers where both columns are numbers
    throughout (``12`` equals ``12.0``), else as the text in the file, so that
    ``07U100`` meets only itself.
    """
    rows, deploy = number_file_rows(rows), number_file_rows(deploy_text)
    numbers = _all_numbers(rows, tag) and _all_numbers(deploy, "PTT")

    def key(name: str) -> Column:
        t = r_text(col(name))
        return (try_double(t) if numbers else t).alias("__tag")

    # one row per deployment: broadcast after a size check, so the histogram
    # and location rows are never shuffled for this join
    keys = dimension(deploy.select(F.col("id").alias("deploy_id"), key("PTT")))
    tagged = rows.withColumns({"__tag": key(tag), "__ptt": r_as_integer(r_text(col(tag)))})
    return join_dimension(_renamed(tagged, renames, keep=["id", "__tag", "__ptt"]), keys, ["__tag"], "left",
                          null_safe=True)


def nsb_deploy(deploy_text: DataFrame, with_geom: bool = True) -> DataFrame:
    """Deployment table: ids from file order, ``deployid``/``ptt`` from the
    tag number, tag family first-match rewrites, text times parsed as UTC,
    blank mortality type -> null, point geometry from the deploy position."""
    d = number_file_rows(deploy_text)
    t = _renamed(d, DEPLOY_RENAMES, keep=["id"])
    t = t.withColumns({
        "capture_id": F.col("id"),
        "deployid": F.col("ptt"),
        "tag_family_lku": replace_first_chain(F.col("tag_family_lku"), S.TAG_FAMILY_RULES),
        "deploy_dt": parse_r_time(F.col("deploy_dt"), S.NSB_DEPLOY_TIME_FORMAT),
        "end_dt": parse_r_time(F.col("end_dt"), S.NSB_DEPLOY_TIME_FORMAT),
        "end_mortality_type": blank_to_null(F.col("end_mortality_type")),
    })
    out = t.select(*DEPLOY_COLUMNS)
    if with_geom:
        out = out.withColumn("geom", make_point(F.col("deploy_long"), F.col("deploy_lat")))
    return out


def nsb_capture(deploy_text: DataFrame) -> DataFrame:
    """Capture table from the same file: species and age-class codes
    (first-match rewrites, in order), blanks -> null on the listed columns,
    the ``open wate`` typo fixed."""
    d = number_file_rows(deploy_text)
    t = _renamed(d, CAPTURE_RENAMES, keep=["id"])
    fixes = {
        "species_lku": replace_first_chain(F.col("species_lku"), S.SPECIES_RULES),
        "age_class_lku": replace_first_chain(F.col("age_class_lku"), S.AGE_CLASS_RULES),
    }
    t = t.withColumns(fixes)
    t = t.withColumns({c: blank_to_null(F.col(c)) for c in S.CAPTURE_BLANK_COLUMNS})
    t = t.withColumn("capture_area", exact_fix(F.col("capture_area"), *S.CAPTURE_AREA_FIX))
    return t.select(*CAPTURE_COLUMNS)


def nsb_histos_raw(histos_text: DataFrame, deploy_text: DataFrame) -> DataFrame:
    """Raw histogram table: file-order ids, the deployment row id joined on
    the tag number (null-safe left join, like dplyr), zero-padded bin names,
    ``hist_dt`` parsed as UTC."""
    j = join_deployments(histos_text, "Ptt", HISTOS_RENAMES, deploy_text)
    j = j.withColumn("hist_dt", parse_r_time(F.col("hist_dt"), S.NSB_LOCS_TIME_FORMAT))
    return j.select(*HISTOS_COLUMNS)


def nsb_locs(locs_text: DataFrame, deploy_text: DataFrame, with_geom: bool = True) -> DataFrame:
    """Location table: file-order ids, deployment row id joined on the tag
    number, dotted headers renamed, time parsed as UTC, blank flags -> null,
    point geometry from the location."""
    j = join_deployments(locs_text, "tag.local.identifier", LOCS_RENAMES, deploy_text)
    j = j.withColumns({
        # the tag number joins the integer PTT upstream, so R read it as integer
        "deployid": F.col("__ptt"),
        "loc_dt": parse_r_time(F.col("loc_dt"), S.NSB_LOCS_TIME_FORMAT),
        **{c: blank_to_null(F.col(c)) for c in S.LOCS_BLANK_COLUMNS},
    })
    out = j.select(*LOCS_COLUMNS)
    if with_geom:
        out = out.withColumn("loc_geom", make_point(F.col("loc_long"), F.col("loc_lat")))
    return out


def blank_rules(text: DataFrame, blank_null: list[str]) -> DataFrame:
    """R's view of text columns (``""`` kept, ``NA`` missing), then
    blank -> null on the listed columns only (FN-5)."""
    out = text.select(*[r_text(col(c)).alias(c) for c in text.columns])
    return out.withColumns({c: blank_to_null(F.col(c)) for c in blank_null if c in out.columns})


def histogram_wide(histos_text: DataFrame) -> DataFrame:
    """A histogram file as a typed wide table: ``deployid`` (text),
    ``hist_type``, ``hist_dt`` (parsed as UTC), ``bin01..bin24``; the input of
    the tidy timeline."""
    t = _renamed(histos_text, HISTOS_RENAMES)
    t = t.withColumn("hist_dt", parse_r_time(F.col("hist_dt"), S.NSB_LOCS_TIME_FORMAT))
    return t.select("deployid", "hist_type", "hist_dt", *S.BIN_COLUMNS)
