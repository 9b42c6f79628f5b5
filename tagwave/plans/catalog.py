"""Registered queries: one per operator key of the blueprint.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables (no samples, no id subsets).  Column names match the DuckDB
oracles in ``tagwave.plans.oracle``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.functions.geo import with_point
from tagwave.functions.text import blank_to_null, r_text, replace_first_chain
from tagwave.jobs import STATUS_TABLE, Landing, histogram_job, load_job
from tagwave.operators import cleanup as C
from tagwave.operators import deploy as D
from tagwave.operators import export as X
from tagwave.operators import extras as EX
from tagwave.operators import histogram as H
from tagwave.operators import load as L
from tagwave.operators import qa as Q
from tagwave.operators import status as ST
from tagwave.operators.sequence import parquet_position, surrogate_ids
from tagwave.operators.stage import stage, track
from tagwave.plans import bindings as B
from tagwave.plans import landed_files as LF
from tagwave.plans import partner_files as PF
from tagwave.session import scratch_path
from tagwave.sources.csv import read_text_csv, write_text_csv
from tagwave.sources.tables import read_table

# Stand-in known-issue rules for the test tables (deployids there are numbers):
# a sensor rule from an instant on, and a later location rule on another tag.
TEST_RULES = [
    ("records", "8", ">=", "2024-01-15 00:00:00", S.EXPLAIN_BAD_SENSOR),
    ("records", "89", ">=", "2024-01-25 00:00:00", S.EXPLAIN_BAD_LOCATION),
]
# In the test records the `type` value exempt from the before-deployment rule.
TEST_EXEMPT_TYPE = "error"


def q_deploy_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.eligible_tags(B.deployments(spark, sf_dir))


def q_qa_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.reset(B.records(spark, sf_dir).select("seq"))


def q_qa_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.flag_active(B.records(spark, sf_dir).select("seq", "deployid"),
                         B.deployments(spark, sf_dir)).select("seq")


def q_qa_before_deploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = B.records(spark, sf_dir).select("seq", "deployid", "dt")
    return Q.flag_before(r, B.deployments(spark, sf_dir), "dt").select("seq")


def q_qa_after_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = B.records(spark, sf_dir).select("seq", "deployid", "dt")
    return Q.flag_after(r, B.deployments(spark, sf_dir), "dt").select("seq")


def q_qa_known_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = B.records(spark, sf_dir).select("seq", "deployid", "dt")
    return Q.flag_known(r, TEST_RULES, "dt").select("seq")


def q_qa_locs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = B.records(spark, sf_dir).select("seq", "deployid", "dt", "type")
    return Q.flag_before(r, B.deployments(spark, sf_dir), "dt", TEST_EXEMPT_TYPE).select("seq")


def q_qa_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = B.records(spark, sf_dir).select("seq", "deployid", "dt", "type")
    out = Q.apply_qa(r, B.deployments(spark, sf_dir), "dt", TEST_EXEMPT_TYPE, TEST_RULES)
    return out.select("seq", "qa_status", "data_status", "data_explain")


# -- loading ----------------------------------------------------------------

def _raw_rows(spark: SparkSession, sf_dir: str, product: S.Product) -> DataFrame:
    if product.name == "locs":
        return L.prefer_sources(B.location_sources(spark, sf_dir), B.location_files(spark, sf_dir))
    return B.product_rows(spark, sf_dir, product.name)


def _routing(spark: SparkSession, sf_dir: str, upto: int = len(S.LOAD_ORDER)):
    """Eligible tags, the landed rows of position ``upto`` and per-tag outcomes
    for positions ``1..upto`` (an outcome depends on earlier positions only;
    one scan tells which products have rows)."""
    tags = D.eligible_tags(B.deployments(spark, sf_dir))
    rows = {p.pos: _raw_rows(spark, sf_dir, p) for p in S.LOAD_ORDER if p.pos == upto}
    presence = B.product_presence(spark, sf_dir).where(F.col("pos") <= upto)
    landing = B.landing_log(spark, sf_dir).where(F.col("pos") <= upto)
    # One row per (tag, position): staged once, read by every product's load.
    outcomes = stage(ST.tag_outcomes(tags, landing, presence, n_products=upto), "outcomes")
    return tags, rows, outcomes


def _point_parts(df: DataFrame, name: str) -> DataFrame:
    """Locations with the parts of their point as columns."""
    if name not in df.columns:
        df = with_point(df, "longitude", "latitude", name)
    g = F.col(name)
    return df.withColumns({f"{name}_{part}": g[part] for part in ("x", "y", "srid")}).drop(name)


def _load(product: S.Product, points: bool = True) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _tags, rows, outcomes = _routing(spark, sf_dir, upto=product.pos)
        keys = ST.loaded_keys(outcomes)
        out = L.load_product(rows[product.pos], ST.loadable_tags(keys, product.pos), product)
        return _point_parts(out, "geom") if product is S.LOCS and points else out
    run.__name__ = f"q_load_{product.name}"
    return run


def _qa_loaded(product: S.Product) -> Callable[[SparkSession, str], DataFrame]:
    """A loaded product table flagged with the production QA settings of
    that table (time column, ``User`` exemption, the real fault list)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        loaded = _load(product, points=False)(spark, sf_dir)
        return Q.qa_table(loaded, B.deployments(spark, sf_dir), product)
    run.__name__ = f"q_qa_loaded_{product.name}"
    return run


def q_qa_loaded_behav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour records (loader switched off upstream, QA still flags them):
    every eligible tag's rows loaded with ids, then flagged on ``end_dt``."""
    deployments = B.deployments(spark, sf_dir)
    loaded = L.load_product(B.behaviour_rows(spark, sf_dir), D.eligible_tags(deployments), S.BEHAV)
    return Q.qa_table(loaded, deployments, S.BEHAV)


def q_surrogate_id_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = B.records(spark, sf_dir).select("deployid", "seq")
    return surrogate_ids(r, "deployid", ["seq"]).select("id", "deployid", "seq")


def q_locs_source_pref(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = L.prefer_sources(B.location_sources(spark, sf_dir), B.location_files(spark, sf_dir))
    return kept.select("deployid", "seq", "pref")


def _status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _tags, _rows, outcomes = _routing(spark, sf_dir)
    return ST.status_of_outcomes(outcomes)


def q_import_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_report(spark, sf_dir)


def q_import_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.import_failures(_status_report(spark, sf_dir))


def q_import_short_circuit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _tags, _rows, outcomes = _routing(spark, sf_dir)
    return ST.short_circuit_report(outcomes)


# -- landed files -------------------------------------------------------------

def q_landed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landed, judged by the files' footers."""
    return Landing(spark, LF.land_products(spark, sf_dir)).products.select(
        "deployid", "product", "rows", "state", "reason")


def q_reload_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status report the load job wrote, after reading its tables back."""
    out = track(scratch_path(spark, "tables"))
    paths = load_job(spark, LF.deployments(spark, sf_dir), LF.land_products(spark, sf_dir), None, out)
    return spark.read.parquet(paths[STATUS_TABLE])


def _extra(product: S.Product) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = EX.read_extra(spark, LF.land_extra(spark, sf_dir, product), product)
        return EX.load_extra(files, D.eligible_tags(LF.deployments(spark, sf_dir)), product)
    run.__name__ = f"q_load_{product.name}"
    return run


def q_extras_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of the optional products, from their tables read back."""
    tags, parts = D.eligible_tags(LF.deployments(spark, sf_dir)), []
    for p in S.EXTRAS:
        files = EX.read_extra(spark, LF.land_extra(spark, sf_dir, p), p)
        loaded = stage(EX.load_extra(files, tags, p), p.table)
        parts.append(EX.extra_status(files, tags, loaded, p))
    return functools.reduce(DataFrame.unionByName, parts).select("data_type", "deployid", "status")


# -- histograms -------------------------------------------------------------

def q_timeline_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.timeline_unpivot(B.wide_histograms(spark, sf_dir).drop("hist_type"))


def q_tidy_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a landed CSV file, with ids that are not whole numbers."""
    return H.tidy_timeline(C.histogram_wide(PF.read_histos(spark, sf_dir)))


def q_timeline_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline inserted into a table, read back in the order of its files
    and rows (``position``)."""
    path = track(scratch_path(spark, "timeline"))
    histogram_job(B.wide_histograms(spark, sf_dir).drop("hist_type"), path)
    back = parquet_position(spark.read.parquet(path))
    return back.select("position", "id", "deploy_id", "deployid", "hist_type", "timeline_start_dt", "percent_dry")


# -- partner CSV cleanup ----------------------------------------------------

def q_nsb_deploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.nsb_deploy(PF.read_deploy(spark, sf_dir), with_geom=False)


def q_nsb_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.nsb_capture(PF.read_deploy(spark, sf_dir))


def q_nsb_histos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.nsb_histos_raw(PF.read_histos(spark, sf_dir), PF.read_deploy(spark, sf_dir))


def q_nsb_locs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _point_parts(C.nsb_locs(PF.read_locs(spark, sf_dir), PF.read_deploy(spark, sf_dir)), "loc_geom")


def q_point_geom(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.nsb_deploy(PF.read_deploy(spark, sf_dir), with_geom=True)
    g = F.col("geom")
    return d.select("id", g["x"].alias("x"), g["y"].alias("y"), g["srid"].alias("srid"))


def _deploy_expr(header: str) -> str:
    return dict(PF.deploy_columns("spark"))[header]


def q_tag_family_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    model = F.expr(_deploy_expr("tag_model"))
    return c.select("c_custkey", replace_first_chain(model, S.TAG_FAMILY_RULES).alias("tag_family_lku"))


def q_species_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    sp = F.expr(_deploy_expr("Species"))
    return c.select("c_custkey", replace_first_chain(sp, S.SPECIES_RULES).alias("species_lku"))


def q_age_class_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    age = replace_first_chain(F.expr(_deploy_expr("animal_life_stage")), S.AGE_CLASS_RULES)
    return c.select("c_custkey", blank_to_null(age).alias("age_class_lku"))


def q_csv_blank_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land a CSV with empty, ``NA`` and filled fields, read it back as R
    would, blank -> null on ``photos`` only (``agency`` keeps ``""``)."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    field = (F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit(None).cast("string"))
              .otherwise(F.col("p_type")))
    path = track(scratch_path(spark, "blank-rules"))
    write_text_csv(p.select(k.cast("string").alias("p_partkey"), field.alias("photos"),
                            field.alias("agency")), path)
    text = read_text_csv(spark, path, header=["p_partkey", "photos", "agency"])
    out = C.blank_rules(text, ["photos"])
    return out.select(F.col("p_partkey").cast("long").alias("p_partkey"), "photos", "agency")


# -- export -------------------------------------------------------------------

def q_atn_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.export_rows(B.tag_details(spark, sf_dir))


def q_export_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export written as CSV parts and read back, typed again."""
    rows = X.export_rows(B.tag_details(spark, sf_dir))
    path = track(scratch_path(spark, "export"))
    X.write_export(rows, path)
    text = read_text_csv(spark, path, header=X.EXPORT_COLUMNS)
    return text.select(*[r_text(F.col(c)).try_cast(t).alias(c) for c, t in rows.dtypes])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "deploy_eligible": q_deploy_eligible,
    "qa_reset": q_qa_reset,
    "qa_active": q_qa_active,
    "qa_before_deploy": q_qa_before_deploy,
    "qa_after_end": q_qa_after_end,
    "qa_known_issues": q_qa_known_issues,
    "qa_locs": q_qa_locs,
    "qa_full": q_qa_full,
    "surrogate_id_load": q_surrogate_id_load,
    "load_allmsg": _load(S.ALLMSG),
    "load_divedepth": _load(S.DIVEDEPTH),
    "load_diveduration": _load(S.DIVEDURATION),
    "load_timeatdepth": _load(S.TIMEATDEPTH),
    "load_timeline": _load(S.TIMELINE),
    "load_locs": _load(S.LOCS),
    "locs_source_pref": q_locs_source_pref,
    "qa_loaded_locs": _qa_loaded(S.LOCS),
    "qa_loaded_timeline": _qa_loaded(S.TIMELINE),
    "qa_loaded_behav": q_qa_loaded_behav,
    "import_status": q_import_status,
    "import_failures": q_import_failures,
    "import_short_circuit": q_import_short_circuit,
    "landed_states": q_landed_states,
    "reload_status": q_reload_status,
    "load_corrupt": _extra(S.CORRUPT),
    "load_status": _extra(S.STATUS),
    "load_haulout": _extra(S.HAULOUT),
    "extras_status": q_extras_status,
    "timeline_unpivot": q_timeline_unpivot,
    "timeline_insert": q_timeline_insert,
    "tidy_timeline": q_tidy_timeline,
    "nsb_deploy": q_nsb_deploy,
    "nsb_capture": q_nsb_capture,
    "nsb_histos_raw": q_nsb_histos_raw,
    "nsb_locs": q_nsb_locs,
    "point_geom": q_point_geom,
    "tag_family_norm": q_tag_family_norm,
    "species_code": q_species_code,
    "age_class_code": q_age_class_code,
    "csv_blank_rules": q_csv_blank_rules,
    "atn_export": q_atn_export,
    "export_file": q_export_file,
}
