"""Product registry, output column lists and the fixed values of the pipeline.

Everything that must equal the original pipeline's literal values sits in
the "fixed values" blocks below, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# QA status literals.
# ---------------------------------------------------------------------------
QA_UNREVIEWED = "unreviewed"
QA_REVIEWED = "reviewed"
QA_ACTIVE = "tag_actively_transmitting"
DATA_USE = "use"
DATA_DO_NOT_USE = "do_not_use"
EXPLAIN_UNREVIEWED = "unreviewed"
EXPLAIN_BEFORE = "records before deploy_dt"
EXPLAIN_AFTER = "records after end_dt"
EXPLAIN_BAD_LOCATION = "erroneous location"
EXPLAIN_BAD_SENSOR = "wet-dry sensors suspected to be compromised"

# Default triple written on load and by the QA reset.
QA_DEFAULTS = {
    "qa_status": QA_UNREVIEWED,
    "data_status": DATA_USE,
    "data_explain": EXPLAIN_UNREVIEWED,
}

# ---------------------------------------------------------------------------
# Import-status texts.
# ---------------------------------------------------------------------------
STATUS_IMPORTED = "imported"
STATUS_FAILED = "failed to import"
MISSING_CSV = "no CSV file"
MISSING_DIVEDEPTH = "no dive depth data in histos CSV file"
MISSING_DIVEDURATION = "no dive duration data in histos CSV file"
MISSING_TIMEATDEPTH = "no time at depth data in histos CSV file"
MISSING_TIMELINE = "no timeline data in histos CSV file"

# ---------------------------------------------------------------------------
# Known sensor / location faults, in the order they apply.
# (table, deployid, comparison, instant UTC, explanation)
# ---------------------------------------------------------------------------
KNOWN_ISSUES = [
    ("locs", "HF2010_1007_06L0129", "=", "2010-05-11 12:49:01", EXPLAIN_BAD_LOCATION),
    ("timeline", "EB2009_3000_09S0188", ">=", "2010-04-01 00:00:00", EXPLAIN_BAD_SENSOR),
    ("timeline", "EB2009_3001_08S0215", ">=", "2010-04-18 00:00:00", EXPLAIN_BAD_SENSOR),
    ("timeline", "EB2009_3002_09S0185", ">=", "2010-04-07 00:00:00", EXPLAIN_BAD_SENSOR),
    ("timeline", "EB2011_3000_10S0628", ">=", "2012-05-12 00:00:00", EXPLAIN_BAD_SENSOR),
    ("timeline", "EB2011_3001_09S1225", ">=", "2012-03-30 00:00:00", EXPLAIN_BAD_SENSOR),
    ("timeline", "EB2011_3002_10S0494", ">=", "2012-05-17 00:00:00", EXPLAIN_BAD_SENSOR),
    ("timeline", "EB2012_3003_10S0625", ">=", "2013-05-26 00:00:00", EXPLAIN_BAD_SENSOR),
    ("timeline", "EB2009_7010_08S0236", ">=", "2010-03-21 00:00:00", EXPLAIN_BAD_SENSOR),
]

# ---------------------------------------------------------------------------
# Partner-CSV code rewrites (first match only, applied in order).
# ---------------------------------------------------------------------------
TAG_FAMILY_RULES = [("Mk10", "MK10"), ("Splash", "SPLA")]
SPECIES_RULES = [("BeardedSeal", "Eb"), ("RingedSeal", "Ph"), ("SpottedSeal", "Pl")]
AGE_CLASS_RULES = [("Juv", "SUB"), ("Adult", "ADT"), ("Pup", "PUP"), ("Pup/Juv", "PSA")]
CAPTURE_AREA_FIX = ("open wate", "open water")

# Columns of the partner deployment CSV where a blank means "missing".
DEPLOY_BLANK_COLUMNS = ["end_mortality_type"]
CAPTURE_BLANK_COLUMNS = ["age_class_lku", "claw_bands", "flipper_tag_color",
                         "flipper_tag_side", "ume", "photos"]
LOCS_BLANK_COLUMNS = ["alg_marked_outlier", "manual_valid"]

# Time formats of the partner CSVs (Spark datetime patterns).
NSB_DEPLOY_TIME_FORMAT = "M/d/yyyy H:mm:ss"
NSB_LOCS_TIME_FORMAT = "yyyy-M-d H:mm:ss"
EXPORT_SOURCE_ZONE = "America/Vancouver"
POINT_SRID = 4326

HIST_TYPE_PERCENT = "Percent"
N_BINS = 24
BIN_COLUMNS = [f"bin{i:02d}" for i in range(1, N_BINS + 1)]


# ---------------------------------------------------------------------------
# Product registry: one row per loaded product, not six copies of code.
# Table names, renames and output columns, in output order.
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Product:
    name: str                 # key used in status reports (data_type)
    pos: int                  # position in the per-tag load order (1-based)
    table: str                # output table name
    time_col: str             # time column after renames (QA compares it)
    missing_text: str         # status when the tag's download lacks the product
    renames: dict = field(default_factory=dict)
    columns: tuple = ()       # output columns, in order
    has_qa: bool = True
    type_exempt: str | None = None  # value of `type` exempt from the before-deploy rule


ALLMSG = Product(
    "allmsg", 1, "tbl_wc_allmsg", "msg_dt", MISSING_CSV,
    renames={"loc_date": "loc_dt", "msg_date": "msg_dt"},
    columns=("id", "deploy_id", "deployid", "ptt", "prg_no", "latitude", "longitude",
             "loc_quality", "loc_dt", "loc_type", "altitude", "pass", "sat", "mote_id",
             "frequency", "msg_dt", "comp", "msg", "x120_db", "best_level", "delta_freq",
             "long_1", "lat_sol_1", "long_2", "lat_sol_2", "loc_idx", "nopc", "error_radius",
             "semi_major_axis", "semi_minor_axis", "ellipse_orientation", "gdop")
    + tuple(f"sensor_number_{i:02d}" for i in range(1, 33)),
    has_qa=False,
)
DIVEDEPTH = Product(
    "histos_divedepth", 2, "tbl_wc_histos_divedepth", "divedepth_dt", MISSING_DIVEDEPTH,
    columns=("id", "deploy_id", "deployid", "divedepth_dt", "bin", "num_dives",
             "qa_status", "data_status", "data_explain"),
)
DIVEDURATION = Product(
    "histos_diveduration", 3, "tbl_wc_histos_diveduration", "diveduration_dt",
    MISSING_DIVEDURATION,
    columns=("id", "deploy_id", "deployid", "diveduration_dt", "bin", "num_dives",
             "qa_status", "data_status", "data_explain"),
)
TIMEATDEPTH = Product(
    "histos_timeatdepth", 4, "tbl_wc_histos_timeatdepth", "tad_start_dt", MISSING_TIMEATDEPTH,
    columns=("id", "deploy_id", "deployid", "tad_start_dt", "bin", "pct_tad",
             "qa_status", "data_status", "data_explain"),
)
TIMELINE = Product(
    "histos_timeline", 5, "tbl_wc_histos_timeline", "timeline_start_dt", MISSING_TIMELINE,
    columns=("id", "deploy_id", "deployid", "hist_type", "timeline_start_dt", "percent_dry",
             "qa_status", "data_status", "data_explain"),
)
LOCS = Product(
    "locs", 6, "geo_wc_locs", "locs_dt", MISSING_CSV,
    renames={"date_time": "locs_dt", "count": "locs_count", "offset": "locs_offset"},
    columns=("id", "deploy_id", "deployid", "ptt", "instr", "locs_dt", "type", "quality",
             "latitude", "longitude", "error_radius", "error_semi_major_axis",
             "error_semi_minor_axis", "error_ellipse_orientation", "locs_offset",
             "offset_orientation", "gpe_msd", "gpe_u", "locs_count", "comment",
             "qa_status", "data_status", "data_explain"),
    type_exempt="User",
)
# Behaviour records: the loader was switched off upstream, but QA still flags
# the table; its "time" column for the QA rules is `end_dt`.
BEHAV = Product(
    "behav", 7, "tbl_wc_behav", "end_dt", MISSING_CSV,
    renames={"count": "message_count", "start": "start_dt", "end": "end_dt"},
    columns=("id", "deploy_id", "deployid", "ptt", "depth_sensor", "source", "instr",
             "message_count", "start_dt", "end_dt", "what", "number", "shape", "depth_min",
             "depth_max", "duration_min", "duration_max", "shallow", "deep",
             "qa_status", "data_status", "data_explain"),
)

# ---------------------------------------------------------------------------
# Names of the products inside one tag's download, and the
# location sources in order of preference.
# ---------------------------------------------------------------------------
LANDED_NAMES = {
    "allmsg": "messages",
    "histos_divedepth": "dive_depths",
    "histos_diveduration": "dive_durations",
    "histos_timeatdepth": "time_depth",
    "histos_timeline": "timelines",
}
LOCATION_SOURCES = ["all_locations", "locations"]
BEHAV_LANDED_NAME = "behavior"

# ---------------------------------------------------------------------------
# Optional products (their loaders are switched off upstream),
# read from CSV files with snake-case header names; renames and output columns.
# ---------------------------------------------------------------------------
EXTRA_TIME_FORMAT = "H:mm:ss d-MMM-yyyy"
CORRUPT = Product(
    "corrupt", 8, "tbl_wc_corrupt", "corrupt_dt", MISSING_CSV,
    renames={"date": "corrupt_dt", "possible_timestamp": "possible_dt"},
    columns=("id", "deploy_id", "deployid", "ptt", "instr", "corrupt_dt", "duplicates", "satellite",
             "location_quality", "latitude", "longitude", "reason", "possible_dt", "possible_type")
    + tuple(f"byte_{i}" for i in range(32)),
    has_qa=False,
)
STATUS = Product(
    "status", 9, "tbl_wc_status", "received_dt", MISSING_CSV,
    renames={"received": "received_dt", "rtc": "rtc_dt", "release_time": "release_dt"},
    columns=("id", "deploy_id", "deployid", "ptt", "depth_sensor", "instr", "sw", "rtc_dt", "received_dt",
             "time_offset", "location_quality", "latitude", "longitude", "type", "hauled_out",
             "broken_thermistor", "broken_link", "transmits", "batt_voltage", "transmit_voltage",
             "transmit_current", "temperature", "depth", "max_depth", "zero_depth_offset", "light_level",
             "no_dawn_dusk", "release_type", "release_dt", "initially_broken", "burn_minutes",
             "release_depth", "fast_gps_power", "twic_power", "power_limit", "wet_dry", "min_wet_dry",
             "max_wet_dry", "wet_dry_threshold", "status_word", "transmit_power", "resets",
             "pre_release_tilt", "pre_release_tilt_sd", "pre_release_tilt_count", "xmit_queue",
             "fast_gps_loc_number", "fast_gps_failures", "batt_discon"),
    has_qa=False,
)
HAULOUT = Product(
    "haulout", 10, "tbl_wc_haulout", "haulout_start_dt", MISSING_CSV,
    renames={"id": "haulout_identifier", "start": "haulout_start_dt", "end": "haulout_end_dt"},
    columns=("id", "deploy_id", "deployid", "ptt", "instr", "haulout_identifier", "haulout_start_dt",
             "haulout_end_dt", "duration", "location_quality"),
    has_qa=False,
)
EXTRAS = [CORRUPT, STATUS, HAULOUT]

# Columns whose values are neither text nor told by their name.
DECLARED_TYPES = {"id": "long", "deploy_id": "long", "latitude": "double", "longitude": "double",
                  "num_dives": "double", "pct_tad": "double", "percent_dry": "double", "message_count": "long"}


def column_type(name: str) -> str:
    """Declared type of an output column: as in ``DECLARED_TYPES``, zone-less
    time for ``*_dt``, else text.  It never depends on what landed."""
    return DECLARED_TYPES.get(name, "timestamp_ntz" if name.endswith("_dt") else "string")


def landed_types(product: Product) -> dict[str, str]:
    """Declared type of every column a tag's file of this product must hold
    (all output columns but those the load makes), under its landed name."""
    landed = {new: old for old, new in product.renames.items()}
    made = {"id", "deploy_id", "deployid", *QA_DEFAULTS}
    return {landed.get(c, c): column_type(c) for c in product.columns if c not in made}


# Load order of the per-tag loop (positions 1..6).
LOAD_ORDER = [ALLMSG, DIVEDEPTH, DIVEDURATION, TIMEATDEPTH, TIMELINE, LOCS]
PRODUCTS = {p.name: p for p in LOAD_ORDER + [BEHAV]}
