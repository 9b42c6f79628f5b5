"""DuckDB SQL oracles, one per registered query.

The driver registers the test tables as views; the shared domain views
(the same derivations as ``tagwave.plans.bindings``) are written as CTEs so
every oracle is one self-contained statement.

Where the original works step by step, so do the oracles: flags are updates in
order, each selecting its rows through joins and ``IN``; ids are bases carried
from tag to tag; the timeline is a union of 24 branches.
"""

from __future__ import annotations

from tagwave import schemas as _S
from tagwave.plans import bindings as _B
from tagwave.plans import landed_files as _LF
from tagwave.plans import partner_files as _PF

# -- shared derivations (mirror tagwave.plans.bindings) ---------------------
def _tag_id(number: str) -> str:
    return (f"case {number} " + " ".join(f"when {n} then '{d}'" for n, d in _B.FAULT_TAGS.items())
            + f" else cast({number} as varchar) end")


def _deployment_tag(number: str) -> str:
    return f"case when {number} = {_B.BLANK_TAG} then '' else {_tag_id(number)} end"


DEP = f"""dep as (
  select c_custkey as id,
    {_deployment_tag("(case when c_custkey % 11 = 0 then c_custkey - 1 else c_custkey end)")} as deployid,
    case when c_custkey % 11 = 0 then timestamp '2024-01-03' + to_days(cast(c_custkey % 7 + 1 as int))
         when c_custkey % 13 = 0 then null
         else timestamp '2024-01-03' + to_days(cast(c_custkey % 5 as int)) end as deploy_dt,
    case when c_custkey % 22 = 0 then timestamp '2024-01-20' + to_days(cast(c_custkey % 9 as int))
         when c_custkey % 11 = 0 then timestamp '2024-01-03' + to_days(cast(c_custkey % 7 + 1 as int))
         when c_custkey % 7 = 0 then null
         when c_custkey % 17 = 0 then timestamp '2024-01-03' + to_days(cast(c_custkey % 5 as int))
         else timestamp '2024-01-20' + to_days(cast(c_custkey % 9 as int)) end as end_dt,
    c_nationkey as capture_event_id
  from customer)"""

REC = f"""rec as (
  select event_id as seq, {_tag_id("user_id")} as deployid, ts as dt,
         event_type as type, value, user_id as tag from events)"""

def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _chosen(table: str, key: str, condition: str) -> str:
    """Keys of the rows an update applies to: some deployment row meets ``condition``."""
    return f"""(select g.{key} from {table} g left join dep d using (deployid)
        left join nation e on d.capture_event_id = e.n_nationkey where {condition})"""


def _updates(table: str, key: str, dt: str, exempt: str | None = None, faults=()) -> str:
    """The updates of ``table`` in order, as CTEs; the last is ``flagged``."""
    before = f"g.{dt} < d.deploy_dt" + (f" and g.type <> '{exempt}'" if exempt else "")
    steps = [("'tag_actively_transmitting'", None, None, f"{key} in {_chosen(table, key, 'd.end_dt is null')}"),
             ("'reviewed'", "'do_not_use'", "'records before deploy_dt'", f"{key} in {_chosen(table, key, before)}"),
             ("'reviewed'", "'do_not_use'", "'records after end_dt'",
              f"{key} in {_chosen(table, key, f'g.{dt} > d.end_dt')}")]
    steps += [("'reviewed'", "'do_not_use'", f"'{why}'", f"deployid = '{tag}' and {dt} {op} timestamp '{at}'")
              for tag, op, at, why in faults]
    ctes = [f"""u0 as (select *, 'unreviewed' as qa_status, 'use' as data_status,
      'unreviewed' as data_explain from {table})"""]
    for i, (*values, where) in enumerate(steps, 1):
        new = ", ".join(f"case when {where} then {v} else {c} end as {c}"
                        for c, v in zip(("qa_status", "data_status", "data_explain"), values) if v)
        ctes.append(f"u{i} as materialized (select * replace ({new}) from u{i - 1})")
    return ",\n".join([*ctes, f"flagged as (select * from u{len(steps)})"])


# Known-issue stand-in rules (see catalog.TEST_RULES); the later rule wins.
TEST_FAULTS = [("8", ">=", "2024-01-15", "wet-dry sensors suspected to be compromised"),
               ("89", ">=", "2024-01-25", "erroneous location")]

ORACLES: dict[str, str] = {
    "deploy_eligible": _with(DEP) + """select id as deploy_id, deployid from dep
      where (deploy_dt <> end_dt) or (deploy_dt is not null and end_dt is null)""",

    "qa_reset": """select event_id as seq, 'unreviewed' as qa_status, 'use' as data_status,
      'unreviewed' as data_explain from events""",

    "qa_active": _with(DEP, REC) + f"select seq from rec where seq in {_chosen('rec', 'seq', 'd.end_dt is null')}",

    "qa_before_deploy": _with(DEP, REC)
    + f"select seq from rec where seq in {_chosen('rec', 'seq', 'g.dt < d.deploy_dt')}",

    "qa_after_end": _with(DEP, REC) + f"select seq from rec where seq in {_chosen('rec', 'seq', 'g.dt > d.end_dt')}",

    "qa_known_issues": _with(REC) + "select seq from rec where " + " or ".join(
        f"(deployid = '{tag}' and dt {op} timestamp '{at}')" for tag, op, at, _ in TEST_FAULTS),

    "qa_locs": _with(DEP, REC) + f"""select seq from rec where seq in
      {_chosen('rec', 'seq', "g.dt < d.deploy_dt and g.type <> 'error'")}""",

    "qa_full": _with(DEP, REC, _updates("rec", "seq", "dt", "error", TEST_FAULTS))
    + "select seq, qa_status, data_status, data_explain from flagged",
}


# -- loading: landing log, products, routing --------------------------------
TAGS = """tags as (select id as deploy_id, deployid from dep
  where (deploy_dt <> end_dt) or (deploy_dt is not null and end_dt is null))"""

LAND = f"""land as (
  select {_deployment_tag("c_custkey")} as deployid, g.pos,
    case when (c_custkey * 7 + g.pos) % 23 = 0 then 'error'
         when (c_custkey + g.pos) % 9 = 0 then 'absent' else 'present' end as state
  from customer, (select cast(unnest(range(1, 7)) as bigint) as pos) g)"""



def _landed(name: str, more: dict | None = None) -> str:
    """A product's landed columns from ``rec`` (the rules of ``bindings``)."""
    product, taken, cols = _S.PRODUCTS[name], {**_B.TAKEN[name], **(more or {})}, []
    for out, src in _B.landed_columns(product):
        kind, period = _B.filler(product, out)
        if src in taken:
            c = taken[src]
        elif kind == "percent":
            c = "'Percent'"
        elif kind == "time":
            c = f"dt + to_minutes(cast(seq % {period} as int))"
        elif kind in ("lat", "long"):
            n, off = (179, 89) if kind == "lat" else (359, 179)
            c = f"case when seq % 29 <> 0 then cast(seq % {n} - {off} as double) end"
        else:
            c = f"'{out} ' || cast(seq % {period} as varchar)"
        cols.append(f'{c} as "{src}"')
    return ", ".join(["seq", "deployid", *cols])


_LOC_TYPE = {
    "date_time": f"""case when tag = {_B.LOCATION_FAULT_TAG} and seq % 2 = 0
      then timestamp '2010-05-11 12:49:01' else dt end""",
    "type": "case when seq % 5 = 0 then 'User' when seq % 7 <> 0 then type end"}

PRODUCT_CTES = [
    f"p1 as (select {_landed('allmsg')} from rec)",
    f"p2 as (select {_landed('histos_divedepth')} from rec where type = 'click')",
    f"p3 as (select {_landed('histos_diveduration')} from rec where type = 'view')",
    f"p4 as (select {_landed('histos_timeatdepth')} from rec where type = 'purchase')",
    f"p5 as (select {_landed('histos_timeline')} from rec where type = 'signup')",
    f"""lsrc as (
  select {_landed('locs', _LOC_TYPE)}, 1 as pref from rec where type = 'error' and tag % 3 = 0
  union all select {_landed('locs', _LOC_TYPE)}, 2 as pref from rec
    where type = 'view' or (type = 'error' and tag % 3 <> 0))""",
    """lfiles as (select distinct deployid, 1 as pref from rec where tag % 3 = 0
  union all select distinct deployid, 2 as pref from rec)""",
    """p6 as (select l.* from lsrc l
  join (select deployid, min(pref) as best from lfiles group by 1) b using (deployid)
  where l.pref = b.best)""",
]

ROUTING = [
    "pres as (" + " union all ".join(
        f"select distinct deployid, cast({i} as bigint) as pos from p{i}" for i in range(1, 7)) + ")",
    """st as (
  select t.deploy_id, t.deployid, g.pos,
    case when l.state is null then 'error'
         when l.state = 'present' and pr.deployid is null then 'error' else l.state end as state
  from tags t cross join (select cast(unnest(range(1, 7)) as bigint) as pos) g
  left join land l on l.deployid = t.deployid and l.pos = g.pos
  left join pres pr on pr.deployid = t.deployid and pr.pos = g.pos)""",
    """outc as (
  select deploy_id, deployid, pos, state,
    case when pos >= min(case when state = 'error' then pos end) over (partition by deployid, deploy_id)
           then 'failed'
         when state = 'absent' then 'missing' else 'loaded' end as outcome
  from st)""",
]

LOAD_PRELUDE = _with(DEP, REC, TAGS, LAND, *PRODUCT_CTES, *ROUTING)

_QA_DEFAULT_COLS = "'unreviewed' as qa_status, 'use' as data_status, 'unreviewed' as data_explain"


def _columns(name: str) -> str:
    """Landed columns under their output names."""
    return ", ".join(f'x."{src}" as "{out}"' for out, src in _B.landed_columns(_S.PRODUCTS[name]))


def _loop_ids(rows: str, tag: str, order: str) -> str:
    """CTEs of the load loop's ids: each tag's base is what the tags before it
    left as ``max(id)``, plus one; ``numbered`` has the rows of ``rows``."""
    return f"""
      held as (select {tag}, count(*) as n from {rows} group by {tag}),
      bases as (select {tag}, 1 + coalesce(sum(n + 1) over (
          order by {tag} rows between unbounded preceding and 1 preceding), 0) as base from held),
      numbered as (select r.*, cast(row_number() over (partition by {tag} order by {order}) + base as bigint) as id
        from {rows} r join bases using ({tag}))"""


def _load_ctes(name: str, listed: str, source: str) -> str:
    """A product loaded tag by tag: every listed row fetches its tag, numbers the
    rows and joins the list.  ``loaded`` has the table without QA columns."""
    return f"""
      listed as ({listed}),
      fetches as (select deployid, row_number() over (partition by deployid) as go from listed),
      fetched as (select f.go, x.* from fetches f join {source} x using (deployid)),
      {_loop_ids("fetched", "deployid, go", "seq")},
      loaded as (select x.id, t.deploy_id, x.deployid, {_columns(name)}
        from numbered x left join listed t on t.deployid is not distinct from x.deployid)"""


def _product(name: str) -> str:
    pos = _S.PRODUCTS[name].pos
    return LOAD_PRELUDE + ", " + _load_ctes(
        name, f"select deploy_id, deployid from outc where pos = {pos} and outcome = 'loaded'", f"p{pos}")


def _load_sql(name: str, qa: bool = True) -> str:
    return _product(name) + "select *" + (f", {_QA_DEFAULT_COLS}" if qa else "") + " from loaded"


def _qa_loaded_sql(name: str, dt: str, faults, exempt: str | None = None) -> str:
    return _product(name) + ", " + _updates("loaded", "id", dt, exempt, faults) + " select * from flagged"


# The production fault list, in the order it applies.
_LOCS_FAULTS = [("HF2010_1007_06L0129", "=", "2010-05-11 12:49:01", "erroneous location")]
_TIMELINE_FAULTS = [(tag, ">=", f"{day} 00:00:00", "wet-dry sensors suspected to be compromised") for tag, day in [
    ("EB2009_3000_09S0188", "2010-04-01"), ("EB2009_3001_08S0215", "2010-04-18"),
    ("EB2009_3002_09S0185", "2010-04-07"), ("EB2011_3000_10S0628", "2012-05-12"),
    ("EB2011_3001_09S1225", "2012-03-30"), ("EB2011_3002_10S0494", "2012-05-17"),
    ("EB2012_3003_10S0625", "2013-05-26"), ("EB2009_7010_08S0236", "2010-03-21"),
]]


# Report texts and code rules, as in tagwave.schemas.
MISSING_TEXT = {
    1: "no CSV file",
    2: "no dive depth data in histos CSV file",
    3: "no dive duration data in histos CSV file",
    4: "no time at depth data in histos CSV file",
    5: "no timeline data in histos CSV file",
    6: "no CSV file",
}
DATA_TYPE = {1: "allmsg", 2: "histos_divedepth", 3: "histos_diveduration",
             4: "histos_timeatdepth", 5: "histos_timeline", 6: "locs"}

_STATUS_PARTS = " union all ".join(
    f"""select '{DATA_TYPE[i]}' as data_type, deployid, status from (
      with imp as (select distinct x.deployid from p{i} x
                   join outc o on o.deployid = x.deployid and o.pos = {i} and o.outcome = 'loaded'),
      miss as (select deployid from outc where pos = {i} and outcome = 'missing' and deployid <> ''),
      done as (select deployid, 'imported' as status from imp
               union all select deployid, '{MISSING_TEXT[i]}' as status from miss)
      select deployid, status from done
      union all select deployid, 'failed to import' as status from (
        select deployid from tags except select deployid from done))"""
    for i in range(1, 7))

ORACLES.update({
    "surrogate_id_load": _with(REC, _loop_ids("rec", "deployid", "seq")) + "select id, deployid, seq from numbered",
    "load_allmsg": _load_sql("allmsg", qa=False),
    "load_divedepth": _load_sql("histos_divedepth"),
    "load_diveduration": _load_sql("histos_diveduration"),
    "load_timeatdepth": _load_sql("histos_timeatdepth"),
    "load_timeline": _load_sql("histos_timeline"),
    "load_locs": _product("locs") + f"""
      select *, {_QA_DEFAULT_COLS}, case when latitude is not null then longitude end as geom_x,
        case when longitude is not null then latitude end as geom_y,
        case when longitude is not null and latitude is not null then 4326 end as geom_srid from loaded""",
    "qa_loaded_locs": _qa_loaded_sql("locs", "locs_dt", _LOCS_FAULTS, "User"),
    "qa_loaded_timeline": _qa_loaded_sql("histos_timeline", "timeline_start_dt", _TIMELINE_FAULTS),
    "locs_source_pref": _with(REC, *PRODUCT_CTES[5:])
    + "select deployid, seq, pref from p6",
    "import_status": LOAD_PRELUDE + _STATUS_PARTS,
    "import_failures": LOAD_PRELUDE + f"select * from ({_STATUS_PARTS}) where status = 'failed to import'",
    "import_short_circuit": LOAD_PRELUDE + """select deployid, pos,
      case outcome when 'failed' then 'failed to import' when 'missing' then 'missing'
           else 'imported' end as status from outc""",
})


# -- histograms ---------------------------------------------------------------
_BIN_AGGS = ",\n    ".join(
    f"max(value) filter (where hour(ts) = {h}) as bin{h + 1:02d}" for h in range(24))
WIDE = f"""wide as (
  select user_id as deploy_id, cast(user_id as varchar) as deployid,
    cast(date_trunc('day', ts) as timestamp) as hist_dt, event_type as hist_type,
    {_BIN_AGGS}
  from events group by 1, 2, 3, 4)"""
HOURS = "(select cast(unnest(range(1, 25)) as bigint) as h) b"

ORACLES.update({
    "timeline_unpivot": _with(WIDE) + """
      , u as (""" + " union ".join(
        f"""select deploy_id, deployid, 'Percent' as hist_type, hist_dt + interval '{h} hour' as timeline_start_dt,
          cast(bin{h + 1:02d} as double) as percent_dry from wide""" for h in range(24)) + """)
      select row_number() over (order by deploy_id, timeline_start_dt, deployid,
          percent_dry asc nulls last, hist_type) as id,
        deploy_id, deployid, hist_type, timeline_start_dt, percent_dry from u""",
})


# -- partner CSV cleanup -------------------------------------------------------


def _q(name: str) -> str:
    return '"' + name + '"'


def _txt(c: str) -> str:
    """R's text field: empty stays '', the text NA is missing."""
    return f"nullif(coalesce({c}, ''), 'NA')"


def _dbl(c: str) -> str:
    return f"try_cast({_txt(c)} as double)"


def _int(c: str) -> str:
    d = _dbl(c)
    return f"(case when {d} >= -2147483647 and {d} < 2147483648 then cast(trunc({d}) as integer) end)"


def _blank(c: str) -> str:
    return f"nullif({c}, '')"


def _time(c: str, us: bool) -> str:
    if us:
        lead = r"^\s*(\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2})"
        fmt = "%m/%d/%Y %H:%M:%S"
    else:
        lead = r"^\s*(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})"
        fmt = "%Y-%m-%d %H:%M:%S"
    return f"try_strptime(nullif(regexp_extract({c}, '{lead}', 1), ''), '{fmt}')"


def _first(c: str, rules) -> str:
    for a, b in rules:
        c = f"regexp_replace({c}, '{a}', '{b}')"
    return c


def _file_cte(name: str, cols, src: str, order: str) -> str:
    body = ", ".join(f"{expr} as {_q(h)}" for h, expr in cols)
    return f"{name} as (select row_number() over (order by {order}) as id, {body} from {src})"


DEPLOY_FILE = _file_cte("dfile", _PF.deploy_columns("duck"), "customer", "c_custkey")
HISTOS_FILE = _file_cte("hfile", _PF.histos_columns("duck"), "wide", "deploy_id, hist_dt, hist_type")
LOCS_FILE = _file_cte("lfile", _PF.locs_columns("duck"), "events", "event_id")
# The tag numbers hold letters, so R reads them as text and compares text.
DEPLOY_KEYS = f"dkeys as (select id as deploy_id, {_txt(_q('PTT'))} as ptt from dfile)"

# Code rules, as in tagwave.schemas.
_TAG_FAMILY = [("Mk10", "MK10"), ("Splash", "SPLA")]
_SPECIES = [("BeardedSeal", "Eb"), ("RingedSeal", "Ph"), ("SpottedSeal", "Pl")]
_AGE = [("Juv", "SUB"), ("Adult", "ADT"), ("Pup", "PUP"), ("Pup/Juv", "PSA")]

NSB_DEPLOY_SELECT = f"""select id, id as capture_id, {_int(_q('PTT'))} as deployid, {_int(_q('PTT'))} as ptt,
    {_first(_txt('tag_model'), _TAG_FAMILY)} as tag_family_lku,
    {_txt('tag_manufacturer_name')} as tag_manufacturer, {_txt('power_source')} as tag_power,
    {_txt('location_algorithms')} as location_alg,
    {_time(_txt('deploy_on_timestamp'), True)} as deploy_dt, {_txt('deploy_location')} as deploy_loc,
    {_dbl('deploy_on_latitude')} as deploy_lat, {_dbl('deploy_on_longitude')} as deploy_long,
    {_txt('attachment_type')} as attachment_type,
    {_time(_txt('deploy_off_timestamp'), True)} as end_dt, {_txt('deployment_end_type')} as end_type,
    {_blank(_txt('mortality_type'))} as end_mortality_type
  from dfile"""

ORACLES.update({
    "nsb_deploy": _with(DEPLOY_FILE) + NSB_DEPLOY_SELECT,
    "point_geom": _with(DEPLOY_FILE) + f"""select id,
        case when deploy_lat is null or deploy_long is null then null else deploy_long end as x,
        case when deploy_lat is null or deploy_long is null then null else deploy_lat end as y,
        case when deploy_lat is null or deploy_long is null then null else 4326 end as srid
      from ({NSB_DEPLOY_SELECT})""",
    "nsb_capture": _with(DEPLOY_FILE) + f"""select id, {_txt('Animal_ID')} as speno,
        {_first(_txt('Species'), _SPECIES)} as species_lku, {_txt('animal_sex')} as sex_lku,
        {_blank(_first(_txt('animal_life_stage'), _AGE))} as age_class_lku, {_txt('Fate')} as fate,
        {_dbl('animal_mass_kg')} as final_mass_kg, {_blank(_txt('CLAW_BANDS'))} as claw_bands,
        {_dbl('LENGTH_STRAIGHT')} as std_length_cm, {_dbl('LENGTH_CURVED')} as curv_length_cm,
        {_dbl('GIRTH_AX')} as ax_girth_cm,
        case when {_txt('CAPTURE_AREA')} = 'open wate' then 'open water' else {_txt('CAPTURE_AREA')} end
          as capture_area,
        {_txt('CAPTURE_METHOD')} as capture_method, {_txt('FLIPPER_ID_TAG')} as flipper_tag,
        {_blank(_txt('FLIPPER_ID_TAG_COLOR'))} as flipper_tag_color,
        {_blank(_txt('FLIPPER_ID_TAG_SIDE'))} as flipper_tag_side, {_blank(_txt('UME'))} as ume,
        {_txt('AGENCY')} as agency, {_txt('CREW')} as crew, {_blank(_txt('PHOTOS'))} as photos,
        {_txt('ADDITIONAL_NOTES')} as capture_notes
      from dfile""",
    "nsb_histos_raw": _with(WIDE, HISTOS_FILE, DEPLOY_FILE, DEPLOY_KEYS) + f"""select h.id, k.deploy_id,
        {_txt(_q('DeployID'))} as deployid, {_txt(_q('Source'))} as source,
        {_txt(_q('HistType'))} as hist_type, {_time(_txt(_q('Date')), False)} as hist_dt,
        {_dbl(_q('Time Offset'))} as time_offset, {_int(_q('Count'))} as hist_count,
        {_int(_q('NumBins'))} as num_bins, {_dbl(_q('Sum'))} as hist_sum,
        {", ".join(f"{_dbl(_q(f'Bin{i}'))} as bin{i:02d}" for i in range(1, 25))}
      from hfile h left join dkeys k on {_txt('h.' + _q('Ptt'))} is not distinct from k.ptt""",
    "tidy_timeline": _with(WIDE, HISTOS_FILE) + f"""
      , u as (select {_int(_q('DeployID'))} as deployid, {_txt(_q('HistType'))} as hist_type,
          {_time(_txt(_q('Date')), False)} + to_hours(b.h - 1) as timeline_start_dt,
          list_extract([{", ".join(_dbl(_q(f"Bin{i}")) for i in range(1, 25))}], b.h) as percent_dry
        from hfile, {HOURS})
      select row_number() over (order by deployid asc nulls last, hist_type, timeline_start_dt,
          percent_dry asc nulls last) as id, deployid, hist_type, timeline_start_dt, percent_dry
      from u""",
    "nsb_locs": _with(LOCS_FILE, DEPLOY_FILE, DEPLOY_KEYS) + f"""select *,
        case when loc_lat is not null then loc_long end as loc_geom_x,
        case when loc_long is not null then loc_lat end as loc_geom_y,
        case when loc_lat is not null and loc_long is not null then 4326 end as loc_geom_srid
      from (select l.id, k.deploy_id,
        {_int(_q('tag-local-identifier'))} as deployid, {_time(_txt(_q('timestamp')), False)} as loc_dt,
        {_dbl(_q('location-lat'))} as loc_lat, {_dbl(_q('location-long'))} as loc_long,
        {_blank(_txt(_q('algorithm-marked-outlier')))} as alg_marked_outlier,
        {_dbl(_q('argos-altitude'))} as argos_altitude, {_int(_q('argos-best-level'))} as argos_best_level,
        {_dbl(_q('argos-calcul-freq'))} as argos_calc_freq, {_int(_q('argos-iq'))} as argos_iq,
        {_dbl(_q('argos-lat1'))} as argos_lat1, {_dbl(_q('argos-lon1'))} as argos_long1,
        {_dbl(_q('argos-lat2'))} as argos_lat2, {_dbl(_q('argos-lon2'))} as argos_long2,
        {_txt(_q('argos-lc'))} as argos_lc, {_int(_q('argos-nb-mes'))} as argos_nb_mes,
        {_int(_q('argos-nb-mes-120'))} as argos_nb_mes_120, {_int(_q('argos-nopc'))} as argos_nopc,
        {_int(_q('argos-pass-duration'))} as argos_pass_duration,
        {_int(_q('argos-sensor-1'))} as argos_sensor1, {_int(_q('argos-sensor-2'))} as argos_sensor2,
        {_int(_q('argos-sensor-3'))} as argos_sensor3, {_int(_q('argos-sensor-4'))} as argos_sensor4,
        {_int(_q('argos-valid-location-algorithm'))} as argos_valid_loc_alg,
        {_blank(_txt(_q('manually-marked-valid')))} as manual_valid, {_txt(_q('sensor-type'))} as sensor_type
      from lfile l left join dkeys k on {_txt('l.' + _q('tag-local-identifier'))} is not distinct from k.ptt)""",
    "tag_family_norm": f"""select c_custkey,
        {_first(dict(_PF.deploy_columns('duck'))['tag_model'], _TAG_FAMILY)} as tag_family_lku
      from customer""",
    "species_code": f"""select c_custkey,
        {_first(dict(_PF.deploy_columns('duck'))['Species'], _SPECIES)} as species_lku from customer""",
    "age_class_code": f"""select c_custkey,
        {_blank(_first(dict(_PF.deploy_columns('duck'))['animal_life_stage'], _AGE))} as age_class_lku
      from customer""",
    "csv_blank_rules": """select p_partkey,
        case p_partkey % 3 when 0 then null when 1 then null else p_type end as photos,
        case p_partkey % 3 when 0 then '' when 1 then null else p_type end as agency
      from part""",
})


# -- export ----------------------------------------------------------------------
ORACLES["atn_export"] = """
  with d as (select
      case o_orderstatus when 'F' then 'I' when 'O' then 'U' else 'D' end as action_lku,
      'pi' || cast(o_custkey % 10 as varchar) || '@example.org' as piemail,
      'data@example.org' as datamanageremail,
      'maker ' || cast(o_orderkey % 3 as varchar) as tagmanufacturer,
      o_orderpriority as tagmodel, 'SN' || cast(o_orderkey as varchar) as tagserialnumber,
      'pressure, wet/dry' as sensors, o_custkey as pttid, o_custkey % 7 + 1000 as argosprogramnum,
      cast(o_orderkey as varchar) as deploymentid, o_orderdate as deploymentstartdate,
      o_orderdate + to_hours(o_orderkey % 24 + 720) as deploymentstopdate,
      o_totalprice / 10000.0 as deploymentlatitude, -150.5 as deploymentlongitude,
      'Eb' as species, 'A' || cast(o_custkey as varchar) as animalid
    from orders)
  select piemail, datamanageremail, tagmanufacturer, tagmodel, tagserialnumber, sensors, pttid,
    argosprogramnum, deploymentid,
    (deploymentstartdate at time zone 'America/Vancouver') at time zone 'UTC' as deploymentstartdate,
    (deploymentstopdate at time zone 'America/Vancouver') at time zone 'UTC' as deploymentstopdate,
    deploymentlatitude, cast(deploymentlongitude as double) as deploymentlongitude, species, animalid
  from d where action_lku = 'I'"""


ORACLES["export_file"] = ORACLES["atn_export"]
ORACLES["timeline_insert"] = "select id as position, * from (" + ORACLES["timeline_unpivot"] + ")"


# -- landed files ------------------------------------------------------------------
ORACLES |= {
    "landed_states": _LF.STATES_SQL,
    "reload_status": _LF.RELOAD_SQL,
    "load_corrupt": _LF.extra_sql(_S.CORRUPT),
    "load_status": _LF.extra_sql(_S.STATUS),
    "load_haulout": _LF.extra_sql(_S.HAULOUT),
    "extras_status": _LF.EXTRA_STATUS_SQL,
}


# -- behaviour records (loaded for every eligible tag, flagged on end_dt) --------
_BEHAV_TAKEN = {"count": "cast(floor(value) as bigint)", "end": "dt + to_minutes(cast(floor(value) as int))"}
ORACLES["qa_loaded_behav"] = _with(DEP, REC, TAGS) + f"""
  , b as (select {_landed("behav", _BEHAV_TAKEN)} from rec where type = 'purchase'),""" + _load_ctes(
    "behav", "select deploy_id, deployid from tags", "b") + ", " + _updates("loaded", "id", "end_dt") + (
    " select * from flagged")
