"""Landed per-tag files derived from the test tables.

Tags are suppliers and their rows the lines they supplied; a product stands for
the lines of some return flag or line status.  Fixed rules on the supplier
number make the odd landings: files that lack a column, hold another type, are
no parquet or have no rows, products that did not land, CSV headers in another
order or short of a column.  The same rules are written in SQL here.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.operators.extras import landed_names
from tagwave.operators.stage import track
from tagwave.plans.bindings import BASE_DAY, END_DAY, _days
from tagwave.session import scratch_path
from tagwave.sources import landed as LD
from tagwave.sources.tables import read_table

# Product -> (lines it stands for, tags that landed it) in both engines' SQL.
LINES = {
    "messages": ("l_linestatus = 'F'", "true"),
    "dive_depths": ("l_returnflag = 'N'", "true"),
    "dive_durations": ("l_returnflag = 'R'", "true"),
    "time_depth": ("l_returnflag = 'A'", "l_suppkey % 5 <> 2"),
    "timelines": ("l_linestatus = 'O'", "true"),
    "all_locations": ("l_returnflag = 'A'", "l_suppkey % 3 = 0"),
    "locations": ("l_returnflag = 'R'", "true"),
}
LACKS = ("messages", "msg", "l_suppkey % 7 = 1")
CLASHES = ("dive_depths", "num_dives", "l_suppkey % 11 = 3")
NO_PARQUET = ("timelines", "l_suppkey % 13 = 4")
NO_ROWS = ("all_locations", "l_suppkey % 9 = 6")
EXTRA_LINES = {"corrupt": "l_returnflag = 'A'", "status": "l_returnflag = 'R'", "haulout": "l_returnflag = 'A'"}
EXTRA_ABSENT, EXTRA_SHORT, EXTRA_REVERSED = "l_suppkey % 5 = 2", "l_suppkey % 6 = 5", "l_suppkey % 4 = 0"
#: The column that short headers leave out.
EXTRA_MISSING = "location_quality"
EXTRA_TIME = "%H:%M:%S %d-%b-%Y "


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deployment per supplier; every tenth has no start and is not eligible."""
    k = F.col("s_suppkey")
    start = F.when(k % 10 != 0, _days(BASE_DAY, k % 5))
    return read_table(spark, sf_dir, "supplier").select(
        k.cast("long").alias("id"), F.concat(F.lit("S"), k.cast("string")).alias("deployid"),
        start.alias("deploy_dt"), _days(END_DAY, k % 9).alias("end_dt"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_suppkey", "l_returnflag", "l_linestatus", F.col("l_shipdate").alias("dt"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
                     F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("deployid"))


def _product(landed: str) -> S.Product:
    if landed in S.LOCATION_SOURCES:
        return S.LOCS
    return next(S.PRODUCTS[name] for name, folder in S.LANDED_NAMES.items() if folder == landed)


@functools.cache
def _texts(name: str, n: int, blanks: bool) -> pa.Array:
    """Texts for the remainders of a division by ``n``, from ``1 - n`` on."""
    plain = [f"{name} {r}" if name else str(r) for r in range(1 - n, n)]
    return pa.array([{0: "NA", 1: ""}.get(r, t) if blanks else t for r, t in zip(range(1 - n, n), plain)])


class _Numbers:
    """A tag's ``seq`` and its remainders, with the sign of ``seq``."""

    def __init__(self, seq: pa.ChunkedArray):
        self.null = seq.is_null().to_numpy() if seq.null_count else None
        self.values = (seq.fill_null(0) if seq.null_count else seq).to_numpy()

    def remainders(self, n: int) -> np.ndarray:
        return np.fmod(self.values, n)

    def doubles(self, n: int) -> pa.Array:
        return pa.array(self.remainders(n).astype(np.float64), mask=self.null)

    def texts(self, name: str, n: int, blanks: bool = False) -> pa.DictionaryArray:
        at = (self.remainders(n) + (n - 1)).astype(np.int32)
        return pa.DictionaryArray.from_arrays(pa.array(at, mask=self.null), _texts(name, n, blanks), safe=False)


def _product_file(rows: pa.Table, types: dict[str, str], landed: str) -> bytes:
    """A tag's parquet file from its ``seq``, ``dt`` and ``odd``."""
    numbers, odd = _Numbers(rows["seq"]), rows["odd"][0].as_py()
    columns = {"seq": rows["seq"]}
    for i, (name, kind) in enumerate(types.items()):
        if odd and landed == LACKS[0] and name == LACKS[1]:
            continue
        if kind == "timestamp_ntz":
            columns[name] = rows["dt"]
        elif kind == "double":
            columns[name] = numbers.doubles(i + 7)
            if odd and landed == CLASHES[0] and name == CLASHES[1]:
                columns[name] = pa.array([None if v is None else f"{v:.1f}" for v in columns[name].to_pylist()], pa.string())
        else:
            columns[name] = numbers.texts(name, i + 7)
    # Without the stored schema the texts of a dictionary are read as texts.
    return LD.parquet_file(pa.table(columns), store_schema=False, write_statistics=False)


def land_products(spark: SparkSession, sf_dir: str) -> str:
    """Write every product's files, a file per tag, packed; returns the folder
    they lie in."""
    root = track(scratch_path(spark, "landed"))
    lines = _lines(spark, sf_dir)
    for landed, (which, tags) in LINES.items():
        types = S.landed_types(_product(landed))
        df = lines.where(which).where(tags)
        odd = F.lit(False)
        if landed in (LACKS[0], CLASHES[0]):
            odd = F.expr(LACKS[2] if landed == LACKS[0] else CLASHES[2])
            df = df.where(odd.isNotNull())
        elif landed == NO_PARQUET[0]:
            df = df.where(f"not ({NO_PARQUET[1]})")
            LD.land_files(_odd_files(spark, sf_dir, NO_PARQUET[1], "broken.parquet", b"no parquet file"), root, landed)
        elif landed == NO_ROWS[0]:
            df = df.where(f"not ({NO_ROWS[1]})")
            empty = LD.empty_parquet_file({"seq": "long", **types})
            LD.land_files(_odd_files(spark, sf_dir, NO_ROWS[1], "empty.parquet", empty), root, landed)
        LD.land_rows(df, ["seq"], [F.col("seq"), F.col("dt"), odd.alias("odd")], root, landed,
                     functools.partial(_product_file, types=types, landed=landed))
    return root


def _odd_files(spark: SparkSession, sf_dir: str, which: str, name: str, content: bytes) -> DataFrame:
    """The same file for some of the suppliers."""
    rows = read_table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey").where(which)
    return rows.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("deployid"),
                       F.lit(name).alias("name"), F.lit(content).alias("content")).distinct()


def raw_header(name: str) -> str:
    """A header as a tag's file prints it, for a cleaned name."""
    if name in ("deploy_id", "id"):
        return {"deploy_id": "DeployID", "id": "ID"}[name]
    words = name.split("_")
    text = [{"gps": "GPS", "twic": "TWIC"}.get(w, w.capitalize()) for w in words]
    return (" " if any(w.isdigit() for w in words) or len(words) % 2 else "").join(text)


def _extra_text(name: str, i: int) -> str:
    """A CSV field, in DuckDB's SQL: a rule's text, ``NA`` where the remainder is
    0 and blank where it is 1; times have a month name and a blank behind."""
    if S.column_type(name) == "timestamp_ntz":
        return f"strftime(dt, '{EXTRA_TIME}')"
    plain = "cast(seq % {n} as string)" if S.column_type(name) == "double" else "concat('{name} ', cast(seq % {n} as string))"
    plain = plain.format(n=i + 7, name=name)
    return f"case seq % {i + 7} when 0 then 'NA' when 1 then '' else {plain} end"


def land_extra(spark: SparkSession, sf_dir: str, product: S.Product) -> str:
    """Write an optional product's CSV files, a file per tag, packed; returns the
    folder they lie in."""
    root = track(scratch_path(spark, "extras"))
    lines = _lines(spark, sf_dir).where(EXTRA_LINES[product.name]).where(f"not ({EXTRA_ABSENT})")
    kind = F.expr(f"case when {EXTRA_SHORT} then 'short' when {EXTRA_REVERSED} then 'reversed' else 'plain' end")
    LD.land_rows(lines, ["seq", "dt"], [F.col("seq"), F.col("dt").cast("timestamp_ntz").alias("dt"), kind.alias("kind"),
                                        F.col("deployid").alias("tag")],
                 root, product.name, functools.partial(_extra_file, names=landed_names(product)), "csv")
    return root


def _extra_file(rows: pa.Table, names: dict[str, str]) -> bytes:
    """A tag's CSV file from its ``tag``, ``seq``, ``dt`` and ``kind``.  No text
    holds a comma or a quote."""
    numbers, times = _Numbers(rows["seq"]), pc.strftime(pc.floor_temporal(rows["dt"], unit="second").cast(pa.timestamp("s")), EXTRA_TIME)
    cells = {"DeployID": rows["tag"].combine_chunks()}
    for i, (c, name) in enumerate(names.items()):
        kind = S.column_type(c)
        cells[raw_header(name)] = (times.combine_chunks() if kind == "timestamp_ntz" else
                                   numbers.texts("" if kind == "double" else c, i + 7, blanks=True).dictionary_decode())
    landed = rows["kind"][0].as_py()
    order = {"plain": [*cells], "reversed": [*cells][::-1], "short": [h for h in cells if h != raw_header(EXTRA_MISSING)]}[landed]
    lines = pc.binary_join_element_wise(*[cells[h] for h in order], ",", null_handling="replace", null_replacement="")
    return LD.csv_file(",".join(order), pa.table({"line": lines}))


# -- the same in SQL ----------------------------------------------------------
LINES_CTE = """li as (select l_suppkey, 'S' || l_suppkey as deployid, l_returnflag, l_linestatus,
    l_shipdate as dt, l_orderkey * 8 + l_linenumber as seq from lineitem)"""
TAGS_CTE = """tags as (select cast(s_suppkey as bigint) as deploy_id, 'S' || s_suppkey as deployid,
    s_suppkey as l_suppkey from supplier where s_suppkey % 10 <> 0)"""


def states_sql() -> str:
    """``deployid, product, rows, state, reason`` of every landed (tag, product)."""
    parts = []
    for landed, (which, tags) in LINES.items():
        state, rows, source = "null", "count(*)", f"li where {which} and {tags}"
        if landed == LACKS[0]:
            state = f"case when {LACKS[2]} then 'lacks {LACKS[1]}' end"
        elif landed == CLASHES[0]:
            state = f"case when {CLASHES[2]} then '{CLASHES[1]} is string' end"
        elif landed == NO_PARQUET[0]:
            state, rows = f"case when {NO_PARQUET[1]} then 'unreadable' end", f"case when {NO_PARQUET[1]} then 0 else count(*) end"
        elif landed == NO_ROWS[0]:
            rows = f"case when {NO_ROWS[1]} then 0 else count(*) end"
        odd = {NO_PARQUET[0]: NO_PARQUET[1], NO_ROWS[0]: NO_ROWS[1]}.get(landed)
        parts.append(f"""select deployid, '{landed}' as product, cast({rows} as bigint) as rows, {state} as reason
          from {source} group by deployid, l_suppkey""")
        if odd:  # such files are there for tags without lines too
            parts.append(f"""select deployid, '{landed}', 0, {"'unreadable'" if landed == NO_PARQUET[0] else "null"}
              from (select 'S' || s_suppkey as deployid, s_suppkey as l_suppkey from supplier) where {odd}
                and deployid not in (select deployid from {source})""")
    return " union all ".join(parts)


STATES_SQL = f"""with {LINES_CTE}, f as ({states_sql()})
  select deployid, product, rows, case when reason is null then 'present' else 'error' end as state, reason from f"""

_AT = {**{f: S.PRODUCTS[n].pos for n, f in S.LANDED_NAMES.items()}}
RELOAD_SQL = f"""with {LINES_CTE}, {TAGS_CTE}, f as ({states_sql()}),
  chosen as (select deployid, case product {" ".join(f"when '{n}' then {p}" for n, p in _AT.items())} end as pos,
      rows, reason from f where product not in ('all_locations', 'locations')
    union all select deployid, 6, rows, reason from f where product = 'all_locations'
    union all select deployid, 6, rows, reason from f where product = 'locations'
      and deployid not in (select deployid from f where product = 'all_locations')),
  st as (select t.deployid, g.pos, case when c.deployid is null then 'absent'
      when c.reason is not null or c.rows = 0 then 'error' else 'present' end as state
    from tags t cross join (select unnest(range(1, 7)) as pos) g
    left join chosen c on c.deployid = t.deployid and c.pos = g.pos),
  o as (select *, min(case when state = 'error' then pos end) over (partition by deployid) as broke from st)
  select case pos {" ".join(f"when {p.pos} then '{p.name}'" for p in S.LOAD_ORDER)} end as data_type, deployid,
    case when pos >= broke then '{S.STATUS_FAILED}'
         when state = 'absent' then case pos {" ".join(f"when {p.pos} then '{p.missing_text}'" for p in S.LOAD_ORDER)} end
         else '{S.STATUS_IMPORTED}' end as status from o"""


def extra_sql(product: S.Product) -> str:
    """An optional product's table."""
    cols = []
    for i, c in enumerate(landed_names(product)):
        text, kind = _extra_text(c, i), S.column_type(c)
        if kind == "timestamp_ntz":
            value = "date_trunc('second', dt)"
        else:
            value = f"nullif({text}, 'NA')"
            value = f"try_cast({value} as double)" if kind == "double" else value
        cols.append(f"{value} as {c}")
    order = ["id", "deploy_id", "deployid", *landed_names(product)]
    return f"""with {LINES_CTE}, {TAGS_CTE},
      x as (select deployid, seq, dt, {", ".join(cols)} from li
        where {EXTRA_LINES[product.name]} and not ({EXTRA_ABSENT}) and not ({EXTRA_SHORT})),
      y as (select x.*, t.deploy_id from x join tags t using (deployid)),
      n as (select deployid, count(*) as n from y group by 1),
      b as (select deployid, 1 + coalesce(sum(n + 1) over (order by deployid
        rows between unbounded preceding and 1 preceding), 0) as base from n)
      select cast(row_number() over (partition by deployid order by seq, dt) + base as bigint) as id, {", ".join(order[1:])}
      from y join b using (deployid)"""


EXTRA_STATUS_SQL = f"with {LINES_CTE}, {TAGS_CTE}, " + ", ".join(
    f"f_{name} as (select distinct deployid from li where {which} and not ({EXTRA_ABSENT}))"
    for name, which in EXTRA_LINES.items()) + " " + " union all ".join(
    f"""select '{name}' as data_type, deployid,
      case when deployid not in (select deployid from f_{name}) then '{S.MISSING_CSV}'
           when {EXTRA_SHORT} then '{S.STATUS_FAILED}' else '{S.STATUS_IMPORTED}' end as status from tags"""
    for name in EXTRA_LINES)
