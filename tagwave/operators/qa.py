"""QA flagging of loaded telemetry tables in a single pass.

Upstream this is 33 ordered ``UPDATE`` statements (reset, "still
transmitting", "before deployment", "after end", then the known-issue
list), where a later statement overwrites an earlier one.  Here the same
result is one projection per table: the records are left-joined once to the
per-deployid deployment summary and three ``when`` chains, latest rule
first, give ``qa_status``, ``data_status`` and ``data_explain``.

Join strategy: the summary has one row per deployid (a dimension).  It is
staged and counted first and broadcast only under a row bound
(``joins.join_dimension``), so the records are never shuffled for it;
beyond the bound the join is a sort-merge join in which a deployid holding a
large share of the records is salted over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.functions.timefmt import utc_time
from tagwave.operators.deploy import deployment_summary
from tagwave.operators.joins import Dimension, dimension, join_dimension

_AT = "__at"  # a record's time as a zone-less UTC time
QA_COLUMNS = ["qa_status", "data_status", "data_explain"]


def reset(df: DataFrame) -> DataFrame:
    """QA-0: every row back to ``unreviewed / use / unreviewed``."""
    return df.withColumns({k: F.lit(v) for k, v in S.QA_DEFAULTS.items()})


def rules_for(table: str, rules: Sequence[tuple] = S.KNOWN_ISSUES) -> list[tuple]:
    """The known-issue rules that apply to one table, in application order."""
    return [r for r in rules if r[0] == table]


def known_issue_explain(rules: Sequence[tuple], dt_col: str,
                        deployid_col: str = "deployid") -> Column | None:
    """Explanation of the last matching known-issue rule, else null.

    Rules are a short literal list, so they become one ``CASE`` expression
    evaluated inside whole-stage codegen (no join).  Later rules win, so the
    chain is built from the last rule backwards.
    """
    expr = None
    for _table, deployid, op, instant, explain in reversed(list(rules)):
        if op not in ("=", ">="):
            raise ValueError(f"known-issue rules compare with = or >=, not {op!r}")
        ts = F.lit(instant).cast("timestamp_ntz")
        dt = F.col(dt_col)
        hit = dt == ts if op == "=" else dt >= ts
        cond = (F.col(deployid_col) == F.lit(deployid)) & hit
        expr = F.when(cond, F.lit(explain)) if expr is None else expr.when(cond, F.lit(explain))
    return expr


def summary_dimension(deployments: DataFrame | Dimension) -> Dimension:
    """The per-deployid summary, staged and size-checked; build it once to flag
    several tables."""
    return deployments if isinstance(deployments, Dimension) else dimension(deployment_summary(deployments))


def with_deployment_summary(records: DataFrame, deployments: DataFrame | Dimension) -> DataFrame:
    """Attach ``max_deploy_dt, min_end_dt, any_open`` per deployid (left join:
    records without a deployment row keep nulls)."""
    return join_dimension(records, summary_dimension(deployments), ["deployid"], "left")


def active_flag() -> Column:
    """QA-1: no deployment row, or some deployment row without ``end_dt``
    (the upstream LEFT JOIN makes orphans count as still transmitting)."""
    return F.coalesce(F.col("any_open"), F.lit(True))


def before_flag(dt_col: str, type_exempt: str | None = None,
                type_col: str = "type") -> Column:
    """QA-2: record before the (latest) deployment start.  For locations a
    ``type`` equal to ``type_exempt`` is exempt; a null ``type`` makes the
    upstream predicate null, so such rows are not flagged either."""
    cond = F.col(dt_col) < F.col("max_deploy_dt")
    if type_exempt is not None:
        cond = cond & (F.col(type_col) != F.lit(type_exempt))
    return F.coalesce(cond, F.lit(False))


def after_flag(dt_col: str) -> Column:
    """QA-3: record after the (earliest) deployment end; no type exemption."""
    return F.coalesce(F.col(dt_col) > F.col("min_end_dt"), F.lit(False))


def explain_column(dt_col: str, type_exempt: str | None, rules: Sequence[tuple],
                   type_col: str = "type") -> Column:
    chain = known_issue_explain(rules, dt_col)
    after = after_flag(dt_col)
    before = before_flag(dt_col, type_exempt, type_col)
    if chain is None:
        chain = F.when(after, F.lit(S.EXPLAIN_AFTER))
    else:
        chain = chain.when(after, F.lit(S.EXPLAIN_AFTER))
    return chain.when(before, F.lit(S.EXPLAIN_BEFORE)).otherwise(F.lit(S.EXPLAIN_UNREVIEWED))


def apply_qa(records: DataFrame, deployments: DataFrame | Dimension, dt_col: str,
             type_exempt: str | None = None, rules: Sequence[tuple] = (),
             type_col: str = "type", keep: Iterable[str] | None = None) -> DataFrame:
    """All QA steps (reset, active, before, after, known issues) in one pass.

    ``records`` needs ``deployid`` and ``dt_col`` (and ``type_col`` when
    ``type_exempt`` is set).  Returns the records with the three QA columns
    replaced.  Upstream the statements select rows by ``id``; with the unique
    ids the loaders produce that is the same as judging every row on its own,
    which is what happens here (no id is needed).
    """
    base = records.drop(*[c for c in QA_COLUMNS if c in records.columns])
    j = with_deployment_summary(base.withColumn(_AT, utc_time(base, dt_col)), deployments)
    explain = explain_column(_AT, type_exempt, rules, type_col)
    out = j.withColumn("data_explain", explain)
    flagged = F.col("data_explain") != F.lit(S.EXPLAIN_UNREVIEWED)
    out = out.withColumns({
        "qa_status": F.when(flagged, F.lit(S.QA_REVIEWED))
                      .when(active_flag(), F.lit(S.QA_ACTIVE))
                      .otherwise(F.lit(S.QA_UNREVIEWED)),
        "data_status": F.when(flagged, F.lit(S.DATA_DO_NOT_USE)).otherwise(F.lit(S.DATA_USE)),
    })
    cols = list(keep) if keep is not None else base.columns
    return out.select(*cols, *QA_COLUMNS)


def qa_table(records: DataFrame, deployments: DataFrame | Dimension, product: S.Product,
             rules: Sequence[tuple] = S.KNOWN_ISSUES) -> DataFrame:
    """QA for one registered product table with its own time column, type
    exemption and the known-issue rules addressed to it."""
    return apply_qa(records, deployments, product.time_col, product.type_exempt,
                    rules_for(product.name.replace("histos_", ""), rules))


# -- single steps, for reports and for checking one rule at a time ----------

def flag_active(records: DataFrame, deployments: DataFrame) -> DataFrame:
    """Rows QA-1 would mark ``tag_actively_transmitting``."""
    return with_deployment_summary(records, deployments).where(active_flag()).select(records.columns)


def flag_before(records: DataFrame, deployments: DataFrame, dt_col: str,
                type_exempt: str | None = None, type_col: str = "type") -> DataFrame:
    """Rows QA-2 would mark ``records before deploy_dt``."""
    j = with_deployment_summary(records.withColumn(_AT, utc_time(records, dt_col)), deployments)
    return j.where(before_flag(_AT, type_exempt, type_col)).select(records.columns)


def flag_after(records: DataFrame, deployments: DataFrame, dt_col: str) -> DataFrame:
    """Rows QA-3 would mark ``records after end_dt``."""
    j = with_deployment_summary(records.withColumn(_AT, utc_time(records, dt_col)), deployments)
    return j.where(after_flag(_AT)).select(records.columns)


def flag_known(records: DataFrame, rules: Sequence[tuple], dt_col: str) -> DataFrame:
    """Rows the known-issue list would mark (no join needed)."""
    expr = known_issue_explain(rules, _AT)
    if expr is None:
        return records.where(F.lit(False))
    return records.withColumn(_AT, utc_time(records, dt_col)).where(expr.isNotNull()).select(records.columns)
