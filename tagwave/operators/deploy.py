"""Deployment registry operators: eligibility (FLT-1) and the per-deployid
summary the QA rules compare against (AGG-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwave.functions.timefmt import utc_time


def eligible_predicate(deploy_dt: str = "deploy_dt", end_dt: str = "end_dt") -> Column:
    """``(deploy_dt <> end_dt) OR (deploy_dt IS NOT NULL AND end_dt IS NULL)``
    with SQL three-valued logic: a null ``deploy_dt`` never qualifies and a
    zero-length deployment drops out.  ``where`` keeps only true rows."""
    d, e = F.col(deploy_dt), F.col(end_dt)
    return (d != e) | (d.isNotNull() & e.isNull())


def eligible_tags(deployments: DataFrame) -> DataFrame:
    """Tags worth loading: ``(deploy_id, deployid)`` of eligible deployments.

    The upstream query also sorts by ``deployid``; here that order is not a
    physical sort but the ordering key of the surrogate ids
    (``sequence.surrogate_ids``), so no single-task sort is planned.
    """
    return (deployments.where(eligible_predicate())
            .select(F.col("id").alias("deploy_id"), "deployid"))


def deployment_summary(deployments: DataFrame) -> DataFrame:
    """One row per ``deployid``: latest start, earliest end and whether any
    deployment row is still open.

    The QA statements ask "does *some* deployment row of this deployid
    satisfy dt < deploy_dt" (an ``IN`` over a join); that is exactly
    ``dt < max(deploy_dt)``, likewise ``dt > min(end_dt)`` and
    ``bool_or(end_dt is null)``.  Aggregating first means the records join
    a table with unique keys, so the join never fans out.
    """
    return (deployments.groupBy("deployid")
            .agg(F.max(utc_time(deployments, "deploy_dt")).alias("max_deploy_dt"),
                 F.min(utc_time(deployments, "end_dt")).alias("min_end_dt"),
                 F.bool_or(F.col("end_dt").isNull()).alias("any_open")))
