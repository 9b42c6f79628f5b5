"""Product loaders: one registry-driven transform for every product.

Upstream each tag is loaded separately: read ``max(id)`` of the target,
number the tag's rows from it, left-join the tag's ``deploy_id``, rename,
add the QA defaults, select, append.  Here one job per product loads all
tags: the landed rows are joined once to the tags whose product loads, the
ids come from the closed form in ``sequence.surrogate_ids`` (no round trip
per tag, no single-task sort), and the result is written in one go.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.operators.joins import Dimension, dimension, join_dimension
from tagwave.operators.sequence import keyed_ids, surrogate_ids


def prefer_sources(sources: DataFrame, landed: DataFrame, key: str = "deployid",
                   pref: str = "pref") -> DataFrame:
    """Keep, per tag, only the rows of its most preferred source among those
    that landed (FLOW-2: ``all_locations`` when the tag has it, else
    ``locations``; never mixed).  ``landed`` (``deployid, pref``) lists the
    sources present for each tag, also those without rows: a tag whose preferred
    source is empty keeps nothing.

    The per-tag choice is joined on (tag, source): broadcast when a count
    shows it is small, else a sort-merge join with hot tags salted.
    """
    best = landed.groupBy(key).agg(F.min(pref).alias(pref))
    return join_dimension(sources, best, [key, pref], "inner")


def fetch_plan(tags: DataFrame) -> DataFrame:
    """``deployid, deploy_ids``: the deployments of every listed deployid.  The
    load loop runs once per listed row and joins the list each time, so a
    deployid listed twice is fetched twice and each fetch's rows appear twice."""
    return (tags.groupBy("deployid").agg(F.sort_array(F.collect_list(F.struct("deploy_id"))).alias("deploy_ids")))


def attach_tags(rows: DataFrame, tags: DataFrame | Dimension) -> DataFrame:
    """Rows of the tags being loaded, with their tag's ``deploy_ids`` (JOIN-1,
    the part before numbering) and a copy per fetch of the tag (``__fetch``).

    Every tag's download only holds that tag, so the upstream left join on
    ``deployid`` becomes an inner join with the loadable tags.  ``tags`` is
    ``fetch_plan`` (e.g. from ``status.loaded_keys``) or the plain tag list; it
    has a row per deployid and is broadcast after a size check, so the rows are
    never shuffled for it.
    """
    if "deploy_ids" not in tags.columns:
        tags = fetch_plan(tags)
    joined = join_dimension(rows, tags.select("deployid", "deploy_ids"), ["deployid"], "inner")
    return joined.withColumn("__fetch", F.explode(F.sequence(F.lit(1), F.size("deploy_ids"))))


def shape(df: DataFrame, product: S.Product) -> DataFrame:
    """Renames, QA defaults and all of the product's output columns, in order;
    a column that no tag landed is null."""
    out = df.withColumnsRenamed({k: v for k, v in product.renames.items() if k in df.columns})
    if product.has_qa:
        out = out.withColumns({k: F.lit(v) for k, v in S.QA_DEFAULTS.items()})
    return out.select(*[c if c in out.columns else F.lit(None).cast(S.column_type(c)).alias(c)
                        for c in product.columns])


@dataclass(frozen=True)
class KeyedRows:
    """Rows that are dear to make, and their ``deployid`` and order columns
    made alone."""

    rows: DataFrame
    keys: DataFrame


def load_product(rows: DataFrame | KeyedRows, tags: DataFrame | Dimension, product: S.Product,
                 order: Sequence[str] = ("seq",)) -> DataFrame:
    """Loaded product table: ids, ``deploy_id``, renames, QA defaults.

    ``order`` is the within-tag row order of the download (arrival order);
    it must make ``(deployid, *order)`` unique for reproducible ids.  Ids are
    given per fetch, before the join fans out: the copies of a row of a tag
    listed twice share their id, as upstream.
    """
    keyed = isinstance(rows, KeyedRows)
    if keyed:  # joined twice, staged once
        tags = dimension(tags if "deploy_ids" in tags.columns else fetch_plan(tags))
    renamed = rows.rows if keyed else rows
    renamed = renamed.withColumnsRenamed({k: v for k, v in product.renames.items() if k in renamed.columns})
    # Only the output columns and the order keys cross the network.
    keep = [c for c in product.columns if c in renamed.columns and c not in ("id", "deploy_id")]
    keep += [o for o in order if o not in keep]
    by = ["deployid", "__fetch"]
    if keyed:
        # As one value the columns are copied at once, not one by one at every step.
        alone = ["deployid", *order]
        whole = renamed.select(*alone, F.struct(*[c for c in keep if c not in alone]).alias("__whole"))
        numbered = keyed_ids(attach_tags(whole, tags), attach_tags(rows.keys, tags), by, list(order), out="id")
        numbered = numbered.select("id", "deploy_ids", *alone, "__whole.*")
    else:
        numbered = surrogate_ids(attach_tags(renamed.select(*keep), tags), by, list(order), out="id")
    fanned = numbered.withColumn("__of", F.explode("deploy_ids")).withColumn("deploy_id", F.col("__of.deploy_id"))
    return shape(fanned, product)
