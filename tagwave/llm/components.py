"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tagwave.operators.stage import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select("v", "u"))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: a node hands its smallest neighbour (or itself) to its
    larger neighbours (``large``), or to itself and its smaller ones."""
    sides = _both_ways(links)
    if large:
        least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = sides.where("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return (out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())


def _staged(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, staged, and a fingerprint of them observed meanwhile."""
    seen = Observation()
    mark = F.sum(F.xxhash64("u", "v") % (1 << 40))
    out = stage(links.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")), "links")
    return out, (seen.get["n"], seen.get["mark"])


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (long columns ``u``, ``v``):
    the smallest node that can be reached.

    Large-star and small-star steps alternate until nothing changes; they keep
    the number of links and need a logarithmic number of rounds.  A node with
    very many neighbours is summed up by partial aggregation and its join is
    one that Spark may split.  Null nodes are dropped; no links, no rows.
    """
    links, state = _staged(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                           .where("u <> v").distinct())
    before = None
    while state != before:
        before = state
        links, state = _staged(_star(_star(links, True), False))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct())
