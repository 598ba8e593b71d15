"""Connected components of a link table by alternating large-star and small-star
steps: every step is a grouped minimum and a join, nothing reaches the driver
but whether a round settled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import written

MAX_ROUNDS = 100


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    around = _both_ways(links)
    # written, so that the join reads plain exchanges and a node with very many links can be split over tasks
    least = written(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return (around.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them (links: a > b)."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: no node hangs on two centres or is centre and leaf at once."""
    ends = (links.select(F.col("a").alias("id"), F.lit(1).alias("leaf"), F.lit(0).alias("centre"))
            .unionByName(links.select(F.col("b").alias("id"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))))
    return (ends.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
            .filter("leaf > 1 OR leaf + centre > 1").isEmpty())


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` of every linked node: the least id it can reach.

    ``links`` has long columns ``a, b`` in any direction, repeats and self
    links allowed; nulls are left out.  No links give no rows.
    """
    stars = written(links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(MAX_ROUNDS):
        if _settled(stars):
            break
        stars = written(_small_star(_large_star(stars)), "stars")
    else:
        raise RuntimeError("components did not settle")
    return (stars.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
            .unionByName(stars.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()))
