"""Frequent item sets, level by level: candidates of k items come from the frequent
sets of k - 1 items, and only they are counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.operators.stats import materialize

#: Items of a basket that one task extends; larger baskets are split.
PER_TASK = 1000


def _candidates(frequent: DataFrame, k: int) -> DataFrame:
    """Sets of k items all of whose subsets of k - 1 are frequent: ``items``, in order.

    Frequent sets that share their first k - 2 items are joined; a set stays if
    leaving out any of those items too gives a frequent set.
    """
    sets = frequent.select("items", F.slice("items", 1, k - 2).alias("prefix"), F.element_at("items", -1).alias("last"))
    other = sets.select("prefix", F.col("last").alias("next"))
    out = sets.join(other, "prefix").filter("last < next").select(F.array_append("items", F.col("next")).alias("items"))
    for left_out in range(k - 2):
        subset = F.concat(F.slice("items", 1, left_out), F.slice("items", left_out + 2, k - 1 - left_out))
        known = frequent.select(F.col("items").alias("subset"))
        out = out.withColumn("subset", subset).join(known, "subset", "left_semi").drop("subset")
    return out


def frequent_sets(df: DataFrame, basket: str, item: str, min_support: float, most: int = 3) -> DataFrame:
    """Sets of 1 to ``most`` items in at least ``min_support`` of all baskets: ``items, size, support``.

    ``items`` is sorted, ``support`` the number of baskets that hold them all.
    An item counts once a basket; rows with a null basket or item are left out;
    no baskets give no rows.  A basket's frequent sets are extended item by
    item, in tasks of ``PER_TASK`` of its items, so a basket of any size is
    spread out and no list of a basket's items is ever built.
    """
    rows = materialize(df.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().distinct())
    least = rows.agg(F.greatest(F.lit(1), F.ceil(F.count_distinct("basket") * F.lit(min_support))).alias("n")).first()["n"]

    level = materialize(rows.groupBy("item").agg(F.count("*").alias("support")).filter(F.col("support") >= least))
    levels = [level.select(F.array("item").alias("items"), "support")]
    held = rows.join(level.select("item"), "item", "left_semi")
    parts = held.groupBy("basket").agg(F.ceil(F.count("*") / PER_TASK).cast("int").alias("parts"))
    held = materialize(held.join(parts, "basket"))
    # every part of a basket meets each of its items
    next_items = held.select("basket", F.col("item").alias("next"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    inside = held.select("basket", "parts", F.array("item").alias("items"))
    for k in range(2, most + 1):
        candidates = materialize(_candidates(levels[-1], k))
        if candidates.isEmpty():
            break
        spread = inside.withColumn("part", F.pmod(F.xxhash64("items"), F.col("parts")).cast("int"))
        longer = (spread.join(next_items, ["basket", "part"]).filter(F.col("next") > F.element_at("items", -1))
                  .select("basket", "parts", F.array_append("items", F.col("next")).alias("items"))
                  .join(candidates, "items", "left_semi"))
        found = materialize(longer.groupBy("items").agg(F.count("*").alias("support")).filter(F.col("support") >= least))
        levels.append(found)
        inside = longer.join(found.select("items"), "items", "left_semi")
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.select("items", F.size("items").alias("size"), "support")
