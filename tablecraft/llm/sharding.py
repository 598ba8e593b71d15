"""Shards by a hierarchical weighted hash tree.

Leaves are the shards, grouped into racks and regions.  Every leaf makes one
exponential draw from the hash of the document id, of rate its weight; a rack's
draw is the least of its leaves', a region's the least of its racks' (so it is
an exponential draw of the summed weight).  A document descends by the least
draw: region, rack, shard.  A change of weight touches only the draws of the
subtree it stands in, so rows move only into or out of that subtree, and a new
shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import written

RACKS, LEAVES = 4, 2
#: Rows in one block of slots.
BLOCK_ROWS = 100_000


def tree(shards: int, racks: int = RACKS, leaves: int = LEAVES) -> list[list[list[int]]]:
    """Regions of ``racks`` racks of ``leaves`` shards; the last ones may be smaller."""
    per = racks * leaves
    return [[list(range(r, min(r + leaves, shards))) for r in range(g, min(g + per, shards), leaves)]
            for g in range(0, shards, per)]


def _draw(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight, u in (0, 1] from 52 bits of the hash of the id and the shard."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double") + 1) / float(1 << 52)
    return -F.log(u) / F.lit(float(weight))


def _least(draws: list[Column]) -> Column:
    return F.least(*draws) if len(draws) > 1 else draws[0]


def _first(children: list[tuple[Column, Column]], least: Column) -> Column:
    """What belongs to the first child whose draw is the least."""
    out = children[-1][1]
    for draw, value in reversed(children[:-1]):
        out = F.when(draw <= least, value).otherwise(out)
    return out


def with_shard(df: DataFrame, key: str, shards: int, name: str, weights: dict[int, float] | None = None) -> DataFrame:
    """Add the shard of each row; ``weights`` (1 where absent, 0: empty) are by shard."""
    w = weights or {}
    top = [[[s for s in rack if w.get(s, 1.0) > 0] for rack in region] for region in tree(shards)]
    top = [[rack for rack in region if rack] for region in top]
    top = [region for region in top if region]
    if not top:
        raise ValueError("no shard has a weight")
    cols = {s: f"__d{s}" for region in top for rack in region for s in rack}
    df = df.withColumns({c: _draw(F.col(key), s, w.get(s, 1.0)) for s, c in cols.items()})
    rack_draw = {(g, r): _least([F.col(cols[s]) for s in rack]) for g, region in enumerate(top) for r, rack in enumerate(region)}
    df = df.withColumns({f"__r{g}_{r}": d for (g, r), d in rack_draw.items()})
    region_draw = {g: _least([F.col(f"__r{g}_{r}") for r in range(len(region))]) for g, region in enumerate(top)}
    df = df.withColumns({f"__g{g}": d for g, d in region_draw.items()})
    df = df.withColumn("__top", _least([F.col(f"__g{g}") for g in range(len(top))]))
    choices = []
    for g, region in enumerate(top):
        racks = []
        for r, rack in enumerate(region):
            here = F.col(f"__r{g}_{r}")
            racks.append((here, _first([(F.col(cols[s]), F.lit(s)) for s in rack], here)))
        choices.append((F.col(f"__g{g}"), _first(racks, F.col(f"__g{g}"))))
    df = df.withColumn(name, _first(choices, F.col("__top")).cast("int"))
    return df.drop("__top", *cols.values(), *[f"__r{g}_{r}" for g, r in rack_draw], *[f"__g{g}" for g in region_draw])


def with_slot(rows: DataFrame, shard: str, order: list[str], name: str = "slot", blocks: int | None = None) -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard is cut into blocks by a hash of ``order``; rows are numbered inside
    their block and blocks follow each other, so no task holds a whole shard.
    Rows equal in all of ``order`` share a block and are numbered in any order.
    """
    blocks = blocks or max(1, -(-rows.count() // BLOCK_ROWS))
    df = rows.withColumn("__block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    from pyspark.sql import Window
    sizes = df.groupBy(shard, "__block").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__from", F.sum("__n").over(
        Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.row_number().over(Window.partitionBy(shard, "__block").orderBy(*order))
    return (df.withColumn("__i", inside - 1)
            .join(before.select(shard, "__block", F.coalesce("__from", F.lit(0)).alias("__from")), [shard, "__block"])
            .withColumn(name, (F.col("__from") + F.col("__i")).cast("long")).drop("__block", "__i", "__from"))


def shard_documents(docs: DataFrame, shards: int = 24, weights: dict[int, float] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    Law ``key``: doc_id and the shard count (and weights) decide; ``grown_shard``
    is the shard with one more.  size: UTF-8 bytes of the text (null: none) plus
    8.  Rows that repeat an id go to one shard and get a slot each; null ids
    share one shard.  No rows give no rows; other columns are not looked at.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(data) + 8).cast("long").alias("size"),
                       F.crc32(data).cast("long").alias("text_crc32"))
    rows = with_shard(rows, "doc_id", shards, "shard", weights)
    rows = with_shard(rows, "doc_id", shards + 1, "grown_shard", weights)
    rows = written(rows.withColumn("law", F.lit("key")), "shards")
    return with_slot(rows, "shard", ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
