"""Regression forests and boosted trees from weighted bin histograms.

Features are binned once (quantile cuts, a few hundred numbers on the driver) and
rows with equal bins collapse to one cell, so a fit reads cells, not rows.  A
level of all trees is one aggregate: per tree, node, feature and bin the sums of
weight and target, cut into running sums; the best cut of each node (two ints and
the sums beside it) is all that reaches the driver.  Trees are arrays of literals
that a row walks down in expressions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.operators.stats import materialize

#: Shares of a Poisson(1) draw up to 0, 1, 2, ... times (fixed values).
POISSON_1 = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676)


@dataclass
class Tree:
    """Splits ``node -> (feature, bin)`` (right where the bin is greater; children 2n, 2n + 1) and leaf values."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)


def _literals(values, cast: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{cast}>")


def node_of(tree: Tree, depth: int, bins: str = "b") -> Column:
    """The node that a row with the bin array ``bins`` reaches: a walk over two arrays of literals."""
    if not tree.splits or depth == 0:
        return F.lit(1)
    inner = range(1, 2 ** depth)
    feature = _literals([tree.splits[n][0] + 1 if n in tree.splits else 0 for n in inner], "int")
    cut = _literals([tree.splits[n][1] if n in tree.splits else 0 for n in inner], "int")

    def step(node, _):
        here = F.try_element_at(feature, node)
        right = F.element_at(bins, here) > F.element_at(cut, node)
        return F.when(here > 0, 2 * node + right.cast("int")).otherwise(node)
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step)


def value_of(tree: Tree, depth: int, bins: str = "b") -> Column:
    """The value of the leaf that a row reaches."""
    values = _literals([tree.values.get(n, 0.0) for n in range(1, 2 ** (depth + 1))], "double")
    return F.element_at(values, node_of(tree, depth, bins))


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = 128) -> list[list[float]]:
    """Distinct approximate quantiles of each feature; a value holding over 1 / bins of the rows is always one."""
    shares = [i / bins for i in range(bins + 1)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").try_cast("double"), shares, 100 * bins).alias(f"c{i}")
                   for i, c in enumerate(features)]).first()
    return [sorted(set(row[f"c{i}"] or [])) for i in range(len(features))]


def readable(features: Sequence[str]) -> Column:
    """Whether every feature of a row is a number: neither null nor NaN."""
    numbers = [F.col(f"`{c}`").try_cast("double") for c in features]
    return reduce(and_, [x.isNotNull() & ~F.isnan(x) for x in numbers], F.lit(True))


def with_bins(df: DataFrame, features: Sequence[str], cuts: list[list[float]], name: str) -> DataFrame:
    """``df`` and the array ``name``: per feature the number of cuts below the value; null for a null or NaN value.

    A value at or below the first cut is in bin 0.  Bins are looked up by
    halving (``Bucketizer``), so a row costs the logarithm of the cuts.  The
    buckets there hold their lower end, so they are cut at the negated values
    and counted from above.  Filter rows before, not after: Spark would work
    out a filter on ``name`` below this step and with it every bin twice.
    """
    own, found = [f"__{name}{i}" for i in range(len(features))], []
    # 0.0 - x has no negative zero, which halving would put below zero
    df = df.select("*", *[(F.lit(0.0) - F.col(f"`{c}`").try_cast("double")).alias(o) for c, o in zip(features, own)])
    for o, at in zip(own, cuts):
        finite = sorted(c for c in at if math.isfinite(c))
        below = F.lit(0)
        if finite:
            ends = [-math.inf, *[0.0 - c for c in reversed(finite)], math.inf]
            df = Bucketizer(splits=ends, inputCol=o, outputCol=f"{o}_at", handleInvalid="keep").transform(df)
            below = F.lit(len(finite)) - F.col(f"{o}_at").cast("int")
        if -math.inf in at:
            below = below + (F.col(o) < math.inf).cast("int")
        found.append(F.when(F.col(o).isNull() | F.isnan(o), None).otherwise(below))
    return df.withColumn(name, F.array(*found)).drop(*own, *[f"{o}_at" for o in own])


def _best_cuts(cells: DataFrame, keys: list[str], width: int, allowed: Column | None) -> DataFrame:
    """Best cut per ``keys``: greatest fall of the squared error; ties: the lowest feature, then bin."""
    long = cells.select(*keys, "g", "h", "n", F.posexplode("b").alias("feature", "bin"))
    if allowed is not None:
        long = long.filter(allowed)
    hist = long.groupBy(*keys, "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    run = Window.partitionBy(*keys, "feature").orderBy("bin")
    every = Window.partitionBy(*keys, "feature")
    cut = hist.select(*keys, "feature", "bin", *[F.sum(c).over(run).alias(f"l{c}") for c in "ghn"],
                      *[F.sum(c).over(every).alias(f"a{c}") for c in "ghn"])
    gl, hl, ga, ha = (F.col(c) for c in ("lg", "lh", "ag", "ah"))
    gain = gl * gl / hl + (ga - gl) * (ga - gl) / (ha - hl) - ga * ga / ha
    usable = cut.filter((F.col("ln") > 0) & (F.col("an") > F.col("ln")) & (hl > 0) & (ha > hl)).withColumn("gain", gain)
    best = usable.groupBy(*keys).agg(F.max(F.struct(
        "gain", (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "lg", "lh", "ln", "ag", "ah", "an")).alias("s"))
    return best.select(*keys, "s.gain", (-F.col("s.feature")).alias("feature"), (-F.col("s.bin")).alias("bin"),
                       "s.lg", "s.lh", "s.ln", "s.ag", "s.ah", "s.an")


def grow(cells: DataFrame, members: Sequence, depth: int, width: int, per_split: int | None = None):
    """Grow one tree per value of ``tree``: ``{member: Tree}`` and the rows of all cuts made.

    ``cells`` holds ``tree, b`` (bin array) ``, g`` (sum of targets) ``, h``
    (sum of curvature) and ``n`` (rows).  ``per_split`` features are tried at a
    node, those with the least MD5 of ``tree:node:feature``.
    """
    trees, made = {m: Tree() for m in members}, []
    for level in range(depth):
        node = F.lit(None).cast("int")
        for m, t in trees.items():
            node = F.when(F.col("tree") == F.lit(m), node_of(t, level)).otherwise(node)
        at = cells.withColumn("node", node).filter(F.col("node") >= 2 ** level)
        allowed = None
        if per_split is not None and per_split < width:
            rows = [(m, n, f) for m, t in trees.items() for n in range(2 ** level, 2 ** (level + 1))
                    for f in tried_features(m, n, width, per_split)]
            text = F.concat_ws(":", F.col("tree").cast("string"), F.col("node").cast("string"), F.col("feature").cast("string"))
            allowed = text.isin([f"{m}:{n}:{f}" for m, n, f in rows])
        found = _best_cuts(at, ["tree", "node"], width, allowed).collect()
        if level == 0:
            for r in at.groupBy("tree").agg((F.sum("g") / F.sum("h")).alias("v")).collect():
                trees[r["tree"]].values[1] = float(r["v"] or 0.0)
        for r in found:
            if r["gain"] <= 0:
                continue
            t, n = trees[r["tree"]], r["node"]
            t.splits[n] = (r["feature"], r["bin"])
            t.values[2 * n] = float(r["lg"] / r["lh"])
            t.values[2 * n + 1] = float((r["ag"] - r["lg"]) / (r["ah"] - r["lh"]))
            made.append(r)
    return trees, made


def tried_features(tree, node: int, width: int, per_split: int) -> list[int]:
    """The features tried at a node: those with the least MD5 of ``tree:node:feature``."""
    return sorted(range(width), key=lambda f: hashlib.md5(f"{tree}:{node}:{f}".encode()).hexdigest())[:per_split]


# ------------------------------------------------------------------ regression forest
def draws(key: Column, tree: Column) -> Column:
    """How often a row stands in a tree's sample: a Poisson(1) draw from the MD5 of ``key:tree``."""
    part = F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), tree.cast("string"))), 1, 8), 16, 10)
    u = part.cast("double") / 4294967296.0
    return sum(((u >= p).cast("int") for p in POISSON_1), F.lit(0))


@dataclass
class Forest:
    features: tuple[str, ...]
    cuts: list[list[float]]
    trees: dict
    depth: int
    splits: list

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the mean of the trees' leaf values; null where a feature is null or NaN."""
        total = sum((value_of(t, self.depth, "_bins") for t in self.trees.values()), F.lit(0.0))
        whole = F.forall("_bins", lambda v: v.isNotNull())
        return with_bins(df, self.features, self.cuts, "_bins").withColumn(name, F.when(whole, total / len(self.trees))).drop("_bins")

    def split_rows(self, spark) -> DataFrame:
        """One row per split: tree, node, feature, threshold (left: at most it), rows and means on both sides."""
        rows = [(r["tree"], r["node"], self.features[r["feature"]], float(self.cuts[r["feature"]][r["bin"]]), int(r["ln"]),
                 int(r["an"] - r["ln"]), float(r["lg"] / r["lh"]), float((r["ag"] - r["lg"]) / (r["ah"] - r["lh"])))
                for r in self.splits]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, n_left long, n_right long, "
                                           "mean_left double, mean_right double")


def regression_forest(df: DataFrame, features: Sequence[str], target: str, key: Sequence[str], trees: int = 10,
                      depth: int = 4, bins: int = 128, per_split: int | None = None) -> Forest:
    """Bagged regression trees of ``target`` on binned ``features``.

    A row stands in a tree's sample as often as a Poisson draw from its ``key``
    says (:func:`draws`), so samples do not depend on partitioning; a node tries
    a third of the features (``per_split``).  Rows with a null or NaN feature or
    target are left out.  An empty table gives trees without splits and value 0.
    """
    feats = list(features)
    per_split = per_split or max(1, len(feats) // 3)
    cuts = quantile_cuts(df, feats, bins)
    y = F.col(target).cast("double")
    rows = with_bins(df.filter(readable(feats) & y.isNotNull() & ~F.isnan(y)), feats, cuts, "_bins").select(
        F.concat_ws("-", *[F.col(k).cast("string") for k in key]).alias("key"), F.col("_bins").alias("b"), y.alias("y"))
    # rows drawn no times go after the sums: a filter before would work out each draw again, once for every share
    drawn = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("n", draws(F.col("key"), F.col("tree")))
    cells = materialize(drawn.groupBy("tree", "b").agg(F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("y"))).alias("g"),
                                                       F.sum("n").cast("double").alias("h"), F.sum("n").alias("n")).filter(F.col("n") > 0))
    grown, made = grow(cells, list(range(trees)), depth, len(feats), per_split)
    return Forest(tuple(feats), cuts, grown, depth, made)


# --------------------------------------------------------------------- boosted trees
@dataclass
class Boosted:
    features: tuple[str, ...]
    cuts: list[list[float]]
    start: dict
    trees: dict
    depth: int
    rate: float
    losses: list

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the class of the greatest margin (ties: the greater name); null where a feature is."""
        scored = [F.struct(sum((self.rate * value_of(t, self.depth, "_bins") for t in self.trees[c]), F.lit(self.start[c])).alias("margin"),
                           F.lit(c).alias("class")) for c in sorted(self.start)]
        whole = F.forall("_bins", lambda v: v.isNotNull())
        return (with_bins(df, self.features, self.cuts, "_bins")
                .withColumn(name, F.when(whole, F.array_max(F.array(*scored))["class"])).drop("_bins"))


def boosted_trees(df: DataFrame, features: Sequence[str], label: str, rounds: int = 8, depth: int = 3, rate: float = 0.3,
                  bins: int = 64) -> Boosted:
    """Logistic boosting, one model per class against the rest; all classes grow in one pass a level.

    Rows with equal bins share their margins, so margins are a column of the
    cells, which each round rewrites to the shared folder: the plan stays one
    round deep.  A leaf moves a margin by its residuals over their variance,
    times ``rate``.  ``losses`` holds (round, class, mean log loss), round 0
    before the first tree.  Rows with a null or NaN feature or a null label are
    left out; an empty table gives no classes.
    """
    feats = list(features)
    cuts = quantile_cuts(df, feats, bins)
    rows = with_bins(df.filter(readable(feats) & F.col(label).isNotNull()), feats, cuts, "_bins").select(
        F.col("_bins").alias("b"), F.col(label).alias("label"))
    counted = materialize(rows.groupBy("b", "label").agg(F.count("*").alias("n")))
    shares = {r["label"]: r["n"] for r in counted.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    total = sum(shares.values())
    classes = sorted(shares)
    start = {c: math.log(max(shares[c], 0.5) / max(total - shares[c], 0.5)) for c in classes}
    model = Boosted(tuple(feats), cuts, start, {c: [] for c in classes}, depth, rate, [])
    if not classes:
        return model
    first = F.lit(0.0)
    for c in classes:
        first = F.when(F.col("tree") == F.lit(c), F.lit(start[c])).otherwise(first)
    cells = counted.withColumn("tree", F.explode(F.array(*[F.lit(c) for c in classes]))).groupBy("tree", "b").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("label") == F.col("tree"), F.col("n")).otherwise(0)).alias("hits"))
    cells = cells.withColumn("margin", first)
    for number in range(rounds + 1):
        cells = materialize(cells)
        m, n, hits = F.col("margin"), F.col("n"), F.col("hits")
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-m))
        softplus = F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))
        for r in cells.groupBy("tree").agg((F.sum(n * softplus - hits * m) / F.sum(n)).alias("loss")).orderBy("tree").collect():
            model.losses.append((number, r["tree"], r["loss"]))
        if number == rounds:
            break
        residuals = cells.select("tree", "b", "n", (hits - n * p).alias("g"), (n * p * (F.lit(1.0) - p)).alias("h"))
        grown, _ = grow(residuals, classes, depth, len(feats))
        moved = F.lit(0.0)
        for c, t in grown.items():
            moved = F.when(F.col("tree") == F.lit(c), value_of(t, depth)).otherwise(moved)
            model.trees[c].append(t)
        cells = cells.withColumn("margin", F.col("margin") + rate * moved)
    return model
