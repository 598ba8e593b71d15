"""Statistics on Spark: z-scores, rank tests, rank correlation, chance criterion.

Rank statistics are built on :func:`cumulative_counts`, which gives every
distinct value the number of rows below it without a global single-partition
window:

1. rows are first collapsed to one row per distinct value (partial aggregation,
   so a value holding a third of all rows costs one row here);
2. distinct values are cut into ``buckets`` ranges by approximate quantiles
   (one scalar subquery), so each window partition holds ~1/buckets of them;
   the range count grows with the data (about a million distinct values per
   range, at least 256 ranges); tables of every size take this path;
3. a running sum inside each range plus the total of all lower ranges (a table
   of at most ``buckets`` rows per key) gives the count below each value.

The collapsed distinct-value table feeds several branches (the quantile cut
points, the in-range window, the range offsets, the final sums), so each rank
function checkpoints it once to the shared checkpoint folder: the input is
scanned and aggregated once, and a lost executor re-reads the checkpoint
instead of recomputing from the source.  That makes these functions run one
job when called (the checkpoint); everything after it stays lazy.

Sums that feed U statistics are exact DECIMAL(38,0) (doubled midranks are
integers), so U stays exact at any row count.  p-values need a distribution
function Spark lacks; they are computed from the one-row result by
:func:`test_result`, a small driver-side helper over already-reduced data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = None  # sized from the data by auto_buckets
MIN_BUCKETS = 256
VALUES_PER_BUCKET = 1_000_000
EXACT = "decimal(38,0)"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint under ``spark.checkpoint.dir`` (never executor-local)."""
    return df.checkpoint(eager=True)


def _cols(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


# ------------------------------------------------------------------ running counts
def buckets_for(n: int) -> int:
    """Range count for ``n`` distinct values: about a million per range, however many there are."""
    b = MIN_BUCKETS
    while b * VALUES_PER_BUCKET < n:
        b *= 2
    return b


def auto_buckets(counts: DataFrame) -> int:
    """:func:`buckets_for` the row count of ``counts`` (one cheap job)."""
    return buckets_for(counts.count())


def cumulative_counts(counts: DataFrame, value: str, count_cols: Sequence[str] | str,
                      keys=None, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Add ``before_<c>`` = sum of ``c`` over rows with the same keys and a smaller value.

    ``counts`` must hold one row per (keys, value).  With ``buckets=None`` the
    table is counted first and cut into :func:`buckets_for` quantile ranges;
    tables of every size take this one path.
    """
    keys = _cols(keys)
    count_cols = _cols(count_cols)
    if buckets is None:
        buckets = auto_buckets(counts)
    bucketed = with_quantile_bucket(counts, value, buckets)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    for c in count_cols:
        bucketed = bucketed.withColumn(f"_in_{c}", F.coalesce(F.sum(c).over(inside), F.lit(0)))
    lower = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(f"_tot_{c}") for c in count_cols])
    for c in count_cols:
        offsets = offsets.withColumn(f"_off_{c}", F.coalesce(F.sum(f"_tot_{c}").over(lower), F.lit(0)))
    offsets = offsets.select(*keys, "_bucket", *[f"_off_{c}" for c in count_cols])
    out = bucketed.join(offsets, [*keys, "_bucket"], "inner")
    for c in count_cols:
        out = out.withColumn(f"before_{c}", (F.col(f"_off_{c}") + F.col(f"_in_{c}")).cast("long"))
    return out.drop("_bucket", *[f"_in_{c}" for c in count_cols], *[f"_off_{c}" for c in count_cols])


def with_quantile_bucket(df: DataFrame, value: str, buckets: int,
                         out: str = "_bucket") -> DataFrame:
    """Add ``out``: index of ``value``'s approximate-quantile range among ``buckets``.

    The ``buckets - 1`` cut points are one scalar subquery; the index is the
    number of cut points below the value, found by binary search: one
    projection per probe (log2(buckets) of them), each a single
    ``try_element_at`` compare.  Equal values share a range and ranges follow
    the value order.
    """
    if buckets == 1:  # no cut points: one range
        return df.withColumn(out, F.lit(0))
    steps = 1
    while steps < buckets:
        steps *= 2
    fractions = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 4 * buckets)  # cut points finer than the ranges they cut
    bounds = df.select(F.percentile_approx(value, fractions, accuracy)).scalar()
    v = F.col(value)
    out_df = df.withColumn("_cuts", bounds).withColumn(out, F.lit(0))  # subquery referenced once
    step = steps // 2
    while step >= 1:
        probe = F.col(out) + step
        out_df = out_df.withColumn(out, F.when(F.try_element_at(F.col("_cuts"), probe) < v, probe)
                                   .otherwise(F.col(out)))
        step //= 2
    return out_df.drop("_cuts")


def midranks(df: DataFrame, value: str, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """One row per distinct non-null ``value``: ``n`` rows and their average rank ``midrank``."""
    counts = materialize(df.select(value).filter(F.col(value).isNotNull())
                         .groupBy(value).agg(F.count(F.lit(1)).alias("n")))
    ranked = cumulative_counts(counts, value, "n", buckets=buckets)
    return ranked.select(value, "n", (F.col("before_n") + (F.col("n") + 1) / 2.0).alias("midrank"))


# ------------------------------------------------------------------------- z-score
def zscore(df: DataFrame, value: str, by=None, name: str = "z") -> DataFrame:
    """Standardise ``value`` with its mean and sample standard deviation.

    Without ``by`` the statistics are one scalar subquery over all rows (not per
    Arrow batch); with ``by`` they are per group and joined back on the keys.
    A zero or undefined deviation gives null.
    """
    keys = _cols(by)
    x = F.col(value).cast("double")
    if not keys:
        s = df.select(F.struct(F.avg(x).alias("mu"), F.stddev_samp(x).alias("sd"))).scalar()
        return (df.withColumn("_s", s)
                .withColumn(name, F.try_divide(x - F.col("_s.mu"), F.col("_s.sd")))
                .drop("_s"))
    stats = df.groupBy(*keys).agg(F.avg(x).alias("_mu"), F.stddev_samp(x).alias("_sd"))
    return (df.join(stats, keys, "left")
            .withColumn(name, F.try_divide(x - F.col("_mu"), F.col("_sd")))
            .drop("_mu", "_sd"))


# ---------------------------------------------------------------- chance criterion
def chance_criterion(df: DataFrame, label: str = "Label", exclude: str | None = "Label",
                     denominator: str = "filtered") -> DataFrame:
    """Proportional chance criterion: sum of squared class shares (one row, ``pcc``).

    Rows whose label equals ``exclude`` (repeated CSV headers) are dropped.
    ``denominator="filtered"`` divides by the remaining rows; ``"all"`` keeps
    the dropped rows in the denominator, as the original code did.
    """
    kept = df.filter(F.col(label) != exclude) if exclude is not None else df.filter(F.col(label).isNotNull())
    counts = kept.groupBy(label).agg(F.count(F.lit(1)).cast("double").alias("c"))
    if denominator == "filtered":
        return counts.agg((F.sum(F.col("c") * F.col("c")) / F.pow(F.sum("c"), 2)).alias("pcc"))
    if denominator == "all":
        total = df.select(F.count(F.lit(1)).cast("double")).scalar()
        return counts.agg(F.sum(F.pow(F.col("c") / total, 2)).alias("pcc"))
    raise ValueError("denominator must be 'filtered' or 'all'")


# ------------------------------------------------------------------- Mann-Whitney U
def _two_group_counts(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    g = F.col(group)
    return materialize(df.select(F.col(value), g).filter(F.col(value).isNotNull() & g.isin(a, b))
                       .groupBy(value)
                       .agg(F.count_if(g == a).alias("c1"), F.count_if(g == b).alias("c2"))
                       .withColumn("t", F.col("c1") + F.col("c2")))


def mann_whitney(df: DataFrame, value: str, group: str, a, b,
                 buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Two-sided Mann-Whitney U of ``value`` between groups ``a`` and ``b``.

    One row: ``n1, n2, u`` (U of group ``a``) and ``z`` (tie-corrected normal
    score with continuity correction, of ``max(U1, U2)`` as scipy reports it).
    ``p = erfc(z / sqrt 2)`` is added by :func:`test_result`.
    """
    counts = _two_group_counts(df, value, group, a, b)
    ranked = cumulative_counts(counts, value, "t", buckets=buckets)
    twice_rank = (2 * F.col("before_t") + F.col("t") + 1).cast(EXACT)
    t = F.col("t").cast(EXACT)
    sums = ranked.agg(
        F.sum("c1").alias("n1"), F.sum("c2").alias("n2"),
        F.sum(F.col("c1").cast(EXACT) * twice_rank).alias("r1x2"),
        F.sum(t * t * t - t).alias("ties"))
    n1, n2 = F.col("n1").cast(EXACT), F.col("n2").cast(EXACT)
    u1 = ((F.col("r1x2") - n1 * (n1 + 1)) / 2).cast("double")
    n1d, n2d = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1d + n2d
    mu = n1d * n2d / 2.0
    sigma = F.sqrt(n1d * n2d / 12.0 * ((n + 1.0) - F.col("ties").cast("double") / (n * (n - 1.0))))
    u_big = F.greatest(F.col("u"), n1d * n2d - F.col("u"))
    return (sums.select("n1", "n2", "ties", u1.alias("u"))
            .select("n1", "n2", "u", F.try_divide(u_big - mu - 0.5, sigma).alias("z")))


# --------------------------------------------------------------- Spearman rank corr
def spearman(df: DataFrame, x: str, y: str, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Spearman rank correlation (average ranks for ties), one row ``rho``.

    Rows are collapsed to distinct ``(x, y)`` pairs with a weight; the ranks of
    ``y`` are joined to them and summed per ``x`` (partly before the shuffle), so
    the ranks of ``x`` meet one row per distinct ``x``, however few there are.
    Doubled midranks are integers, so every sum is exact DECIMAL(38,0) and the
    centring uses the exact mean: 4*cov = sum(w*2rx*2ry) - n*(n+1)^2, likewise
    for the variances.  No extra pass for ``n``.
    """
    pairs = materialize(df.select(F.col(x).alias("_x"), F.col(y).alias("_y"))
                        .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
                        .groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("w")))
    rx = twice_midranks_of_weighted(pairs, "_x", buckets).withColumnRenamed("r2", "rx2")
    ry = twice_midranks_of_weighted(pairs, "_y", buckets).withColumnRenamed("r2", "ry2")
    w, a, b = F.col("w").cast(EXACT), F.col("rx2").cast(EXACT), F.col("ry2").cast(EXACT)
    by_x = (pairs.join(ry, "_y").groupBy("_x")
            .agg(F.sum(w).alias("w"), F.sum(w * b).alias("wb"), F.sum(w * b * b).alias("wbb")))
    sums = by_x.join(rx, "_x").agg(F.sum(w).alias("n"), F.sum(a * F.col("wb")).alias("sxy"),
                                   F.sum(w * a * a).alias("sxx"), F.sum("wbb").alias("syy"))
    n = F.col("n")
    centre = n * (n + 1) * (n + 1)
    cov, vx, vy = (F.col("sxy") - centre), (F.col("sxx") - centre), (F.col("syy") - centre)
    return sums.select(F.try_divide(cov.cast("double"),
                                    F.sqrt(vx.cast("double")) * F.sqrt(vy.cast("double"))).alias("rho"))


def twice_midranks_of_weighted(pairs: DataFrame, value: str, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Twice the average rank of each distinct ``value`` (an integer), rows weighted by ``w``."""
    counts = materialize(pairs.groupBy(value).agg(F.sum("w").alias("n")))
    ranked = cumulative_counts(counts, value, "n", buckets=buckets)
    return ranked.select(value, (2 * F.col("before_n") + F.col("n") + 1).alias("r2"))


def spearman_mllib(df: DataFrame, x: str, y: str) -> float:
    """The MLlib form: ``Correlation.corr(method='spearman')`` (runs a job)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    vec = VectorAssembler(inputCols=[x, y], outputCol="_features", handleInvalid="skip")
    data = vec.transform(df.select(F.col(x).cast("double"), F.col(y).cast("double")))
    return float(Correlation.corr(data, "_features", method="spearman").first()[0][0, 1])


# ------------------------------------------------------------ Kolmogorov-Smirnov (2)
def ks_2samp(df: DataFrame, value: str, group: str, a, b,
             buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Two-sample KS statistic ``d``: the largest gap between the two running shares."""
    counts = _two_group_counts(df, value, group, a, b)
    ranked = cumulative_counts(counts, value, ["c1", "c2"], buckets=buckets)
    tot = counts.select(F.struct(F.sum("c1").cast("double").alias("n1"),
                                 F.sum("c2").cast("double").alias("n2"))).scalar()
    staged = ranked.withColumn("_t", tot)  # subquery referenced once
    gap = F.abs((F.col("before_c1") + F.col("c1")) / F.col("_t.n1")
                - (F.col("before_c2") + F.col("c2")) / F.col("_t.n2"))
    return staged.agg(F.max(gap).alias("d"), F.first("_t.n1").cast("long").alias("n1"),
                      F.first("_t.n2").cast("long").alias("n2"))


# Fixed values of a rational approximation of the normal tail (Hart's), highest power first.
NORMAL_UPPER = (3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
NORMAL_LOWER = (8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def normal_cdf(z) -> Column:
    """The standard normal distribution function as a native expression, exact to about 1e-14."""
    x = F.abs(z)

    def polynomial(powers):
        out = F.lit(powers[0])
        for c in powers[1:]:
            out = out * x + F.lit(c)
        return out

    fraction = x + 0.65
    for i in (4, 3, 2, 1):  # far out: a continued fraction
        fraction = x + F.lit(float(i)) / fraction
    density = F.exp(-x * x / 2)
    tail = F.when(x < 7.07106781186547, density * polynomial(NORMAL_UPPER) / polynomial(NORMAL_LOWER)).otherwise(density / fraction / 2.506628274631)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def ks_1samp(df: DataFrame, value: str, mean: float | None = None, deviation: float | None = None,
             buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """One-sample KS test against a normal distribution: ``n, d, d_plus, d_minus``.

    ``d_plus`` is how far the share of rows up to a value rises above the
    distribution, ``d_minus`` how far it falls below just before a value, ``d``
    the larger.  Without ``mean`` or ``deviation`` those of the rows are taken
    (deviation over n).  Rows collapse to distinct values, which are ranked by
    ranges; no row meets another.  Nulls are left out; no rows give nulls, and
    so do equal rows, which have no deviation.
    """
    x = F.col(value).cast("double")
    counts = materialize(df.select(x.alias(value)).filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("c")))
    w = F.col("c").cast("double")
    total = counts.agg(F.sum("c").alias("n"), (F.sum(w * F.col(value)) / F.sum(w)).alias("m"))
    n, m = total.select("n").scalar(), total.select("m").scalar()
    mean_of = F.lit(float(mean)) if mean is not None else m
    spread = counts.withColumn("_m", mean_of).agg(F.sqrt(F.sum(w * (F.col(value) - F.col("_m")) * (F.col(value) - F.col("_m"))) / F.sum(w)))
    sd_of = F.lit(float(deviation)) if deviation is not None else spread.scalar()
    ranked = cumulative_counts(counts, value, "c", buckets=buckets).withColumn("_n", n).withColumn("_m", mean_of).withColumn("_sd", sd_of)
    below = normal_cdf(F.try_divide(F.col(value) - F.col("_m"), F.col("_sd")))
    gaps = ranked.withColumn("_f", F.when(F.col("_sd") > 0, below))
    out = gaps.agg(F.first("_n").alias("n"), F.max((F.col("before_c") + F.col("c")) / F.col("_n") - F.col("_f")).alias("d_plus"),
                   F.max(F.col("_f") - F.col("before_c") / F.col("_n")).alias("d_minus"))
    return out.select("n", F.greatest("d_plus", "d_minus").alias("d"), "d_plus", "d_minus")


def ks_1samp_mllib(df: DataFrame, value: str, dist: str = "norm", *params: float) -> DataFrame:
    """The MLlib form, against a named distribution: ``pValue, statistic`` (runs a job)."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    data = df.select(F.col(value).cast("double").alias(value)).filter(F.col(value).isNotNull())
    return KolmogorovSmirnovTest.test(data, value, dist, *params)


# ------------------------------------------------------------------ Kruskal-Wallis
def kruskal(df: DataFrame, value: str, group: str, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Kruskal-Wallis H (tie-corrected) over all groups: one row ``k, n, h``.

    Rank sums come from (value, group) cell counts joined to the value's
    doubled midrank, summed exactly; H adds up the groups' squared distances
    from the mean rank, so no two nearly equal numbers are subtracted.  The tie term sum(t^3 - t) over values equals sum(c * (t^2 - 1))
    over cells, so everything is one pass over the per-group table.
    """
    data = df.select(F.col(value), F.col(group)).filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    per_cell = materialize(data.groupBy(value, group).agg(F.count(F.lit(1)).alias("c")))
    ranks = cumulative_counts(per_cell.groupBy(value).agg(F.sum("c").alias("t")), value, "t",
                              buckets=buckets)
    ranks = ranks.select(value, "t", (2 * F.col("before_t") + F.col("t") + 1).alias("r2"))
    cells = per_cell.join(ranks, value)
    t = F.col("t").cast("double")
    per_group = cells.groupBy(group).agg(F.sum("c").cast("double").alias("ng"),
                                         (F.sum(F.col("c").cast(EXACT) * F.col("r2")).cast("double") / 2).alias("rg"),
                                         F.sum(F.col("c") * (t * t - 1.0)).alias("tie"))
    total = per_cell.agg(F.sum("c").cast("double").alias("n")).scalar()
    away = F.col("rg") / F.col("ng") - (F.col("n_all") + 1.0) / 2
    agg = per_group.withColumn("n_all", total).agg(
        F.count(F.lit(1)).alias("k"), F.sum("ng").alias("n"),
        F.sum(F.col("ng") * away * away).alias("s"), F.sum("tie").alias("tie"))
    n = F.col("n")
    h = 12.0 / (n * (n + 1.0)) * F.col("s")
    return agg.select("k", n.cast("long").alias("n"),
                      F.try_divide(h, 1.0 - F.col("tie") / (n * n * n - n)).alias("h"))


# ----------------------------------------------------------------------- Levene
def _group_value_counts(df: DataFrame, value: str, group: str) -> DataFrame:
    return materialize(df.select(F.col(value).cast("double").alias(value), F.col(group))
                       .filter(F.col(value).isNotNull() & F.col(group).isNotNull())
                       .groupBy(group, value).agg(F.count(F.lit(1)).alias("c")))


def _medians_of_counts(counts: DataFrame, value: str, group: str, buckets: int | None) -> DataFrame:
    ranked = cumulative_counts(counts, value, "c", keys=[group], buckets=buckets)
    sizes = counts.groupBy(group).agg(F.sum("c").alias("ng"))
    lo_pos = F.floor((F.col("ng") + 1) / 2)
    hi_pos = F.floor(F.col("ng") / 2) + 1
    covers = lambda p: (F.col("before_c") < p) & (p <= F.col("before_c") + F.col("c"))
    return (ranked.join(sizes, group)
            .filter(covers(lo_pos) | covers(hi_pos))
            .groupBy(group)
            .agg(F.avg(value).alias("median"), F.first("ng").alias("ng")))


def group_medians(df: DataFrame, value: str, group: str, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Exact median per group from running counts (no per-group value lists)."""
    return _medians_of_counts(_group_value_counts(df, value, group), value, group, buckets)


def levene(df: DataFrame, value: str, group: str, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Brown-Forsythe / Levene W with median centring: one row ``k, n, w``.

    The source is read once, into one weighted row per (group, value); the
    deviations are taken from that table.  With per-group size n_g and mean
    deviation z_g, the between-group sum is sum(n_g (z_g - z)^2) around the
    overall mean z, the within-group sum is sum(c (z_i - z_g)^2).
    """
    counts = _group_value_counts(df, value, group)
    med = _medians_of_counts(counts, value, group, buckets).select(group, "median")
    c = F.col("c").cast("double")
    z = counts.join(med, group).select(group, c.alias("_c"), F.abs(F.col(value) - F.col("median")).alias("_z"))
    means = materialize(z.groupBy(group).agg(F.sum("_c").alias("ng"),
                                             (F.sum(F.col("_c") * F.col("_z")) / F.sum("_c")).alias("zg")))
    spread = (z.join(means.select(group, "zg"), group).select(group, "_c", (F.col("_z") - F.col("zg")).alias("_d"))
              .groupBy(group).agg(F.sum(F.col("_c") * F.col("_d") * F.col("_d")).alias("within")))
    mean = means.agg((F.sum(F.col("ng") * F.col("zg")) / F.sum("ng")).alias("z")).scalar()
    away = F.col("zg") - F.col("z_all")
    agg = means.withColumn("z_all", mean).join(spread, group).agg(
        F.count(F.lit(1)).alias("k"), F.sum("ng").alias("n"),
        F.sum(F.col("ng") * away * away).alias("between"), F.sum("within").alias("within"))
    k, n = F.col("k").cast("double"), F.col("n")
    return agg.select(F.col("k").cast("long").alias("k"), n.cast("long").alias("n"),
                      F.try_divide((n - k) * F.col("between"), (k - 1.0) * F.col("within")).alias("w"))


# ------------------------------------------------------------------ p-value helpers
def normal_sf2(z: float) -> float:
    """Two-sided normal tail for a non-negative score."""
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


def chi2_sf(x: float, dof: float) -> float:
    """Upper tail of chi-square: regularised upper incomplete gamma Q(dof/2, x/2)."""
    return _gamma_q(dof / 2.0, x / 2.0)


def _gamma_q(a: float, x: float) -> float:
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:  # series for P, then 1 - P
        term = total = 1.0 / a
        ap = a
        for _ in range(10_000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - gln))
    b = x + 1.0 - a  # continued fraction for Q (Lentz)
    c, d = 1.0 / 1e-300, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def f_sf(x: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution: I_{d2/(d2+d1 x)}(d2/2, d1/2)."""
    if x <= 0:
        return 1.0
    return _betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * x))


def _betainc(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _betainc(b, a, 1.0 - x)
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (1e-300 if abs(d) < 1e-300 else d)
    h = d
    for m in range(1, 10_000):
        m2 = 2 * m
        for num in (m * (b - m) * x / ((a + m2 - 1.0) * (a + m2)),
                    -(a + m) * (a + b + m) * x / ((a + m2) * (a + m2 + 1.0))):
            d = 1.0 + num * d
            d = 1.0 / (1e-300 if abs(d) < 1e-300 else d)
            c = 1.0 + num / c
            c = 1e-300 if abs(c) < 1e-300 else c
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * h / a


def ks_sf(d: float, n1: int, n2: int) -> float:
    """Asymptotic two-sample KS p-value (Kolmogorov distribution)."""
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-8:
        return 1.0
    total, sign = 0.0, 1.0
    for j in range(1, 200):
        term = 2.0 * sign * math.exp(-2.0 * (j * lam) ** 2)
        total += term
        if abs(term) < 1e-16:
            break
        sign = -sign
    return min(1.0, max(0.0, total))


def test_result(stat_df: DataFrame, kind: str) -> dict:
    """Take the one-row statistic and add its p-value (driver-side, one row)."""
    row = stat_df.first().asDict()
    if kind == "mann_whitney":
        row["p"] = normal_sf2(abs(row["z"])) if row["z"] is not None else None
    elif kind == "kruskal":
        row["p"] = chi2_sf(row["h"], row["k"] - 1) if row["h"] is not None else None
    elif kind == "levene":
        row["p"] = f_sf(row["w"], row["k"] - 1, row["n"] - row["k"]) if row["w"] is not None else None
    elif kind == "ks":
        row["p"] = ks_sf(row["d"], row["n1"], row["n2"]) if row["d"] is not None else None
    else:
        raise ValueError(kind)
    return row
