"""Grouped profiles: means, distinct counts, time buckets, pivots, histograms.

All of these are one hash aggregate (partial per task, final after one shuffle
on the group key) over columns pruned at the scan.  One-row statistics such as
a histogram's range are scalar subqueries: Spark runs them once and inlines the
value, so no cross join and no driver round trip is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.temporal import (
    hour_of_epoch_millis, on_day, weekday0, year_month_of_epoch)


def _cols(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


# ------------------------------------------------------------------ trips profiles
def mean_of(value, exact_scale: int | None = None) -> Column:
    """Mean of a column, nulls skipped.

    With ``exact_scale`` (e.g. 2 for money in cents) the sum is an exact
    DECIMAL(38, scale), so the mean does not depend on summation order or
    partitioning: the same data gives the same bits on every run and engine.
    """
    c = F.col(value) if isinstance(value, str) else value
    if exact_scale is None:
        return F.avg(c)
    total = F.sum(c.cast(f"decimal(38,{exact_scale})")).cast("double")
    return F.try_divide(total, F.count(c).cast("double"))


def mean_by(df: DataFrame, key: str = "PULocationID", value: str = "fare_amount",
            name: str = "mean fare amount", exact_scale: int | None = None) -> DataFrame:
    """Mean of ``value`` per ``key``, sorted by key (nulls skipped)."""
    return df.groupBy(key).agg(mean_of(value, exact_scale).alias(name)).orderBy(key)


MEAN_BY_SQL = """
    SELECT {key}, {mean} AS `{name}`
    FROM {view}
    GROUP BY {key}
    ORDER BY {key}
"""


def mean_by_sql(df: DataFrame, key: str = "PULocationID", value: str = "fare_amount",
                name: str = "mean fare amount", view: str = "trips", exact_scale: int | None = None) -> DataFrame:
    """SQL form of :func:`mean_by` over a temporary view of ``df``."""
    df.createOrReplaceTempView(view)
    mean = f"avg({value})" if exact_scale is None else (
        f"try_divide(CAST(sum(CAST({value} AS DECIMAL(38,{exact_scale}))) AS DOUBLE), CAST(count({value}) AS DOUBLE))")
    return df.sparkSession.sql(MEAN_BY_SQL.format(key=key, mean=mean, name=name, view=view))


def distinct_per_hour(df: DataFrame, ts: str = "lpep_pickup_datetime",
                      value: str = "PULocationID") -> DataFrame:
    """Hour bucket (text) and the sorted array of distinct ``value`` seen in it.

    The set per hour is bounded by the value's domain, not by the row count.
    """
    # Group on the truncated timestamp (8 bytes) and format once per group.
    return (df.select(F.date_trunc("hour", ts).alias("_hour"), F.col(value))
            .groupBy("_hour")
            .agg(F.sort_array(F.collect_set(value)).alias("pickup_locations"))
            .orderBy("_hour")
            .select(F.date_format("_hour", "yyyy-MM-dd HH:mm:ss").alias("pickup_hour"), "pickup_locations"))


DISTINCT_PER_HOUR_SQL = """
    WITH hourly AS (
        SELECT date_trunc('hour', {ts}) AS bucket, collect_set({value}) AS found
        FROM {view}
        GROUP BY 1)
    SELECT date_format(bucket, 'yyyy-MM-dd HH:mm:ss') AS pickup_hour, array_sort(found) AS pickup_locations
    FROM hourly
    ORDER BY bucket
"""

CREATION_YEARS_SQL = """
    WITH accounts AS (
        SELECT DISTINCT user.id AS account, try_cast(right(user.created_at, 4) AS INT) AS year
        FROM {view}
        WHERE created_at IS NOT NULL)
    SELECT year, count(account) AS frequency
    FROM accounts
    GROUP BY year
    ORDER BY frequency DESC, year
"""


def distinct_per_hour_sql(df: DataFrame, ts: str = "lpep_pickup_datetime",
                          value: str = "PULocationID", view: str = "trips") -> DataFrame:
    """SQL form of :func:`distinct_per_hour` (group on the hour, format once per group)."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(DISTINCT_PER_HOUR_SQL.format(ts=ts, value=value, view=view))


def creation_years_sql(df: DataFrame, view: str = "tweets2") -> DataFrame:
    """SQL form of :func:`creation_years`."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(CREATION_YEARS_SQL.format(view=view))


def distinct_counts_by_hour(df: DataFrame, ts: str = "lpep_pickup_datetime",
                            cols: Sequence[str] = ("PULocationID", "DOLocationID")) -> DataFrame:
    """Exact distinct count of each column per hour of day."""
    return (df.select(F.hour(ts).alias("hour"), *cols)
            .groupBy("hour")
            .agg(*[F.countDistinct(c).alias(c) for c in cols])
            .orderBy("hour"))


def pair_key(a: str = "PULocationID", b: str = "DOLocationID") -> Column:
    return F.concat_ws("-", F.col(a).cast("string"), F.col(b).cast("string"))


def pair_count_by_hour(df: DataFrame, ts: str = "lpep_pickup_datetime",
                       a: str = "PULocationID", b: str = "DOLocationID") -> DataFrame:
    """Distinct ``a-b`` pairs per hour of day, told apart as :func:`pair_key` does (a null side is left out)."""
    both = F.struct(F.coalesce(a, b).alias("x"), F.when(F.col(a).isNotNull(), F.col(b)).alias("y"))
    return (df.select(F.hour(ts).alias("hour"), both.alias("pair"))
            .groupBy("hour").agg(F.countDistinct("pair").alias("pairs"))
            .orderBy("hour"))


def join_ids(df: DataFrame, a: str = "PULocationID", b: str = "DOLocationID") -> DataFrame:
    """One column ``pudo`` = ``a-b``."""
    return df.select(pair_key(a, b).alias("pudo"))


def trips_by_weekday(df: DataFrame, ts: str = "lpep_pickup_datetime") -> DataFrame:
    """Trips per day of week, Monday = 0 (the table behind the bar chart)."""
    return (df.select(weekday0(ts).alias("day_of_week"))
            .groupBy("day_of_week").agg(F.count(F.lit(1)).alias("trips"))
            .orderBy("day_of_week"))


def mean_matrix(df: DataFrame, row_ts: str = "lpep_pickup_datetime",
                col_ts: str = "lpep_dropoff_datetime", value: str = "tip_amount",
                exact_scale: int | None = None) -> DataFrame:
    """Pickup-hour by dropoff-hour matrix of mean ``value``; missing cells are null.

    The pivot values are fixed (0..23), so Spark needs no extra job to find them.
    """
    hours = list(range(24))
    wide = (df.select(F.hour(row_ts).alias("pu_hour"), F.hour(col_ts).alias("do_hour"), F.col(value))
            .groupBy("pu_hour").pivot("do_hour", hours).agg(mean_of(value, exact_scale)))
    return wide.select("pu_hour", *[F.col(str(h)).alias(f"h_{h:02d}") for h in hours]).orderBy("pu_hour")


def day_slice(df: DataFrame, day: str, ts: str = "lpep_pickup_datetime") -> DataFrame:
    """Rows of one calendar day with hour and minute columns, sorted by time."""
    return (df.filter(on_day(ts, day))
            .withColumn("pickup_hour", F.hour(ts))
            .withColumn("pickup_minute", F.minute(ts))
            .orderBy(ts))


# ----------------------------------------------------------------- tweets, comments
def creation_years(df: DataFrame) -> DataFrame:
    """Distinct users per account creation year, most first."""
    return (df.filter(F.col("created_at").isNotNull())
            .select(F.substring("user.created_at", -4, 4).try_cast("int").alias("year"),
                    F.col("user.id").alias("user_id"))
            .groupBy("year").agg(F.countDistinct("user_id").alias("frequency"))
            .orderBy(F.desc("frequency"), F.asc("year")))


def by_account_month(df: DataFrame, n: int = 12, created: str = "author_created_utc",
                     value: str = "subreddit_id") -> DataFrame:
    """Comments (non-null ``value``) per account creation month, newest ``n`` months."""
    return (df.select(year_month_of_epoch(created).alias("account_created"), F.col(value))
            .groupBy("account_created").agg(F.count(value).alias("comments"))
            .orderBy(F.desc("account_created"))
            .limit(n))


# Fixed value: the header line that carries a crawled URL's fetch time (epoch ms).
FETCH_TIME_PREFIX = "x_commoncrawl_FetchTimestamp:"


def crawl_hours(df: DataFrame, prefix: str = FETCH_TIME_PREFIX) -> DataFrame:
    """Crawled URLs per hour of day from fetch-time header lines (epoch ms)."""
    ms = F.regexp_extract("value", r"\d+", 0).try_cast("long")
    return (df.filter(F.col("value").startswith(prefix))
            .select(hour_of_epoch_millis(ms).alias("hour"))
            .groupBy("hour").count()
            .orderBy("hour"))


# --------------------------------------------------------------------------- matches
def matches_by_mode(df: DataFrame, mode: str = "game_mode", key: str = "match_id") -> DataFrame:
    """Matches per game mode, fewest first (null mode kept as its own group)."""
    return (df.groupBy(mode).agg(F.count(key).alias("matches"))
            .orderBy(F.asc("matches"), F.asc_nulls_first(mode)))


def _with_range(values: DataFrame, col: str, out: str) -> DataFrame:
    """Add ``out`` = ``struct(lo, hi)`` of ``col``: one scalar subquery, referenced once."""
    rng = values.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    return values.withColumn(out, rng)


def _bin_of(x: Column, rng: Column, bins: int) -> Column:
    lo, hi = rng["lo"], rng["hi"]
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor((x - lo) / width)
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 20, by=None) -> DataFrame:
    """Equal-width histogram of ``col``: ``[by...], bin, lo, hi, count``.

    Edges span the overall min..max (shared by every ``by`` group, so groups
    are comparable); the last bin is closed on the right.  Empty bins are
    present with count 0.  The result has at most ``bins`` rows per group.
    The range is one scalar subquery carried as a column into the (small)
    per-bin table, so it is computed once.
    """
    keys = _cols(by)
    values = df.select(*keys, F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    staged = _with_range(values, "x", "_r")
    counts = (staged.select(*keys, _bin_of(F.col("x"), F.col("_r"), bins).alias("bin"), "_r")
              .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"), F.first("_r").alias("_r")))
    per_group = counts.groupBy(*keys).agg(F.first("_r").alias("_r"))
    grid = per_group.select(*keys, "_r", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_r.hi") - F.col("_r.lo")) / F.lit(float(bins))
    return (grid.join(counts.drop("_r"), [*keys, "bin"], "left")
            .select(*keys, "bin",
                    (F.col("_r.lo") + F.col("bin") * width).alias("lo"),
                    (F.col("_r.lo") + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
            .orderBy(*keys, "bin"))


def binned_pairs(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """2-D equal-width binned counts of ``(x, y)``: the scatter plot at any scale."""
    values = (df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
              .filter(F.col("x").isNotNull() & F.col("y").isNotNull()))
    staged = _with_range(_with_range(values, "x", "_rx"), "y", "_ry")
    return (staged.select(_bin_of(F.col("x"), F.col("_rx"), bins).alias("xbin"),
                          _bin_of(F.col("y"), F.col("_ry"), bins).alias("ybin"))
            .groupBy("xbin", "ybin").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("xbin", "ybin"))


def pair_corr(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of two columns (one row, ``r``)."""
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column: one aggregate pass, then unpivot to rows."""
    names = df.columns
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    return wide.unpivot([], [F.col(f"`{c}`") for c in names], "column", "nulls")
