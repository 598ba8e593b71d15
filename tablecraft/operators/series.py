"""Packed page-view series.

A monthly dump row packs its views as ``<day letter><hour letter><count>...``
per day, days joined by commas.  Day ``d`` is ``chr(64 + d)`` and hour ``h`` is
``chr(65 + h)``, so days 27..31 are the characters after ``Z`` (day 28 is a
backslash: read such files with quote and escape characters off).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGEVIEW_SCHEMA = "project STRING, page STRING, monthly_total BIGINT, hourly_counts STRING"


def read_pageviews(spark: SparkSession, path) -> DataFrame:
    """Space-separated, header-less dump files (bz2 and globs welcome)."""
    return (spark.read.schema(PAGEVIEW_SCHEMA)
            .option("sep", " ").option("quote", "").option("escape", "")
            .csv(path))


def day_views(daily) -> F.Column:
    """Total views of one packed day: the digits after the first hour letter, summed.

    A count beyond the long range is an error, never skipped.
    """
    counts = F.filter(F.split(F.substr(daily, F.lit(3)), r"\D"), lambda x: x != "")
    return F.aggregate(counts, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def mean_daily_views(df: DataFrame, project: str = "en.z", page: str = "Big_Data") -> DataFrame:
    """Mean views per day of month for one page, sorted by day."""
    days = (df.filter((F.col("project") == project) & (F.col("page") == page))
            .select(F.explode(F.split("hourly_counts", ",")).alias("daily"))
            .filter(F.col("daily") != ""))
    return (days.select((F.ascii("daily") - 64).alias("day"), day_views(F.col("daily")).alias("views"))
            .groupBy("day").agg(F.avg("views").alias("mean daily views"))
            .orderBy("day"))
