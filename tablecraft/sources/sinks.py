"""Sinks: partitioned Parquet, plain Parquet, small result CSVs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cluster_for_partitioned_write(df: DataFrame, by) -> DataFrame:
    """Rebalance rows on the partition columns, so each task writes few folders.

    Spark sizes the tasks from the measured bytes: small values share a task,
    and a value holding a third of the rows is split over as many as it needs.
    """
    cols = [by] if isinstance(by, str) else list(by)
    return df.hint("rebalance", *cols)


def write_partitioned(df: DataFrame, path: str, by, mode: str = "overwrite") -> None:
    """Parquet partitioned by ``by`` (one folder per value; readers prune them)."""
    cols = [by] if isinstance(by, str) else list(by)
    cluster_for_partitioned_write(df, cols).write.mode(mode).partitionBy(*cols).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with Spark's default mode: fail if the folder exists."""
    df.write.mode(mode).parquet(path)


def save_small_csv(df: DataFrame, path: str, limit: int | None = None,
                   mode: str = "overwrite") -> None:
    """A small, already reduced result (or its first ``limit`` rows) as one CSV file with a header."""
    if limit is not None:
        df = df.limit(limit)
    df.repartition(1).write.mode(mode).option("header", True).csv(path)
