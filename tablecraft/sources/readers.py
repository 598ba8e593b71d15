"""File readers with the options the analyses need.

Declared schemas are preferred everywhere (no inference pass over the data);
the inferring forms exist for exploration.  All readers are lazy Spark scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv_text(spark: SparkSession, path, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV with every column as text (globs, compressed files and folders welcome)."""
    return spark.read.option("header", header).option("sep", sep).csv(path)


def read_csv_inferred(spark: SparkSession, path, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV with inferred types (runs an extra pass over the data to infer)."""
    return (spark.read.option("header", header).option("sep", sep)
            .option("inferSchema", True).csv(path))


def read_csv_declared(spark: SparkSession, path, schema: str, sep: str = ",",
                      header: bool = False, raw: bool = False) -> DataFrame:
    """CSV with a declared DDL schema; ``raw`` turns quote and escape handling off."""
    reader = spark.read.schema(schema).option("header", header).option("sep", sep)
    if raw:
        reader = reader.option("quote", "").option("escape", "")
    return reader.csv(path)


def read_json(spark: SparkSession, path, schema: str | None = None,
              multiline: bool = False) -> DataFrame:
    """JSON lines (or one pretty-printed document per file with ``multiline``)."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.option("multiLine", multiline).json(path)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line: ``value``."""
    return spark.read.text(path)


def read_whole_texts(spark: SparkSession, path) -> DataFrame:
    """One row per file: ``path`` and the whole text ``value``.

    Small files share a task: Spark packs them up to
    ``spark.sql.files.maxPartitionBytes``, each counted with
    ``spark.sql.files.openCostInBytes``; a file is never cut.
    """
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value")


def json_from_text_files(spark: SparkSession, path, schema: str) -> DataFrame:
    """JSON documents one per line inside text files, parsed JVM-side with a declared schema."""
    return spark.read.text(path).select(F.from_json("value", schema).alias("doc")).select("doc.*")


def json_lines_checked(spark: SparkSession, path, schema: str) -> DataFrame:
    """Every line of JSON text files: ``path, line, doc, reason``; nothing is dropped.

    ``doc`` is the line parsed with ``schema``; where it cannot be, ``doc`` is
    null and ``reason`` says why: ``blank``, ``no JSON object`` (broken, cut or
    another kind of value) or ``wrong type`` (an object, but a field does not
    fit its type).  Missing fields are null, extra ones ignored.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    parsed = lines.withColumn("doc", F.from_json("line", f"{schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"}))
    reason = (F.when(F.trim("line") == "", "blank").when(F.json_object_keys("line").isNull(), "no JSON object")
              .when(F.col("doc._corrupt").isNotNull(), "wrong type"))
    return (parsed.withColumn("reason", reason)
            .select("path", "line", F.when(F.col("reason").isNull(), F.col("doc").dropFields("_corrupt")).alias("doc"), "reason"))


def json_lines_split(spark: SparkSession, path, schema: str) -> tuple[DataFrame, DataFrame]:
    """The typed rows of JSON text files, and the lines that gave none (``path, line, reason``)."""
    rows = json_lines_checked(spark, path, schema)
    return rows.filter("reason IS NULL").select("doc.*"), rows.filter("reason IS NOT NULL").select("path", "line", "reason")


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """File paths and sizes under a prefix (file contents are never read)."""
    return spark.read.format("binaryFile").load(glob).select("path", "length", "modificationTime")
