"""Readers (S1-S6, S9, S11) and the Python UDF forms (F2, F3, F5) against their native twins."""

import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablecraft.functions import udfs as U
from tablecraft.operators import stats as S
from tablecraft.sources import readers as RD


def test_csv_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2.5\n3;\n")
    text = RD.read_csv_text(spark, str(tmp_path / "*.csv"), sep=";")
    assert dict(text.dtypes) == {"x": "string", "y": "string"}
    inferred = RD.read_csv_inferred(spark, str(tmp_path / "a.csv"), sep=";")
    assert dict(inferred.dtypes) == {"x": "int", "y": "double"}
    (tmp_path / "raw.txt").write_text('en.z "Quote 7 \\A1,\n')
    raw = RD.read_csv_declared(spark, str(tmp_path / "raw.txt"), "p STRING, page STRING, n INT, h STRING",
                               sep=" ", raw=True).first()
    assert (raw["page"], raw["n"], raw["h"]) == ('"Quote', 7, "\\A1,")


def test_json_text_and_files(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "pretty").mkdir()
    (tmp_path / "pretty" / "doc.json").write_text(json.dumps({"a": 3}, indent=2))
    assert [r["a"] for r in RD.read_json(spark, str(tmp_path / "lines.json"), "a INT").collect()] == [1, 2]
    assert RD.read_json(spark, str(tmp_path / "pretty"), "a INT", multiline=True).first()["a"] == 3
    parsed = RD.json_from_text_files(spark, str(tmp_path / "lines.json"), "a INT")
    assert sorted(r["a"] for r in parsed.collect()) == [1, 2]
    assert RD.read_lines(spark, str(tmp_path / "lines.json")).count() == 2
    whole = RD.read_whole_texts(spark, str(tmp_path / "lines.json")).first()
    assert whole["path"].endswith("lines.json") and whole["value"].count("\n") == 2
    listing = RD.list_files(spark, str(tmp_path / "*.json")).collect()
    assert len(listing) == 1 and listing[0]["length"] > 0


def test_fare_struct_udf_equals_native(spark):
    cols = U.FARE_FIELDS
    row = tuple(float(i) + 0.1 for i in range(len(cols)))
    df = spark.createDataFrame([row, tuple([None] * len(cols))], ", ".join(f"{c} double" for c in cols))
    native = df.select(U.fare_struct().alias("s")).collect()
    pandas = df.select(U.fare_struct_udf()(*[F.col(c) for c in cols]).alias("s")).collect()
    for a, b in zip(native, pandas):
        for c in cols:
            x, y = a["s"][c], b["s"][c]
            assert (x is None and (y is None or math.isnan(y))) or x == pytest.approx(y)


def test_zscore_udf_is_per_batch_but_native_is_global(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.createDataFrame(pd.DataFrame({"x": [float(i) for i in range(20)]})).coalesce(1)
        per_batch = [r[0] for r in df.select(U.zscore_udf()("x")).collect()]
        native = [r["z"] for r in S.zscore(df, "x").collect()]
        assert per_batch[0] == pytest.approx(per_batch[10])  # each batch standardised on its own
        assert native[0] != pytest.approx(native[10])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_grouped_sorted_distinct_equals_native(spark):
    df = spark.createDataFrame([("h1", 10), ("h1", 2), ("h1", 10), ("h2", 5)], "h string, v int")
    grouped = {r["h"]: r["vals"] for r in U.sorted_distinct_grouped(df, "h", "v", "vals").collect()}
    native = {r["h"]: r["vals"] for r in df.groupBy("h").agg(F.sort_array(F.collect_set("v")).alias("vals")).collect()}
    assert grouped == native == {"h1": [2, 10], "h2": [5]}


def test_ks_one_sample(spark):
    df = spark.createDataFrame([(float(x) / 10,) for x in range(-30, 31)], "x double")
    row = S.ks_1samp_mllib(df, "x", "norm", 0.0, 1.0).first()
    assert 0.0 <= row["pValue"] <= 1.0 and row["statistic"] > 0


def test_ship_package_once_per_application(spark):
    import zipfile

    from pyspark import SparkFiles

    from tablecraft import session as SS
    SS._SHIPPED.discard(spark.sparkContext.applicationId)
    SS.ship_package(spark)
    SS.ship_package(spark)  # second call is a no-op
    names = zipfile.ZipFile(SparkFiles.get("tablecraft-src.zip")).namelist()
    assert "tablecraft/operators/ingest.py" in names and "tablecraft/plans/registry.py" in names
    assert spark.sparkContext.applicationId in SS._SHIPPED
