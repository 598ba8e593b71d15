"""Profiles: histograms, pivots, null profile, time buckets."""

import datetime as dt

from tablecraft.operators import profiles as P


def test_histogram_fills_empty_bins_and_closes_last(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,), (10.0,), (None,)], "x double")
    rows = P.histogram(df, "x", bins=5).collect()
    assert [r["bin"] for r in rows] == [0, 1, 2, 3, 4]
    assert [r["count"] for r in rows] == [3, 0, 0, 0, 1]
    assert rows[0]["lo"] == 0.0 and rows[-1]["hi"] == 10.0


def test_histogram_by_group_shares_edges(spark):
    df = spark.createDataFrame([("a", 0), ("a", 4), ("b", 8), ("b", 8)], "g string, x int")
    rows = P.histogram(df, "x", bins=4, by="g").collect()
    assert len(rows) == 8
    by = {(r["g"], r["bin"]): r["count"] for r in rows}
    assert by[("a", 0)] == 1 and by[("a", 2)] == 1 and by[("b", 3)] == 2 and by[("b", 0)] == 0


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3,), (3,)], "x int")
    rows = P.histogram(df, "x", bins=3).collect()
    assert [r["count"] for r in rows] == [2, 0, 0]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "a int, `b.c` string, d string")
    got = {r["column"]: r["nulls"] for r in P.null_profile(df).collect()}
    assert got == {"a": 1, "b.c": 2, "d": 0}


def test_mean_matrix_missing_cells_are_null(spark):
    t = dt.datetime
    rows = [(t(2020, 1, 1, 23, 59), t(2020, 1, 2, 0, 5), 1.0), (t(2020, 1, 1, 23, 10), t(2020, 1, 1, 23, 20), 3.0)]
    df = spark.createDataFrame(rows, "pu timestamp_ntz, do timestamp_ntz, tip double")
    out = P.mean_matrix(df, "pu", "do", "tip").collect()
    assert len(out) == 1 and out[0]["pu_hour"] == 23
    assert out[0]["h_00"] == 1.0 and out[0]["h_23"] == 3.0 and out[0]["h_12"] is None
    assert P.mean_matrix(df, "pu", "do", "tip", exact_scale=2).collect()[0]["h_00"] == 1.0


def test_weekday_is_monday_zero_and_day_slice(spark):
    t = dt.datetime
    rows = [(t(2024, 1, 1, 0, 0),), (t(2024, 1, 7, 23, 59),), (t(2024, 1, 8, 0, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = {r["day_of_week"]: r["trips"] for r in P.trips_by_weekday(df, "ts").collect()}
    assert got == {0: 2, 6: 1}
    sl = P.day_slice(df, "2024-01-07", "ts").collect()
    assert len(sl) == 1 and (sl[0]["pickup_hour"], sl[0]["pickup_minute"]) == (23, 59)


def test_distinct_per_hour_sorted_numeric(spark):
    t = dt.datetime
    rows = [(t(2024, 1, 1, 5, 1), 10), (t(2024, 1, 1, 5, 59), 2), (t(2024, 1, 1, 5, 30), 10)]
    df = spark.createDataFrame(rows, "lpep_pickup_datetime timestamp_ntz, PULocationID int")
    out = P.distinct_per_hour(df).collect()
    assert out[0]["pickup_hour"] == "2024-01-01 05:00:00" and out[0]["pickup_locations"] == [2, 10]


def test_by_account_month_newest_first(spark):
    rows = [(0, "a"), (2_678_400, "b"), (2_678_401, None)]  # Jan 1970, Feb 1970
    df = spark.createDataFrame(rows, "author_created_utc long, subreddit_id string")
    got = [tuple(r) for r in P.by_account_month(df, n=12).collect()]
    assert got == [("1970-02", 1), ("1970-01", 1)]
