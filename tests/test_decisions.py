"""SURVEY decisions not covered elsewhere: Q7 unseen ids, Q14 try_cast under ANSI, Q20 null group key."""

from pyspark.sql import functions as F

from tablecraft.operators import ml
from tablecraft.operators.matches import clean_matches
from tablecraft.operators.profiles import crawl_hours, matches_by_mode
from tablecraft.operators.series import mean_daily_views


def test_unseen_ids_are_predicted_not_rejected(spark):
    train = spark.createDataFrame([(i % 10, i % 7, 1 + (i % 10) % 2) for i in range(400)],
                                  "PULocationID int, DOLocationID int, payment_type int")
    new = spark.createDataFrame([(3, 2), (250, 99)], "PULocationID int, DOLocationID int")
    out = ml.predict_class(train, new, keep=("PULocationID",)).collect()
    assert len(out) == 2 and all(r["prediction"] in (1, 2) for r in out)


def test_junk_text_becomes_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = [(1, "1400000000", "t", "2400", "oops", "1", "10"), (2, "x", "t", "", "60", "1", "10")]
    df = spark.createDataFrame(rows, "match_id long, start_time string, radiant_win string, duration string, "
                                     "first_blood_time string, game_mode string, human_players string")
    out = clean_matches(df).collect()
    assert len(out) == 1 and out[0]["first_blood_time"] is None and out[0]["duration_mins"] == 40
    lines = spark.createDataFrame([("x_commoncrawl_FetchTimestamp:",), ("x_commoncrawl_FetchTimestamp:3600000",)],
                                  "value string")
    got = {r["hour"]: r["count"] for r in crawl_hours(lines).collect()}
    assert got == {None: 1, 1: 1}
    dump = spark.createDataFrame([("en.z", "P", 1, "AA1B,BAx,")], "project string, page string, "
                                 "monthly_total int, hourly_counts string")
    assert [tuple(r) for r in mean_daily_views(dump, "en.z", "P").collect()] == [(1, 1.0), (2, 0.0)]


def test_null_group_key_is_kept(spark):
    df = spark.createDataFrame([(1, "All Pick"), (2, None), (3, None)], "match_id long, game_mode string")
    got = {r["game_mode"]: r["matches"] for r in matches_by_mode(df).collect()}
    assert got == {"All Pick": 1, None: 2}
    first = matches_by_mode(df).first()
    assert first["matches"] == 1
    assert df.filter(F.col("game_mode").isNull()).count() == 2
