"""Game-match clean-up and derived columns.

Element-wise Python lambdas of the original clean-up are replaced by native
expressions, so the whole clean-up stays one codegen'd projection and the
filters reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.cleaning import bit_advantage, game_mode_name

# Columns the clean-up drops (missing ones are ignored), the
# release day before which matches are discarded, and the human player count.
DROP_COLUMNS = ("pgroup", "chat", "objectives", "version", "radiant_win",
                "start_year", "start_time")
RELEASE_DAY = "2013-07-09 00:00:00"
HUMAN_PLAYERS = 10


def clean_matches(df: DataFrame, release_day: str = RELEASE_DAY,
                  players: int = HUMAN_PLAYERS) -> DataFrame:
    """Typed, labelled matches after the release day with ``players`` humans.

    ``win_type`` is ``radiant`` when ``radiant_win = 't'`` and ``dire``
    otherwise (a null flag counts as a dire win, as in the original).
    Unknown game-mode ids become null.  Missing drop columns are ignored.
    """
    start = F.timestamp_seconds(F.col("start_time").try_cast("long"))
    duration = F.col("duration").try_cast("int")
    first_blood = F.col("first_blood_time").try_cast("int")
    out = (df
           .withColumn("start_ts", start)
           .withColumn("win_type", F.when(F.col("radiant_win") == "t", F.lit("radiant"))
                       .otherwise(F.lit("dire")))
           .withColumn("game_mode", game_mode_name(F.col("game_mode").try_cast("int")))
           .withColumn("duration", duration)
           .withColumn("first_blood_time", first_blood)
           .withColumn("duration_mins", F.floor(duration / 60).cast("int"))
           .withColumn("first_blood_mins", F.floor(first_blood / 60).cast("int"))
           .filter((F.col("start_ts") >= F.lit(release_day).cast("timestamp"))
                   & (F.col("human_players").try_cast("int") == players)))
    return out.drop(*DROP_COLUMNS, "start_ts")


def with_advantages(df: DataFrame) -> DataFrame:
    """Tower and barracks advantage of Radiant: remaining structures, Radiant minus Dire."""
    return (df
            .withColumn("tower_adv_radiant",
                        bit_advantage("tower_status_radiant", "tower_status_dire"))
            .withColumn("barracks_adv_radiant",
                        bit_advantage("barracks_status_radiant", "barracks_status_dire")))


def bit_advantages(df: DataFrame, key: str = "match_id") -> DataFrame:
    return with_advantages(df).select(
        key, F.col("tower_adv_radiant").alias("tower_adv"),
        F.col("barracks_adv_radiant").alias("barracks_adv"))
