"""Per-(user, item) roll-ups of daily logs.

All of these are ``groupBy.agg`` plans: Spark runs a partial hash aggregate
before the shuffle, so even a key holding a third of all rows leaves each map
task as one row.  Double sums are rounded (``digits``) so the result does not
depend on the order in which partial sums meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.functions.numeric import round_to
from reelpath.functions.labels import (CONTENT_TYPES_ALL, CONTENT_TYPES_SERIES_MOVIE,
                                       completion_rating, valid_number)

SUM_DIGITS = 6


def valid_pairs(stats: DataFrame, value_col: str = "total_playtime_combined") -> DataFrame:
    """pairs whose summed playtime is a number."""
    return stats.filter(valid_number(F.col(value_col)))


def aggregate_playtime(df: DataFrame, with_decay: bool = False, user_col: str = "userId", item_col: str = "item_id",
                       digits: int = SUM_DIGITS, drop_invalid: bool = True) -> DataFrame:
    """A1 + F3: summed playtime per pair; ``max(decay_factor)`` when decayed.

    A NaN or null in any row of a pair makes the sum NaN/null and the pair is
    dropped after the aggregation (the reference's rule), unless the caller
    still needs its user (``drop_invalid``).
    """
    aggs = [round_to(F.sum("total_play_time_sec"), digits).alias("total_playtime_combined")]
    if with_decay:
        aggs.append(F.max("decay_factor").alias("recent_decay_factor"))
    stats = df.groupBy(user_col, item_col).agg(*aggs)
    return valid_pairs(stats) if drop_invalid else stats


def users_in_both(train: DataFrame, test: DataFrame, user_col: str = "userId") -> DataFrame:
    """J1 on roll-ups: the users that have pairs on either side."""
    return train.select(user_col).distinct().join(test.select(user_col).distinct(), user_col, "left_semi")


def click_pairs(clicks: DataFrame) -> DataFrame:
    """C5 on roll-ups: one row per pair, whether it has a quality click
    (``quality_click_flag``) and the latest decay factor of those clicks."""
    quality = F.col("quality_click_flag") == 1
    return clicks.groupBy("userId", "item_id").agg(
        F.max(F.when(quality, 1).otherwise(0)).alias("quality_click_flag"),
        F.max(F.when(quality, F.col("decay_factor"))).alias("decay_factor"))


def decayed_playtime(df: DataFrame, digits: int = SUM_DIGITS, drop_invalid: bool = True) -> DataFrame:
    """A3: ``sum(playtime * decay)`` and ``max(decay)`` per pair."""
    sums = df.groupBy("userId", "item_id").agg(
        round_to(F.sum(F.col("total_play_time_sec") * F.col("decay_factor")), digits).alias("decayed_playtime"),
        F.max("decay_factor").alias("recent_decay_factor"))
    return valid_pairs(sums, "decayed_playtime") if drop_invalid else sums


def sessions_per_pair(consumption: DataFrame, types=CONTENT_TYPES_ALL,
                      digits: int = SUM_DIGITS) -> DataFrame:
    """A2 (+F2): playtime and session count per (user, content, duration, type)."""
    return (consumption.filter(F.col("content_content_type").isin(*types))
            .groupBy("userId", "content_id", "duration_secs", "content_content_type")
            .agg(round_to(F.sum("total_play_time_sec"), digits).alias("total_playtime_combined"),
                 F.count(F.lit(1)).alias("num_sessions")))


def repeat_watchers(df: DataFrame, user_col: str = "userId", item_col: str = "item_id") -> DataFrame:
    """A4: pairs seen on more than one row."""
    return (df.groupBy(user_col, item_col).agg(F.count(F.lit(1)).alias("watch_count"))
            .filter(F.col("watch_count") > 1))


def completion_ratings(consumption: DataFrame, parent_map: DataFrame,
                       min_playtime: float = 300.0, digits: int = SUM_DIGITS) -> DataFrame:
    """A5 + C2 + F9 + J11: series/movie completion rate and 0..4 rating.

    Session playtime is capped at the content duration, contents of one parent
    item are pooled, ``rate = sum(capped) / sum(duration)``.  Contents without a
    parent keep a null item (left join).  Division by a zero duration gives null.
    """
    pairs = sessions_per_pair(consumption, types=CONTENT_TYPES_SERIES_MOVIE, digits=digits)
    watched = pairs.where(F.col("total_playtime_combined") > min_playtime) \
        .withColumn("counted", F.least("total_playtime_combined", "duration_secs"))
    # the parent map has one row per content; contents without one stay under a null item
    parents = parent_map.select("content_id", "item_id")
    pooled = watched.join(parents, "content_id", "left").groupBy("userId", "item_id", "content_content_type").agg(
        round_to(F.sum("counted"), digits).alias("total_playtime_combined"),
        round_to(F.sum("duration_secs"), digits).alias("total_duration_combined"))
    share = F.try_divide("total_playtime_combined", "total_duration_combined")
    return pooled.withColumns({"rating_label_custom": completion_rating(share).cast("int"),
                               "completion_rate": round_to(share, digits)})
