"""Edge cases of the labelling and weighting operators (hand-made frames)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from reelpath.operators import interactions, scoring
from reelpath.sources.fixtures import Split
from reelpath.sources.scan import split_windows


def test_nan_or_null_poisons_only_its_pair(spark):
    rows = [("u1", "a", 10.0), ("u1", "a", float("nan")), ("u1", "b", 5.0),
            ("u2", "a", None), ("u2", "b", 1.0)]
    df = spark.createDataFrame(rows, "userId string, item_id string, total_play_time_sec double")
    out = {(r.userId, r.item_id) for r in interactions.aggregate_playtime(df).collect()}
    assert out == {("u1", "b"), ("u2", "b")}


def test_confidence_buckets_and_item_support(spark):
    # item x: 5 users with playtime 1..5 -> percent_rank 0, .25, .5, .75, 1
    rows = [(f"u{i}", "x", float(i)) for i in range(1, 6)] + [("u1", "rare", 9.0)]
    df = spark.createDataFrame(rows, "userId string, item_id string, total_playtime_combined double")
    got = {r.userId: r.confidence for r in scoring.confidence_labels(df).collect()}
    assert got == {"u1": 0.2, "u2": 1.0, "u3": 2.0, "u4": 3.0, "u5": 4.0}  # 'rare' dropped (<5 rows)


def test_tied_playtime_gets_one_bucket(spark):
    rows = [(f"u{i}", "x", 7.0) for i in range(6)]
    df = spark.createDataFrame(rows, "userId string, item_id string, total_playtime_combined double")
    assert {r.confidence for r in scoring.confidence_labels(df).collect()} == {0.2}


def test_popularity_all_counts_equal_gives_score_1(spark):
    rows = [("u1", "a", 1.0), ("u2", "b", 1.0)]
    df = spark.createDataFrame(rows, "userId string, item_id string, confidence double")
    pop = scoring.item_popularity(df).collect()
    assert {r.popularity_score for r in pop} == {1}
    assert all(abs(r.popularity_penalty - 1 / math.log10(11)) < 1e-12 for r in pop)


def test_decay_range_and_common_users(spark):
    split = Split("2024-01-30", 2, 5)
    base = dt.date(2024, 1, 30)
    rows = [("u1", "a", 1.0, base - dt.timedelta(days=d)) for d in range(0, 7)]
    rows += [("u2", "a", 1.0, base - dt.timedelta(days=4))]   # train only -> dropped
    df = spark.createDataFrame(rows, "userId string, item_id string, total_play_time_sec double, day date")
    train, test = split_windows(df, split, decay=True)
    decay = {r.days_ago: r.decay_factor for r in train.collect()}
    assert decay == {2: 1.0, 3: 0.875, 4: 0.75, 5: 0.625, 6: 0.5}
    assert {r.userId for r in train.collect()} == {"u1"}
    assert {r.decay_factor for r in test.collect()} == {1.0}


def test_custom_users_shapes(spark):
    train = spark.createDataFrame([("u1", "a", 0.2, 0.5)],
                                  "userId string, item_id string, confidence double, recent_decay_factor double")
    users = [{"userId": "p", "watch_history": " a, ,b "}, {"userID": "q", "watch_history": ["c", " "]},
             {"userId": "r", "watch_history": 5}, {"userId": "u1", "watch_history": "a"}]
    out = scoring.inject_custom_users(train, scoring.custom_user_rows(spark, users)).collect()
    got = {(r.userId, r.item_id): (r.confidence, r.recent_decay_factor) for r in out}
    assert got == {("p", "a"): (4.0, 1.0), ("p", "b"): (4.0, 1.0), ("q", "c"): (4.0, 1.0),
                   ("u1", "a"): (4.0, 1.0)}


def test_zscore_single_row_user_is_not_a_like(spark):
    rows = [("solo", "a", 5.0), ("u", "a", 1.0), ("u", "b", 1.0), ("u", "c", 10.0)]
    df = spark.createDataFrame(rows, "userId string, item_id string, total_playtime_combined double")
    out = {(r.userId, r.item_id): (r.playtime_z_user, r.user_likes)
           for r in scoring.zscore_likes(df).collect()}
    assert out[("solo", "a")] == (None, 0)
    assert out[("u", "c")][1] == 1 and out[("u", "a")][1] == 0


def test_completion_rating_caps_and_pools(spark):
    cons = spark.createDataFrame(
        [("u", "c1", 1000.0, 900.0, "MOVIE", "s1"), ("u", "c1", 1000.0, 600.0, "MOVIE", "s2"),
         ("u", "c2", 1000.0, 500.0, "EPISODE", "s3"), ("u", "c3", 1000.0, 50.0, "EPISODE", "s4")],
        "userId string, content_id string, duration_secs double, total_play_time_sec double, "
        "content_content_type string, user_session_id string")
    pm = spark.createDataFrame([("c1", "m"), ("c2", "show"), ("c3", "show")],
                               "content_id string, item_id string")
    got = {r.item_id: (r.completion_rate, r.rating_label_custom)
           for r in interactions.completion_ratings(cons, pm).collect()}
    assert got["m"] == (1.0, 4)          # 1500 capped at 1000
    assert got["show"] == (0.5, 2)       # c3 below 300 s is dropped first


def test_undecayed_click_merge(spark):
    labels = spark.createDataFrame([("u", "a", 0.2), ("u", "MATCH1", 4.0)],
                                   "userId string, item_id string, confidence double")
    clicks = spark.createDataFrame([("u", "a", 1), ("u", "a", 1), ("u", "b", 1), ("u", "c", 0)],
                                   "userId string, item_id string, quality_click_flag int")
    merged = scoring.merge_signals(labels, scoring.click_signals(clicks, decay=False), decay=False)
    got = {(r.userId, r.item_id): r.confidence for r in merged.collect()}
    assert got == {("u", "a"): 2.0, ("u", "b"): 2.0}     # MATCH ids excluded, flag 0 ignored
    assert merged.columns == ["userId", "item_id", "confidence"]


def test_content_groups(spark):
    from reelpath.functions.labels import content_group
    names = ["EPISODE", "tvshow", "TV show", "tv_shows", "Movie", "film", "SEASON", "tv_show", "series", "video"]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    got = {r.t: r.g for r in df.withColumn("g", content_group(F.col("t"))).collect()}
    assert [got[n] for n in names] == ["tv_show"] * 4 + ["movie"] * 2 + ["other"] * 4
