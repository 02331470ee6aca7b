"""Skew-safe ranks equal the plain window functions (hot groups, ties, nulls,
Arrow batches of 7 rows so runs continue across batches)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelpath.operators.ranking import (dense_ids, dense_ids_many, percent_rank_within,
                                        rank_within, with_group_count)


def _frame(spark, n=600, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 20)}"   # one group ~ 40%
        u = rnd.random()
        v = float(rnd.randint(0, 30)) if u > 0.08 else (None if u > 0.04 else float("nan"))
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_percent_rank_matches_window(spark):
    df = _frame(spark)
    ours = percent_rank_within(df, "g", "v", "pr", num_partitions=5).select("id", "pr")
    w = Window.partitionBy("g").orderBy("v")
    ref = df.withColumn("pr", F.percent_rank().over(w)).select("id", "pr")
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_rank_and_row_number_match_window(spark):
    df = _frame(spark, seed=9)
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = df.withColumn("r", F.row_number().over(w)).select("id", "r")
    ours = rank_within(df, "g", ["v", "id"], "r", ties="row", num_partitions=6).select("id", "r")
    assert sorted(ours.collect()) == sorted(ref.collect())
    wr = Window.partitionBy("g").orderBy("v")
    ref2 = df.withColumn("r", F.rank().over(wr)).select("id", "r")
    ours2 = rank_within(df, "g", "v", "r", ties="min", num_partitions=3).select("id", "r")
    assert sorted(ours2.collect()) == sorted(ref2.collect())


def test_dense_ids_are_global_row_numbers(spark):
    keys = spark.createDataFrame([(f"u{i % 137}",) for i in range(1000)], "k string")
    ids = dense_ids(keys, "k", "idx", num_partitions=4).collect()
    expect = {k: i for i, k in enumerate(sorted({f"u{i}" for i in range(137)}))}
    assert {r.k: r.idx for r in ids} == expect


def test_dense_ids_many_numbers_each_set(spark):
    df = spark.createDataFrame([(str(i % 13), str(i % 5)) for i in range(100)], "u string, i string")
    out = dense_ids_many({"userIndex": (df, "u"), "itemIndex": (df, "i")}, num_partitions=3)
    users = {r.u: r.userIndex for r in out["userIndex"].collect()}
    items = {r.i: r.itemIndex for r in out["itemIndex"].collect()}
    assert users == {k: n for n, k in enumerate(sorted(str(x) for x in range(13)))}
    assert items == {k: n for n, k in enumerate(sorted(str(x) for x in range(5)))}


def test_group_count_equals_window_count(spark):
    df = _frame(spark, 200)
    ours = with_group_count(df, "g", "n").select("id", "n")
    ref = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g"))).select("id", "n")
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_hot_group_is_spread_over_partitions(spark):
    """One group with a third of the rows must not land in one task."""
    from reelpath.operators.ranking import _PID, _ranged
    n = 3000
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 50}", float(i % 97)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    spread = _ranged(df, ["g", "v"], 8)
    sizes = [r["count"] for r in spread.filter(F.col("g") == "hot").groupBy(_PID).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < n // 3 * 0.6


def test_hot_value_stays_spread(spark):
    """90 % of one item's rows tie on a value: after the rank no partition
    holds more than twice the mean, and no Python runs."""
    n = 20_000
    df = spark.range(n, numPartitions=8).select(
        "id", F.lit("item").alias("g"), F.when(F.col("id") % 10 > 0, 1.0).otherwise(F.col("id") * 1.0).alias("v"))
    ranked = rank_within(df, "g", "v", "r")
    assert "Python" not in ranked._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in ranked.where("v = 1.0").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes) and len(sizes) >= 4
    assert ranked.where("v = 1.0").select("r").distinct().count() == 1


def test_hot_user_is_small_before_users_are_compared(spark):
    """One user with a third of all raw rows: pairs are summed before the
    common-user join, so the join reads a few rows of that user."""
    from reelpath.operators import interactions
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("userId"),
        (F.col("id") % 7).cast("string").alias("item_id"), F.lit(1.0).alias("total_play_time_sec"))
    stats = interactions.aggregate_playtime(rows)
    assert stats.where("userId = 'hot'").count() == 7
    users = interactions.users_in_both(stats, stats.where("userId <> 'u1'"))
    assert users.where("userId = 'hot'").count() == 1 and users.where("userId = 'u1'").count() == 0


def test_hot_user_of_clicks_is_small_before_users_are_compared(spark):
    """The same for clicks and decayed sums, and equal to the join of raw rows."""
    from reelpath.operators import interactions, scoring
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("userId"),
        (F.col("id") % 7).cast("string").alias("item_id"), (F.col("id") % 4 == 0).cast("int").alias("quality_click_flag"),
        (1 - F.col("id") % 10 / 20).alias("decay_factor"), F.lit(2.0).alias("total_play_time_sec"))
    test = rows.where("userId <> 'u1'")
    pairs = interactions.click_pairs(rows)
    assert pairs.where("userId = 'hot'").count() == 7
    users = interactions.users_in_both(pairs, interactions.click_pairs(test))
    got = scoring.click_signals(pairs.join(users, "userId", "left_semi"))
    raw = scoring.click_signals(rows.join(test.select("userId").distinct(), "userId", "left_semi"))
    assert sorted(map(tuple, got.select(*raw.columns).collect())) == sorted(map(tuple, raw.collect())) and got.count() > 100
    sums = interactions.decayed_playtime(rows, drop_invalid=False)
    assert sums.where("userId = 'hot'").count() == 7
    assert interactions.users_in_both(sums, test).where("userId = 'u1'").count() == 0


def test_labels_read_their_input_once(spark):
    """The pairs are cut before they are ranked: the plan holds no file scan, and
    the ranking pass does not repeat the roll-up."""
    from paths import SF_SMALL
    from reelpath.plans.queries import QUERIES
    plan = QUERIES["confidence_labels"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan


def test_top_k_uses_map_side_group_limit(spark):
    from reelpath.operators.recommend import top_k
    df = spark.range(1000).select((F.col("id") % 3).cast("int").alias("userIndex"),
                                  F.col("id").cast("int").alias("itemIndex"),
                                  F.rand(1).alias("score"))
    plan = top_k(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_null_and_nan_are_not_ties(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", float("nan")), (3, "a", float("nan")),
                                (4, "b", 1.0)], "id long, g string, v double")
    ours = rank_within(df, "g", "v", "r", ties="min", num_partitions=2).select("id", "r")
    ref = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy("v"))).select("id", "r")
    assert sorted(ours.collect()) == sorted(ref.collect())
