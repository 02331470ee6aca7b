"""Ranking quality and catalogue metrics as tables.

Metrics are computed on rows -- ``(user, item, rank)`` predictions against
``(user, item)`` truth -- so no user is ever materialised as one array:

* hits = predictions semi-joined with the truth;
* cumulative hits per user come from a window over at most k rows;
* precision@k = hits/k, recall = hits/|truth|,
  AP = sum over hit positions of (hits so far / position) / |truth|
  (the definitions of ``RankingMetrics.precisionAt`` and
  ``meanAveragePrecision``), averaged over users with predictions and truth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelpath.functions.labels import scaled_1_100
from reelpath.operators.diagnose import ACCURACY, quantile_row, quantile_rows, side_by_side
from reelpath.operators.indexing import restrict_to_users


def per_user_metrics(preds: DataFrame, truth: DataFrame, k: int,
                     user_col: str = "userIndex", item_col: str = "itemIndex",
                     rank_col: str = "rank") -> DataFrame:
    """Per evaluated user: ``n_actual, hits, precision_at_k, recall_at_k, ap``."""
    p = preds.filter(F.col(rank_col) <= k).select(user_col, item_col, rank_col)
    t = truth.select(user_col, item_col).distinct()
    n_actual = t.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_actual"))
    hits = p.join(t, [user_col, item_col], "left_semi")
    w = Window.partitionBy(user_col).orderBy(rank_col).rowsBetween(Window.unboundedPreceding, 0)
    per_hit = hits.withColumn("_cum", F.count(F.lit(1)).over(w))
    hit_agg = per_hit.groupBy(user_col).agg(
        F.count(F.lit(1)).alias("hits"), F.sum(F.col("_cum") / F.col(rank_col)).alias("_prec_sum"))
    users = p.select(user_col).distinct().join(n_actual, user_col)
    return (users.join(hit_agg, user_col, "left")
            .select(user_col, "n_actual",
                    F.coalesce("hits", F.lit(0)).cast("long").alias("hits"),
                    (F.coalesce("hits", F.lit(0)) / F.lit(k)).alias("precision_at_k"),
                    (F.coalesce("hits", F.lit(0)) / F.col("n_actual")).alias("recall_at_k"),
                    (F.coalesce("_prec_sum", F.lit(0.0)) / F.col("n_actual")).alias("ap")))


def ranking_metrics(preds: DataFrame, truth: DataFrame, k: int, **kw) -> DataFrame:
    """Users evaluated, precision@k, recall@k, MAP (one row)."""
    u = per_user_metrics(preds, truth, k, **kw)
    return u.agg(F.count(F.lit(1)).alias("users"),
                 F.avg("precision_at_k").alias("precision_at_k"),
                 F.avg("recall_at_k").alias("recall_at_k"),
                 F.avg("ap").alias("map"))


def cohort_of(n: F.Column) -> F.Column:
    return (F.when(n <= 3, "1-3").when(n <= 10, "4-10").otherwise(">10"))


def cohort_metrics(preds: DataFrame, truth: DataFrame, k: int, **kw) -> DataFrame:
    """Metrics by truth-size cohort (1-3, 4-10, >10) and for all users."""
    u = per_user_metrics(preds, truth, k, **kw).withColumn("cohort", cohort_of(F.col("n_actual")))
    aggs = [F.count(F.lit(1)).alias("users"), F.avg("ap").alias("map"),
            F.avg("recall_at_k").alias("recall_at_k"), F.avg("precision_at_k").alias("precision_at_k")]
    by = u.groupBy("cohort").agg(*aggs)
    return by.unionByName(u.agg(*aggs).withColumn("cohort", F.lit("all")))


def item_slots(recs: DataFrame, item_col: str = "itemIndex") -> DataFrame:
    """List slots that each recommended item holds."""
    return recs.groupBy(item_col).agg(F.count(F.lit(1)).alias("times_recommended"))


def catalogue_coverage(recs: DataFrame, catalogue: DataFrame, item_col: str = "itemIndex") -> DataFrame:
    """E5 + J15: the share of catalogue items that hold at least one slot."""
    known = catalogue.select(item_col).distinct()
    reached = known.join(recs.select(item_col).distinct(), item_col, "left_semi")
    both = side_by_side(known.agg(F.count(F.lit(1)).alias("total_items")),
                        reached.agg(F.count(F.lit(1)).alias("covered_items")))
    return both.withColumn("coverage", F.coalesce(F.try_divide("covered_items", "total_items"), F.lit(0.0)))


def frequency_scores(recs: DataFrame, item_col: str = "itemIndex") -> DataFrame:
    """C14: an item's slots scaled to 1..100 (1 when all hold as many)."""
    slots = item_slots(recs, item_col)
    extremes = slots.agg(F.min("times_recommended").alias("fewest"), F.max("times_recommended").alias("most"))
    score = scaled_1_100(F.col("times_recommended"), F.col("fewest"), F.col("most"))
    return slots.join(F.broadcast(extremes)).select(item_col, "times_recommended", score.alias("rec_frequency_score"))


def frequency_percentiles(recs: DataFrame, **kw) -> DataFrame:
    """Percentiles of the frequency score (long form)."""
    return quantile_rows(frequency_scores(recs, **kw), "rec_frequency_score")


def top_domination(recs: DataFrame, n: int = 10, item_col: str = "itemIndex") -> DataFrame:
    """The n most recommended items, their slot share, and the share of
    all slots the n hold together."""
    counts = recs.groupBy(item_col).agg(F.count(F.lit(1)).alias("times_recommended"))
    total = recs.agg(F.count(F.lit(1)).alias("_slots"))
    top = counts.orderBy(F.col("times_recommended").desc(), F.col(item_col)).limit(n)
    top_sum = top.agg(F.sum("times_recommended").alias("_top"))
    return (top.crossJoin(F.broadcast(side_by_side(total, top_sum)))
            .select(item_col, "times_recommended",
                    (F.col("times_recommended") / F.col("_slots") * 100.0).alias("slot_pct"),
                    (F.col("_top") / F.col("_slots") * 100.0).alias("top_n_pct")))


def output_skew(recs: DataFrame, catalogue: DataFrame, item_col: str = "itemIndex",
                user_col: str = "userIndex") -> DataFrame:
    """Users, slots, unique items, coverage %, times-recommended
    quantiles, share of slots held by items at or above p99 (alarm > 30%)."""
    counts = recs.groupBy(item_col).agg(F.count(F.lit(1)).alias("times_recommended"))
    q = quantile_row(counts, "times_recommended", (0.5, 0.9, 0.95, 0.99, 1.0))
    base = side_by_side(
        recs.agg(F.countDistinct(user_col).alias("users"), F.count(F.lit(1)).alias("total_recs")),
        counts.agg(F.count(F.lit(1)).alias("unique_items")),
        catalogue.select(item_col).distinct().agg(F.count(F.lit(1)).alias("catalogue_items")),
        q)
    top = (counts.crossJoin(F.broadcast(q.select("p99")))
           .agg(F.coalesce(F.sum(F.when(F.col("times_recommended") >= F.col("p99"),
                                        F.col("times_recommended"))), F.lit(0)).alias("_top")))
    return (base.crossJoin(F.broadcast(top))
            .withColumn("coverage_pct", F.col("unique_items") / F.col("catalogue_items") * 100.0)
            .withColumn("top1_slot_pct", F.col("_top") / F.col("total_recs") * 100.0)
            .withColumn("collapse_alarm", F.col("top1_slot_pct") > 30.0)
            .drop("_top"))


def popularity_amplification(recs: DataFrame, popularity_idx: DataFrame,
                             item_col: str = "itemIndex") -> DataFrame:
    """E14 + J8: mean 1..100 popularity of recommended slots (unknown -> 1);
    alarm above 75."""
    counts = recs.groupBy(item_col).agg(F.count(F.lit(1)).alias("times_recommended"))
    joined = counts.join(popularity_idx.select(item_col, "popularity_score"), item_col, "left")
    return (joined.agg((F.sum(F.col("times_recommended")
                              * F.coalesce(F.col("popularity_score"), F.lit(1)))
                        / F.sum("times_recommended")).alias("avg_popularity_score"))
            .withColumn("amplification_alarm", F.col("avg_popularity_score") > 75.0))


def resurrection(recs: DataFrame, indexed_train: DataFrame, item_col: str = "itemIndex") -> DataFrame:
    """Of the items at or below the median train count, the share that
    is recommended at least once."""
    train_counts = indexed_train.groupBy(item_col).agg(F.count(F.lit(1)).alias("n"))
    med = train_counts.agg(F.percentile_approx("n", 0.5, ACCURACY).alias("_med"))
    bottom = (train_counts.crossJoin(F.broadcast(med))
              .filter(F.col("n") <= F.col("_med")).select(item_col))
    recommended = recs.select(item_col).distinct()
    hit = bottom.join(recommended, item_col, "left_semi")
    return side_by_side(bottom.agg(F.count(F.lit(1)).alias("niche_items")),
                        hit.agg(F.count(F.lit(1)).alias("niche_recommended"))) \
        .withColumn("resurrection_pct",
                    F.when(F.col("niche_items") > 0,
                           F.col("niche_recommended") / F.col("niche_items") * 100.0)
                    .otherwise(F.lit(0.0)))


def popularity_percentiles(popularity: DataFrame) -> DataFrame:
    """Quantiles of score, user count and penalty over items with score > 0."""
    p = popularity.filter(F.col("popularity_score") > 0)
    parts = []
    for c in ("popularity_score", "user_count", "popularity_penalty"):
        parts.append(quantile_rows(p.select(F.col(c).cast("double").alias(c)), c)
                     .withColumn("metric", F.lit(c)))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def evaluated_users(preds: DataFrame, truth: DataFrame, train: DataFrame,
                    user_col: str = "userIndex") -> DataFrame:
    """Truth restricted to train users (semi-join) joined to predictions:
    per user, predicted and actual counts."""
    tn = restrict_to_users(truth, train, user_col).groupBy(user_col).agg(F.count(F.lit(1)).alias("n_actual"))
    pn = preds.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_predicted"))
    return pn.join(tn, user_col)


def recall_by_arrays(preds: DataFrame, truth: DataFrame) -> DataFrame:
    """U5 / E2 on the array form: ``size(array_intersect(predicted, actual)) /
    size(actual)`` per user (``predicted_items``, ``actual_items`` arrays),
    averaged over users present in both."""
    j = preds.join(truth, "userIndex").dropna()
    return j.agg(F.avg(F.size(F.array_intersect("predicted_items", "actual_items"))
                       / F.size("actual_items")).alias("avg_recall"),
                 F.count(F.lit(1)).alias("users"))
