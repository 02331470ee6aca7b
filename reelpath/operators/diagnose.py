"""Distribution and funnel diagnostics as tables.

The reference prints these; here each is a small DataFrame.  Scalars are
one-row aggregates; several of them are put side by side with a cross join
of one-row frames (never a driver collect).  Quantiles use
``percentile_approx`` -- a mergeable sketch, so no task sees a whole column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.functions.numeric import round_to
from reelpath.functions.labels import content_group

ACCURACY = 10000          # relative error 1e-4 (the reference used 1e-2 / 1e-3)
FUNNEL_QS = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)
REPORT_QS = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
CUMULATIVE_THRESHOLDS = (1, 2, 3, 5, 10, 20, 50, 100)
EXACT_THRESHOLDS = (1, 2, 3, 5, 10, 20)


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Join one-row frames into one row."""
    return reduce(lambda a, b: a.crossJoin(b), frames)


def _qname(q: float) -> str:
    return f"p{int(round(q * 100)):02d}" if q < 1 else "p100"


def quantile_row(df: DataFrame, col: str, qs=REPORT_QS, accuracy: int = ACCURACY,
                 prefix: str = "") -> DataFrame:
    """One row: ``percentile_approx`` at each q, as columns ``{prefix}pNN``."""
    arr = df.agg(F.percentile_approx(col, list(qs), accuracy).alias("_q"))
    return arr.select(*[F.col("_q")[i].alias(f"{prefix}{_qname(q)}") for i, q in enumerate(qs)])


def quantile_rows(df: DataFrame, col: str, qs=REPORT_QS, accuracy: int = ACCURACY) -> DataFrame:
    """Long form: one row per quantile ``(quantile, value)``."""
    arr = df.agg(F.percentile_approx(col, list(qs), accuracy).alias("_q"))
    qcol = F.array(*[F.lit(float(q)) for q in qs])
    return (arr.select(F.arrays_zip(qcol.alias("quantile"), F.col("_q").alias("value")).alias("z"))
            .select(F.inline("z")))


# ------------------------------------------------------------------ activity

def items_per_user(df: DataFrame, user_col: str = "userId", item_col: str = "item_id") -> DataFrame:
    """Distinct items per user."""
    return df.groupBy(user_col).agg(F.countDistinct(item_col).alias("distinct_content_count"))


def count_of_counts(per_user: DataFrame, col: str = "distinct_content_count") -> DataFrame:
    """Users per distinct-item count."""
    return per_user.groupBy(col).agg(F.count(F.lit(1)).alias("users"))


def user_thresholds(per_user: DataFrame, col: str = "distinct_content_count") -> DataFrame:
    """A8 + A9: users with >= t and == t items, one row."""
    c = F.col(col)
    aggs = [F.count_if(c >= t).alias(f"users_ge_{t}") for t in CUMULATIVE_THRESHOLDS]
    aggs += [F.count_if(c == t).alias(f"users_eq_{t}") for t in EXACT_THRESHOLDS]
    return per_user.agg(*aggs)


def user_watch_time(df: DataFrame, value_col: str = "total_play_time_sec",
                    user_col: str = "userId", digits: int = 6) -> DataFrame:
    """Total watch time per user, positive totals only."""
    return (df.groupBy(user_col).agg(round_to(F.sum(value_col), digits).alias("watch_time"))
            .filter(F.col("watch_time") > 0))


def multi_row_users(df: DataFrame, user_col: str = "userId") -> DataFrame:
    """Users with more than one row."""
    return (df.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def shared_sessions(df: DataFrame, session_col: str = "user_session_id",
                    user_col: str = "userId") -> DataFrame:
    """Sessions used by more than one distinct user."""
    return (df.groupBy(session_col).agg(F.countDistinct(user_col).alias("n_users"))
            .filter(F.col("n_users") > 1))


# ------------------------------------------------------------------ content types

def content_type_mix(df: DataFrame, type_col: str = "content_content_type",
                     user_col: str = "userId", item_col: str = "content_id",
                     value_col: str = "total_play_time_sec", digits: int = 6) -> DataFrame:
    """A11 + A12 + A13 + C13: per type group -- rows, distinct pairs, users,
    total watch, mean per-user watch."""
    g = df.withColumn("type_group", content_group(F.col(type_col)))
    per_user = (g.groupBy("type_group", user_col)
                .agg(F.sum(value_col).alias("_u_watch")))
    per_type_user = per_user.groupBy("type_group").agg(
        round_to(F.avg("_u_watch"), digits).alias("mean_user_watch"),
        F.count(F.lit(1)).alias("users"))
    per_type = g.groupBy("type_group").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(user_col, item_col).alias("n_pairs"),
        # a large total: rounded to cents so the partial-sum order cannot show
        round_to(F.sum(value_col), 2).alias("total_watch"))
    return per_type.join(per_type_user, "type_group")


def user_type_watch(df: DataFrame, type_col: str = "content_content_type", user_col: str = "userId",
                    value_col: str = "total_play_time_sec") -> DataFrame:
    """Watch time per (user, type group)."""
    return (df.withColumn("type_group", content_group(F.col(type_col)))
            .groupBy(user_col, "type_group").agg(round_to(F.sum(value_col), 6).alias("watch_time")))


def dominant_type(df: DataFrame, type_col: str = "content_content_type",
                  user_col: str = "userId", value_col: str = "total_play_time_sec") -> DataFrame:
    """Each user's type group with the most watch time (ties -> smaller
    name, a user without watch time -> smallest name); users per dominant group."""
    per = user_type_watch(df, type_col, user_col, value_col)
    first = F.min(F.struct((-F.coalesce("watch_time", F.lit(float("-inf")))).alias("w"), "type_group"))
    top = per.groupBy(user_col).agg(first["type_group"].alias("dominant_type"))
    return top.groupBy("dominant_type").agg(F.count(F.lit(1)).alias("users"))


# ------------------------------------------------------------------ audits

def pair_audit(df: DataFrame, user_col: str = "userId", item_col: str = "item_id") -> DataFrame:
    """Rows versus distinct pairs."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(user_col, item_col).alias("n_pairs"))


def day_window_audit(day_df: DataFrame, window_df: DataFrame, key: str) -> DataFrame:
    """A19 + U3: distinct keys in one day, in the window, and in both."""
    d = day_df.select(key).distinct()
    w = window_df.select(key).distinct()
    both = d.intersect(w)
    return side_by_side(d.agg(F.count(F.lit(1)).alias("day_keys")),
                        w.agg(F.count(F.lit(1)).alias("window_keys")),
                        both.agg(F.count(F.lit(1)).alias("both_keys")))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histograms over all rows, of the values (``scale`` raw)
    and of log(1 + value) (log1p), in one pass after one for the bounds.

    Bin = floor((v-lo)/(hi-lo)*bins), the maximum folded into the last bin.
    """
    both = F.explode(F.array(F.struct(F.lit("raw").alias("scale"), F.col(col).alias("v")),
                             F.struct(F.lit("log1p").alias("scale"), F.log1p(col).alias("v"))))
    vals = df.select(both.alias("x")).select("x.*").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    bounds = vals.groupBy("scale").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))    # two rows
    b = F.when(F.col("hi") > F.col("lo"),
               F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                       F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    return (vals.join(F.broadcast(bounds), "scale").withColumn("bin", b)
            .groupBy("scale", "bin").agg(F.count(F.lit(1)).alias("n")))


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long table (column, value, n) of distinct values per column."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    longf = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, value)")
    return longf.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


#: distinct values up to which a profile's count is exact (2^k), and values tracked for the top counts
EXACT_DISTINCT_BITS = 16
TOP_TRACKED = 10_000


def _top_counts(sketch: str) -> tuple[F.Column, F.Column]:
    """(counts, falling; the one most common value or null) of a frequent-item
    estimate, nulls left out."""
    known = F.filter(sketch, lambda x: x["item"].isNotNull())
    counts = F.sort_array(F.transform(known, lambda x: x["count"]), asc=False)
    most, next_ = F.get(counts, F.lit(0)), F.get(counts, F.lit(1))
    leaders = F.transform(F.filter(known, lambda x: x["count"] == most), lambda x: x["item"])
    return counts, F.when(next_.isNull() | (most > next_), F.get(leaders, F.lit(0)))


def table_profile(df: DataFrame, top: int = 3) -> DataFrame:
    """One row per column: position, name, type, value in the first row
    (rows ordered by all columns), rows, nulls, distinct values, bounds, the
    ``top`` largest counts and the most common value (null if two tie).

    One pass: everything is a mergeable aggregate of fixed size.  Distinct values
    are counted by theta sketches, exact up to 2^16 and estimated beyond, and top
    counts by frequent-item sketches, exact up to ``TOP_TRACKED`` values."""
    aggs = [F.count(F.lit(1)).alias("_rows"), F.min(F.struct(*[F.col(c) for c in df.columns])).alias("_first")]
    for i, c in enumerate(df.columns):
        text = F.col(c).cast("string")
        aggs += [F.count(c).alias(f"_n{i}"), F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}"),
                 F.theta_sketch_agg(text, EXACT_DISTINCT_BITS).alias(f"_d{i}"),
                 F.expr(f"approx_top_k(CAST(`{c}` AS STRING), {top + 2}, {TOP_TRACKED})").alias(f"_t{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, (c, kind) in enumerate(df.dtypes):
        counts, common = _top_counts(f"_t{i}")
        rows.append(F.struct(
            F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.lit(kind).alias("type"),
            F.col(f"_first.`{c}`").cast("string").alias("first_value"), F.col("_rows").alias("n_rows"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("n_null"),
            F.coalesce(F.theta_sketch_estimate(f"_d{i}"), F.lit(0)).cast("long").alias("n_distinct"),
            F.col(f"_lo{i}").cast("string").alias("min_value"), F.col(f"_hi{i}").cast("string").alias("max_value"),
            F.array_join(F.transform(F.slice(counts, 1, top), lambda x: x.cast("string")), ",").alias("top_counts"),
            common.alias("top_value")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def overlap_distribution(train: DataFrame, test: DataFrame, user_col: str = "userId",
                         item_col: str = "item_id") -> DataFrame:
    """A25 + U5: per user |train items ∩ test items|, users per overlap size.

    Computed on rows (distinct pairs joined on user and item), so a heavy user
    is never one array; users of both windows with no overlap count as 0.
    """
    tr = train.select(user_col, item_col).distinct()
    te = test.select(user_col, item_col).distinct()
    both_users = tr.select(user_col).distinct().join(te.select(user_col).distinct(), user_col)
    hits = tr.join(te, [user_col, item_col]).groupBy(user_col).agg(
        F.count(F.lit(1)).alias("overlap"))
    per_user = (both_users.join(hits, user_col, "left")
                .select(user_col, F.coalesce("overlap", F.lit(0)).cast("long").alias("overlap")))
    return per_user.groupBy("overlap").agg(F.count(F.lit(1)).alias("users"))


# ------------------------------------------------------------------ bounds

def signal_bounds(df: DataFrame, col: str = "confidence") -> DataFrame:
    """A21 + A22: min/max/mean/stddev and conditional counts, one row."""
    c = F.col(col)
    return df.agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"),
                  F.avg(c).alias("mean_value"), F.stddev(c).alias("stddev_value"),
                  F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(c <= 0.1).alias("n_le_0_1"),
                  F.count_if(c >= 3.0).alias("n_ge_3"))


# ------------------------------------------------------------------ funnel

def funnel_shape(indexed: DataFrame) -> DataFrame:
    """Filled cells, users, items, sparsity %, users per item."""
    base = indexed.agg(F.count(F.lit(1)).alias("cells"),
                       F.countDistinct("userIndex").alias("users"),
                       F.countDistinct("itemIndex").alias("items"))
    possible = F.col("users") * F.col("items")
    return base.select(
        "cells", "users", "items",
        F.when(possible > 0, (F.lit(1.0) - F.col("cells") / possible) * 100.0)
        .otherwise(F.lit(100.0)).alias("sparsity_pct"),
        F.when(F.col("items") > 0, F.col("users") / F.col("items")).otherwise(F.lit(0.0))
        .alias("users_per_item"))


def funnel_users(indexed: DataFrame) -> DataFrame:
    """Items per user -- quantiles, users with 1 and < 5 rows, and the
    largest user's share of the catalogue."""
    per = indexed.groupBy("userIndex").agg(F.count(F.lit(1)).alias("u_count"))
    items = indexed.agg(F.countDistinct("itemIndex").alias("_items"))
    q = quantile_row(per, "u_count", FUNNEL_QS)
    counts = per.agg(F.count_if(F.col("u_count") == 1).alias("single_item_users"),
                     F.count_if(F.col("u_count") < 5).alias("cold_users"),
                     F.count(F.lit(1)).alias("users"))
    out = side_by_side(q, counts, items)
    return out.withColumn("max_user_catalogue_pct",
                          F.col("p100") / F.col("_items") * 100.0).drop("_items")


def funnel_items(indexed: DataFrame) -> DataFrame:
    """Users per item -- quantiles, items with 1 and < 5 users, traffic
    share of items at or above p90 and at or below p50."""
    per = indexed.groupBy("itemIndex").agg(F.count(F.lit(1)).alias("i_count"))
    q = quantile_row(per, "i_count", FUNNEL_QS)
    joined = per.crossJoin(F.broadcast(q.select("p50", "p90")))
    shares = joined.agg(
        F.count_if(F.col("i_count") == 1).alias("single_user_items"),
        F.count_if(F.col("i_count") < 5).alias("cold_items"),
        (F.coalesce(F.sum(F.when(F.col("i_count") >= F.col("p90"), F.col("i_count"))), F.lit(0))
         / F.sum("i_count") * 100.0).alias("top10_traffic_pct"),
        (F.coalesce(F.sum(F.when(F.col("i_count") <= F.col("p50"), F.col("i_count"))), F.lit(0))
         / F.sum("i_count") * 100.0).alias("bottom50_traffic_pct"))
    return side_by_side(q, shares)


def funnel_signal(indexed: DataFrame, col: str = "confidence") -> DataFrame:
    """Confidence min/max/mean/stddev, share <= 0.1 and >= 3.0."""
    b = signal_bounds(indexed, col)
    return b.select("*", (F.col("n_le_0_1") / F.col("n_rows") * 100.0).alias("pct_le_0_1"),
                    (F.col("n_ge_3") / F.col("n_rows") * 100.0).alias("pct_ge_3"))


def confidence_spread(indexed: DataFrame, col: str = "confidence", top: int = 15) -> DataFrame:
    """Counts of confidence rounded to 1 place; the ``top`` most common
    (ties broken by value), with their share of all rows."""
    total = indexed.agg(F.count(F.lit(1)).alias("_n"))
    counts = (indexed.groupBy(round_to(col, 1).alias("conf_rounded"))
              .agg(F.count(F.lit(1)).alias("n")))
    topk = counts.orderBy(F.col("n").desc(), F.col("conf_rounded")).limit(top)
    return (topk.crossJoin(F.broadcast(total))
            .select("conf_rounded", "n", (F.col("n") / F.col("_n") * 100.0).alias("pct")))
