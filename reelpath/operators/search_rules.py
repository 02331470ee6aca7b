"""Search sessions and association rules.

Itemsets are mined with ``pyspark.ml.fpm.FPGrowth``, whose input is one array
per basket: a basket holds the distinct items of one user or one user's day.
Everything before and after the mining works on (basket, item) rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.operators.clean import long_keywords, search_actions, valid_search_rows
from reelpath.operators.ranking import with_group_count

# Actions and sources that define the three search flags
SESSION_ACTIONS = ("search_input", "text_input", "voice_search", "search_click", "voice search")
CONSUMPTION_ACTIONS = ("tile_click", "banner_cta_click")
CONSUMPTION_SOURCES = ("search_page", "searchLayout")
AUTOSUGGEST_ACTIONS = ("item_search", "autosuggest_click")
AUTOSUGGEST_ASSETS = ("autosuggest", "auto_suggestion")

MIN_SUPPORT = 0.0005
MIN_CONFIDENCE = 0.01


def search_flags(df: DataFrame) -> DataFrame:
    """Consumption / session / autosuggest flags (0 or 1)."""
    act = F.col("events_meta_action")
    consumption = ((act.isin(*CONSUMPTION_ACTIONS)
                    & F.col("events_meta_source_name").isin(*CONSUMPTION_SOURCES))
                   | (act == "search_result_consumed"))
    session = (act.isin(*SESSION_ACTIONS)
               | ((act == "tab_click") & (F.lower("events_meta_asset_name") == "search")
                  & (F.lower("events_appid") == "largescreen")))
    autosuggest = (act.isin(*AUTOSUGGEST_ACTIONS)
                   & F.col("events_meta_asset_name").isin(*AUTOSUGGEST_ASSETS)
                   & (F.col("eventtype") == "click"))
    return (df.withColumn("consumption", F.when(consumption, 1).otherwise(0))
            .withColumn("session", F.when(session, 1).otherwise(0))
            .withColumn("autosuggest", F.when(autosuggest, 1).otherwise(0)))


def resolve_users(events: DataFrame, identity: DataFrame) -> DataFrame:
    """J9 + F19: rows with a search session id, deduplicated, device ids
    mapped to registered ids on the same day (``uid``), action allow-list.

    The identity map is deduplicated per (temp id, day) -- deterministically
    the smallest registered id -- so one device never fans a row out.
    """
    ev = events.filter(F.col("events_meta_search_session_id").isNotNull()).distinct()
    idm = (identity.filter(F.col("temp_uid").isNotNull())
           .groupBy("temp_uid", F.col("day").alias("um_day"))
           .agg(F.min("reg_uid").alias("reg_uid")))
    joined = ev.join(idm, (ev.events_uid == idm.temp_uid) & (ev.day == idm.um_day), "left")
    out = (joined.withColumn("uid", F.coalesce(F.col("reg_uid"), F.col("events_uid")))
           .drop("temp_uid", "um_day", "reg_uid", "events_uid"))
    return search_actions(out)


def search_sequence(flagged: DataFrame) -> DataFrame:
    """Order of events inside each search session (session rows only).

    ``row_number`` by timestamp (ties by action and keyword); the per-session
    window is computed with the skew-safe range numbering.
    """
    from reelpath.operators.ranking import rank_within
    rows = flagged.filter(F.col("session") == 1).select(
        "events_meta_search_session_id", "events_ts", "events_meta_keyword", "events_meta_action")
    return rank_within(rows, "events_meta_search_session_id",
                       ["events_ts", "events_meta_action", "events_meta_keyword"],
                       rank_col="sequence_order", ties="row")


def session_keyword(flagged: DataFrame) -> DataFrame:
    """W8 + F5: one row per search session -- the longest keyword, then the
    latest, then the smallest keyword -- for valid users.

    A ``max`` over a struct ordered (length, ts, -keyword) is a partial
    aggregate, so a huge session is reduced before the shuffle.
    """
    rows = valid_search_rows(flagged.filter(F.col("session") == 1))
    best = F.max(F.struct(F.length("events_meta_keyword").alias("l"),
                          F.col("events_ts").alias("ts"),
                          F.col("events_meta_keyword").alias("kw"), F.col("uid")))
    # ties on (length, ts) resolve to the larger keyword, then uid: deterministic
    return (rows.groupBy("events_meta_search_session_id").agg(best.alias("b"))
            .select("events_meta_search_session_id", F.col("b.uid").alias("uid"),
                    F.col("b.kw").alias("events_meta_keyword"), F.col("b.ts").alias("events_ts")))


def multi_searchers(sessions: DataFrame, min_searches: int = 3) -> DataFrame:
    """Session rows of users with at least ``min_searches`` sessions."""
    return (with_group_count(sessions, "uid", "user_record_count")
            .filter(F.col("user_record_count") >= min_searches).drop("user_record_count"))


def baskets(df: DataFrame, basket_cols: list[str] | str, item_col: str,
            out_col: str = "items") -> DataFrame:
    """Unique items per basket key."""
    keys = [basket_cols] if isinstance(basket_cols, str) else list(basket_cols)
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(item_col)).alias(out_col))


def fit_rules(basket_df: DataFrame, min_support: float = MIN_SUPPORT,
              min_confidence: float = MIN_CONFIDENCE, items_col: str = "items") -> FPGrowthModel:
    """R2: FP-Growth over the baskets."""
    return FPGrowth(itemsCol=items_col, minSupport=min_support,
                    minConfidence=min_confidence).fit(basket_df)


def frequent_itemsets(model: FPGrowthModel) -> DataFrame:
    """Every frequent itemset (``items, freq``)."""
    return model.freqItemsets


def association_rules(model: FPGrowthModel) -> DataFrame:
    """Every rule (``antecedent, consequent, confidence, lift, support``)."""
    return model.associationRules


def rule_pairs(model: FPGrowthModel) -> DataFrame:
    """Rules with one antecedent item as scalar columns
    (item_id, rec_item_id, confidence, lift, support)."""
    single = association_rules(model).where(F.size("antecedent") == 1)
    return single.select(F.element_at("antecedent", 1).alias("item_id"), F.element_at("consequent", 1).alias("rec_item_id"),
                         "confidence", "lift", "support")


def related_keywords(rules: DataFrame, keyword_col: str = "keyword") -> DataFrame:
    """For each keyword, every rule whose antecedent contains it.

    ``rules`` are exploded on the antecedent, so a lookup is an equality
    filter (or a join with a frame of keywords)."""
    return rules.select(F.explode("antecedent").alias(keyword_col), "antecedent", "consequent",
                        "confidence", "lift", "support")


def apply_rules(rules: DataFrame, owned: DataFrame, basket_col: str = "uid", item_col: str = "search_key") -> DataFrame:
    """Per basket the consequents of the rules whose antecedent it holds,
    without what it holds already (``basket, prediction`` rows).

    ``owned`` are (basket, item) rows.  A rule fires in a basket when as many of
    its antecedent items meet the basket's items as the antecedent has; rules
    and baskets meet in a join on the item, and nothing reaches the driver."""
    named = rules.select(F.xxhash64(F.array_sort("antecedent"), "consequent").alias("rule"), "antecedent",
                         F.element_at("consequent", 1).alias("prediction"), F.size("antecedent").alias("needs"))
    parts = named.select("rule", "prediction", "needs", F.explode("antecedent").alias(item_col))
    own = owned.select(basket_col, item_col).distinct()
    fired = own.join(parts, item_col).groupBy(basket_col, "rule", "prediction", "needs") \
        .agg(F.count(F.lit(1)).alias("held")).where(F.col("held") == F.col("needs"))
    return fired.select(basket_col, "prediction").distinct().join(
        own.withColumnRenamed(item_col, "prediction"), [basket_col, "prediction"], "left_anti")


def multi_search_pairs(flagged: DataFrame, min_searches: int = 3, min_len: int = 3) -> DataFrame:
    """R7 as rows: flagged rows -> F5 -> W8 -> W9 -> F10, (uid, search_key)."""
    return long_keywords(multi_searchers(session_keyword(flagged), min_searches), min_len)


def multi_search_share(flagged: DataFrame, min_searches: int = 3) -> DataFrame:
    """Users with >= ``min_searches`` search sessions over searching users."""
    per_user = session_keyword(flagged).groupBy("uid").agg(F.count(F.lit(1)).alias("n"))
    return per_user.agg(F.count(F.lit(1)).alias("searching_users"),
                        F.count_if(F.col("n") >= min_searches).alias("multi_search_users")) \
        .withColumn("multi_search_pct",
                    F.col("multi_search_users") / F.col("searching_users") * 100.0)
