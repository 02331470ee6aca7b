"""Projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.functions.labels import CONTENT_TYPES_ALL

# The search actions kept by the search flow (the intended list;
# the reference's source fuses two of them through a missing comma)
SEARCH_ACTIONS = ("search_input", "text_input", "voice_search", "search_click",
                  "voice search", "search_result_consumed", "tab_click", "tile_click",
                  "banner_cta_click", "item_search", "autosuggest_click")


def catalogue_items(*tables: DataFrame, ids_col: str = "content_ids") -> DataFrame:
    """F8 + U1 + U2: published entries with a non-empty id array (``ids_col``),
    exploded to one row per id, union of all tables, distinct."""
    def clean(df: DataFrame) -> DataFrame:
        return (df.filter((F.size(ids_col) > 0) & (F.col("published") == F.lit(True)))
                .select(F.explode(ids_col).alias("_id"), "title",
                        F.col("OriginalLanguage").cast("string").alias("original_language"),
                        "Genres")
                .select(F.col("_id").cast("string").alias("item_id"), "title",
                        "original_language", "Genres"))
    out = clean(tables[0])
    for t in tables[1:]:
        out = out.unionByName(clean(t))
    return out.distinct()


def allowed_types(df: DataFrame, types=CONTENT_TYPES_ALL,
                  col: str = "content_content_type") -> DataFrame:
    """content-type allow-list."""
    return df.filter(F.col(col).isin(*types))


def min_playtime(df: DataFrame, seconds: float = 300.0,
                 col: str = "total_play_time_sec") -> DataFrame:
    """keep rows watched longer than ``seconds``."""
    return df.filter(F.col(col) > seconds)


def valid_users(df: DataFrame, user_col: str = "userId") -> DataFrame:
    """user id not null and not blank."""
    return df.filter(F.col(user_col).isNotNull() & (F.trim(F.col(user_col)) != ""))


def valid_search_rows(df: DataFrame, uid_col: str = "uid",
                      keyword_col: str = "events_meta_keyword") -> DataFrame:
    """uid not null, not 'NaN' (any case), not empty; keyword not null.

    A string is never tested with ``isnan`` (that casts and fails under ANSI).
    """
    uid = F.col(uid_col)
    return df.filter(uid.isNotNull() & (uid != "") & (F.lower(uid) != "nan")
                     & F.col(keyword_col).isNotNull())


def long_keywords(df: DataFrame, min_len: int = 3, user_col: str = "uid",
                  keyword_col: str = "events_meta_keyword") -> DataFrame:
    """distinct (user, keyword) with keyword longer than ``min_len``."""
    return (df.select(user_col, F.col(keyword_col).alias("search_key"))
            .filter(F.length("search_key") > min_len).distinct())


def search_actions(df: DataFrame, actions=SEARCH_ACTIONS,
                   col: str = "events_meta_action") -> DataFrame:
    """action allow-list."""
    return df.filter(F.col(col).isin(*actions))


def keep_keys(df: DataFrame, keys: DataFrame, on: list[str] | str) -> DataFrame:
    """F18 (positive): ``key IN (keys)`` as a left-semi join (no driver list)."""
    return df.join(keys, on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: list[str] | str) -> DataFrame:
    """F18 (negative) / U4 / J4 / J5: ``key NOT IN (keys)`` as a left-anti join."""
    return df.join(keys, on, "left_anti")


def dedupe_min(df: DataFrame, keys: list[str], pick: str) -> DataFrame:
    """one row per key, deterministically the row with the smallest ``pick``."""
    others = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(F.col(pick), *[F.col(c) for c in others if c != pick])).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in others])
