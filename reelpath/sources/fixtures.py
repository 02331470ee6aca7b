"""Views over the provided test tables that give the reference's inputs.

Each view exists twice: as a Spark ``DataFrame`` builder and as a DuckDB SQL
body (``FIXTURE_SQL``) used by the oracle queries.  The two must stay in
step; ``tests/test_fixtures_streaming.py`` checks that they agree.

The mapping (FIXTURES.md):

* ``interactions``  <- ``events``: userId = user_id, item_id = JSON ``props.k``,
  day = date(ts), playtime = value
* ``playtime``      <- interactions of type view/purchase
* ``clicks``        <- interactions of type click (flag 1) / error (flag 0)
* ``catalogue_tv`` / ``catalogue_movie`` <- ``part`` (ids, published, title,
  language, genres); the two tables overlap on LARGE parts
* ``consumption``   <- ``lineitem`` x ``orders`` x ``part`` (session grain)
* ``parent_map``    <- ``part``: content -> content div 10
* ``search_events`` <- ``events`` (session = user||day, keyword = term_k)
* ``identity_map``  <- signup events: device id -> registered id on that day
* ``factors``       <- ``embeddings``
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


@dataclass(frozen=True)
class Split:
    """Day split: test = [0, test_days) days back from base, train after it."""

    base_date: str = "2024-01-30"
    test_days: int = 8
    train_days: int = 22


DEFAULT_SPLIT = Split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- Spark side

def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions_from(table(spark, sf_dir, "events"))


def interactions_from(ev: DataFrame) -> DataFrame:
    """The interactions mapping over any frame shaped like ``events``
    (a batch read or a streaming micro-batch)."""
    return ev.select(
        F.col("user_id").cast("string").alias("userId"),
        F.get_json_object("props", "$.k").alias("item_id"),
        F.to_date("ts").alias("day"),
        F.col("value").alias("total_play_time_sec"),
        F.col("event_type"),
        F.col("ts"),
    )


def playtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (interactions(spark, sf_dir)
            .filter(F.col("event_type").isin("view", "purchase"))
            .select("userId", "item_id", "total_play_time_sec", "day"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (interactions(spark, sf_dir)
            .filter(F.col("event_type").isin("click", "error"))
            .select("userId", "item_id",
                    F.when(F.col("event_type") == "click", 1).otherwise(0)
                    .cast("int").alias("quality_click_flag"),
                    "day"))


def _catalogue(spark: SparkSession, sf_dir: str, types: tuple[str, ...],
               genres: Column) -> DataFrame:
    part = table(spark, sf_dir, "part").filter(F.col("p_type").isin(*types))
    ids = (F.when(F.col("p_size") % 7 == 0, F.array().cast("array<string>"))
           .otherwise(F.array(F.col("p_partkey").cast("string"))))
    return part.select(
        ids.alias("content_ids"),
        (F.col("p_size") % 10 != 0).alias("published"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("OriginalLanguage"),
        genres.alias("Genres"),
    )


def catalogue_tv(spark: SparkSession, sf_dir: str) -> DataFrame:
    # comma-list genres: "small, ring"
    genres = F.concat_ws(", ", F.lower("p_type"), F.split("p_name", " ").getItem(0))
    return _catalogue(spark, sf_dir, ("SMALL", "MEDIUM", "LARGE"), genres)


def catalogue_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    # bracketed-text genres: "['standard', 'red']"
    genres = F.concat(F.lit("['"), F.lower("p_type"), F.lit("', '"),
                      F.split("p_name", " ").getItem(0), F.lit("']"))
    return _catalogue(spark, sf_dir, ("STANDARD", "ECONOMY", "PROMO", "LARGE"), genres)


def consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    ctype = (F.when(F.col("p_type") == "STANDARD", "MOVIE")
             .when(F.col("p_type") == "SMALL", "EPISODE")
             .when(F.col("p_type") == "MEDIUM", "VIDEO")
             .when(F.col("p_type") == "LARGE", "TVSHOW")
             .when(F.col("p_type") == "ECONOMY", "SEASON")
             .otherwise("TRAILER"))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(pt, li.l_partkey == pt.p_partkey)
            .select(F.col("o_custkey").cast("string").alias("userId"),
                    F.col("l_partkey").cast("string").alias("content_id"),
                    (F.col("p_retailprice") * 80).alias("duration_secs"),
                    F.col("l_extendedprice").alias("total_play_time_sec"),
                    ctype.alias("content_content_type"),
                    F.col("l_orderkey").cast("string").alias("user_session_id"),
                    F.to_date("o_orderdate").alias("day")))


def parent_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    # parts of size <= 5 have no parent: they stay unmapped
    return (table(spark, sf_dir, "part").filter(F.col("p_size") > 5)
            .select(F.col("p_partkey").cast("string").alias("content_id"),
                    F.floor(F.col("p_partkey") / 10).cast("string").alias("item_id")))


def search_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    day = F.to_date("ts")
    action = (F.when(F.col("event_type") == "view", "search_input")
              .when(F.col("event_type") == "click", "search_click")
              .when(F.col("event_type") == "purchase", "search_result_consumed")
              .when(F.col("event_type") == "signup", "tab_click")
              .otherwise("autosuggest_click"))
    return ev.select(
        day.alias("day"),
        F.col("ts").alias("events_ts"),
        action.alias("events_meta_action"),
        F.when(F.col("user_id") % 2 == 0, "search_page").otherwise("home")
        .alias("events_meta_source_name"),
        F.lit("1.0").alias("events_av"),
        F.lit("phone").alias("events_dt"),
        F.lit("android").alias("events_os"),
        F.concat_ws("_", F.col("user_id").cast("string"), day.cast("string"))
        .alias("events_meta_search_session_id"),
        F.col("user_id").cast("string").alias("events_uid"),
        k.alias("content_id"),
        F.when(F.col("user_id") % 2 == 0, "LargeScreen").otherwise("mobile").alias("events_appid"),
        F.concat(F.lit("term_"), k).alias("events_meta_keyword"),
        F.when(k.cast("int") % 2 == 0, "Search").otherwise("autosuggest")
        .alias("events_meta_asset_name"),
        F.concat(F.lit("content "), k).alias("events_meta_content_name"),
        F.lit("click").alias("eventtype"),
    )


def identity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    return ev.select(F.col("user_id").cast("string").alias("temp_uid"),
                     F.concat(F.lit("reg_"), F.col("user_id").cast("string")).alias("reg_uid"),
                     F.to_date("ts").alias("day"))


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))


# ---------------------------------------------------------------- DuckDB side

FIXTURE_SQL: dict[str, str] = {
    "interactions": """
        SELECT CAST(user_id AS VARCHAR) AS userId,
               json_extract_string(props, '$.k') AS item_id,
               CAST(ts AS DATE) AS day,
               value AS total_play_time_sec,
               event_type, ts
        FROM events""",
    "playtime": """
        SELECT userId, item_id, total_play_time_sec, day FROM interactions
        WHERE event_type IN ('view', 'purchase')""",
    "clicks": """
        SELECT userId, item_id,
               CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS INTEGER) AS quality_click_flag,
               day
        FROM interactions WHERE event_type IN ('click', 'error')""",
    "catalogue_tv": """
        SELECT CASE WHEN p_size % 7 = 0 THEN CAST([] AS VARCHAR[])
                    ELSE [CAST(p_partkey AS VARCHAR)] END AS content_ids,
               p_size % 10 <> 0 AS published,
               p_name AS title, p_brand AS OriginalLanguage,
               lower(p_type) || ', ' || split_part(p_name, ' ', 1) AS Genres
        FROM part WHERE p_type IN ('SMALL', 'MEDIUM', 'LARGE')""",
    "catalogue_movie": """
        SELECT CASE WHEN p_size % 7 = 0 THEN CAST([] AS VARCHAR[])
                    ELSE [CAST(p_partkey AS VARCHAR)] END AS content_ids,
               p_size % 10 <> 0 AS published,
               p_name AS title, p_brand AS OriginalLanguage,
               '[''' || lower(p_type) || ''', ''' || split_part(p_name, ' ', 1) || ''']' AS Genres
        FROM part WHERE p_type IN ('STANDARD', 'ECONOMY', 'PROMO', 'LARGE')""",
    "consumption": """
        SELECT CAST(o_custkey AS VARCHAR) AS userId,
               CAST(l_partkey AS VARCHAR) AS content_id,
               p_retailprice * 80 AS duration_secs,
               l_extendedprice AS total_play_time_sec,
               CASE p_type WHEN 'STANDARD' THEN 'MOVIE' WHEN 'SMALL' THEN 'EPISODE'
                           WHEN 'MEDIUM' THEN 'VIDEO' WHEN 'LARGE' THEN 'TVSHOW'
                           WHEN 'ECONOMY' THEN 'SEASON' ELSE 'TRAILER' END AS content_content_type,
               CAST(l_orderkey AS VARCHAR) AS user_session_id,
               CAST(o_orderdate AS DATE) AS day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN part ON l_partkey = p_partkey""",
    "parent_map": """
        SELECT CAST(p_partkey AS VARCHAR) AS content_id,
               CAST(floor(p_partkey / 10) AS BIGINT)::VARCHAR AS item_id
        FROM part WHERE p_size > 5""",
    "search_events": """
        SELECT CAST(ts AS DATE) AS day, ts AS events_ts,
               CASE event_type WHEN 'view' THEN 'search_input' WHEN 'click' THEN 'search_click'
                               WHEN 'purchase' THEN 'search_result_consumed'
                               WHEN 'signup' THEN 'tab_click' ELSE 'autosuggest_click' END
                   AS events_meta_action,
               CASE WHEN user_id % 2 = 0 THEN 'search_page' ELSE 'home' END AS events_meta_source_name,
               '1.0' AS events_av, 'phone' AS events_dt, 'android' AS events_os,
               CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR)
                   AS events_meta_search_session_id,
               CAST(user_id AS VARCHAR) AS events_uid,
               json_extract_string(props, '$.k') AS content_id,
               CASE WHEN user_id % 2 = 0 THEN 'LargeScreen' ELSE 'mobile' END AS events_appid,
               'term_' || json_extract_string(props, '$.k') AS events_meta_keyword,
               CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0
                    THEN 'Search' ELSE 'autosuggest' END AS events_meta_asset_name,
               'content ' || json_extract_string(props, '$.k') AS events_meta_content_name,
               'click' AS eventtype
        FROM events""",
    "identity_map": """
        SELECT CAST(user_id AS VARCHAR) AS temp_uid, 'reg_' || CAST(user_id AS VARCHAR) AS reg_uid,
               CAST(ts AS DATE) AS day
        FROM events WHERE event_type = 'signup'""",
    "factors": """
        SELECT CAST(vec_id AS INTEGER) AS id, embedding AS features FROM embeddings""",
}


def fixture_ctes() -> str:
    """All fixture views as a ``WITH`` prefix body (DuckDB drops unused CTEs)."""
    return ",\n".join(f"{name} AS ({body})" for name, body in FIXTURE_SQL.items())


SPARK_FIXTURES = {
    "interactions": interactions,
    "playtime": playtime,
    "clicks": clicks,
    "catalogue_tv": catalogue_tv,
    "catalogue_movie": catalogue_movie,
    "consumption": consumption,
    "parent_map": parent_map,
    "search_events": search_events,
    "identity_map": identity_map,
    "factors": factors,
}
