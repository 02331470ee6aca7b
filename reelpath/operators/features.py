"""Item content features and user samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def genre_list(genres):
    """Genres given as a scalar, a comma list or bracketed text -> trimmed
    array of names (quotes and brackets removed, blanks dropped)."""
    text = F.regexp_replace(genres.cast("string"), r"[\[\]'\"]", "")
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def item_features(metadata: DataFrame, known_items: DataFrame | None = None,
                  prefix: bool = True) -> DataFrame:
    """Long table ``(item_id, feature)`` of language and genres.

    Missing language or genres become ``Unknown``; with ``prefix`` the values
    are tagged ``lang:`` / ``genre:``; items absent from ``known_items`` (the
    item lookup) are removed."""
    lang = F.coalesce(F.col("original_language"), F.lit(UNKNOWN))
    genres = genre_list(F.col("Genres"))
    genres = F.when(F.size(genres) > 0, genres).otherwise(F.array(F.lit(UNKNOWN)))
    lp, gp = ("lang:", "genre:") if prefix else ("", "")
    feats = F.array_union(F.array(F.concat(F.lit(lp), lang)),
                          F.transform(genres, lambda g: F.concat(F.lit(gp), g)))
    out = metadata.select("item_id", F.explode(feats).alias("feature")).distinct()
    if known_items is not None:
        out = out.join(known_items.select("item_id"), "item_id", "left_semi")
    return out


def hash_bucket(key, seed: int, buckets: int = 100):
    """A stable bucket in [0, buckets) from md5(seed:key) -- the same in any
    engine that has md5, and independent of partitioning."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10)
    return h.cast("long") % buckets


def sample_users(df: DataFrame, percent: int, seed: int = 42, user_col: str = "userId") -> DataFrame:
    """T3 (users): keep rows of users whose hash bucket is below ``percent``."""
    return df.filter(hash_bucket(F.col(user_col), seed) < percent)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """T3 (rows): rows whose md5 with the seed falls under ``fraction``, so the
    sample is the same on any cluster; ``_h`` carries the hash."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in df.columns])
    keyed = df.withColumn("_h", F.md5(text.cast("binary")))
    return keyed.where(F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / float(1 << 32) < fraction)


def sampled_train_test(train: DataFrame, test: DataFrame, percent: int = 5, seed: int = 42,
                       keys=("userId", "item_id")) -> tuple[DataFrame, DataFrame]:
    """M18 + J5 + J16: train and test rows of a user sample; test pairs that
    are already in train are scrubbed (left-anti)."""
    users = sample_users(train.select("userId").distinct(), percent, seed)
    tr = train.join(users, "userId", "left_semi")
    te = (test.join(users, "userId", "left_semi")
          .join(tr.select(*keys), list(keys), "left_anti"))
    return tr, te
