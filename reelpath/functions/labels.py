"""Column expressions for labels, weights and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# rank buckets (upper bound of percent_rank -> confidence)
RANK_BUCKETS = ((0.20, 0.2), (0.40, 1.0), (0.60, 2.0), (0.80, 3.0))
TOP_BUCKET = 4.0
# completion-rate buckets (lower bound of rate -> rating), other types 0
COMPLETION_BUCKETS = ((0.8, 4), (0.6, 3), (0.4, 2), (0.2, 1))
# click confidence and custom-user confidence
CLICK_CONFIDENCE = 2.0
CUSTOM_USER_CONFIDENCE = 4.0
# content types kept by the allow-lists
CONTENT_TYPES_ALL = ("MOVIE", "EPISODE", "VIDEO", "TVSHOW", "SEASON")
CONTENT_TYPES_SERIES_MOVIE = ("MOVIE", "EPISODE")
# content-type grouping (lower-cased type -> group)
TV_SHOW_TYPES = ("episode", "tvshow", "tv show", "tv_shows")
MOVIE_TYPES = ("movie", "film")
# excluded substrings in item ids (case-sensitive)
EXCLUDED_ITEM_MARKERS = ("MATCH", "HIGHLIGHTS")


def rank_confidence(pr: Column) -> Column:
    """percent_rank within the item -> confidence bucket."""
    expr = None
    for bound, value in RANK_BUCKETS:
        expr = F.when(pr <= bound, value) if expr is None else expr.when(pr <= bound, value)
    return expr.otherwise(TOP_BUCKET)


def completion_rating(rate: Column) -> Column:
    """Completion rate -> 0..4 rating."""
    expr = None
    for bound, value in COMPLETION_BUCKETS:
        expr = F.when(rate >= bound, value) if expr is None else expr.when(rate >= bound, value)
    return expr.otherwise(0)


def linear_decay(days_ago: Column, split) -> Column:
    """1.0 for the newest train day falling linearly to 0.5 for the oldest."""
    span = max(1, split.train_days - 1)
    return F.lit(1.0) - F.lit(0.5) * ((days_ago - F.lit(split.test_days)) / F.lit(span))


def scaled_1_100(n: Column, lo: Column, hi: Column) -> Column:
    """``(n-lo)/(hi-lo)*99+1``; 1 when every count is equal (the
    reference divides by zero there)."""
    return F.when(hi > lo, (n - lo) / (hi - lo) * 99.0 + 1.0).otherwise(F.lit(1.0))


def log_penalty(n: Column) -> Column:
    """``1 / log10(n + 10)``."""
    return F.lit(1.0) / F.log10(n + F.lit(10.0))


def content_group(ctype: Column) -> Column:
    """Lower-cased type -> tv_show / movie / other."""
    low = F.lower(ctype)
    return (F.when(low.isin(*TV_SHOW_TYPES), "tv_show")
            .when(low.isin(*MOVIE_TYPES), "movie")
            .otherwise("other"))


def item_allowed(item: Column) -> Column:
    """item id contains none of the excluded markers."""
    cond = F.lit(True)
    for marker in EXCLUDED_ITEM_MARKERS:
        cond = cond & ~item.contains(marker)
    return cond


def valid_number(c: Column) -> Column:
    """not null and not NaN (numeric columns only)."""
    return c.isNotNull() & ~F.isnan(c)
