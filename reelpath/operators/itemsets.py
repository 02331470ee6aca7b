"""Item sets as bitmaps, and frequent sets mined on rows.

Bitmaps.  A set of item indexes is kept as rows (user, word, bits): bit ``i`` of
word ``w`` stands for item ``64 w + i``.  They are built by ``bit_or``, a partial
aggregate, so a user with millions of rows leaves each map task as a few words,
and intersections are ``&`` and ``bit_count`` on rows joined by (user, word).
No array of a user's items is made on the way.

Frequent sets.  ``mine`` works level by level on (basket, item) rows:

* level 1 counts items, and only frequent ones go on;
* level 2 joins the rows of a basket with themselves, ``a < b``.  Baskets with
  more than ``WIDE`` items are salted, so that the pairs of one basket are made
  by many tasks, and pairs are summed on the map side;
* level k joins frequent (k-1)-sets that share all but their last item, drops
  candidates with an infrequent subset, and counts them by joining the baskets'
  occurrences of the two halves, keyed by (basket, set).

A set is an array of its k items in order; no basket is ever an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpath.sources.bundle import cut_lineage

WORD = 64
#: a basket with more items than this is dealt to several tasks
WIDE = 1_000


# ------------------------------------------------------------------ bitmaps

def bitmaps(pairs: DataFrame, user_col: str = "userIndex", item_col: str = "itemIndex") -> DataFrame:
    """(user, word, bits) of the distinct items of each user."""
    item = F.col(item_col).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (item % WORD).cast("int"))
    return pairs.select(user_col, F.floor(item / WORD).cast("long").alias("word"), bit.alias("bit")) \
        .groupBy(user_col, "word").agg(F.bit_or("bit").alias("bits"))


def cardinalities(sets: DataFrame, user_col: str = "userIndex", out_col: str = "n") -> DataFrame:
    """Items in each set."""
    return sets.groupBy(user_col).agg(F.sum(F.bit_count("bits")).cast("long").alias(out_col))


def intersections(a: DataFrame, b: DataFrame, user_col: str = "userIndex", out_col: str = "n") -> DataFrame:
    """|A ∩ B| of the users that are in both, 0 included."""
    both = a.join(b.withColumnRenamed("bits", "other"), [user_col, "word"])
    hits = both.groupBy(user_col).agg(F.sum(F.bit_count(F.col("bits").bitwiseAND(F.col("other")))).cast("long").alias(out_col))
    users = a.select(user_col).distinct().join(b.select(user_col).distinct(), user_col)
    return users.join(hits, user_col, "left").withColumn(out_col, F.coalesce(out_col, F.lit(0)).cast("long"))


def _bits(word: Column, bits: Column) -> Column:
    """The item indexes of one word, ascending."""
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(bits, i) == 1)
    return F.transform(places, lambda i: (word * WORD + i).cast("int"))


def members(sets: DataFrame, user_col: str = "userIndex", item_col: str = "itemIndex") -> DataFrame:
    """The sets back as rows."""
    return sets.select(user_col, F.explode(_bits(F.col("word"), F.col("bits"))).alias(item_col))


def as_arrays(sets: DataFrame, user_col: str = "userIndex", out_col: str = "actual_items") -> DataFrame:
    """The sets as ascending arrays, for callers that want the stored form."""
    words = F.array_sort(F.collect_list(F.struct("word", "bits")))          # one entry per 64 items of the catalogue
    return sets.groupBy(user_col).agg(words.alias("_w")) \
        .select(user_col, F.flatten(F.transform("_w", lambda x: _bits(x["word"], x["bits"]))).alias(out_col))


def mean_recall(preds: DataFrame, truth: DataFrame, user_col: str = "userIndex") -> DataFrame:
    """U5 / E2 on bitmaps: mean of |predicted ∩ actual| / |actual| over the
    users in both (``avg_recall, users``)."""
    n = cardinalities(truth, user_col, "actual")
    per = intersections(preds, truth, user_col, "hits").join(n, user_col)
    return per.agg(F.avg(F.col("hits") / F.col("actual")).alias("avg_recall"), F.count(F.lit(1)).alias("users"))


# ------------------------------------------------------------------ frequent sets

def basket_rows(df: DataFrame, basket_cols: list[str] | str, item_col: str) -> DataFrame:
    """R1 as rows: (basket, item), each once; nulls take no part."""
    keys = [basket_cols] if isinstance(basket_cols, str) else list(basket_cols)
    basket = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    return df.select(basket.alias("basket"), F.col(item_col).alias("item")).where(F.col("item").isNotNull()).distinct()


def pair_counts(rows: DataFrame, wide: int = WIDE) -> DataFrame:
    """(a, b, freq) of all pairs ``a < b`` of items that share a basket."""
    sizes = rows.groupBy("basket").agg(F.ceil(F.count(F.lit(1)) / wide).cast("int").alias("parts"))
    sized = rows.join(sizes, "basket")
    left = sized.select("basket", F.col("item").alias("a"), F.pmod(F.xxhash64("item"), F.col("parts")).cast("int").alias("part"))
    right = sized.select("basket", F.col("item").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return left.join(right, ["basket", "part"]).where(F.col("a") < F.col("b")) \
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("freq"))


def mine(rows: DataFrame, min_support: float, max_size: int | None = None, wide: int = WIDE) -> tuple[DataFrame, int]:
    """R2 + R3: every frequent set, (items, freq) with ascending items, and the
    number of baskets.  A set is frequent from ``ceil(min_support x baskets)``."""
    rows = cut_lineage(rows.select("basket", "item").distinct())
    baskets = rows.select("basket").distinct().count()
    least = F.ceil(F.lit(float(min_support)) * F.lit(baskets))
    single = cut_lineage(rows.groupBy("item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least))
    found = single.select(F.array("item").alias("items"), "freq")
    if max_size == 1:
        return found, baskets
    often = cut_lineage(rows.join(single.select("item"), "item", "left_semi"))
    level = cut_lineage(pair_counts(often, wide).where(F.col("freq") >= least)
                        .select(F.array("a", "b").alias("items"), "freq"))
    held = None
    size = 2
    while True:
        found = found.unionByName(level)
        if max_size == size or level.isEmpty():
            return found, baskets
        if held is None:
            ab = level.select(F.col("items")[0].alias("a"), F.col("items")[1].alias("b"), "items")
            a, b = often.withColumnRenamed("item", "a"), often.withColumnRenamed("item", "b")
            held = cut_lineage(a.join(ab, "a").join(b, ["basket", "b"]).select("basket", "items"))
        size += 1
        wanted = candidates(level, size)
        # a basket holds a candidate when it holds both of its halves
        half = held.withColumnRenamed("items", "left").join(wanted, "left").select("basket", "right", "items")
        held = cut_lineage(half.join(held.withColumnRenamed("items", "right"), ["basket", "right"]).select("basket", "items"))
        level = cut_lineage(held.groupBy("items").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least))
        held = held.join(level.select("items"), "items", "left_semi")


def candidates(level: DataFrame, size: int) -> DataFrame:
    """(items, left, right): sets of ``size`` whose subsets of one item less are
    all in ``level``; left and right are the two that differ in the last item."""
    sets = level.select(F.col("items").alias("left"), F.slice("items", 1, size - 2).alias("stem"),
                        F.element_at("items", -1).alias("last"))
    other = sets.select(F.col("left").alias("right"), "stem", F.col("last").alias("more"))
    pairs = sets.join(other, "stem").where(F.col("last") < F.col("more")) \
        .select(F.concat("left", F.array("more")).alias("items"), "left", "right")
    if size < 3:
        return pairs
    subsets = pairs.select("items", F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("part"))
    whole = subsets.join(level.select(F.col("items").alias("part")), "part", "left_semi") \
        .groupBy("items").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == size).select("items")
    return pairs.join(whole, "items", "left_semi")


def rules(sets: DataFrame, baskets: int, min_confidence: float) -> DataFrame:
    """Rules with one consequent item (antecedent, consequent, confidence,
    lift, support), from the frequent sets of :func:`mine`."""
    split = sets.where(F.size("items") > 1).select("freq", F.explode("items").alias("y"), "items") \
        .select(F.array_remove("items", F.col("y")).alias("antecedent"), F.array("y").alias("consequent"), "freq")
    of = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("n_if"))
    then = sets.select(F.col("items").alias("consequent"), F.col("freq").alias("n_then"))
    confidence = F.col("freq") / F.col("n_if")
    return split.join(of, "antecedent").join(then, "consequent").where(confidence >= min_confidence).select(
        "antecedent", "consequent", confidence.alias("confidence"),
        (confidence / (F.col("n_then") / F.lit(baskets))).alias("lift"), (F.col("freq") / F.lit(baskets)).alias("support"))
