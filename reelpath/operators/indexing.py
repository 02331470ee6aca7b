"""Dense integer ids and id-encoded frames.

The reference numbers users and items with ``rdd.zipWithIndex`` (order not
fixed) or a global ``row_number`` window (one task).  Here ids come from
:func:`reelpath.operators.ranking.dense_ids`: 0-based, in ascending key
order, reproducible, and computed across all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.operators.ranking import dense_ids_many, rank_within


def build_lookups(train: DataFrame, user_col: str = "userId",
                  item_col: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """``(userId, userIndex int)`` and ``(item_id, itemIndex int)``."""
    ids = dense_ids_many({"userIndex": (train, user_col), "itemIndex": (train, item_col)})
    return ids["userIndex"], ids["itemIndex"]


def encode(train: DataFrame, test: DataFrame, users: DataFrame, items: DataFrame,
           value_col: str = "confidence") -> tuple[DataFrame, DataFrame]:
    """J2 + J3: names -> ids.  The user lookup holds exactly the train users,
    so the inner join with it is the J2 restriction; test items unseen in
    train drop out of the item join."""
    indexed_train = (train.join(users, "userId").join(items, "item_id")
                     .select("userIndex", "itemIndex", value_col))
    indexed_test = (test.join(users, "userId").join(items, "item_id")
                    .select("userIndex", "itemIndex"))
    return indexed_train, indexed_test


def restrict_to_users(test: DataFrame, train: DataFrame, user_col: str = "userId") -> DataFrame:
    """Test rows of users present in train (semi-join, no fan-out)."""
    return test.join(train.select(user_col), user_col, "left_semi")


def ground_truth_rows(indexed_test: DataFrame) -> DataFrame:
    """Distinct (userIndex, itemIndex) test pairs -- the row form of the truth."""
    return indexed_test.select("userIndex", "itemIndex").distinct()


def ground_truth(indexed_test: DataFrame) -> DataFrame:
    """``userIndex, actual_items`` (sorted set).  A set is bounded by the
    catalogue size, whatever the user's row count."""
    return (indexed_test.groupBy("userIndex")
            .agg(F.array_sort(F.collect_set("itemIndex")).alias("actual_items")))


def string_index(df: DataFrame, input_col: str, output_col: str,
                 order: str = "alphabetAsc") -> DataFrame:
    """Label ids 0, 1, ... of a column's values, one row per value.

    ``alphabetAsc`` numbers them by value, ``frequencyDesc`` by falling count
    (ties by value).  Counts are a partial aggregate and the numbering spans
    all tasks; nothing is fitted on the driver.  Null values get no id."""
    if order not in ("alphabetAsc", "frequencyDesc"):
        raise ValueError(f"unknown order {order}")
    values = df.where(F.col(input_col).isNotNull()).groupBy(input_col).agg((-F.count(F.lit(1))).alias("_rp_freq")) \
        .withColumn("_rp_all", F.lit(0))
    by = [input_col] if order == "alphabetAsc" else ["_rp_freq", input_col]
    ranked = rank_within(values, "_rp_all", by, "_rp_rn", ties="row")
    return ranked.select(input_col, (F.col("_rp_rn") - 1).cast("int").alias(output_col))


def decode_items(rows: DataFrame, items: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """I4 + J6: ids -> item names (+ titles, left join keeps untitled items)."""
    out = rows.join(items, "itemIndex", "left")
    if metadata is not None:
        out = out.join(metadata, "item_id", "left")
    return out
