"""Scans of day-partitioned logs.

The reference lists one ``day=YYYY-MM-DD`` directory per day, probes each
on the driver and unions them.  Here a window is one read of the root with a
``day BETWEEN`` predicate on the partition column: Spark prunes partitions
itself, missing days simply match nothing and the ``day`` column survives.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelpath.functions.labels import linear_decay
from reelpath.sources.fixtures import DEFAULT_SPLIT, Split


def window_bounds(base_date: str, from_ago: int, to_ago: int) -> tuple[str, str]:
    """Half-open ``[from_ago, to_ago)`` days back from ``base_date`` as dates."""
    base = date.fromisoformat(base_date)
    first = base - timedelta(days=to_ago - 1)
    last = base - timedelta(days=from_ago)
    return first.isoformat(), last.isoformat()


def day_window_filter(base_date: str, from_ago: int, to_ago: int, day_col: str = "day") -> Column:
    """Predicate on a date column; literal bounds so it prunes partitions."""
    first, last = window_bounds(base_date, from_ago, to_ago)
    return F.col(day_col).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def day_window(df: DataFrame, base_date: str, from_ago: int, to_ago: int,
               day_col: str = "day") -> DataFrame:
    """Rows whose day lies ``from_ago`` (incl.) .. ``to_ago`` (excl.) days back."""
    return df.filter(day_window_filter(base_date, from_ago, to_ago, day_col))


def read_days(spark: SparkSession, root: str, base_date: str, from_ago: int, to_ago: int,
              schema: StructType | None = None, merge_schema: bool = True,
              ignore_corrupt: bool = False) -> DataFrame:
    """One read of a day-partitioned Parquet root, pruned to a window.

    ``schema`` gives a typed empty frame when the root does not exist yet; any
    other error is raised.  Unreadable files fail the read unless
    ``ignore_corrupt`` asks for them to be skipped.
    """
    reader = (spark.read.option("mergeSchema", str(merge_schema).lower())
              .option("ignoreCorruptFiles", str(ignore_corrupt).lower()))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.parquet(root)
    except AnalysisException as e:
        if schema is None or not _missing(e):
            raise
        return spark.createDataFrame([], schema)
    return day_window(df, base_date, from_ago, to_ago)


def _missing(e: AnalysisException) -> bool:
    """The path or glob matched nothing."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_day_list(spark: SparkSession, root: str, days: list[str],
                  schema: StructType | None = None) -> DataFrame | None:
    """Read the listed ``day=`` folders in one scan; missing days are
    skipped.  One glob (``day={d1,d2,..}``) with ``basePath`` keeps the ``day``
    column; no per-day probing.  With no day present: a typed empty frame when
    ``schema`` is given, else ``None``."""
    if not days:
        return spark.createDataFrame([], schema) if schema is not None else None
    pattern = f"{root.rstrip('/')}/day={{{','.join(days)}}}"
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(pattern)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], schema) if schema is not None else None


def window_days(base_date: str, from_ago: int, to_ago: int) -> list[str]:
    """The ISO dates of the window ``[from_ago, to_ago)`` days back."""
    base = date.fromisoformat(base_date)
    return [(base - timedelta(days=i)).isoformat() for i in range(from_ago, to_ago)]


def read_single_day(spark: SparkSession, root: str, day: str) -> DataFrame:
    """One day of a partitioned root (partition filter, not a leaf path)."""
    return spark.read.parquet(root).filter(F.col("day") == F.lit(day).cast("date"))


def union_days(frames: list[DataFrame]) -> DataFrame:
    """S3: bag union by column name, tolerating drifted columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def day_from_path(df: DataFrame, out_col: str = "day") -> DataFrame:
    """Recover the day from the ``day=`` segment of each row's file path."""
    path = F.col("_metadata.file_path")
    return df.withColumn(out_col, F.to_date(F.regexp_extract(path, r"day=(\d{4}-\d{2}-\d{2})", 1)))


def split_windows(df: DataFrame, split: Split = DEFAULT_SPLIT, decay: bool = False,
                  common_users: bool = True, user_col: str = "userId",
                  day_col: str = "day") -> tuple[DataFrame, DataFrame]:
    """S1 + C3 + J1: train and test windows of a daily log.

    With ``decay`` the train rows get ``days_ago`` and ``decay_factor``
    (newest 1.0 down to 0.5) and test rows a constant 1.0.  With
    ``common_users`` each side keeps only users present in both windows: one
    grouped min/max of "is test day" per user (partial aggregation keeps a hot
    user to one row per map task) and a semi-join of each side against it.
    """
    test = day_window(df, split.base_date, 0, split.test_days, day_col)
    train = day_window(df, split.base_date, split.test_days,
                       split.test_days + split.train_days, day_col)
    if decay:
        days_ago = F.datediff(F.lit(split.base_date).cast("date"), F.col(day_col))
        train = (train.withColumn("days_ago", days_ago)
                 .withColumn("decay_factor", linear_decay(F.col("days_ago"), split)))
        test = test.withColumn("decay_factor", F.lit(1.0))
    if common_users:
        # one aggregate over both windows finds users present in each
        first_test, _ = window_bounds(split.base_date, 0, split.test_days)
        both = day_window(df, split.base_date, 0, split.test_days + split.train_days, day_col)
        in_test = F.col(day_col) >= F.lit(first_test).cast("date")
        users = (both.groupBy(user_col)
                 .agg(F.max(in_test.cast("int")).alias("_t"), F.min(in_test.cast("int")).alias("_f"))
                 .filter((F.col("_t") == 1) & (F.col("_f") == 0)).select(user_col))
        train = train.join(users, user_col, "left_semi")
        test = test.join(users, user_col, "left_semi")
    return train, test


def newest_snapshot(spark: SparkSession, root: str, base_day: str, key: str = "snapshot",
                    schema: StructType | None = None) -> DataFrame:
    """The newest dated prefix (``root/<key>=YYYY-MM-DD``) at or before
    ``base_day``.  The date comes from the partition column alone, and the read is
    pruned to that one prefix.  With no such prefix, an empty frame; a root that
    does not exist gives a typed empty frame when ``schema`` is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.parquet(root)
    except AnalysisException as e:
        if schema is None or not _missing(e):
            raise
        return spark.createDataFrame([], schema)
    day = F.col(key).cast("date")
    newest = df.where(day <= F.lit(base_day).cast("date")).select(key).distinct().agg(F.max(day)).first()[0]
    if newest is None:
        return df.where(F.lit(False))
    return df.where(day == F.lit(newest.isoformat()).cast("date"))


def catalogue_snapshot(spark: SparkSession, tv_root: str, movie_root: str, base_day: str) -> DataFrame:
    """The catalogue of ``base_day``, both parts from their newest prefix."""
    from reelpath.operators.clean import catalogue_items
    return catalogue_items(newest_snapshot(spark, tv_root, base_day).drop("snapshot"),
                           newest_snapshot(spark, movie_root, base_day).drop("snapshot"))


def similar_snapshot(spark: SparkSession, root: str, base_day: str) -> DataFrame:
    """The similar-items rows (item_id, rec_item_id, confidence) of the
    newest stored table, unpacked from its arrays."""
    from reelpath.operators.recommend import read_similar
    return read_similar(newest_snapshot(spark, root, base_day))


def read_tolerant(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """A Parquet root of which unreadable files are skipped.  The schema is
    given, so that no file's footer is needed to plan the read."""
    return spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(root)


def skipped_files(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """(path, length) of the files below ``root`` that gave ``rows`` (read
    by :func:`read_tolerant`) no row: unreadable ones and empty ones.

    The files are listed as a table, without their contents, and compared with
    the paths that rows come from; neither list passes the driver."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    read = rows.select(F.col("_metadata.file_path").alias("path")).distinct()
    return listed.where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]")).join(read, "path", "left_anti")
