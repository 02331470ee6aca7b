"""Skew-safe per-group ranks, sequence numbers and dense ids.

A window ``OVER (PARTITION BY g ORDER BY v)`` sends a whole group to one task.
When one item or user holds a third of all rows that task holds a third of the
data.  The functions here give the same numbers without that bottleneck, with
built-in expressions only.

``row_number``: rows are range-partitioned on ``(g, v)`` and sorted inside the
partitions, so a hot group spans many of them.  A row's number is its position
in the sorted partition minus the first position of its ``(partition, g)`` run
plus the rows of the group in earlier partitions -- a table of at most #groups +
#partitions rows.

``rank`` with ties: rows are first counted per ``(g, v)`` (a partial aggregate,
so any number of equal values is one row), the counts are numbered the same
way, and every row gets its rank by a join on ``(g, v)``.  Keys that hold more
than 1/``HOT_KEYS`` of all rows -- at most ``HOT_KEYS`` -- are broadcast, all
others are joined by shuffle, so a value shared by most rows meets no single task.

The range-partitioned frame is checkpointed to the shared folder, so both uses
of it see identical partitions even after an executor loss.

Group sizes (``count(*) OVER (g)``) need no ordering and are a plain
``groupBy`` count joined back (partial aggregation before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelpath.session import checkpoint_root

_PID = "_rp_pid"
#: at most this many keys are joined by broadcast
HOT_KEYS = 10_000


def with_group_count(df: DataFrame, group_cols: list[str] | str, out_col: str) -> DataFrame:
    """``count(*) OVER (PARTITION BY group)`` as aggregate + join."""
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out_col))
    return df.join(counts, keys, "inner") if _no_null_keys(df, keys) else \
        df.join(counts, [df[k].eqNullSafe(counts[k]) for k in keys], "inner").drop(
            *[counts[k] for k in keys])


def _no_null_keys(df: DataFrame, keys: list[str]) -> bool:
    return all(not f.nullable for f in df.select(*keys).schema.fields)


def _attach(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner", small: bool = False) -> DataFrame:
    """``a`` with the other columns of ``b``, rows matched on ``keys``, nulls too."""
    named = b.withColumnsRenamed({k: f"_rp_key_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_rp_key_{k}")) for k in keys]
    return a.join(F.broadcast(named) if small else named, match, how).drop(*[f"_rp_key_{k}" for k in keys])


def _ranged(df: DataFrame, cols: list[str], num_partitions: int | None) -> DataFrame:
    """Range-partitioned on ``cols``, sorted inside, with the partition number.

    Without an explicit count AQE may coalesce neighbours to the advisory size,
    which keeps the key order."""
    checkpoint_root(df.sparkSession)
    spread = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    return spread.sortWithinPartitions(*cols).withColumn(_PID, F.spark_partition_id())


def _offsets(runs: DataFrame, group_cols: list[str]) -> DataFrame:
    """Per (partition, group): rows of the group in earlier partitions, and its size."""
    group = Window.partitionBy(*group_cols)
    earlier = group.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return (runs.withColumn("_rp_offset", F.coalesce(F.sum("_rp_n").over(earlier), F.lit(0)))
            .withColumn("_rp_size", F.sum("_rp_n").over(group)).drop("_rp_n"))


def _row_numbers(df: DataFrame, group_cols: list[str], order_cols: list[str],
                 num_partitions: int | None) -> DataFrame:
    rows = _ranged(df, group_cols + order_cols, num_partitions) \
        .withColumn("_rp_pos", F.monotonically_increasing_id()).checkpoint(eager=True)
    keys = [_PID] + group_cols
    runs = rows.groupBy(*keys).agg(F.min("_rp_pos").alias("_rp_first"), F.count(F.lit(1)).alias("_rp_n"))
    at = _offsets(runs, group_cols)
    return (_attach(rows, at, keys)
            .withColumn("_rp_number", F.col("_rp_offset") + F.col("_rp_pos") - F.col("_rp_first") + 1)
            .drop("_rp_pos", "_rp_first", "_rp_offset", _PID))


def _min_ranks(df: DataFrame, group_cols: list[str], order_cols: list[str],
               num_partitions: int | None) -> DataFrame:
    values = group_cols + order_cols
    counts = _ranged(df.groupBy(*values).agg(F.count(F.lit(1)).alias("_rp_ties")), values, num_partitions) \
        .checkpoint(eager=True)
    keys = [_PID] + group_cols
    at = _offsets(counts.groupBy(*keys).agg(F.sum("_rp_ties").alias("_rp_n")), group_cols)
    before = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (counts.withColumn("_rp_before", F.coalesce(F.sum("_rp_ties").over(before), F.lit(0))))
    ranks = (_attach(ranks, at, keys)
             .withColumn("_rp_number", F.col("_rp_offset") + F.col("_rp_before") + 1)
             .select(*values, "_rp_number", "_rp_size", "_rp_ties"))
    total = counts.agg(F.sum("_rp_ties").alias("_rp_total"))
    sized = ranks.crossJoin(F.broadcast(total))
    is_hot = F.col("_rp_ties") * HOT_KEYS > F.col("_rp_total")
    found = ["_rp_number", "_rp_size"]
    hot = sized.where(is_hot).select(*values, *[F.col(c).alias(f"{c}_hot") for c in found])
    rest = sized.where(~is_hot).select(*values, *found)
    first = _attach(df, hot, values, "left", small=True)
    done = first.where(F.col("_rp_number_hot").isNotNull())
    done = done.select(*df.columns, *[F.col(f"{c}_hot").alias(c) for c in found])
    open_ = first.where(F.col("_rp_number_hot").isNull()).select(*df.columns)
    return done.unionByName(_attach(open_, rest, values).select(*done.columns))


def rank_within(df: DataFrame, group_cols: list[str] | str, order_cols: list[str] | str,
                rank_col: str = "rank", size_col: str | None = None, ties: str = "min",
                num_partitions: int | None = None) -> DataFrame:
    """``rank()`` (ties='min') or ``row_number()`` (ties='row') within groups,
    ascending on ``order_cols``, plus optionally the group size."""
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    numbered = (_min_ranks if ties == "min" else _row_numbers)(df, group_cols, order_cols, num_partitions)
    out = numbered.withColumn(rank_col, F.col("_rp_number").cast("long"))
    if size_col:
        out = out.withColumn(size_col, F.col("_rp_size").cast("long"))
    return out.drop("_rp_number", "_rp_size")


def percent_rank_within(df: DataFrame, group_cols: list[str] | str, order_col: str,
                        out_col: str = "rank", size_col: str | None = None,
                        num_partitions: int | None = None) -> DataFrame:
    """``percent_rank() OVER (PARTITION BY g ORDER BY v)`` = (rank-1)/(n-1), 0 when n=1."""
    ranked = rank_within(df, group_cols, [order_col], "_rp_rank", "_rp_size2", "min",
                         num_partitions)
    pr = F.when(F.col("_rp_size2") > 1,
                (F.col("_rp_rank") - 1) / (F.col("_rp_size2") - 1)).otherwise(F.lit(0.0))
    out = ranked.withColumn(out_col, pr)
    if size_col:
        out = out.withColumnRenamed("_rp_size2", size_col)
    return out.drop("_rp_rank", "_rp_size2")


def dense_ids(keys: DataFrame, key_col: str, id_col: str, base: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Ids ``base..base+n-1`` in ascending key order, equal to a global
    ``row_number() - 1 + base`` but computed without a single-task window."""
    distinct = keys.select(key_col).distinct().withColumn("_rp_all", F.lit(0))
    ranked = rank_within(distinct, ["_rp_all"], [key_col], "_rp_rn", ties="row",
                         num_partitions=num_partitions)
    return ranked.select(key_col, (F.col("_rp_rn") - 1 + base).cast("int").alias(id_col))


def dense_ids_many(frames: dict[str, tuple[DataFrame, str]], base: int = 0,
                   num_partitions: int | None = None,
                   materialize: bool = True) -> dict[str, DataFrame]:
    """I2 for several key sets in one range-partitioned pass.

    ``frames`` maps a name to ``(frame, key_col)``; keys are cast to string and
    numbered per name (group = name), so users and items share one sampling
    job, one checkpoint and one offset table.  Each result has the original
    key column (original type) and ``<name>`` as the id column."""
    union = None
    for name, (df, key) in frames.items():
        part = df.select(F.lit(name).alias("_rp_kind"), F.col(key).cast("string").alias("_rp_key"))
        union = part if union is None else union.unionByName(part)
    ranked = rank_within(union.distinct(), ["_rp_kind"], ["_rp_key"], "_rp_rn", ties="row",
                         num_partitions=num_partitions)
    if materialize:
        # one small lookup table in the shared folder; every later join reads it
        from reelpath.sources.bundle import cut_lineage
        ranked = cut_lineage(ranked)
    out = {}
    for name, (df, key) in frames.items():
        key_type = df.schema[key].dataType
        out[name] = (ranked.filter(F.col("_rp_kind") == name)
                     .select(F.col("_rp_key").cast(key_type).alias(key),
                             (F.col("_rp_rn") - 1 + base).cast("int").alias(name)))
    return out
