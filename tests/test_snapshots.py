"""Dated snapshots, damaged files and the column profile."""

import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reelpath.operators.diagnose import table_profile
from reelpath.operators.recommend import similar_items
from reelpath.sources.scan import newest_snapshot, read_tolerant, similar_snapshot, skipped_files


def test_newest_snapshot_at_or_before_the_base_day(spark, tmp_path):
    root = str(tmp_path / "items")
    rows = [(day, k) for k, day in enumerate(["2024-01-05", "2024-01-15", "2024-01-15", "2024-02-01"])]
    spark.createDataFrame(rows, "snapshot string, v int").write.partitionBy("snapshot").parquet(root)
    got = lambda day: sorted(r.v for r in newest_snapshot(spark, root, day).collect())
    assert got("2024-01-04") == [] and got("2024-01-05") == [0] and got("2024-01-14") == [0]
    assert got("2024-01-15") == [1, 2] and got("2030-01-01") == [3]
    plan = newest_snapshot(spark, root, "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in plan and "2024-01-15" in plan
    missing = str(tmp_path / "none")
    assert newest_snapshot(spark, missing, "2024-01-20", schema="v int, snapshot date").count() == 0
    with pytest.raises(AnalysisException):
        newest_snapshot(spark, missing, "2024-01-20")


def test_similar_items_snapshot_is_unpacked(spark, tmp_path):
    root = str(tmp_path / "similar")
    pairs = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.25), ("b", "a", 1.0)], "item_id string, rec_item_id string, confidence double")
    stored = similar_items(pairs)
    stored.withColumn("snapshot", F.lit("2024-01-01")).unionByName(
        stored.where("item_id = 'b'").withColumn("snapshot", F.lit("2024-03-01"))).write.partitionBy("snapshot").parquet(root)
    assert sorted(map(tuple, similar_snapshot(spark, root, "2024-02-01").collect())) == sorted(map(tuple, pairs.collect()))
    assert [tuple(r) for r in similar_snapshot(spark, root, "2024-03-02").collect()] == [("b", "a", 1.0)]


def test_a_truncated_file_is_skipped_and_named(spark, tmp_path):
    root = str(tmp_path / "log")
    spark.range(4000).withColumn("day", F.concat(F.lit("2024-01-0"), F.col("id") % 4 + 1)).repartition(4, "day") \
        .write.partitionBy("day").parquet(root)
    victim = sorted(glob.glob(f"{root}/day=2024-01-03/*.parquet"))[0]
    with open(victim, "r+b") as fh:
        fh.truncate(os.path.getsize(victim) // 2)
    rows = read_tolerant(spark, root, spark.read.parquet(f"{root}/day=2024-01-01").schema)
    assert rows.count() == 3000
    lost = skipped_files(spark, root, rows).collect()
    assert [(r.path.split("/")[-1], r.length) for r in lost] == [(os.path.basename(victim), os.path.getsize(victim))]


def test_profile_of_odd_columns(spark):
    df = spark.createDataFrame([(1, "x", None, 1.5), (2, "x", None, None), (2, "y", None, -0.5), (None, None, None, 2.0)],
                               "a int, `b c` string, none string, d double")
    got = {r.column_name: r for r in table_profile(df, 2).collect()}
    assert list(got) == ["a", "b c", "none", "d"] and [r.position for r in got.values()] == [1, 2, 3, 4]
    assert (got["a"].n_rows, got["a"].n_null, got["a"].n_distinct, got["a"].top_value, got["a"].top_counts) == (4, 1, 2, "2", "2,1")
    assert (got["b c"].min_value, got["b c"].max_value, got["b c"].top_value, got["b c"].first_value) == ("x", "y", "x", None)
    assert (got["none"].n_null, got["none"].n_distinct, got["none"].top_value, got["none"].top_counts) == (4, 0, None, "")
    assert (got["d"].type, got["d"].min_value, got["d"].top_value, got["d"].first_value) == ("double", "-0.5", None, "2.0")
    assert [r.n_rows for r in table_profile(df.limit(0)).collect()] == [0] * 4
    many = spark.range(200_000).select(F.col("id").alias("k"))
    assert abs(table_profile(many).first().n_distinct - 200_000) < 4_000
