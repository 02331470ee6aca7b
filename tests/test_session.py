"""Session helpers: the shared checkpoint folder and cluster sizing."""

from reelpath.session import checkpoint_root, cluster_conf, scratch_path


def test_checkpoint_root_is_stable_and_scratch_paths_are_unique(spark):
    a = checkpoint_root(spark)
    assert a and checkpoint_root(spark) == a
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(a.rstrip("/"))


def test_cluster_conf_sizes_partitions_from_input():
    small = cluster_conf(1024 ** 3)
    big = cluster_conf(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 409600
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_is_dropped(spark):
    import os

    from reelpath.session import drop_scratch, scratch_path
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert drop_scratch(spark, [path]) == 1 and not os.path.exists(path.removeprefix("file:"))
