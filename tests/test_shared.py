"""Frames kept for the length of a block, and released whatever happens."""

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from paths import SF_SMALL
from reelpath.sources.shared import SharedFrames


def cached_blocks(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_frames_are_computed_once_and_released(spark):
    before = cached_blocks(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).repartition(3).mapInArrow(count, "id long")
    with SharedFrames() as shared:
        kept = shared.keep(df)
        assert shared.keep(kept) is kept and shared.kept == 1
        assert kept.count() == 1000 and kept.agg(F.sum("id")).first()[0] == 499_500
        assert kept.join(kept.select("id"), "id").count() == 1000
        assert cached_blocks(spark) == before + 1
    assert seen.value == 1000
    assert cached_blocks(spark) == before and kept.storageLevel == StorageLevel.NONE


def test_a_failing_query_leaves_no_block(spark):
    before = cached_blocks(spark)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        with SharedFrames() as shared:
            a = shared.keep(spark.range(10))
            assert a.count() == 10 and cached_blocks(spark) == before + 1
            shared.keep(a.select((F.lit(1) / (F.col("id") - 5)).alias("x"))).collect()
    assert cached_blocks(spark) == before


def test_frames_of_others_are_left_alone(spark):
    own = spark.range(5).cache()
    try:
        with SharedFrames() as shared:
            shared.keep(own)
            assert shared.kept == 0
        assert own.storageLevel != StorageLevel.NONE
        with pytest.raises(RuntimeError):
            SharedFrames().keep(own)
    finally:
        own.unpersist(blocking=True)


def test_similarity_reads_each_roll_up_once(spark, monkeypatch):
    """The playtime log is read once per window, however many stages ask for it."""
    from reelpath.plans import queries
    from reelpath.plans.workbench import Workbench
    seen = spark.sparkContext.accumulator(0)
    view = Workbench.view

    def counted(self, name):
        df = view(self, name)
        if name != "playtime":
            return df
        schema = df.schema

        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return df.mapInArrow(count, schema)

    want = sorted(map(tuple, queries.QUERIES["similarity_recs"](spark, SF_SMALL).collect()))
    monkeypatch.setattr(Workbench, "view", counted)
    before = cached_blocks(spark)
    assert sorted(map(tuple, queries.QUERIES["similarity_recs"](spark, SF_SMALL).collect())) == want and want
    rows = view(Workbench(spark, SF_SMALL), "playtime").count()
    assert 0 < seen.value <= 2 * rows and cached_blocks(spark) == before
