"""No window of op6 moves the packed vectors."""

from pyspark.sql import functions as F

from reelpath.llm import topk
from reelpath.session import checkpoint_root


def test_buckets_are_numbered_without_their_vectors(spark):
    checkpoint_root(spark)
    v = topk.scaled_vectors(spark.range(50).select(
        F.col("id").alias("vec_id"), F.array(F.col("id") / 50, F.lit(1.0)).cast("array<float>").alias("embedding")))
    buckets = topk.packed(v, 8).checkpoint()
    plan = topk._pairs(topk.packed(v, 8), buckets, 3)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = [plan[i + 1] for i, line in enumerate(plan) if "Window [row_number" in line]
    assert below and not any("vecs#" in line for line in below)
