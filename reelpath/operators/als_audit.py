"""Was the fit right?  Normal-equation residuals of a fitted ALS model (M1, M2).

ALS solves, for every vector ``x`` of the side it updates last (the users), one
linear system given the vectors ``y`` of the other side::

    implicit   (sum_all y y' + sum_rated c y y' + reg n I) x = sum_rated,r>0 (1 + c) y,   c = alpha |r|
    explicit   (sum_rated y y' + reg n I) x = sum_rated r y

so the fit is checked against its own equations: the residual of each vector is
one sum of scaled vectors over its ratings, plus the Gram matrix of the fixed
side times ``x``.  The Gram matrix is one row of rank x rank numbers, summed
from outer products by partial aggregation, and the only thing broadcast.
All of it is expressions and aggregates inside the JVM.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpath.operators.vectors import dot

#: a solved vector's residual, relative to the right-hand side; factors are 4-byte floats
TOLERANCE = 1e-3


def _scaled(vec: Column, by: Column) -> Column:
    return array_to_vector(F.transform(vec, lambda v: v * by))


def gram(vectors: DataFrame, vec: str = "features") -> DataFrame:
    """One row: the sum of ``v v'`` as an array of rows."""
    wide = F.flatten(F.transform(vec, lambda a: F.transform(vec, lambda b: a.cast("double") * b.cast("double"))))
    total = vectors.select(F.size(vec).alias("rank"), array_to_vector(wide).alias("o")) \
        .agg(F.max("rank").alias("rank"), vector_to_array(Summarizer.sum(F.col("o"))).alias("flat"))
    rows = F.transform(F.sequence(F.lit(0), F.col("rank") - 1), lambda i: F.slice("flat", i * F.col("rank") + 1, F.col("rank")))
    return total.select(rows.alias("gram"))


def residuals(model: ALSModel, ratings: DataFrame, alpha: float = 1.0, reg_param: float = 0.1, implicit: bool = True,
              user_col: str = "userIndex", item_col: str = "itemIndex", rating_col: str = "confidence") -> DataFrame:
    """Per user of the model: (user, residual), the length of the residual over
    the length of the right-hand side.  ``ratings`` must be what was fitted."""
    users = model.userFactors.select(F.col("id").alias(user_col), F.col("features").cast("array<double>").alias("x"))
    items = model.itemFactors.select(F.col("id").alias(item_col), F.col("features").cast("array<double>").alias("y"))
    r = F.col(rating_col).cast("float").cast("double")                    # the fit reads floats
    rated = ratings.select(user_col, item_col, r.alias("r")).join(items, item_col).join(users, user_col)
    xy = dot(F.col("x"), F.col("y"))
    if implicit:
        c = F.lit(float(alpha)) * F.abs("r")
        wanted = F.when(F.col("r") > 0, 1 + c).otherwise(F.lit(0.0))
        off, counts = c * xy - wanted, F.count_if(F.col("r") > 0)
    else:
        wanted = F.col("r")
        off, counts = xy - wanted, F.count(F.lit(1))
    sums = rated.withColumns({"off": off, "wanted": wanted}).groupBy(user_col).agg(
        counts.alias("n"), Summarizer.sum(_scaled(F.col("y"), F.col("off"))).alias("left"),
        Summarizer.sum(_scaled(F.col("y"), F.col("wanted"))).alias("right"))
    rows = users.join(sums, user_col).select(user_col, "x", "n", vector_to_array("left").alias("left"),
                                             vector_to_array("right").alias("right"))
    ridge = F.lit(float(reg_param)) * F.col("n")
    miss = F.zip_with("left", "x", lambda a, b: a + ridge * b)
    if implicit:
        rows = rows.crossJoin(F.broadcast(gram(items, "y")))              # one row of rank x rank numbers
        miss = F.zip_with(miss, F.transform("gram", lambda g: dot(g, F.col("x"))), lambda a, b: a + b)
    rows = rows.withColumn("miss", miss)
    size = F.sqrt(dot(F.col("miss"), F.col("miss")))
    return rows.select(user_col, F.coalesce(F.try_divide(size, F.sqrt(dot(F.col("right"), F.col("right")))), size).alias("residual"))


def unsolved(model: ALSModel, ratings: DataFrame, tolerance: float = TOLERANCE, **params) -> DataFrame:
    """One row: vectors of the side solved last that miss their system by more
    than ``tolerance``, and users of the model without a rating."""
    per = residuals(model, ratings, **params)
    lost = model.userFactors.select(F.col("id").alias("userIndex")).join(per, "userIndex", "left_anti")
    return per.agg(F.count_if(~(F.col("residual") <= tolerance)).alias("bad")) \
        .crossJoin(lost.agg(F.count(F.lit(1)).alias("lost"))) \
        .select((F.col("bad") + F.col("lost")).alias("unsolved_users"))
