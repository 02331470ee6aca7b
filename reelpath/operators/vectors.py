"""Latent-vector search.

Up to ``MAX_QUERIES`` query vectors (counted) are broadcast and scored in a
projection over the table of vectors; more of them, such as the profiles of all
users, are searched block against block (:mod:`reelpath.operators.blocked`).
Profile vectors (mean of a user's history vectors) are a grouped vector mean
(``Summarizer``), so a heavy user is reduced by partial aggregation.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpath.operators.blocked import search


def dot(a: Column, b: Column) -> Column:
    """Element-wise product summed, in double precision."""
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """dot / (|a| |b|); null for a zero vector."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


#: query rows that may be broadcast to every vector row
MAX_QUERIES = 10_000


def few(query: DataFrame, max_queries: int | None = None) -> bool:
    """Whether the query rows are few enough to be broadcast."""
    most = MAX_QUERIES if max_queries is None else max_queries
    return query.limit(most + 1).count() <= most


def score_against(query: DataFrame, vectors: DataFrame, metric: str = "cosine",
                  id_col: str = "id", vec_col: str = "features", out_col: str = "score") -> DataFrame:
    """Score every vector against every query row (``q_id``, ``q_vec``); a
    query's own id is excluded.  For ``few`` queries."""
    fn = cosine if metric == "cosine" else dot
    return (vectors.crossJoin(F.broadcast(query))
            .filter(F.col(id_col) != F.col("q_id"))
            .withColumn(out_col, fn(F.col(vec_col), F.col("q_vec")))
            .drop("q_vec"))


def best(scored: DataFrame, n: int, query_col: str, id_col: str) -> DataFrame:
    """The n best rows of each query (ties by id)."""
    w = Window.partitionBy(query_col).orderBy(F.col("score").desc(), F.col(id_col))
    return (scored.filter(F.col("score").isNotNull()).withColumn("_r", F.row_number().over(w))
            .filter(F.col("_r") <= n).select(query_col, id_col, "score"))


def nearest(query: DataFrame, vectors: DataFrame, n: int = 10, metric: str = "cosine",
            id_col: str = "id", vec_col: str = "features", max_queries: int | None = None) -> DataFrame:
    """Per query row the n most similar vectors."""
    if few(query, max_queries):
        return best(score_against(query, vectors, metric, id_col, vec_col), n, "q_id", id_col)
    own = query.select("q_id", F.col("q_id").alias(id_col))
    found, _ = search(query, vectors, n, metric, own, id_col=id_col, vec_col=vec_col)
    return found.withColumnRenamed("id", id_col)


def profile_vectors(history: DataFrame, vectors: DataFrame, user_col: str = "userId",
                    item_id_col: str = "vec_id", id_col: str = "id",
                    vec_col: str = "features") -> DataFrame:
    """Per user, the mean of the history items' vectors.

    ``history`` rows are (user, vec_id).  The mean is ``Summarizer.mean`` -- a
    typed vector aggregate with partial aggregation -- so each history row
    carries one vector instead of being exploded into one row per dimension."""
    joined = (history.join(vectors, history[item_id_col] == vectors[id_col])
              .select(user_col, array_to_vector(F.col(vec_col)).alias("_v")))
    return (joined.groupBy(user_col).agg(Summarizer.mean(F.col("_v")).alias("_m"))
            .select(user_col, vector_to_array(F.col("_m")).alias("profile")))


def profile_recommendations(profile: DataFrame, vectors: DataFrame, seen: DataFrame, n: int = 10,
                            user_col: str = "userId", id_col: str = "id",
                            vec_col: str = "features", max_queries: int | None = None) -> DataFrame:
    """Per user in ``profile`` the n unseen vectors with the largest dot
    product; ``seen`` rows are (user, vec_id)."""
    q = profile.select(F.col(user_col), F.col("profile").alias("q_vec"))
    if not few(q, max_queries):
        gone = seen.select(user_col, F.col("vec_id").alias(id_col))
        found, _ = search(q, vectors, n, "dot", gone, q_id=user_col, id_col=id_col, vec_col=vec_col)
        return found.withColumnsRenamed({"q_id": user_col, "id": id_col})
    scored = (vectors.crossJoin(F.broadcast(q))
              .withColumn("score", dot(F.col(vec_col), F.col("q_vec"))).drop("q_vec"))
    unseen = scored.join(seen.select(user_col, F.col("vec_id").alias(id_col)), [user_col, id_col], "left_anti")
    return best(unseen, n, user_col, id_col)


def taste_neighbours(profiles: DataFrame, user: DataFrame, n: int = 10,
                     user_col: str = "userId", max_queries: int | None = None) -> DataFrame:
    """Per user in ``user`` the n users with the closest profile (cosine)."""
    q = (profiles.join(user.select(user_col), user_col)
         .select(F.col(user_col).alias("query_user"), F.col("profile").alias("q_vec")))
    if not few(q, max_queries):
        own = q.select("query_user", F.col("query_user").alias(user_col))
        found, _ = search(q, profiles, n, "cosine", own, q_id="query_user", id_col=user_col, vec_col="profile")
        return found.withColumnsRenamed({"q_id": "query_user", "id": user_col})
    scored = (profiles.crossJoin(F.broadcast(q))
              .filter(F.col(user_col) != F.col("query_user"))
              .withColumn("score", cosine(F.col("profile"), F.col("q_vec"))))
    return best(scored, n, "query_user", user_col)
