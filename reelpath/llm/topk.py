"""Exact top-k inner products: norm-bucketed retrieval.

Vectors are sorted into buckets by length.  A seed pass over the longest
vectors gives every query a lower bound on its k-th best product.  The second
pass takes blocks of queries against the buckets.  In a bucket whose longest
vector has length ``l`` a product can reach the bound only if the cosine
reaches ``bound / (|q| * l)``: above 1 the bucket is skipped for the query;
below, the bucket chooses per query block between two prunings -- by length
(low thresholds: only vectors of length >= bound / |q| stay) and by coordinate
(high thresholds: on the query's strongest coordinate the normalised value must
lie in the band that the cosine threshold leaves open) -- and verifies the
survivors with full products.  All prunings keep equality, so ties survive and
go to the smaller ``vec_id``.

Defined cases: vectors that are null, empty or hold null or non-finite
components, and rows with a null ``vec_id``, take no part; only vectors of a
query's dimension are its candidates; a query's candidates are the rows with
another ``vec_id``; rows that repeat a ``vec_id`` are separate candidates;
products are exact while they stay below 2^53; a component whose floor(64 x) is
no 64-bit whole number takes the nearest one; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelpath.llm.common import broadcast_if_small
from reelpath.session import checkpoint_root

K = 20
SCALE = 64.0
#: vectors per bucket and queries per block
BUCKET_ROWS = 4096
QUERY_ROWS = 512
#: vectors of the buckets that share one copy of the query blocks
GROUP_ROWS = 4 * BUCKET_ROWS
#: above this cosine threshold a bucket prunes by coordinate
COORDINATE_FROM = 0.5

HITS = "query_id long, vec_id long, score long"


def scaled_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double> of whole numbers, dim, norm) of the valid rows."""
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * SCALE).cast("double"))
    ok = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & ok) \
        .select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v")) \
        .select("vec_id", "v", F.size("v").alias("dim"),
                F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("norm"))


def _pack(rows_per_block: int):
    """Sorted vector rows to blocks of one dimension, numbered by partition and
    counter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held: dict[int, list] = {}

        def block(dim):
            ids, vecs, bounds = (np.concatenate(x) for x in held.pop(dim))
            norms = np.sqrt((vecs * vecs).sum(1))
            with np.errstate(divide="ignore", invalid="ignore"):
                reach = np.where(bounds > 0, bounds / norms, -1.0).min()
            return pa.RecordBatch.from_arrays(
                [pa.array([next(number)], pa.int64()), pa.array([dim], pa.int32()), pa.array([norms.max()]), pa.array([reach]),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (ids, vecs, bounds))],
                names=["bucket", "dim", "top", "reach", "ids", "vecs", "bounds"])

        for b in batches:
            dims = b.column("dim").to_numpy()
            ids, bounds = b.column("vec_id").to_numpy(), b.column("bound").to_numpy()
            offs, flat = b.column("v").offsets.to_numpy(), b.column("v").values.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1), len(dims)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                while lo < hi:
                    d = int(dims[lo])
                    got = held.setdefault(d, [[], [], []])
                    take = min(rows_per_block - sum(map(len, got[0])), hi - lo)
                    got[0].append(ids[lo:lo + take].astype("<i8"))
                    got[1].append(flat[offs[lo]:offs[lo + take]].reshape(take, d).astype("<f8"))
                    got[2].append(bounds[lo:lo + take].astype("<f8"))
                    lo += take
                    if sum(map(len, got[0])) == rows_per_block:
                        yield block(d)
        for d in list(held):
            yield block(d)
    return run


def packed(vectors: DataFrame, rows_per_block: int) -> DataFrame:
    """Blocks of up to ``rows_per_block`` vectors of similar length.

    Range partitioning by length spreads equal lengths by id, so one very
    common vector does not meet in one task."""
    v = vectors if "bound" in vectors.columns else vectors.withColumn("bound", F.lit(float("-inf")))
    order = ["dim", F.desc("norm"), "vec_id"]
    return v.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "v", "dim", "bound") \
        .mapInArrow(_pack(rows_per_block), "bucket long, dim int, top double, reach double, ids binary, vecs binary, bounds binary")


def best_of(scores: np.ndarray, q: np.ndarray, ids: np.ndarray, cols: np.ndarray, k: int):
    """Positions of each row's k best entries (score down, id up), own id left out."""
    for i in range(scores.shape[0]):
        s = scores[i]
        ok = ids[cols] != q[i]
        s, c = s[ok], cols[ok]
        if len(s) > k:
            kth = np.partition(s, len(s) - k)[len(s) - k]
            keep = s >= kth
            s, c = s[keep], c[keep]
        o = np.lexsort((ids[c], -s))[:k]
        yield i, ids[c[o]], s[o]


def search_block(qi: np.ndarray, qv: np.ndarray, bound: np.ndarray, ids: np.ndarray, vecs: np.ndarray, k: int):
    """Yield (query id, vec ids, scores) of a query block against a bucket."""
    norms = np.sqrt((vecs * vecs).sum(1))
    longest = norms.max()
    qn = np.sqrt((qv * qv).sum(1))
    slack = 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        cos = np.where(bound > 0, bound / np.maximum(qn * longest, 1e-300), -1.0)
    live = np.flatnonzero(cos <= 1.0 + slack)
    by_coord = live[cos[live] >= COORDINATE_FROM]
    by_length = live[cos[live] < COORDINATE_FROM]
    if len(by_length):
        # the least demanding query of the block decides how short a vector may be
        need = np.where(bound[by_length] > 0, bound[by_length] / np.maximum(qn[by_length], 1e-300), -1.0).min()
        cols = np.flatnonzero(norms >= need * (1 - slack) - slack)
        if len(cols):
            scores = qv[by_length] @ vecs[cols].T
            for i, v, s in best_of(scores, qi[by_length], ids, cols, k):
                yield qi[by_length[i]], v, s
    if len(by_coord):
        unit = vecs / np.maximum(norms, 1e-300)[:, None]
        for i in by_coord:
            qu = qv[i] / max(qn[i], 1e-300)
            f = int(np.argmax(np.abs(qu)))
            # cos(angle(q, e_f) + angle threshold) .. : feasible band on coordinate f
            t, c = min(cos[i], 1.0), qu[f]
            spread = np.sqrt(max(0.0, (1 - t * t) * (1 - c * c)))
            lo = -1.0 if c * t - spread <= -1 or -c >= t else c * t - spread
            hi = 1.0 if c >= t else c * t + spread
            x = unit[:, f]
            cols = np.flatnonzero((x >= lo - 1e-9) & (x <= hi + 1e-9) & (norms * qn[i] >= bound[i] * (1 - slack)))
            if len(cols):
                for _, v, s in best_of((qv[i:i + 1] @ vecs[cols].T), qi[i:i + 1], ids, cols, k):
                    yield qi[i], v, s


def _search(k: int):
    """The k best products of each query of a block within a group of buckets.

    Rows of one query block and group follow each other, longest vectors first;
    what a bucket gives raises the bounds for the next one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, bounds = None, [], np.zeros(0)

        def best() -> Iterator[pa.RecordBatch]:
            if held:
                q, v, s = (np.concatenate([h[j] for h in held]).astype(np.int64) for j in range(3))
                order = np.lexsort((v, -s, q))
                q, v, s = q[order], v[order], s[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                yield pa.RecordBatch.from_arrays([pa.array(x[place < k]) for x in (q, v, s)],
                                                 names=["query_id", "vec_id", "score"])
            held.clear()

        for b in batches:
            for r in b.to_pylist():
                dim, key = r["dim"], (r["dim"], r["grp"], r["q_ids"])
                if key != now:
                    yield from best()
                    now, bounds = key, np.frombuffer(r["q_bounds"], "<f8").copy()
                qi, ids = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["ids"], "<i8")
                qv = np.frombuffer(r["q_vecs"], "<f8").reshape(-1, dim)
                vecs = np.frombuffer(r["vecs"], "<f8").reshape(-1, dim)
                at = {q: i for i, q in enumerate(qi.tolist())}
                for q, v, s in search_block(qi, qv, bounds, ids, vecs, k):
                    held.append((np.full(len(v), q), v, s))
                    if len(s) == k:
                        bounds[at[int(q)]] = max(bounds[at[int(q)]], s[-1])
        yield from best()
    return run


def _pairs(queries: DataFrame, buckets: DataFrame, k: int) -> DataFrame:
    """Search every query block against every bucket that can reach it.

    Buckets are dealt, longest first, to groups of ``GROUP_ROWS`` vectors.  A
    query block goes to the groups of its dimension whose longest vector can
    reach the block's least demanding bound, and to no other, so blocks are
    pruned before they are shuffled."""
    # numbered without the vectors, which stay where they are until the join
    slim = buckets.select("bucket", "dim", "top", (F.octet_length("ids") / 8).alias("n"))
    order = Window.orderBy("dim", F.desc("top"), "bucket")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    groups = slim.select("bucket", "dim", "top", F.row_number().over(order).alias("place"),
                         F.floor(F.coalesce(upto, F.lit(0.0)) / GROUP_ROWS).alias("grp"))
    n = buckets.count()
    b = buckets.join(broadcast_if_small(groups.select("bucket", "grp", "place"), n), "bucket")
    q = queries.select("dim", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"),
                       F.col("bounds").alias("q_bounds"), "reach")
    longest = groups.groupBy("dim", "grp").agg(F.max("top").alias("longest"))
    q = q.join(broadcast_if_small(longest, n), "dim").where(F.col("longest") >= F.col("reach") * (1 - 1e-9))
    live = F.col("top") >= F.col("reach") * (1 - 1e-9)
    return q.drop("longest").join(b.select("dim", "grp", "place", "top", "ids", "vecs"), ["dim", "grp"]).where(live) \
        .select("dim", "grp", "q_ids", "q_vecs", "q_bounds", "place", "ids", "vecs") \
        .sortWithinPartitions("dim", "grp", "q_ids", "place").mapInArrow(_search(k), HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best products.

    ``vectors`` and ``queries`` come from :func:`scaled_vectors`; a query id
    that repeats is asked once, with its smallest vector."""
    checkpoint_root(vectors.sparkSession)
    queries = queries.groupBy("vec_id").agg(F.min(F.struct("v", "dim", "norm")).alias("q")).select("vec_id", "q.*")
    buckets = packed(vectors, BUCKET_ROWS).checkpoint()
    longest = buckets.groupBy("dim").agg(F.max(F.struct("top", "bucket")).alias("m")).select("m.bucket")
    seed = buckets.join(F.broadcast(longest), "bucket", "left_semi").checkpoint()
    first = _ranked(_pairs(packed(queries, QUERY_ROWS), seed, k), k)
    bound = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("bound")).where(F.col("n") == k)
    known = queries.join(bound.select(F.col("query_id").alias("vec_id"), F.col("bound").cast("double")), "vec_id", "left") \
        .fillna(float("-inf"), ["bound"])
    return _ranked(_pairs(packed(known, QUERY_ROWS), buckets, k), k).select("query_id", "rank", "vec_id", "score")
