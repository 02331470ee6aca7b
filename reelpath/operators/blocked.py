"""Best inner products of any number of queries against any number of vectors
(M3, M10-M13), exact, in blocks.

Vectors are numbered by falling length and packed into blocks of ``BLOCK_ROWS``.
Queries are dealt to rows and blocks to columns of a grid, and a cell of the grid
is a cogroup: nothing is broadcast, and a task holds one cell, at most about
``CELL_BYTES`` of vectors from either side.  It multiplies ``CHUNK_ROWS`` queries
with a block at a time and keeps the best of each query over all blocks of the
cell.  A query is shuffled once for each column and a vector once for each row, not
once for each block: a round has about ``CELLS`` cells unless a side needs more
for its size.

Blocks are searched in rounds that double: after a round, a query whose worst
kept product is above its length times the length of the longest vector left is
done, since no later vector can enter its list.  Later rounds join the open
queries only.

Products are rounded to ``DIGITS`` places and ties go to the smaller id, so the
result does not depend on the blocks.  Pairs to leave out (a history, a query's own id)
are counted first: a query asks for its ``n`` best and as many more as it leaves
out, and the pairs are removed by an anti-join at the end, however long the
history is.

Null vectors and ids, and vectors with null, NaN or infinite components, take no part;
with ``cosine`` neither do vectors of length 0.  Vectors meet queries of their
own number of components only.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpath.operators.ranking import rank_within
from reelpath.session import checkpoint_root

# what runs in the workers is shipped by value: they need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
CHUNK_ROWS = 2048
#: cells of a round, and bytes of vectors that either side brings to a cell
CELLS = 36
CELL_BYTES = 32 * 2 ** 20
DIGITS = 9


def length(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))


def usable(df: DataFrame, id_col: str, vec_col: str, metric: str, out_id: str) -> DataFrame:
    """(out_id, vec, len, dim); unit vectors for ``cosine``."""
    v = df.select(F.col(id_col).alias(out_id), F.col(vec_col).cast("array<double>").alias("vec")) \
        .where(F.col(out_id).isNotNull() & (F.size("vec") > 0)).withColumn("len", length(F.col("vec")))
    v = v.where(F.col("len").isNotNull() & ~F.isnan("len") & (F.col("len") < float("inf")))
    if metric == "cosine":
        v = v.where("len > 0").withColumn("vec", F.transform("vec", lambda x: x / F.col("len"))).withColumn("len", F.lit(1.0))
    return v.withColumn("dim", F.size("vec"))


def _matrix(table: pa.Table) -> bytes:
    flat = table.column("vec").combine_chunks()
    return np.ascontiguousarray(flat.flatten().to_numpy()).tobytes()


def _pack_vectors(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(batches)
    ids = t.column("id").combine_chunks()
    ends = pa.array([0, len(ids)], pa.int32())
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()),
         pa.array([max(t.column("len").to_pylist())], pa.float64()), pa.ListArray.from_arrays(ends, ids),
         pa.array([_matrix(t)], pa.binary())], names=["dim", "block", "top", "ids", "vecs"])


def _rows(flat: pa.Array, dim: int) -> np.ndarray:
    return np.ascontiguousarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _cell(key: Tuple[pa.Scalar, ...], queries: pa.Table, blocks: pa.Table) -> pa.Table:
    """The best products of each query of a cell over the blocks of the cell."""
    dim, out = key[0].as_py(), []
    if queries.num_rows and blocks.num_rows:
        queries, blocks = queries.combine_chunks(), blocks.sort_by("block")
        held = blocks.column("ids").combine_chunks()
        ids, ends = held.flatten(), np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy())])
        place = np.empty(len(ids), np.int64)                          # place of each id in the order of ids
        place[pa.compute.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))
        tops = blocks.column("top").to_pylist()
        vecs = [np.frombuffer(m.as_buffer(), np.float64).reshape(-1, dim) for m in blocks.column("vecs")]
        for lo in range(0, queries.num_rows, CHUNK_ROWS):
            part = queries.slice(lo, CHUNK_ROWS)
            who, which, score = _chunk(part, dim, vecs, tops, ends, place)
            out.append(pa.Table.from_arrays(
                [part.column("q_id").take(pa.array(who)), part.column("need").take(pa.array(who)), ids.take(pa.array(which)),
                 pa.array(score)], names=["q_id", "need", "id", "score"]))
    if out:
        return pa.concat_tables(out)
    found = blocks.schema.field("ids").type.value_type
    return pa.schema([("q_id", queries.schema.field("q_id").type), ("need", pa.int32()), ("id", found),
                      ("score", pa.float64())]).empty_table()


def _chunk(part: pa.Table, dim: int, vecs: list, tops: list, ends: np.ndarray, place: np.ndarray) -> tuple:
    """(query, vector, score) of the best products of some queries, as positions."""
    q = _rows(part.column("vec").combine_chunks().flatten(), dim)
    lens, needs = part.column("len").to_numpy(), part.column("need").to_numpy()
    floors = part.column("floor").to_numpy().copy()
    who, which, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for v, top, start in zip(vecs, tops, ends):
        open_ = np.flatnonzero(lens * top * (1 + 1e-12) + 10.0 ** -DIGITS >= floors)
        if not len(open_):
            continue
        p = np.round((q[open_] @ v.T) * 10.0 ** DIGITS) / 10.0 ** DIGITS
        for row, at in zip(p, open_):
            good = np.flatnonzero(row >= floors[at])
            if len(good) >= needs[at]:
                cut = np.partition(row[good], len(good) - needs[at])[len(good) - needs[at]]
                floors[at] = max(floors[at], cut)
                good = good[row[good] >= cut]
                if len(good) > needs[at]:                     # ties at the cut: smaller ids stay
                    good = good[np.lexsort((place[start + good], -row[good]))[:needs[at]]]
            who.append(np.full(len(good), at)), which.append(start + good), score.append(row[good])
    who, which, score = np.concatenate(who), np.concatenate(which), np.concatenate(score)
    kept = score >= floors[who]
    who, which, score = who[kept], which[kept], score[kept]
    order = np.lexsort((place[which], -score, who))
    who, which, score = who[order], which[order], score[order]
    first = np.searchsorted(who, who)                         # where the entries of the query begin
    kept = np.arange(len(who)) - first < needs[who]
    return who[kept], which[kept], score[kept]


def _parts(size: int, most: int, wanted: int) -> int:
    """Parts of a side of the grid: as many as wanted, and more where they would pass ``CELL_BYTES``."""
    return max(1, min(most, max(wanted, -(-size // CELL_BYTES))))


def search(queries: DataFrame, vectors: DataFrame, n: int, metric: str = "dot", leave_out: DataFrame | None = None,
           q_id: str = "q_id", q_vec: str = "q_vec", id_col: str = "id", vec_col: str = "features"
           ) -> tuple[DataFrame, dict[str, int]]:
    """The ``n`` best vectors of each query: (q_id, id, score), and how many
    (query, block) products were made of how many there are.

    ``leave_out`` holds (q_id, id) pairs that are not wanted."""
    checkpoint_root(queries.sparkSession)
    q = usable(queries, q_id, q_vec, metric, "q_id")
    v = usable(vectors, id_col, vec_col, metric, "id")
    kinds = dict(q.dtypes)["q_id"], dict(v.dtypes)["id"]
    if leave_out is None:
        q = q.withColumn("need", F.lit(n))
    else:
        leave_out = leave_out.select(F.col(q_id).alias("q_id"), F.col(id_col).alias("id")).distinct().checkpoint()
        left = leave_out.groupBy("q_id").agg(F.count(F.lit(1)).cast("int").alias("left"))
        q = q.join(left, "q_id", "left").withColumn("need", F.coalesce("left", F.lit(0)) + n).drop("left")
    q = q.withColumn("floor", F.lit(float("-inf"))).checkpoint()
    ranked = rank_within(v.withColumn("short", -F.round("len", 6)), ["dim"], ["short", "id"], "number", ties="row")
    block = F.floor((F.col("number") - 1) / BLOCK_ROWS).cast("long")
    packed = ranked.select("dim", block.alias("block"), "id", "vec", "len").groupBy("dim", "block").applyInArrow(
        _pack_vectors, f"dim int, block long, top double, ids array<{kinds[1]}>, vecs binary").checkpoint()
    tops = packed.select("dim", "block", "top")
    last, dim = packed.agg(F.max("block"), F.max("dim")).first()
    blocks, widest = (last or 0) + 1, 8 * (dim or 1)
    asked = q.count()
    stats = {"made": 0, "all": asked * packed.count(), "rounds": 0}
    best, open_, lo, width = None, q, 0, 1
    while lo < blocks and asked:
        to = min(lo + width, blocks)
        columns = _parts((to - lo) * BLOCK_ROWS * widest, to - lo, round(CELLS ** 0.5))
        rows = _parts(asked * widest, asked, -(-CELLS // columns))
        some = packed.where((F.col("block") >= lo) & (F.col("block") < to))
        left = open_.withColumn("row", F.pmod(F.xxhash64("q_id"), F.lit(rows))) \
            .withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))))
        right = some.withColumn("column", F.col("block") % columns) \
            .withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))))
        got = left.groupBy("dim", "row", "column").cogroup(right.groupBy("dim", "row", "column")).applyInArrow(
            _cell, f"q_id {kinds[0]}, need int, id {kinds[1]}, score double")
        got = got if best is None else got.unionByName(best)
        w = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "id")
        best = got.withColumn("place", F.row_number().over(w)).where("place <= need").drop("place").checkpoint()
        stats["made"] += asked * (to - lo)
        stats["rounds"] += 1
        lo, width = lo + width, max(1, lo + width)
        if lo < blocks:
            ends = best.groupBy("q_id").agg(F.count(F.lit(1)).alias("held"), F.min("score").alias("worst"))
            longest = tops.where(F.col("block") == lo).select("dim", F.col("top").alias("next"))
            open_ = open_.drop("floor").join(ends, "q_id", "left").join(longest, "dim") \
                .withColumn("floor", F.when(F.col("held") >= F.col("need"), F.col("worst")).otherwise(F.lit(float("-inf")))) \
                .where(F.col("len") * F.col("next") * (1 + 1e-12) + 10.0 ** -DIGITS >= F.col("floor")) \
                .select("q_id", "vec", "len", "dim", "need", "floor").checkpoint()
            asked = open_.count()
    if best is None:
        return queries.sparkSession.createDataFrame([], f"q_id {kinds[0]}, id {kinds[1]}, score double"), stats
    if leave_out is not None:
        best = best.join(leave_out, ["q_id", "id"], "left_anti")
        w = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "id")
        best = best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
    return best.select("q_id", "id", "score"), stats
