"""ALS steps over few items and any number of users (M1, M2): the equations and
the start of Spark ML's ALS, solved by matrix routines inside tasks.

Ratings are dealt to blocks by user, once per fit.  An iteration is one pass over
the blocks and one over the items:

* a block adds up, for each of its items, what its users say (``sum c x x'``,
  the right-hand side and the ratings counted); these partial sums are shuffled
  by item, not the users' vectors, and the items are solved where they meet;
* the items' vectors go to every block, which solves its users.

A user's vector never leaves its block before the last iteration, so a pass
shuffles items x blocks systems however many users there are.  With many items
that is more than the vectors themselves: :func:`fits` says where the partial
sums pay, and :func:`reelpath.operators.recommend.train_als` lets Spark ML
iterate elsewhere.

As in Spark ML sums are made in doubles, and ratings and vectors are floats.
"""

from __future__ import annotations

import sys
from typing import Callable, Tuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.sources.bundle import cut_lineage

# what runs in the workers is shipped by value: they need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ratings of a block, and systems solved at a time
BLOCK_RATINGS = 125_000
BATCH = 128
#: most bytes of the items' vectors, which every block holds, and of the systems that one task solves
ITEM_BYTES = 64 * 2 ** 20
PART_BYTES = 32 * 2 ** 20
#: partial sums up to this many bytes a pass are taken even where the vectors are fewer bytes
SMALL_PASS = 64 * 2 ** 20

_PACKED = "block int, ids binary, ends binary, items binary, ratings binary"
_SYSTEMS = "part int, id int, n long, gram binary, rhs binary"
_VECTORS = "id int, features array<float>"


def block_count(ratings: int) -> int:
    return max(1, -(-ratings // BLOCK_RATINGS))


def system_bytes(rank: int) -> int:
    return 8 * (rank * (rank + 1) // 2 + rank)


def fits(users: int, items: int, ratings: int, rank: int, item_blocks: int) -> bool:
    """Few enough items that partial sums are the smaller message: each block
    holds all items' vectors, and Spark ML would send a user's vector to as
    many item blocks as its ratings touch."""
    sums = items * block_count(ratings) * system_bytes(rank)
    sent = min(users * item_blocks, ratings) * 4 * rank
    return items * rank * 8 <= ITEM_BYTES and sums <= max(sent, SMALL_PASS)


# ------------------------------------------------------------------ inside tasks

def _array(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _pack(key: Tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The ratings of a block as arrays, by user and item."""
    user, item = (rows.column(c).to_numpy() for c in ("user", "item"))
    order = np.lexsort((item, user))
    ids, counts = np.unique(user, return_counts=True)
    packed = [ids.astype(np.int32), np.cumsum(counts).astype(np.int64), item[order].astype(np.int32),
              rows.column("rating").to_numpy()[order].astype(np.float32)]
    return pa.table([pa.array([key[0].as_py()], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in packed)],
                    names=["block", "ids", "ends", "items", "ratings"])


def _vectors(table: pa.Table, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending, and vectors."""
    table = table.combine_chunks()
    ids = table.column("id").to_numpy()
    flat = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(-1, rank)[order].astype(np.float64)


def _as_rows(ids: np.ndarray, vecs: np.ndarray) -> pa.Table:
    ends = pa.array(np.arange(len(ids) + 1) * vecs.shape[1], pa.int32())
    flat = pa.array(vecs.astype(np.float32).ravel(), pa.float32())
    return pa.table([pa.array(ids, pa.int32()), pa.ListArray.from_arrays(ends, flat)], names=["id", "features"])


def _weights(ratings: np.ndarray, alpha: float, implicit: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per rating: its weight in the matrix, in the right-hand side, and whether it counts for the ridge."""
    r = ratings.astype(np.float64)
    if not implicit:
        return np.ones_like(r), r, np.ones(len(r), bool)
    c = alpha * np.abs(r)
    return c, np.where(r > 0, 1.0 + c, 0.0), r > 0


def _solved(systems: np.ndarray, rhs: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    k = rhs.shape[1]
    systems[:, np.arange(k), np.arange(k)] += ridge[:, None]
    return np.linalg.solve(systems, rhs[:, :, None])[:, :, 0].astype(np.float32)


class _Block:
    """One block's ratings, unpacked."""

    def __init__(self, packed: pa.Table, alpha: float, implicit: bool):
        row = {c: packed.column(c)[0] for c in packed.column_names}
        self.ids, self.ends = _array(row["ids"], np.int32), _array(row["ends"], np.int64)
        self.items = _array(row["items"], np.int32)
        self.implicit = implicit
        self.c, self.wanted, self.counted = _weights(_array(row["ratings"], np.float32), alpha, implicit)
        self.starts = np.concatenate([[0], self.ends[:-1]])

    def users(self, item_ids: np.ndarray, y: np.ndarray, reg: float) -> np.ndarray:
        """The users' vectors, given the items'."""
        k, at = y.shape[1], np.searchsorted(item_ids, self.items)
        gram = y.T @ y if self.implicit else np.zeros((k, k))
        n = np.add.reduceat(self.counted.astype(np.float64), self.starts)
        out = np.empty((len(self.ids), k), np.float32)
        for lo in range(0, len(self.ids), BATCH):
            hi = min(lo + BATCH, len(self.ids))
            systems, rhs = np.empty((hi - lo, k, k)), np.empty((hi - lo, k))
            for u in range(lo, hi):
                s = slice(self.starts[u], self.ends[u])
                mine = y[at[s]]
                np.matmul((mine * self.c[s, None]).T, mine, out=systems[u - lo])
                rhs[u - lo] = self.wanted[s] @ mine
            systems += gram
            out[lo:hi] = _solved(systems, rhs, reg * n[lo:hi])
        return out

    def systems(self, x: np.ndarray, parts: int) -> pa.Table:
        """What the block's users say of its items, and their Gram matrix (id -1) for each part."""
        x = x.astype(np.float64)
        k, user = x.shape[1], np.repeat(np.arange(len(self.ids)), self.ends - self.starts)
        upper = np.triu_indices(k)
        order = np.argsort(self.items, kind="stable")
        ids, first = np.unique(self.items[order], return_index=True)
        last = np.append(first[1:], len(order))
        rows = []
        for i, a, b in zip(ids.tolist(), first, last):
            s = order[a:b]
            theirs = x[user[s]]
            rows.append((i % parts, i, int(self.counted[s].sum()), ((theirs * self.c[s, None]).T @ theirs)[upper].tobytes(),
                         (self.wanted[s] @ theirs).tobytes()))
        if self.implicit:
            gram = (x.T @ x)[upper].tobytes()
            rows += [(p, -1, 0, gram, b"") for p in range(parts)]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "id", "n", "gram", "rhs"])


def _none(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<float>": pa.list_(pa.float32())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]).empty_table()


def _items(rank: int, reg: float) -> Callable:
    """Solves the items of a part from the partial sums of all blocks."""
    def solve(key: Tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()
        grams, sides = rows.column("gram"), rows.column("rhs")
        upper, width = np.triu_indices(rank), rank * (rank + 1) // 2
        total, out = np.zeros(width), []
        found, first = np.unique(ids, return_index=True)
        for i, a, b in zip(found.tolist(), first, np.append(first[1:], len(ids))):
            system = np.zeros(width)
            for j in range(a, b):
                system += _array(grams[j], np.float64)
            if i == -1:
                total = system
                continue
            side = sum(_array(sides[j], np.float64) for j in range(a, b))
            square = np.zeros((1, rank, rank))
            square[0][upper] = system + total
            square[0] += np.triu(square[0], 1).T
            out.append(_solved(square, side[None, :], np.array([reg * n[a:b].sum()]))[0])
        found = found[found >= 0]
        return _as_rows(found, np.array(out)) if len(found) else _none(_VECTORS)
    return solve


# ------------------------------------------------------------------ the iterations

def iterate(ratings: DataFrame, start: DataFrame, items: int, rows: int, rank: int, max_iter: int, alpha: float,
            reg_param: float, implicit: bool) -> tuple[DataFrame, DataFrame]:
    """(user vectors, item vectors) after ``max_iter`` iterations from the users'
    vectors ``start`` (id, features); ``ratings`` has (user, item, rating),
    ``rows`` of them over ``items`` items.  The items' vectors are cut each time."""
    blocks = block_count(rows)
    parts = max(1, min(items, max(8, -(-items * blocks * system_bytes(rank) // PART_BYTES))))
    packed = cut_lineage(ratings.withColumn("block", F.pmod("user", F.lit(blocks)).cast("int"))
                         .groupBy("block").applyInArrow(_pack, _PACKED))

    def first(key, block, vectors):
        if not block.num_rows:
            return _none(_SYSTEMS)
        held, (ids, x) = _Block(block, alpha, implicit), _vectors(vectors, rank)
        return held.systems(x[np.searchsorted(ids, held.ids)], parts)

    def again(key, block, vectors):
        if not block.num_rows:
            return _none(_SYSTEMS)
        held = _Block(block, alpha, implicit)
        return held.systems(held.users(*_vectors(vectors, rank), reg_param), parts)

    def last(key, block, vectors):
        if not block.num_rows:
            return _none(_VECTORS)
        held = _Block(block, alpha, implicit)
        return _as_rows(held.ids, held.users(*_vectors(vectors, rank), reg_param))

    def passed(vectors, step, schema):
        return packed.groupBy("block").cogroup(vectors.groupBy("block")).applyInArrow(step, schema)

    own = start.withColumn("block", F.pmod("id", F.lit(blocks)).cast("int"))
    systems = passed(own, first, _SYSTEMS)
    for i in range(1, max_iter + 1):
        solved = cut_lineage(systems.groupBy("part").applyInArrow(_items(rank, reg_param), _VECTORS))
        sent = solved.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        if i < max_iter:
            systems = passed(sent, again, _SYSTEMS)
    return passed(sent, last, _VECTORS), solved
