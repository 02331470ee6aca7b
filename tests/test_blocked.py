"""Blocked search, bitmaps, sets mined on rows and the ALS audit."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from reelpath.operators import als_audit, blocked, itemsets, recommend, vectors
from reelpath.plans.workbench import Workbench


def frames(spark, n_q, n_v, dim=6, seed=0, spread=3.0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n_v, dim)) * rng.lognormal(0, spread, (n_v, 1))
    v[n_v // 2] = v[0]                                   # a tie
    q = rng.normal(size=(n_q, dim))
    return (spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "q_id long, q_vec array<double>"),
            spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, features array<double>"), q, v)


def best_of(q, v, n, out=(), unit=False):
    if unit:
        q, v = q / np.linalg.norm(q, axis=1, keepdims=True), v / np.linalg.norm(v, axis=1, keepdims=True)
    p = np.round(q @ v.T * 1e9) / 1e9
    rows = []
    for i, row in enumerate(p):
        ids = [j for j in sorted(range(len(row)), key=lambda j: (-row[j], j)) if (i, j) not in out][:n]
        rows += [(i, j, pytest.approx(row[j], abs=1e-8)) for j in ids]
    return rows


@pytest.mark.parametrize("metric", ["dot", "cosine"])
@pytest.mark.parametrize("some_out", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, metric, some_out):
    monkeypatch.setattr(blocked, "BLOCK_ROWS", 16)
    monkeypatch.setattr(blocked, "CHUNK_ROWS", 5)
    qs, vs, q, v = frames(spark, 23, 200)
    out = {(i, j) for i in range(23) for j in range(0, 200, i + 1)} if some_out else set()
    gone = spark.createDataFrame(sorted(out), "q_id long, id long") if some_out else None
    got, stats = blocked.search(qs, vs, 7, metric, gone)
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], -r[2], r[1]))
    assert rows == best_of(q, v, 7, out, metric == "cosine")
    assert stats["all"] == 23 * 13 and stats["made"] <= stats["all"]
    if metric == "dot" and not some_out:
        assert stats["made"] < stats["all"] / 2, stats          # short blocks are never met


def test_search_takes_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (None, [1.0, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []),
                               (6, [0.0, 0.0]), (7, [1.0]), (8, [2.0, None])], "id long, features array<double>")
    q = v.select(F.col("id").alias("q_id"), F.col("features").alias("q_vec"))
    got, _ = blocked.search(q, v, 3)
    assert {(r.q_id, r.id) for r in got.collect()} == {(1, 1), (1, 6), (6, 1), (6, 6), (7, 7)}
    got, _ = blocked.search(q, v, 3, "cosine")
    assert {(r.q_id, r.id) for r in got.collect()} == {(1, 1), (7, 7)}
    for a, b in ((q.limit(0), v), (q, v.limit(0))):
        assert blocked.search(a, b, 3)[0].count() == 0


def test_many_queries_equal_few(spark):
    qs, vs, _, _ = frames(spark, 30, 60, spread=0.2)
    for metric in ("cosine", "dot"):
        a = vectors.nearest(qs, vs, 5, metric).collect()
        b = vectors.nearest(qs, vs, 5, metric, max_queries=3).collect()
        assert sorted((r.q_id, r.id) for r in a) == sorted((r.q_id, r.id) for r in b) and len(a) == 150


# ------------------------------------------------------------------ ALS

@pytest.fixture(scope="module")
def fitted(spark):
    rnd = random.Random(1)
    rows = [(u, i, rnd.choice([0.2, 1.0, 2.0, 4.0])) for u in range(60) for i in rnd.sample(range(40), 8)]
    train = spark.createDataFrame(rows, "userIndex int, itemIndex int, confidence double").cache()
    yield train
    train.unpersist()


@pytest.mark.parametrize("implicit", [True, False])
def test_every_user_vector_solves_its_equation(spark, fitted, implicit):
    params = {"alpha": 10.0, "reg_param": 0.5}
    model = recommend.train_als(fitted, rank=8, max_iter=4, implicit=implicit, **params)
    assert als_audit.unsolved(model, fitted, implicit=implicit, **params).first()[0] == 0
    # the audit sees a wrong fit: other ratings, other parameters
    other = fitted.withColumn("confidence", F.when(F.col("userIndex") == 3, F.col("confidence") * 3).otherwise(F.col("confidence")))
    assert als_audit.unsolved(model, other, implicit=implicit, **params).first()[0] == 1
    assert als_audit.unsolved(model, fitted, implicit=implicit, alpha=10.0, reg_param=2.0).first()[0] == 60
    assert als_audit.unsolved(model, fitted.where("userIndex <> 5"), implicit=implicit, **params).first()[0] >= 1


def test_gram_matrix(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(50, 5)).astype(np.float32)
    df = spark.createDataFrame([(x.tolist(),) for x in v], "features array<float>")
    assert np.allclose(np.array(als_audit.gram(df).first()[0]), v.astype(float).T @ v.astype(float))


def test_top_n_equals_the_models_own(spark, fitted, monkeypatch):
    monkeypatch.setattr(blocked, "BLOCK_ROWS", 8)
    model = recommend.train_als(fitted, rank=8, max_iter=4, alpha=10.0, reg_param=0.5)
    got = {r.userIndex: [(x.itemIndex, pytest.approx(x.rating, abs=1e-5)) for x in r.recommendations]
           for r in recommend.raw_recommendations(model, 6).collect()}
    want = {r.userIndex: [(x.itemIndex, x.rating) for x in r.recommendations] for r in model.recommendForAllUsers(6).collect()}
    assert got == want and recommend.raw_recommendations(model, 6).dtypes == model.recommendForAllUsers(6).dtypes
    some = fitted.where("userIndex in (2, 9)").select("userIndex").distinct()
    assert {r.userIndex for r in recommend.raw_recommendations(model, 6, some).collect()} == {2, 9}


def test_blocks_follow_the_data(spark, fitted, monkeypatch):
    assert recommend.als_blocks(fitted) == (10, 10)
    monkeypatch.setattr(recommend, "BLOCK_IDS", 3)
    users, items = recommend.als_blocks(fitted)
    assert 18 <= users <= 22 and 12 <= items <= 15
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 10)
    assert recommend.als_blocks(fitted) == (48, 48)


# ------------------------------------------------------------------ bitmaps

def test_bitmaps_equal_sets(spark):
    rnd = random.Random(2)
    a = [(u, rnd.randrange(500)) for u in range(20) for _ in range(rnd.randrange(60))]
    b = [(u, rnd.randrange(500)) for u in range(5, 25) for _ in range(rnd.randrange(60))]
    a += [(1, 63), (1, 64), (1, 0), (1, 63)]
    to = lambda rows: itemsets.bitmaps(spark.createDataFrame(rows, "userIndex int, itemIndex int"))
    sets = lambda rows: {u: {i for x, i in rows if x == u} for u, _ in rows}
    ba, bb, sa, sb = to(a), to(b), sets(a), sets(b)
    assert {r.userIndex: r.n for r in itemsets.cardinalities(ba).collect()} == {u: len(s) for u, s in sa.items()}
    assert {r.userIndex: r.n for r in itemsets.intersections(ba, bb).collect()} == {u: len(sa[u] & sb[u]) for u in sa.keys() & sb}
    assert {r.userIndex: r.actual_items for r in itemsets.as_arrays(ba).collect()} == {u: sorted(s) for u, s in sa.items()}
    assert sorted(map(tuple, itemsets.members(ba).collect())) == sorted((u, i) for u, s in sa.items() for i in s)
    got = itemsets.mean_recall(ba, bb).first()
    both = sa.keys() & sb
    assert got.users == len(both)
    assert got.avg_recall == pytest.approx(sum(len(sa[u] & sb[u]) / len(sb[u]) for u in both) / len(both))


def test_a_hot_user_is_a_few_words(spark):
    rows = spark.range(50_000).select(F.lit(1).alias("userIndex"), (F.col("id") % 1000).cast("int").alias("itemIndex"))
    assert itemsets.bitmaps(rows).count() == 16
    plan = itemsets.bitmaps(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan


# ------------------------------------------------------------------ sets on rows

def plain_sets(baskets, least):
    out = {}
    items = sorted({i for b in baskets for i in b})
    level = [(i,) for i in items]
    while level:
        found = {s: n for s in level if (n := sum(set(s) <= b for b in baskets)) >= least}
        out.update(found)
        keys = sorted(found)
        level = [a + b[-1:] for a, b in itertools.combinations(keys, 2) if a[:-1] == b[:-1]]
    return out


@pytest.mark.parametrize("wide", [2, 1000])
def test_sets_on_rows_equal_brute_force(spark, wide):
    rnd = random.Random(4)
    baskets = [{x for x in "abcdefgh" if rnd.random() < 0.45} for _ in range(60)]
    rows = [(k, x) for k, b in enumerate(baskets) for x in b] + [(3, None)]
    df = spark.createDataFrame(rows + rows[:20], "uid int, word string")
    filled = [b for b in baskets if b]
    sets, n = itemsets.mine(itemsets.basket_rows(df, "uid", "word"), 0.1, wide=wide)
    want = plain_sets(filled, -(-len(filled) // 10))
    assert n == len(filled) and {tuple(r["items"]): r.freq for r in sets.collect()} == want and max(map(len, want)) >= 3
    pairs, _ = itemsets.mine(itemsets.basket_rows(df, "uid", "word"), 0.1, max_size=2)
    assert {tuple(r["items"]): r.freq for r in pairs.collect()} == {k: v for k, v in want.items() if len(k) <= 2}
    got = {(tuple(r.antecedent), r.consequent[0]): (r.confidence, r.lift, r.support)
           for r in itemsets.rules(sets, n, 0.6).collect()}
    rules = {}
    for s, f in want.items():
        for y in s if len(s) > 1 else ():
            x = tuple(i for i in s if i != y)
            if f / want[x] >= 0.6:
                rules[x, y] = tuple(pytest.approx(v) for v in (f / want[x], f / want[x] / (want[y,] / n), f / n))
    assert got == rules and rules


def test_one_very_wide_basket(spark):
    """A basket of 10,000 items beside small ones: no array per basket, and its
    pairs are made by several tasks."""
    wide = spark.range(10_000).select(F.lit("hot").alias("uid"), F.col("id").cast("string").alias("word"))
    small = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("uid"),
                                     (F.col("id") % 1000 % 10 + F.floor(F.col("id") / 1000) * 10).cast("string").alias("word"))
    sets, n = itemsets.mine(itemsets.basket_rows(wide.unionByName(small), "uid", "word"), 0.05)
    got = {tuple(r["items"]): r.freq for r in sets.collect()}
    assert n == 1001 and len(got) == 30 + 30 + 10 and got["0", "10", "20"] == 101
    counted = itemsets.pair_counts(itemsets.basket_rows(wide.where("cast(word as int) < 2500"), "uid", "word"))
    assert counted.count() == 2500 * 2499 // 2


def test_pair_rules_equal_the_mined_model(spark):
    from reelpath.operators.search_rules import rule_pairs
    wb = Workbench(spark, SF_SMALL)
    key = lambda df: sorted((r.item_id, r.rec_item_id, round(r.confidence, 9), round(r.lift, 9), round(r.support, 9))
                            for r in df.collect())
    assert key(wb.sim_pairs()) == key(rule_pairs(wb.rule_model()))


def test_a_cell_answers_once_for_all_its_blocks():
    """Best of each query over every block of a cell, not of each block by itself."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(3)
    q, v = rng.integers(-3, 4, (9, 4)).astype(float), rng.integers(-3, 4, (40, 4)).astype(float)
    length = lambda m: np.sqrt((m * m).sum(axis=1))
    queries = pa.table({"q_id": pa.array(range(9), pa.int64()), "vec": list(map(list, q)), "len": length(q),
                        "need": pa.array([4] * 9, pa.int32()), "floor": [float("-inf")] * 9})
    blocks = pa.table({"block": [0, 1, 2, 3], "top": [100.0] * 4, "ids": [list(range(10 * b, 10 * b + 10)) for b in range(4)],
                       "vecs": pa.array([v[10 * b:10 * b + 10].tobytes() for b in range(4)], pa.binary())})
    got = blocked._cell((pa.scalar(4), pa.scalar(0), pa.scalar(0)), queries, blocks).to_pylist()
    want = [(i, j, float(q[i] @ v[j])) for i in range(9) for j in sorted(range(40), key=lambda j: (-(q[i] @ v[j]), j))[:4]]
    assert [(r["q_id"], r["id"], r["score"]) for r in got] == want
    # a side is cut by size only beyond the wanted parts, and never into more parts than it has rows
    assert blocked._parts(10, 1000, 6) == 6 and blocked._parts(10, 3, 6) == 3
    assert blocked._parts(10 * blocked.CELL_BYTES, 1000, 6) == 10
