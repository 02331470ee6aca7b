"""Recommender properties and metric cross-checks."""

import pytest
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from reelpath.operators import evaluate, recommend


def _preds_truth(spark):
    preds = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 20, 1), (2, 21, 2), (3, 30, 1)],
        "userIndex int, itemIndex int, rank int")
    truth = spark.createDataFrame([(1, 11), (1, 12), (1, 99), (2, 77), (3, 30), (4, 40)],
                                  "userIndex int, itemIndex int")
    return preds, truth


def test_metrics_equal_ranking_metrics(spark):
    preds, truth = _preds_truth(spark)
    k = 3
    ours = evaluate.ranking_metrics(preds, truth, k).first()
    pairs = [([10, 11, 12], [11, 12, 99]), ([20, 21], [77]), ([30], [30])]
    rm = RankingMetrics(spark.sparkContext.parallelize(pairs))
    assert ours.users == 3
    assert abs(ours.map - rm.meanAveragePrecision) < 1e-12
    assert abs(ours.precision_at_k - rm.precisionAt(k)) < 1e-12
    assert abs(ours.recall_at_k - (2 / 3 + 0 + 1) / 3) < 1e-12


def test_top_k_ties_and_limit(spark):
    df = spark.createDataFrame([(1, i, 1.0) for i in range(5)] + [(2, 9, 2.0)],
                               "userIndex int, itemIndex int, score double")
    top = recommend.top_k(df, 3).collect()
    assert sorted((r.userIndex, r.itemIndex, r.rank) for r in top) == \
        [(1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 9, 1)]


def test_novelty_two_ways_agree_and_drop_seen(spark):
    raw = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (1, 7, 3), (2, 5, 1), (3, 8, 1)],
                                "userIndex int, itemIndex int, rank int")
    train = spark.createDataFrame([(1, 6, 1.0), (2, 5, 1.0), (9, 1, 1.0)],
                                  "userIndex int, itemIndex int, confidence double")
    anti = recommend.drop_seen(raw, train, ["userIndex", "itemIndex"])
    arrays = raw.groupBy("userIndex").agg(
        F.array_sort(F.collect_list(F.struct("rank", "itemIndex"))).alias("recommendations"))
    by_arrays = recommend.unseen_first(arrays, recommend.history_arrays(train, arrays), 2)
    a = sorted((r.userIndex, r.itemIndex) for r in anti.collect())
    b = sorted((r.userIndex, x) for r in by_arrays.collect() for x in r.predicted_items)
    assert a == b == [(1, 5), (1, 7), (3, 8)]


def test_as_arrays_keeps_rank_order(spark):
    ranked = spark.createDataFrame([(1, 30, 3), (1, 10, 1), (1, 20, 2)],
                                   "userIndex int, itemIndex int, rank int")
    assert recommend.as_arrays(ranked).first().predicted_items == [10, 20, 30]


def test_als_scores_are_factor_dot_products_and_rerank_is_novel(spark):
    rows = [(u, i, float((u * 7 + i) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    train = spark.createDataFrame(rows, "userIndex int, itemIndex int, confidence double")
    model = recommend.train_als(train, rank=4, max_iter=5, alpha=5.0, reg_param=0.1)
    flat = recommend.flatten_recs(recommend.raw_recommendations(model, 5))
    uf = {r.id: r.features for r in model.userFactors.collect()}
    itf = {r.id: r.features for r in model.itemFactors.collect()}
    for r in flat.limit(20).collect():
        dot = sum(a * b for a, b in zip(uf[r.userIndex], itf[r.itemIndex]))
        assert abs(dot - r.als_rating) < 1e-4
    top = recommend.popularity_rerank(flat, train, None, 3)
    assert top.join(train, ["userIndex", "itemIndex"]).count() == 0
    per_user = top.groupBy("userIndex").agg(F.count("*").alias("n"),
                                            F.countDistinct("itemIndex").alias("d")).collect()
    assert all(r.n <= 3 and r.n == r.d for r in per_user)


def test_coverage_counts_never_recommended_items(spark):
    recs = spark.createDataFrame([(1, 1), (2, 1), (2, 2)], "userIndex int, itemIndex int")
    cat = spark.createDataFrame([(i,) for i in range(4)], "itemIndex int")
    r = evaluate.catalogue_coverage(recs, cat).first()
    assert (r.total_items, r.covered_items, r.coverage) == (4, 2, 0.5)


def test_pick_user_is_repeatable(spark):
    df = spark.createDataFrame([(f"u{i}", str(j)) for i in range(30) for j in range(i % 5)],
                               "userId string, item_id string")
    a = recommend.pick_user(df, 3).first().userId
    b = recommend.pick_user(df.repartition(7), 3).first().userId
    assert a == b


def test_array_recall_equals_row_recall(spark):
    from reelpath.operators.indexing import ground_truth
    preds, truth = _preds_truth(spark)
    arrays = recommend.as_arrays(preds)
    a = evaluate.recall_by_arrays(arrays, ground_truth(truth)).first()
    b = evaluate.ranking_metrics(preds, truth, 3).first()
    assert a.users == b.users and abs(a.avg_recall - b.recall_at_k) < 1e-12


def test_similar_items_roundtrip(spark):
    pairs = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.25), ("b", "a", 1.0)],
                                  "item_id string, rec_item_id string, confidence double")
    back = recommend.read_similar(recommend.similar_items(pairs))
    assert sorted(back.collect()) == sorted(pairs.collect())


def test_grid_sweep_isolates_a_failing_point(spark, monkeypatch):
    from paths import SF_SMALL
    from reelpath.plans import queries
    monkeypatch.setattr(queries, "GRID", {"rank": [2, 0], "max_iter": [2]})
    rows = {r.params: r for r in queries.grid_sweep(spark, SF_SMALL).collect()}
    assert {p: r.status for p, r in rows.items()} == {"max_iter=2,rank=2": "ok", "max_iter=2,rank=0": "failed"}
    assert "rank" in rows["max_iter=2,rank=0"].error


def test_grid_sweep_isolates_an_error_in_the_metrics(spark, monkeypatch):
    from paths import SF_SMALL
    from reelpath.plans import queries
    monkeypatch.setattr(queries, "GRID", {"rank": [2, 3], "max_iter": [2]})
    real, calls = evaluate.ranking_metrics, []

    def failing(*a, **k):
        calls.append(1)
        out = real(*a, **k)
        return out.withColumn("map", F.raise_error(F.lit("broken metric")).cast("double")) if len(calls) == 1 else out
    monkeypatch.setattr(evaluate, "ranking_metrics", failing)
    rows = {r.params: r for r in queries.grid_sweep(spark, SF_SMALL).collect()}
    assert rows["max_iter=2,rank=2"].status == "failed" and "broken metric" in rows["max_iter=2,rank=2"].error
    assert rows["max_iter=2,rank=3"].status == "ok"


def test_grid_is_the_whole_grid():
    from reelpath.plans import queries
    assert len(queries.GRID["alpha"]) * len(queries.GRID["max_iter"]) == 10


def test_recommendations_come_most_popular_first_unknown_last(spark):
    user = spark.createDataFrame([("u",)], "userId string")
    recs = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("u", "c", 3), ("v", "a", 1)],
                                 "userId string, item_id string, rank int")
    titles = spark.createDataFrame([("a", "A")], "item_id string, title string")
    pop = spark.createDataFrame([("b", 9), ("c", 50)], "item_id string, popularity_score int")
    got = recommend.user_recommendations(user, recs, titles, pop).collect()
    assert [(r.item_id, r.position) for r in got] == [("c", 1), ("b", 2), ("a", 3)]


def test_vectors_answer_every_query(spark):
    from reelpath.operators import vectors
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "id int, features array<float>")
    q = v.where("id < 3").toDF("q_id", "q_vec")
    got = vectors.nearest(q, v, 2, "dot").groupBy("q_id").count().collect()
    assert {r.q_id: r["count"] for r in got} == {0: 2, 1: 2, 2: 2}


def _votes_by_hand(train, pairs, drop_watched):
    sums = {}
    for u, i, d in train:
        for a, b, c in pairs:
            if a == i:
                sums[u, b] = sums.get((u, b), 0.0) + c * d
    seen = {(u, i) for u, i, _ in train} if drop_watched else set()
    return sorted((u, b, round(v, 9)) for (u, b), v in sums.items() if (u, b) not in seen)


def test_similarity_votes_are_made_where_the_user_is(spark, monkeypatch):
    monkeypatch.setattr(recommend, "TRAIN_ROWS", 50, raising=False)
    train = [(f"u{u}", f"i{i}", 1.0 / (1 + (u + i) % 4)) for u in range(30) for i in range(9) if (u * i) % 4 != 1]
    pairs = [(f"i{a}", f"i{b}", 0.1 + ((a * 3 + b) % 7) / 10) for a in range(8) for b in range(9) if a != b and (a + b) % 3]
    t = spark.createDataFrame(train, "userId string, item_id string, recent_decay_factor double")
    p = spark.createDataFrame(pairs, "item_id string, rec_item_id string, confidence double")
    for drop in (True, False):
        want = _votes_by_hand(train, pairs, drop)
        scores = recommend.similarity_scores(t, p, drop)
        assert sorted(tuple(r) for r in scores.collect()) == want
        # only the history is shuffled, by user: no exchange of votes or of their partial sums
        plan = scores._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(userId" in line]
        assert dealt and all("rec_item_id" not in line for line in dealt)
        by_shuffle = recommend.similarity_scores(t, p, drop, max_rules=0)
        assert sorted(tuple(r) for r in by_shuffle.collect()) == want


def _fitted_both_ways(spark, implicit, monkeypatch):
    from reelpath.operators import als
    monkeypatch.setattr(als, "BLOCK_RATINGS", 60)
    # hub items, items of one user, ratings of 0 and below, a pair that comes twice
    rows = [(u, i, float((u * 7 + i * 3) % 5 - 1) * 0.6) for u in range(40) for i in range(12) if (u + i) % 3 or i == 0]
    rows += [(u, 20 + u, 1.5) for u in range(0, 40, 9)] + [(3, 0, 2.0)]
    t = spark.createDataFrame(rows, "userIndex int, itemIndex int, confidence double")
    params = dict(rank=5, max_iter=4, alpha=3.0, reg_param=0.4, implicit=implicit)
    return [recommend.train_als(t, by_sums=by, **params) for by in (True, False)]


@pytest.mark.parametrize("implicit", [True, False])
def test_als_by_sums_equals_spark_ml(spark, monkeypatch, implicit):
    """the same start and equations, whoever iterates."""
    ours, theirs = _fitted_both_ways(spark, implicit, monkeypatch)
    assert ours.rank == theirs.rank and ours.getUserCol() == "userIndex" and ours.getColdStartStrategy() == "drop"
    for a, b in ((ours.userFactors, theirs.userFactors), (ours.itemFactors, theirs.itemFactors)):
        a, b = ({r.id: list(r.features) for r in x.collect()} for x in (a, b))
        assert a.keys() == b.keys()
        assert max(abs(x - y) for i in a for x, y in zip(a[i], b[i])) < 1e-4


def test_als_by_sums_only_where_items_are_few():
    from reelpath.operators import als
    assert als.fits(540_000, 100, 15_600_000, 100, 10) and als.fits(1_500, 100, 43_000, 100, 10)
    assert not als.fits(2_000_000, 500_000, 100_000_000, 100, 20)       # each block would hold 400 MB of item vectors
    assert not als.fits(5_000, 50_000, 20_000_000, 100, 10)             # sums would outweigh the vectors


def test_grid_sweep_goes_on_from_the_shorter_fit(spark, monkeypatch):
    """the longer of two fits that differ in length only makes the missing iterations."""
    from paths import SF_SMALL
    from reelpath.operators import als
    from reelpath.plans import queries
    made, real = [], als.iterate

    def counted(ratings, start, items, rows, rank, max_iter, *a):
        made.append(max_iter)
        return real(ratings, start, items, rows, rank, max_iter, *a)
    monkeypatch.setattr(als, "iterate", counted)
    monkeypatch.setattr(queries, "GRID", {"alpha": [2.0, 3.0], "max_iter": [2, 3], "rank": [4]})
    rows = {r.params: r for r in queries.grid_sweep(spark, SF_SMALL).collect()}
    assert made == [2, 1, 2, 1] and all(r.status == "ok" for r in rows.values())
    monkeypatch.setattr(queries, "GRID", {"alpha": [3.0], "max_iter": [3], "rank": [4]})
    alone = queries.grid_sweep(spark, SF_SMALL).first()
    assert alone == rows["alpha=3.0,max_iter=3,rank=4"]
