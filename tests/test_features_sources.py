"""Item features, samples, scans and bundles."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from reelpath.operators import features
from reelpath.sources import bundle, scan


def test_genre_formats(spark):
    meta = spark.createDataFrame(
        [("1", "en", "drama"), ("2", None, "comedy, action"), ("3", "hi", "['a', 'b']"),
         ("4", "ta", None), ("5", "en", "  ,  ")],
        "item_id string, original_language string, Genres string")
    got = {}
    for r in features.item_features(meta).collect():
        got.setdefault(r.item_id, set()).add(r.feature)
    assert got == {"1": {"lang:en", "genre:drama"},
                   "2": {"lang:Unknown", "genre:comedy", "genre:action"},
                   "3": {"lang:hi", "genre:a", "genre:b"},
                   "4": {"lang:ta", "genre:Unknown"}, "5": {"lang:en", "genre:Unknown"}}


def test_user_sample_is_stable_and_scrubbed(spark):
    train = spark.createDataFrame([(f"u{i}", "a") for i in range(400)], "userId string, item_id string")
    test = spark.createDataFrame([(f"u{i}", x) for i in range(400) for x in ("a", "b")],
                                 "userId string, item_id string")
    tr1, te1 = features.sampled_train_test(train, test, 10)
    tr2, _ = features.sampled_train_test(train.repartition(5), test, 10)
    assert sorted(tr1.collect()) == sorted(tr2.collect())
    assert 10 < tr1.count() < 80
    assert {r.item_id for r in te1.collect()} == {"b"}


def test_partitioned_scan_prunes_and_keeps_day(spark):
    root = tempfile.mkdtemp(prefix="reelpath-test-")
    rows = [("u", "a", 1.0, dt.date(2024, 1, 30) - dt.timedelta(days=d)) for d in range(10)]
    df = spark.createDataFrame(rows, "userId string, item_id string, total_play_time_sec double, day date")
    bundle.write_table(df, f"{root}/log", ["day"])
    got = scan.read_days(spark, f"{root}/log", "2024-01-30", 2, 5)
    assert sorted(r.day for r in got.collect()) == [dt.date(2024, 1, 26), dt.date(2024, 1, 27),
                                                     dt.date(2024, 1, 28)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    with_path = scan.day_from_path(got, "path_day").collect()
    assert all(r.path_day == r.day for r in with_path)
    empty = scan.read_days(spark, f"{root}/missing", "2024-01-30", 0, 3, schema=df.schema)
    assert empty.count() == 0 and empty.columns == df.columns


def test_bundle_roundtrip_and_unit_failure(spark):
    folder = tempfile.mkdtemp(prefix="reelpath-bundle-")
    a = spark.range(5).withColumn("x", F.col("id") * 2)
    assert bundle.save_bundle({"a": a, "skipped": None}, folder) == ["a"]
    assert sorted(bundle.load_bundle(spark, folder, ["a"])["a"].collect()) == sorted(a.collect())
    try:
        bundle.load_bundle(spark, folder, ["a", "skipped"])
        raise AssertionError("expected failure")
    except RuntimeError:
        pass


def test_model_bundle_and_csv_export(spark):
    from reelpath.operators import recommend
    rows = [(u, i, 1.0 + (u + i) % 3) for u in range(8) for i in range(6)]
    train = spark.createDataFrame(rows, "userIndex int, itemIndex int, confidence double")
    model = recommend.train_als(train, rank=3, max_iter=3)
    raw = recommend.raw_recommendations(model, 3)
    folder = tempfile.mkdtemp(prefix="reelpath-model-")
    bundle.save_model_bundle(model, raw, raw.limit(2), folder + "/m")
    m2, raw2, novel2 = bundle.load_model_bundle(spark, folder + "/m")
    assert m2.rank == 3 and raw2.count() == raw.count() and novel2.count() == 2
    out = bundle.export_sample_csv(train, folder + "/csv", fraction=1.0, n=10)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) >= 1


def test_union_fold_and_single_day(spark):
    root = tempfile.mkdtemp(prefix="reelpath-days-")
    d1 = spark.createDataFrame([("u", 1.0, dt.date(2024, 1, 1))], "userId string, v double, day date")
    d2 = spark.createDataFrame([("u", "x", dt.date(2024, 1, 2))], "userId string, extra string, day date")
    folded = scan.union_days([d1, d2])
    assert set(folded.columns) == {"userId", "v", "day", "extra"} and folded.count() == 2
    bundle.write_table(d1.unionByName(d1.withColumn("day", F.lit(dt.date(2024, 1, 2)))),
                       f"{root}/log", ["day"])
    one = scan.read_single_day(spark, f"{root}/log", "2024-01-02").collect()
    assert [r.day for r in one] == [dt.date(2024, 1, 2)]


def test_day_list_scan_skips_missing_days(spark):
    root = tempfile.mkdtemp(prefix="reelpath-list-")
    rows = [("u", 1.0, dt.date(2024, 1, 30) - dt.timedelta(days=d)) for d in (0, 1, 3)]
    df = spark.createDataFrame(rows, "userId string, v double, day date")
    bundle.write_table(df, f"{root}/log", ["day"])
    days = scan.window_days("2024-01-30", 0, 3)          # 30, 29, 28 (28 missing)
    got = scan.read_day_list(spark, f"{root}/log", days)
    assert sorted(r.day for r in got.collect()) == [dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
    assert scan.read_day_list(spark, f"{root}/log", ["2023-01-01"]) is None
    typed = scan.read_day_list(spark, f"{root}/log", ["2023-01-01"], schema=df.schema)
    assert typed.count() == 0 and typed.columns == df.columns


def test_genres_as_arrays_and_nested_lists(spark):
    flat = spark.createDataFrame([("1", "en", ["drama", " action "])],
                                 "item_id string, original_language string, Genres array<string>")
    nested = spark.createDataFrame([("2", "en", [["drama"], ["crime", "noir"]])],
                                   "item_id string, original_language string, Genres array<array<string>>")
    got1 = {r.feature for r in features.item_features(flat).collect()}
    got2 = {r.feature for r in features.item_features(nested).collect()}
    assert got1 == {"lang:en", "genre:drama", "genre:action"}
    assert got2 == {"lang:en", "genre:drama", "genre:crime", "genre:noir"}
