"""Search flags, session selection and the rule miner against brute force."""

import datetime as dt
from itertools import combinations

from pyspark.sql import functions as F

from reelpath.operators import search_rules as sr

COLS = ("day date, events_ts timestamp, events_meta_action string, events_meta_source_name string, "
        "events_meta_search_session_id string, events_uid string, events_appid string, "
        "events_meta_keyword string, events_meta_asset_name string, eventtype string")


def _row(action, src="x", sess="s1", uid="d1", app="mobile", kw="term", asset="a", et="click", sec=0):
    return (dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, sec), action, src, sess, uid, app, kw,
            asset, et)


def test_each_action_and_flags(spark):
    rows = [_row("search_input", sec=1), _row("tab_click", app="LargeScreen", asset="Search", sec=2),
            _row("tab_click", sec=3), _row("tile_click", src="search_page", sec=4),
            _row("search_result_consumed", sec=5),
            _row("autosuggest_click", asset="autosuggest", sec=6), _row("unknown_action", sec=7),
            _row("voice search", sess=None, sec=8)]
    ev = spark.createDataFrame(rows, COLS)
    idm = spark.createDataFrame([("d1", "reg1", dt.date(2024, 1, 1)), ("d1", "reg0", dt.date(2024, 1, 1))],
                                "temp_uid string, reg_uid string, day date")
    out = sr.search_flags(sr.resolve_users(ev, idm)).orderBy("events_ts").collect()
    assert [r.events_meta_action for r in out] == ["search_input", "tab_click", "tab_click",
                                                   "tile_click", "search_result_consumed",
                                                   "autosuggest_click"]
    assert [r.session for r in out] == [1, 1, 0, 0, 0, 0]
    assert [r.consumption for r in out] == [0, 0, 0, 1, 1, 0]
    assert [r.autosuggest for r in out] == [0, 0, 0, 0, 0, 1]
    assert {r.uid for r in out} == {"reg0"}       # deduped map: smallest registered id


def test_session_keyword_and_invalid_uids(spark):
    rows = [_row("search_input", kw="abc", sec=1), _row("search_input", kw="abcdef", sec=2),
            _row("search_input", kw="xyzuvw", sec=2), _row("search_input", kw="zz", sec=9),
            _row("search_input", sess="s2", uid="", kw="abcd"),
            _row("search_input", sess="s3", uid="NaN", kw="abcd")]
    ev = spark.createDataFrame(rows, COLS).withColumn("uid", F.col("events_uid")).withColumn(
        "session", F.lit(1))
    out = sr.session_keyword(ev).collect()
    assert [(r.events_meta_search_session_id, r.events_meta_keyword) for r in out] == [("s1", "xyzuvw")]


def test_one_to_one_rules_equal_brute_force(spark):
    baskets = [["a", "b", "c"], ["a", "b"], ["a", "c"], ["b", "c", "d"], ["a", "b", "d"], ["d"]]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "id int, items array<string>")
    model = sr.fit_rules(df, min_support=0.3, min_confidence=0.5)
    got = {(r.item_id, r.rec_item_id): (round(r.confidence, 9), round(r.lift, 9), round(r.support, 9))
           for r in sr.rule_pairs(model).collect()}
    n = len(baskets)
    freq = {}
    for b in baskets:
        for x in b:
            freq[(x,)] = freq.get((x,), 0) + 1
        for x, y in combinations(sorted(b), 2):
            freq[(x, y)] = freq.get((x, y), 0) + 1
    want = {}
    min_count = -(-0.3 * n // 1)
    for (x, y), f in [(k, v) for k, v in freq.items() if len(k) == 2]:
        for a, c in ((x, y), (y, x)):
            conf = f / freq[(a,)]
            if f >= min_count and conf >= 0.5:
                want[(a, c)] = (round(conf, 9), round(conf / (freq[(c,)] / n), 9), round(f / n, 9))
    assert got == want


def test_rules_apply_as_joins(spark):
    rules = spark.createDataFrame([(["a"], ["b"]), (["a", "b"], ["c"]), (["d"], ["a"])],
                                  "antecedent array<string>, consequent array<string>")
    owned = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "b"), ("v", "a"), ("w", "x")],
                                  "uid string, search_key string")
    got = {(r.uid, r.prediction) for r in sr.apply_rules(rules, owned).collect()}
    assert got == {("u", "c"), ("v", "b")}
