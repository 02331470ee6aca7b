"""A spot check of named queries against their DuckDB twins (sf0.001).
The full sweep over every query is ``python tools/oracle_check.py``."""

import duckdb
import pytest

import __spark_entry__ as entry
from reelpath.sources.fixtures import TABLES

from paths import SF_ORACLE, SF_SMALL

SPOT = ["confidence_labels", "indexed_train", "completion_ratings", "funnel_items",
        "similarity_recs", "ranking_metrics", "taste_neighbours", "als_checks", "cold_user_recs",
        "seen_excluded", "novel_by_arrays", "search_sequence", "item_features",
        "playtime_histogram", "popularity_percentiles", "user_recs", "partitioned_scan",
        "streaming_rollup", "cohort_metrics"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def cell(v):
        return f"{round(v, 6):.6f}" if isinstance(v, float) else str(v)
    return sorted("|".join(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SPOT)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(drows, dcols)


@pytest.mark.parametrize("name", ["association_rules", "rule_predictions"])
def test_rules_match_oracle(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_ORACLE)
    cur = c.execute(entry.oracle_sql()[name])
    want = _norm(cur.fetchall(), [d[0] for d in cur.description])
    assert want and _norm([tuple(r) for r in df.collect()], df.columns) == want


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() >= 0
