"""Spark fixture views equal their DuckDB bodies; the streaming roll-up
equals the batch roll-up."""

import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from reelpath.sources.fixtures import FIXTURE_SQL, SPARK_FIXTURES, TABLES, fixture_ctes
from reelpath.streaming.rollup import (events_to_playtime, playtime_partials, rollup_view,
                                       start_rollup)

from paths import SF_SMALL


def _cell(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _cell(v.tolist())
    return str(v)


@pytest.mark.parametrize("name", sorted(FIXTURE_SQL))
def test_fixture_view_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(f"WITH {fixture_ctes()} SELECT * FROM {name}")
    dcols = [d[0] for d in cur.description]
    drows = sorted("|".join(_cell(v) for v in r) for r in cur.fetchall())
    df = SPARK_FIXTURES[name](spark, SF_SMALL)
    assert df.columns == dcols
    srows = sorted("|".join(_cell(v) for v in r) for r in df.collect())
    assert srows == drows


def test_streaming_rollup_equals_batch(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    out = tempfile.mkdtemp(prefix="rollup-")
    q = start_rollup(spark, f"{SF_SMALL}/events.parque[t]", schema, out + "/parts",
                     out + "/ckpt", events_to_playtime)
    q.awaitTermination()
    streamed = rollup_view(spark, out + "/parts")
    batch = playtime_partials(events_to_playtime(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    batch = batch.withColumn("playtime", F.round("playtime", 6))
    assert sorted(streamed.collect()) == sorted(batch.select(*streamed.columns).collect())
    # a second run finds no new files and writes nothing new
    q2 = start_rollup(spark, f"{SF_SMALL}/events.parque[t]", schema, out + "/parts",
                      out + "/ckpt", events_to_playtime)
    q2.awaitTermination()
    assert rollup_view(spark, out + "/parts").count() == streamed.count()
