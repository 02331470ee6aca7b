"""Personal data: what the trees learn from."""

import pytest
from pyspark.sql import functions as F

from reelpath.llm import pii


def test_every_candidate_is_learned_from(spark, monkeypatch):
    """The trees are fitted on all rows of their part, however many there are."""
    fitted = []

    class Fitted(Exception):
        pass

    class Trees:
        def __init__(self, **kw):
            pass

        def fit(self, df):
            fitted.append(df.count())
            raise Fitted

    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    rows = spark.range(60_000).select((F.col("id") % 4).cast("int").alias("kind"), (F.col("id") % 2).cast("int").alias("positive"),
                                      F.array(F.col("id").cast("double")).alias("x"), F.xxhash64("id").alias("h"))
    with pytest.raises(Fitted):
        pii.learn(rows)
    part = rows.where(F.pmod(F.shiftright("h", 20), F.lit(10)) < 7).count()
    assert fitted == [part] and part > 40_000
