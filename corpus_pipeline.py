"""Corpus preparation from end to end.

``STAGES`` lists (name, function) in order; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's ``docs``.  All stages but the last return the columns of
``documents``:

1. language ID drops documents without a letter or without a language of at
   least half of their words;
2. near-duplicate removal keeps the smallest id of each class;
3. decontamination drops documents that contain a benchmark item;
4. mixing repeats or drops documents so that sources reach their word targets;
5. token output writes the ORC data set, reads it back and digests it.

Empty tables pass through every stage; nulls, repeated rows and further columns
are handled as the operators' docstrings say.  SQL cannot express the stages
(models, sampled hashes, a tokenizer), so ``ORACLE_SQL`` is None; tests compare
each stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelpath.llm import decontam, language, mixing, near_dup, token_orc
from reelpath.llm.common import read_table
from reelpath.session import scratch_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_orc.tokens_round_trip(docs)


STAGES = [
    ("language ID", identified),
    ("MinHash near-dedup", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("token output", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
