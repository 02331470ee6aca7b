"""Toxicity: maximum-scoring segments over token log-odds.

Training counts, over all learned documents, in how many toxic and how many
other documents a feature occurs.  The features of a token are the word and its
prefixes of 4 to 7 bytes, each hashed to one of ``2^BITS`` classes, so the
model has a fixed size and word forms share the evidence of their stem.  A
feature's log-odds ratio has an informative Dirichlet prior (``PRIOR_EACH`` per
feature seen and a mass of ``PRIOR_MASS`` spread like the corpus); features whose ratio stands more than
``MIN_Z`` standard errors above zero and reaches ``MIN_LOG_ODDS`` keep it.  A
token scores its best kept feature, any other token a small negative constant,
the log-odds of meeting no kept feature.

A linear-time scan (Ruzzo and Tompa) finds all maximal scoring segments of a
text; only tokens with positive scores are visited one by one, the runs between
them enter as sums.  Segment maxima of clean text follow an extreme-value law:
its scale and its constant K are fitted by maximum likelihood to the clean
training documents, which turns a segment score into an excess over what the
text's length explains.  A document's score is a logistic function of its best
excess and of the summed excess of its significant segments.

Learning uses every labelled row outside the held-out fifth; texts that occur
several times count once per label.  Labels, lang, source and doc_id are inputs
of no score.

Defined cases: null and empty texts have no tokens and get the score of a text
without evidence; several labels of one doc_id count as toxic if any is; rows
with a null label teach nothing; without a toxic or without a clean training
document every score is the share of toxic training documents (0 if none);
rows that repeat a doc_id each get a row; further columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.llm.common import (Words, broadcast_if_small, id_remainder, mix64, sum_blocks, text_pieces, word_bytes)
from reelpath.session import checkpoint_root

FOLDS, HELD_OUT = 5, 0
BITS = 20
PREFIXES = (4, 5, 6, 7)
BLOCKS = 64
PRIOR_MASS = 500.0
PRIOR_EACH = 0.5
MIN_Z = 3.0
MIN_LOG_ODDS = 1.0
#: scales tried for the extreme-value law; 1 is the theory's for log-odds scores
SCALES = tuple(x / 10 for x in range(2, 11))


def token_features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(feature class, token index) for the word and its prefixes of each token."""
    running = w.running()
    size = w.ends - w.starts
    every = np.arange(len(size))
    ids, toks = [w.hashes(running)], [every]
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        h = running[w.starts[long] + k] - running[w.starts[long]]
        ids.append(mix64(h + np.uint64(k)))
        toks.append(long)
    shift = np.uint64(64 - BITS)
    return (np.concatenate(ids) >> shift).astype(np.int64), np.concatenate(toks)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = word_bytes()
    counts = np.zeros((2, 1 << BITS), np.int64)
    n = 0
    for b in batches:
        toxic = b.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi, buf, offs in text_pieces(b.column("text")):
            w = Words(buf, offs, table)
            f, tok = token_features(w)
            key = np.unique((w.docs()[tok].astype(np.int64) << BITS) | f)   # once per document
            cls = toxic[lo:hi][key >> BITS]
            for c in (0, 1):
                counts[c] += np.bincount(key[cls == c] & ((1 << BITS) - 1), minlength=1 << BITS)
            n += len(key)
    if n:
        cells = counts.reshape(2, BLOCKS, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BLOCKS, dtype=np.int32)),
             pa.array([np.ascontiguousarray(cells[:, k]).tobytes() for k in range(BLOCKS)], pa.binary())],
            names=["block", "cells"])


def _once_per_text(labelled: DataFrame) -> DataFrame:
    """One document of each (label, text), chosen by the smallest id."""
    slim = labelled.select("doc_id", "toxic", F.xxhash64("text").alias("h"))
    return slim.groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id")).select("doc_id")


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, text) of the labelled rows that may be learned from."""
    lab = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() &
                       (id_remainder("doc_id", FOLDS) != HELD_OUT)) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return docs.select("doc_id", F.lower("text").alias("text")).join(broadcast_if_small(lab), "doc_id")


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """(score by feature class, score of other tokens); None without both labels."""
    rows = labelled_texts(docs, labels)
    rows = rows.join(broadcast_if_small(_once_per_text(rows).checkpoint()), "doc_id", "left_semi")
    partial = rows.select("toxic", "text").mapInArrow(_count, "block int, cells binary")
    got = sorted(sum_blocks(partial, ["block"]).collect())            # BLOCKS rows of fixed size
    if not got:
        return None
    n = np.concatenate([np.frombuffer(r.cells, np.int64).reshape(2, -1) for r in got], axis=1).astype(float)
    total = n.sum(1)
    if not total.all():
        return None
    seen = n.sum(0) > 0
    prior = PRIOR_EACH * seen + PRIOR_MASS * n.sum(0) / n.sum()
    a1, a0 = n[1] + prior, n[0] + prior
    a1[~seen] = a0[~seen] = PRIOR_EACH
    mass = total + prior.sum()
    delta = np.log(a1 / (mass[1] - a1)) - np.log(a0 / (mass[0] - a0))
    delta[~seen] = 0.0
    z = delta / np.sqrt(1 / a1 + 1 / a0)
    kept = (z >= MIN_Z) & (delta >= MIN_LOG_ODDS)
    share = (n[:, kept].sum(1) + 0.5) / (total + 1.0)
    other = float(min(-0.02, np.log((1 - share[1]) / (1 - share[0]))))
    return np.where(kept, delta, 0.0).astype(np.float32), other


def maximal_segments(at: np.ndarray, score: np.ndarray, other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end token, score).

    ``at`` are the positions with a positive ``score``; every other token
    scores ``other``.  One pass; each segment is appended and merged once."""
    out: list[list] = []        # [first, end, sum before, sum after, previous smaller]
    run, last = 0.0, -1
    for i, s in zip(at.tolist(), score.tolist()):
        left = run + other * (i - last - 1)
        run = left + s
        last = i
        seg = [i, i + 1, left, run, -1]
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= seg[2]:
                j = out[j][4]
            if j < 0 or out[j][3] >= seg[3]:
                seg[4] = j
                out.append(seg)
                break
            seg[0], seg[2] = out[j][0], out[j][2]
            nxt = out[j][4]
            del out[j:]
            j = nxt
    return [(a, e, r - lft) for a, e, lft, r, _ in out]


def _scan(model: tuple[np.ndarray, float]):
    table_of, other = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes()
        for b in batches:
            tokens, best, segs = [], [], []
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                w = Words(buf, offs, table)
                f, tok = token_features(w)
                s = np.zeros(len(w.starts), np.float32)
                np.maximum.at(s, tok[table_of[f] > 0], table_of[f[table_of[f] > 0]])
                hit = np.flatnonzero(s > 0)
                cut = np.searchsorted(hit, w.splits)
                for d in range(hi - lo):
                    mine = hit[cut[d]:cut[d + 1]]
                    got = maximal_segments(mine - w.splits[d], s[mine], other) if len(mine) else []
                    segs.append(got)
                    best.append(max((g[2] for g in got), default=0.0))
                tokens.append(w.counts)
            flat = [g for d in segs for g in d]
            ends = np.concatenate([[0], np.cumsum([len(d) for d in segs])])
            struct = pa.StructArray.from_arrays(
                [pa.array([g[0] for g in flat], pa.int64()), pa.array([g[1] for g in flat], pa.int64()),
                 pa.array([g[2] for g in flat], pa.float64())], names=["first", "end", "score"])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(np.concatenate(tokens) if tokens else [], pa.int64()),
                 pa.array(best, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)],
                names=["doc_id", "n_tokens", "best", "segments"])
    return run


SEGMENTS = "doc_id long, n_tokens long, best double, segments array<struct<first: long, end: long, score: double>>"


def fit_extreme_value(clean: DataFrame) -> tuple[float, float]:
    """(scale, K) of ``P(best >= x) = 1 - exp(-K n exp(-scale x))`` on clean rows
    (n_tokens, best), by maximum likelihood over ``SCALES``; K has a closed form."""
    n = F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")
    r = clean.agg(F.count("*").alias("docs"), F.avg("best").alias("best"),
                  *[F.avg(n * F.exp(-F.col("best") * s)).alias(f"z{i}") for i, s in enumerate(SCALES)]).first()
    if not r.docs:
        return 1.0, 1.0
    fits = [(np.log(s) - np.log(r[f"z{i}"]) - s * r.best, s, 1.0 / r[f"z{i}"]) for i, s in enumerate(SCALES)]
    _, scale, k = max(fits)
    return float(scale), float(k)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with doc_id, held_out, score, predicted and the
    significant toxic passages (token ranges and their excess)."""
    checkpoint_root(docs.sparkSession)
    labels = labels.select("doc_id", "toxic")
    model = learn(docs, labels)
    out = F.coalesce(id_remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    if model is None:
        share = labels.where(id_remainder("doc_id", FOLDS) != HELD_OUT).agg(F.avg("toxic")).first()[0] or 0.0
        return docs.select("doc_id", out.alias("held_out"), F.lit(float(share)).alias("score"),
                           F.lit(int(share >= 0.5)).alias("predicted"),
                           F.expr("cast(array() as array<struct<first: long, end: long, excess: double>>)").alias("passages"))
    seen = docs.select("doc_id", F.lower("text").alias("text")).mapInArrow(_scan(model), SEGMENTS).checkpoint()
    lab = labels.where(F.col("toxic").isNotNull() & (id_remainder("doc_id", FOLDS) != HELD_OUT)) \
        .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    train = seen.select("doc_id", "n_tokens", "best", "segments").join(broadcast_if_small(lab), "doc_id")
    scale, k = fit_extreme_value(train.where("label = 0"))
    explained = F.log(F.lit(k) * F.greatest(F.col("n_tokens"), F.lit(1)))

    def featured(df: DataFrame) -> DataFrame:
        kept = F.filter(F.transform("segments", lambda s: F.struct(
            s["first"], s["end"], (s["score"] * scale - explained).alias("excess"))), lambda s: s["excess"] > 0)
        return df.withColumn("passages", kept) \
            .withColumn("x1", F.col("best") * scale - explained) \
            .withColumn("x2", F.log1p(F.aggregate("passages", F.lit(0.0), lambda a, s: a + s["excess"]))) \
            .withColumn("x3", F.log1p("best"))

    fitted = VectorAssembler(inputCols=["x1", "x2", "x3"], outputCol="x").transform(featured(train)).select("x", "label")
    lr = LogisticRegression(featuresCol="x", labelCol="label", maxIter=50, regParam=1e-3).fit(fitted)
    c = lr.coefficients
    logit = F.lit(float(lr.intercept)) + F.col("x1") * float(c[0]) + F.col("x2") * float(c[1]) + F.col("x3") * float(c[2])
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return featured(seen).withColumn("score", score).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")
