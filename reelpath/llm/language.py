"""Language identification: multilingual mixture inference.

Learning counts, per language, the byte trigrams inside words (one per byte of
a word, the word's border as a blank), hashed to ``2^BITS`` classes: a table of
fixed size per language.  A word's likelihood under a language is the product
of its smoothed trigram probabilities.

A document is a mixture: each word comes from one language, drawn with the
document's proportions.  Expectation-maximisation estimates the proportions
over all languages; then languages leave one at a time, the smallest proportion
first, each time with proportions estimated anew, as long as the penalised
likelihood ``log L - PENALTY * languages * log(words) / 2`` gets better.  The
predicted language has the largest proportion of the selected set, and the
score is that proportion.

All documents of a text piece go through each step together as arrays.

Learning uses text and lang of every document outside the held-out third;
lang, source and doc_id are inputs of no prediction.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a
text whose only words have letters outside the learned scripts still gets its
most likely language; ties go to the language first in code point order; with
nothing to learn from every text is ``und``; rows that repeat a doc_id each get
a row; further columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.llm.common import Words, broadcast_if_small, id_remainder, sum_blocks, text_pieces, tidy, word_bytes
from reelpath.session import checkpoint_root

FOLDS, HELD_OUT = 3, 1
BITS = 16
SMOOTHING = 0.5
EM_STEPS = 6
PENALTY = 2.0
#: the tables of all languages must fit in a task; more languages raise an error
MAX_LANGUAGES = 256
UNKNOWN = "und"


def trigram_classes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(class, word index) of each byte of each word."""
    b = np.where(w.inside, w.buf, 32).astype(np.uint32)
    at = np.flatnonzero(w.inside)
    word = (np.cumsum(w.first, dtype=np.int32) - 1)[at]
    before = np.where(at == w.starts[word], 32, b[at - 1])
    after = np.where(at + 1 == w.ends[word], 32, b[np.minimum(at + 1, len(b) - 1)])
    code = (before << 16) | (b[at] << 8) | after
    return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32), word


def _count(langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes(digits=False)
        n = np.zeros((len(langs), 1 << BITS), np.int64)
        for b in batches:
            at = np.searchsorted(langs, b.column("lang").to_numpy(zero_copy_only=False).astype(str))
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                w = Words(buf, offs, table)
                f, word = trigram_classes(w)
                lang = at[lo:hi][w.docs()[word]]
                n += np.bincount(lang * (1 << BITS) + f, minlength=n.size).reshape(n.shape)
        got = np.flatnonzero(n.sum(1))
        if len(got):
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[k] for k in got], pa.string()), pa.array([n[k].tobytes() for k in got], pa.binary())],
                names=["lang", "cells"])
    return run


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages in code point order, log probability table per class)."""
    rows = docs.where(F.col("lang").isNotNull() & (id_remainder("doc_id", FOLDS) != HELD_OUT))
    langs = sorted(r.lang for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not langs:
        return [], np.zeros((1 << BITS, 0), np.float32)
    partial = rows.select("lang", F.lower("text").alias("text")).mapInArrow(tidy(_count(langs)), "lang string, cells binary")
    got = {r.lang: np.frombuffer(r.cells, np.int64) for r in sum_blocks(partial, ["lang"]).collect()}
    n = np.stack([got.get(x, np.zeros(1 << BITS, np.int64)) for x in langs], axis=1) + SMOOTHING
    return langs, np.log(n / n.sum(0)).astype(np.float32)


def mixture(like: np.ndarray, splits: np.ndarray, start: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM proportions and log-likelihood per document.

    ``like`` (words x languages) are likelihoods scaled to a maximum of 1 per
    word, ``splits`` the documents' word ranges, none empty."""
    n = np.diff(splits)[:, None]
    share = start
    for _ in range(steps):
        r = like * np.repeat(share, n[:, 0], axis=0)
        r /= np.maximum(r.sum(1, keepdims=True), 1e-30)
        share = np.add.reduceat(r, splits[:-1], axis=0) / n
    p = (like * np.repeat(share, n[:, 0], axis=0)).sum(1)
    return share, np.add.reduceat(np.log(np.maximum(p, 1e-30)), splits[:-1])


def select_languages(like: np.ndarray, splits: np.ndarray, steps: int = EM_STEPS,
                     penalty: float = PENALTY) -> np.ndarray:
    """Proportions per document over its selected set of languages (else 0)."""
    docs, langs = len(splits) - 1, like.shape[1]
    size = np.diff(splits)
    share, ll = mixture(like, splits, np.full((docs, langs), 1.0 / langs), steps)
    cost = penalty * 0.5 * np.log(np.maximum(size, 2))
    best, best_value = share.copy(), ll - cost * langs
    open_ = np.arange(docs)
    current = share.copy()
    for left in range(langs - 1, 0, -1):
        if not len(open_):
            break
        words = np.concatenate([np.arange(splits[d], splits[d + 1]) for d in open_])
        cut = np.concatenate([[0], np.cumsum(size[open_])])
        trial = current[open_].copy()
        held = np.where(trial > 0, trial, 2.0)
        trial[np.arange(len(open_)), held.argmin(1)] = 0.0
        total = trial.sum(1, keepdims=True)
        trial = np.where(total > 0, trial / np.maximum(total, 1e-30), 0.0)
        share, ll = mixture(like[words], cut, trial, steps)
        value = ll - cost[open_] * left
        better = value >= best_value[open_]
        won = open_[better]
        best[won], best_value[won], current[won] = share[better], value[better], share[better]
        open_ = won
    return best


def _predict(langs: list[str], log_p: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes(digits=False)
        for b in batches:
            pred, score, shares = [], [], []
            for lo, hi, buf, offs in text_pieces(b.column("text"), 1 << 20):
                w = Words(buf, offs, table)
                full = np.flatnonzero(w.counts)
                share = np.zeros((hi - lo, len(langs)))
                if len(full):
                    f, _ = trigram_classes(w)
                    inner = np.concatenate([[0], np.cumsum(w.ends - w.starts)])[:-1]
                    ll = np.add.reduceat(log_p[f], inner, axis=0)
                    like = np.exp(ll - ll.max(1, keepdims=True)).astype(np.float32)
                    share[full] = select_languages(like, np.append(w.splits[:-1][full], w.splits[-1]))
                top = share.argmax(1)
                score.append(np.minimum(share[np.arange(hi - lo), top], 1.0))
                pred += [langs[t] if n else None for t, n in zip(top, w.counts)]
                shares.append(share)
            shares = np.concatenate(shares) if shares else np.zeros((0, len(langs)))
            ends = np.arange(len(pred) + 1, dtype=np.int32) * len(langs)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in b.schema.names if c != "text"), pa.array(pred, pa.string()),
                 pa.array(np.concatenate(score) if score else [], pa.float64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(shares.ravel(), pa.float64()))],
                names=[*(c for c in b.schema.names if c != "text"), "pred", "top", "shares"])
    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and the proportions by language
    (``langs`` and ``shares``) of every row of ``docs``."""
    checkpoint_root(docs.sparkSession)
    langs, log_p = model or learn(docs)
    held = F.coalesce(id_remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    if not langs:
        return docs.select("doc_id", held.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.expr("cast(array() as array<string>)").alias("langs"),
                           F.expr("cast(array() as array<double>)").alias("shares"))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id"), letters.alias("letters"), F.lower("text").alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    got = rows.mapInArrow(tidy(_predict(langs, log_p)),
                          f"doc_id {kind}, letters boolean, pred string, top double, shares array<double>")
    known = F.col("letters") & F.col("pred").isNotNull()
    return got.select("doc_id", held.alias("held_out"),
                      F.when(known, F.col("pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                      F.when(known, F.col("top")).otherwise(F.lit(0.0)).alias("score"),
                      F.array(*[F.lit(x) for x in langs]).alias("langs"), "shares")


def keep_identified(docs: DataFrame, min_share: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose predicted language is not ``und`` and holds at
    least ``min_share`` of the text; an id that repeats goes if all its rows do."""
    judged = identify(docs).select(F.col("doc_id").alias("_id"), (
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_share)).alias("ok"))
    bad = judged.groupBy("_id").agg(F.max("ok").alias("ok")).where(~F.col("ok")).select("_id").checkpoint()
    return docs.join(broadcast_if_small(bad), docs["doc_id"].eqNullSafe(bad["_id"]), "left_anti")
