"""Language-model scores: stupid backoff over count tables partitioned by hash.

The corpus itself is the model: n-grams of one to ``ORDER`` words are counted
over all documents, and a document is scored with the counts of all *other*
documents (its own occurrences are taken off), so that every score is one of
unseen text.  A token's score is ``count(n-gram) / count(context)`` for the
longest n-gram that occurs elsewhere, times ``ALPHA`` for each order given up,
``count(word) / words`` for a word alone, and ``1 / words`` at the same discount
for a word that occurs nowhere else.

The plan is the join of exploded n-grams with count tables, sent in packed
rows.  Documents are dealt to chunks by hash.  A chunk sends its distinct
n-grams, sorted by hash, and their counts to the count partition that owns the
hash range (an n-gram of a third of all documents is one entry per chunk);
a count partition adds up and answers every chunk with the totals in the order
asked; a chunk joins the answers to its documents' n-grams and sums per
document.  Partition and chunk sizes are fixed by ``CHUNK_BYTES``, so their
numbers grow with the corpus; packed rows never outnumber exploded n-grams.
N-grams are told apart by 56 bits of hash.  :func:`relational_scores` is the
same plan with one row per n-gram.

Defined cases: null, empty and wordless texts have 0 tokens and score 0; rows
that repeat a doc_id are separate documents; a single document is scored
against no other text (every word unseen, against one word); null ids pass
through; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.llm.common import Words, gram_hashes, text_pieces, word_bytes
from reelpath.session import checkpoint_root

ORDER = 3
ALPHA = 0.4
CHUNK_BYTES = 8 << 20
HASH_SHIFT = 8

SCORES = "doc_id long, n_tokens long, log_score double, longest array<long>"


def chunk_grams(texts: pa.Array, order: int) -> tuple[np.ndarray, list]:
    """(words per document, per order (56-bit hash, document, first word))."""
    table = word_bytes()
    counts, grams, base_doc, base_word = [], [[] for _ in range(order)], 0, 0
    for lo, hi, buf, offs in text_pieces(texts):
        w = Words(buf, offs, table)
        h, docs = w.hashes(), w.docs()
        for n in range(1, order + 1):
            g, at = gram_hashes(h, docs, n)
            # 0 is kept for the number of words
            grams[n - 1].append((np.maximum(g >> np.uint64(HASH_SHIFT), 1), docs[at].astype(np.int64) + base_doc, at + base_word))
        counts.append(w.counts)
        base_doc += hi - lo
        base_word += len(h)
    joined = [tuple(np.concatenate(x) for x in zip(*g)) if g else (np.zeros(0, np.uint64), np.zeros(0, np.int64),
                                                                   np.zeros(0, np.int64)) for g in grams]
    return (np.concatenate(counts) if counts else np.zeros(0, np.int64)), joined


def owner(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The count partition of each hash; rises with the hash."""
    return ((hashes >> np.uint64(24)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, compressed."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def sender(order: int, parts: int):
    def send(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.concat_arrays([b.column("text") for b in batches])
        sizes, grams = chunk_grams(texts, order)
        every = np.concatenate([g[0] for g in grams])
        distinct, counts = np.unique(every, return_counts=True)
        cuts = np.searchsorted(owner(distinct, parts), np.arange(parts + 1))
        words = int(sizes.sum())
        for p in range(parts):
            lo, hi = cuts[p], cuts[p + 1]
            if p and lo == hi:
                continue
            h, c = distinct[lo:hi].astype(np.int64), counts[lo:hi]
            if p == 0:                                   # hash 0 carries the number of words
                h, c = np.concatenate([[0], h]), np.concatenate([[words], c])
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([key[0].as_py()], pa.int64()), pa.array([len(h)], pa.int64()),
                 pa.array([pack(np.diff(h, prepend=0))], pa.binary()), pa.array([pack(c)], pa.binary())],
                names=["part", "chunk", "n", "hashes", "counts"])
    return send


def answer(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of one count partition, given back to each chunk in its order."""
    asked, hs, cs = [], [], []
    for b in batches:
        for i in range(b.num_rows):
            n = b.column("n")[i].as_py()
            asked.append((b.column("chunk")[i].as_py(), n))
            hs.append(np.cumsum(unpack(b.column("hashes")[i].as_buffer(), n)))
            cs.append(unpack(b.column("counts")[i].as_buffer(), n))
    distinct, at = np.unique(np.concatenate(hs), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, np.concatenate(cs))
    lo = 0
    for chunk, n in asked:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([chunk], pa.int64()),
             pa.array([n], pa.int64()), pa.array([pack(total[at[lo:lo + n]])], pa.binary())],
            names=["part", "chunk", "n", "totals"])
        lo += n


def token_scores(sizes: np.ndarray, grams: list, totals: list[np.ndarray], words: int, alpha: float):
    """(log score, order used) per token.  ``totals`` holds each n-gram's count
    in the whole corpus, aligned with ``grams``."""
    n, order = int(sizes.sum()), len(grams)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    rest = np.maximum(words - sizes, 1)[docs].astype(np.float64)
    elsewhere = []
    for (g, d, at), total in zip(grams, totals):
        left = np.zeros(n, np.int64)
        left[at] = total - own_counts(d, g)
        elsewhere.append(left)                  # by the n-gram's first word
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    score, used = np.zeros(n), np.zeros(n, np.int64)
    done = np.zeros(n, bool)
    for k in range(order, 0, -1):
        i = np.flatnonzero(~done & (place >= k - 1))
        count = elsewhere[k - 1][i - k + 1].astype(np.float64)
        context = elsewhere[k - 2][i - k + 1].astype(np.float64) if k > 1 else rest[i]
        ok = (count > 0) & (context > 0)
        given_up = np.minimum(place[i[ok]] + 1, order) - k
        score[i[ok]] = given_up * np.log(alpha) + np.log(count[ok]) - np.log(context[ok])
        used[i[ok]] = k
        done[i[ok]] = True
    i = np.flatnonzero(~done)
    score[i] = (np.minimum(place[i] + 1, order) - 1) * np.log(alpha) - np.log(rest[i])
    return score, used


def own_counts(d: np.ndarray, g: np.ndarray) -> np.ndarray:
    """How often each n-gram occurs in its own document."""
    if not len(g):
        return np.zeros(0, np.int64)
    order = np.lexsort((g, d))
    new = np.ones(len(g), bool)
    new[1:] = (g[order][1:] != g[order][:-1]) | (d[order][1:] != d[order][:-1])
    group = np.cumsum(new) - 1
    out = np.empty(len(g), np.int64)
    out[order] = np.bincount(group)[group]
    return out


def scorer(order: int, alpha: float):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = pa.concat_arrays(left.column("text").chunks)
        sizes, grams = chunk_grams(texts, order)
        distinct, inv = np.unique(np.concatenate([g[0] for g in grams]), return_inverse=True)
        right = right.sort_by("part")
        got = np.concatenate([unpack(right.column("totals")[i].as_buffer(), right.column("n")[i].as_py())
                              for i in range(right.num_rows)])
        words, total = int(got[0]), got[1:][inv]
        cuts = np.cumsum([0] + [len(g[0]) for g in grams])
        s, used = token_scores(sizes, grams, [total[a:b] for a, b in zip(cuts[:-1], cuts[1:])], words, alpha)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.array([s[a:b].sum() for a, b in zip(ends[:-1], ends[1:])])
        docs = np.repeat(np.arange(len(sizes)), sizes)
        levels = np.bincount(docs * (order + 1) + used, minlength=len(sizes) * (order + 1))
        offs = pa.array(np.arange(len(sizes) + 1) * (order + 1), pa.int32())
        return pa.table({"doc_id": left.column("doc_id"), "n_tokens": pa.array(sizes, pa.int64()),
                         "log_score": pa.array(sums, pa.float64()),
                         "longest": pa.ListArray.from_arrays(offs, pa.array(levels.astype(np.int64)))})
    return score


def score_documents(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, log_score, longest) of every row; ``longest[k]`` counts
    the tokens scored with an n-gram of k words (0: seen nowhere else)."""
    checkpoint_root(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // chunk_bytes))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.coalesce("text", F.lit(""))).alias("text")) \
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))
    asked = base.groupBy("chunk").applyInArrow(
        sender(order, n), "part int, chunk long, n long, hashes binary, counts binary")
    told = asked.groupBy("part").applyInArrow(answer, "part int, chunk long, n long, totals binary")
    return base.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(scorer(order, alpha), SCORES)


# ------------------------------------------------------------------ the same scores as plain joins

GRAMS = "row long, start long, k int, gram long"


def exploder(order: int):
    """(row, first word, order, hash) of every n-gram of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, grams = chunk_grams(b.column("text"), order)
            rows, first = b.column("row").to_numpy(), np.cumsum(sizes) - sizes
            for k, (h, d, at) in enumerate(grams, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[d]), pa.array(at - first[d]), pa.array(np.full(len(h), k, np.int32)), pa.array(h.astype(np.int64))],
                    names=["row", "start", "k", "gram"])
    return run


def relational_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """What :func:`score_documents` returns, as joins of one row per n-gram.

    The plainer form of the same plan: exploded n-grams, a count table grouped by
    hash, an equi-join of the two, sums per document.  It moves every n-gram three
    times as a row of its own, many times the input, where the packed form moves
    sorted hashes as differences; the README has the figures."""
    checkpoint_root(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.coalesce("text", F.lit(""))).alias("text")) \
        .withColumn("row", F.monotonically_increasing_id()).checkpoint()
    grams = base.select("row", "text").mapInArrow(exploder(order), GRAMS).checkpoint()
    own = grams.groupBy("row", "gram").agg(F.count(F.lit(1)).alias("own"))
    total = own.groupBy("gram").agg(F.sum("own").alias("total"))
    elsewhere = own.join(total, "gram").select("row", "gram", (F.col("total") - F.col("own")).alias("left"))
    known = grams.join(elsewhere, ["row", "gram"]).select("row", "start", "k", "left").checkpoint()
    sizes = known.where("k = 1").groupBy("row").agg(F.count(F.lit(1)).alias("n_tokens")).checkpoint()
    words = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    # an n-gram scores its last word, and is the context of the word after it
    scores = known.select("row", (F.col("start") + F.col("k") - 1).alias("token"), "k", F.col("left").alias("n"),
                          F.lit(None).cast("long").alias("context"))
    contexts = known.where(F.col("k") < order).select("row", (F.col("start") + F.col("k")).alias("token"), (F.col("k") + 1).alias("k"),
                                                       F.lit(None).cast("long").alias("n"), F.col("left").alias("context"))
    rest = F.greatest(F.lit(words) - F.col("n_tokens"), F.lit(1))
    each = scores.union(contexts).groupBy("row", "token", "k").agg(F.max("n").alias("n"), F.max("context").alias("context")) \
        .where(F.col("n").isNotNull()).join(sizes, "row")
    context = F.when(F.col("k") == 1, rest).otherwise(F.col("context"))
    fits = (F.col("n") > 0) & (context > 0)
    longest = F.max(F.when(fits, F.struct("k", (F.log("n") - F.log(context)).alias("p"))))
    most = F.least(F.col("token") + 1, F.lit(order))
    per = each.groupBy("row", "token", "n_tokens").agg(longest.alias("best")) \
        .withColumn("k", F.coalesce("best.k", F.lit(0))) \
        .withColumn("p", F.coalesce(F.col("best.p"), -F.log(rest)) +
                    (most - F.greatest(F.col("k"), F.lit(1))) * F.lit(float(np.log(alpha))))
    sums = per.groupBy("row").agg(F.sum("p").alias("log_score"),
                                  F.array(*[F.count_if(F.col("k") == k) for k in range(order + 1)]).alias("longest"))
    none = F.array(*[F.lit(0).cast("long") for _ in range(order + 1)])
    return base.select("row", "doc_id").join(sizes, "row", "left").join(sums, "row", "left").select(
        "doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce("log_score", F.lit(0.0)).alias("log_score"), F.coalesce("longest", none).alias("longest"))
