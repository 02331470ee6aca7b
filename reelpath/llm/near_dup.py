"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its shingles of five words; a shingle weighs
``(1 + log tf) * (1 + DAMP * idf / largest idf)``, in the sketches and in the
verification alike, so the bands reach every pair that verification accepts with
the probability of its verified similarity.  The idf is damped, because a large
group of near copies makes its own shingles common and would hide behind its own
popularity.  Document frequencies are counted over all documents in
``2^BITS`` hashed classes of shingles (feature hashing), a table of fixed size.
A class then holds about ``documents * shingles / 2^BITS`` occurrences, so the
idf of a rare shingle is ``log(2^BITS / shingles per document)`` at every corpus
size, and only shingles more common than that weigh less.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples per
document; two documents share a sample with probability equal to their weighted
Jaccard similarity.  The random numbers of a shingle come from fixed tables
that its hash indexes, with other bits for each sample.  ``ROWS`` samples make
a band; documents that share a band are candidates.

Exact copies (equal lower-case text) collapse first.  Candidates are verified
by weighted Jaccard similarity of ``THRESHOLD`` or more.

The classes are the connected components of the verified links.  First every
member of a bucket is verified against the bucket's smallest id; then, in
rounds, each bucket whose members still lie in different classes names up to
``NAMED`` members, chosen by hash, and the members of other classes are verified
against those.  These rounds only save work.  The finish is exact: over all
members of buckets that are still split, a prefix-filter join on the shingles
and on size classes gives every pair of different classes that can reach
``THRESHOLD``, and these are verified.  Texts list their shingles rarest first.  The first shingle that
two texts share bounds their common weight by what either text has from there
on, so a pair is left out only where that bound already rules it out.

Defined cases: a text of one to four words is a single shingle; texts without a
word are copies only of exactly equal texts (null and empty are equal); rows
that repeat a doc_id count as one document, with the smallest text hash deciding
its class; null doc_ids take no part and are kept by :func:`keep_one`; an empty
table has no classes; other columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpath.llm.common import (Words, broadcast_if_small, gram_hashes, small_batches, sum_blocks, text_pieces, tidy,
                                 uniform_words, word_bytes)
from reelpath.session import checkpoint_root

SHINGLE = 5
THRESHOLD = 0.8
BITS = 20
BLOCKS = 64
BANDS = 12
ROWS = 4
TABLE_BITS = 14
#: weight that the rarest shingle has over a shingle of every document
DAMP = 0.1
#: room for rounding in the bounds of the finish
SLACK = 1e-6
#: ratio between the weights of neighbouring size classes in the finish: a text reaches its own and the next
SIZE_STEP = 1 / THRESHOLD
#: members that a bucket names in each linking round
NAMED = (4, 16)


def shingles(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, tf), sorted by document and hash."""
    w = Words(buf, offs, table)
    h, docs = w.hashes(), w.docs()
    g, at = gram_hashes(h, docs, SHINGLE)
    d = docs[at]
    for n in range(1, SHINGLE):                       # short documents are one shingle
        few = np.flatnonzero(w.counts == n)
        if len(few):
            first = w.splits[few]
            one = h[first].copy()
            for k in range(1, n):
                one = one * np.uint64(0x9FB21C651E98DF25) + h[first + k]
            g, d = np.concatenate([g, one]), np.concatenate([d, few.astype(np.int32)])
    order = np.lexsort((g, d))
    d, g = d[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return d[at], g[at], np.diff(np.append(at, len(g)))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = word_bytes()
    n = np.zeros(1 << BITS, np.int64)
    docs = 0
    for b in batches:
        docs += b.num_rows
        for _, _, buf, offs in text_pieces(b.column("text")):
            _, g, _ = shingles(buf, offs, table)
            n += np.bincount((g >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    if docs:
        cells = [*(c.tobytes() for c in n.reshape(BLOCKS, -1)), np.array([docs]).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS + 1), pa.int32()), pa.array(cells, pa.binary())],
                                         names=["block", "cells"])


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf by shingle class, over all rows of ``docs``; fixed size."""
    partial = docs.select(F.lower("text").alias("text")).mapInArrow(tidy(_frequencies), "block int, cells binary")
    got = sorted(sum_blocks(partial, ["block"]).collect())
    if not got:
        return np.ones(1 << BITS, np.float32)
    n = np.frombuffer(got[-1].cells, np.int64)[0]
    df = np.concatenate([np.frombuffer(r.cells, np.int64) for r in got[:-1]])
    return np.log(1 + n / np.maximum(df, 1)).astype(np.float32)


def shingle_weights(g: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(tf)) * (1 + DAMP * idf[(g >> np.uint64(64 - BITS)).astype(np.int64)] / idf.max())


def sampling_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and log c (Gamma(2, 1)) and beta (uniform) per sample and table entry."""
    size = (BANDS * ROWS, 1 << TABLE_BITS)
    u = [(uniform_words(size[0] * size[1], 11 + k) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 + 2.0 ** -54
         for k in range(5)]
    r, c, beta = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]
    return tuple(x.reshape(size).astype(np.float32) for x in (r, c, beta))


def weighted_samples(d: np.ndarray, g: np.ndarray, weight: np.ndarray, docs: int, tables) -> np.ndarray:
    """Band keys (documents x BANDS); rows of documents without a shingle are 0."""
    out = np.zeros((docs, BANDS), np.uint64)
    if not len(g):
        return out
    heads = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    own = d[heads]
    span = np.diff(np.append(heads, len(d)))
    logw = np.log(weight).astype(np.float32)
    rs, cs, betas = tables
    mask = np.uint64((1 << TABLE_BITS) - 1)
    mult = uniform_words(BANDS * ROWS, 5) | np.uint64(1)
    for band in range(BANDS):
        key = np.zeros(len(heads), np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            at = ((g * mult[k]) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
            r = rs[k][at]
            t = np.floor(logw / r + betas[k][at])
            a = cs[k][at] - r * (t - betas[k][at] + 1)
            low = np.minimum.reduceat(a, heads)
            # the sample is the smallest hash among the minima, with its level t
            is_min = np.flatnonzero(a == np.repeat(low, span))
            pick = np.minimum.reduceat(g[is_min], np.searchsorted(is_min, heads))
            level = np.maximum.reduceat(np.where(a == np.repeat(low, span), t, -np.inf), heads)
            key = (key ^ pick ^ (level.astype(np.int64).astype(np.uint64) << np.uint64(40))) * np.uint64(0x9FB21C651E98DF25)
            key ^= key >> np.uint64(29)
        out[own, band] = key | np.uint64(1)
    return out


def _sign(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables = word_bytes(), sampling_tables()
        for b in batches:
            ids, keys = b.column("doc_id"), []
            words = []
            for lo, hi, buf, offs in text_pieces(b.column("text"), 1 << 20):
                d, g, tf = shingles(buf, offs, table)
                keys.append(weighted_samples(d, g, shingle_weights(g, tf, idf), hi - lo, tables))
                words.append(np.bincount(d, minlength=hi - lo))
            keys = np.concatenate(keys).astype(np.int64) if keys else np.zeros((0, BANDS), np.int64)
            offsets = np.arange(len(keys) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [ids, b.column("copy"), pa.array(np.concatenate(words) if words else [], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
                names=["doc_id", "copy", "n_shingles", "bands"])
    return run


def _weighted_sets(idf: np.ndarray):
    """Packed (hash, weight) arrays of each document, for verification."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes()
        for b in batches:
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                d, g, tf = shingles(buf, offs, table)
                w = shingle_weights(g, tf, idf).astype(np.float32)
                cut = np.searchsorted(d, np.arange(hi - lo + 1))
                hs = [g[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]
                ws = [w[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(hs, pa.binary()), pa.array(ws, pa.binary())],
                    names=["doc_id", "hashes", "weights"])
    return run


def weighted_jaccard(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    """Both hash arrays sorted, without repeats."""
    at = np.searchsorted(h2, h1)
    at[at == len(h2)] = 0
    both = h2[at] == h1 if len(h2) else np.zeros(len(h1), bool)
    low = float(np.minimum(w1[both], w2[at[both]]).sum(dtype=np.float64))
    high = float(w1.sum(dtype=np.float64) + w2.sum(dtype=np.float64)) - low
    return low / high if high else 0.0


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h1, w1, h2, w2 = (b.column(c) for c in ("h1", "w1", "h2", "w2"))
        sim = [weighted_jaccard(np.frombuffer(h1[i].as_buffer(), np.uint64), np.frombuffer(w1[i].as_buffer(), np.float32),
                                np.frombuffer(h2[i].as_buffer(), np.uint64), np.frombuffer(w2[i].as_buffer(), np.float32))
               for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sim, pa.float64())],
                                         names=["a", "b", "similarity"])


def settled(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, without the size estimate of the plan behind it.

    A checkpoint keeps that estimate, and joins multiply estimates: over rounds
    the driver would come to spend minutes on numbers of millions of digits."""
    done, spark = df.checkpoint(), df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(
        done._jdf.queryExecution().toRdd(), done._jdf.schema(), False), spark)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity reaches ``THRESHOLD``."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("h1"), F.col("weights").alias("w1"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("h2"), F.col("weights").alias("w2"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "h1", "w1", "h2", "w2") \
        .mapInArrow(tidy(_similarity), "a long, b long, similarity double").where(F.col("similarity") >= THRESHOLD)


def _prefixes(idf: np.ndarray):
    """Rows (gram, rest): the shingles, rarest first, from which on a text still
    holds ``THRESHOLD`` of its weight, with the weight from there on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels = b.column("doc_id").to_numpy(), b.column("class").to_numpy()
            at, grams, rests, totals = [], [], [], []
            for i in range(b.num_rows):
                h = np.frombuffer(b.column("hashes")[i].as_buffer(), np.uint64)
                w = np.frombuffer(b.column("weights")[i].as_buffer(), np.float32).astype(np.float64)
                order = np.lexsort((h, -idf[(h >> np.uint64(64 - BITS)).astype(np.int64)]))
                rest = np.cumsum(w[order][::-1])[::-1]
                n = int((rest >= THRESHOLD * rest[0] * (1 - SLACK)).sum()) if len(rest) else 0
                grams.append(h[order[:n]].astype(np.int64))
                rests.append(rest[:n])
                at.append(np.full(n, i))
                totals.append(np.full(n, rest[0] if n else 0.0))
            if at:
                at = np.concatenate(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(labels[at]), *(pa.array(np.concatenate(x)) for x in (grams, rests, totals))],
                    names=["doc_id", "class", "gram", "rest", "total"])
    return run


def size_class(total: Column) -> Column:
    return F.floor(F.log(total) / np.log(SIZE_STEP)).cast("long")


def asking_sides(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix rows (doc_id, class, gram, rest, total, major) as the lighter text of a
    pair, one for each size class that it can reach, and as the heavier one, in its
    own.  ``major`` is the class that has several texts in the shingle, or null.
    ``side`` 0 joins texts outside it with all, 1 those inside it with the others."""
    need = THRESHOLD / (1 + THRESHOLD) * (1 - SLACK)
    inside = F.coalesce(F.col("class") == F.col("major"), F.lit(False))
    x, y = (p.withColumn("inside", inside).select("gram", "inside", "major", *(F.col(c).alias(c + k) for c in (
        "doc_id", "class", "rest", "total"))) for k in "12")
    most = F.col("rest1") / need - F.col("total1")
    x = x.withColumn("most", most).where(F.col("most") >= F.col("total1") * (1 - SLACK)) \
        .withColumn("size", F.explode(F.sequence(size_class(F.col("total1") * (1 - SLACK)), size_class(F.col("most"))))) \
        .withColumn("side", F.col("inside").cast("int")).drop("inside", "major", "most")
    both = F.col("major").isNotNull() & ~F.col("inside")
    y = y.withColumn("size", size_class(F.col("total2"))) \
        .withColumn("side", F.explode(F.when(both, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("inside", "major")
    return x, y


def unlinked_pairs(members: DataFrame, sets: DataFrame, idf: np.ndarray) -> DataFrame:
    """Every pair (a, b) of ``members`` (doc_id, class) in different classes that
    can reach ``THRESHOLD``; exact, whatever the size of a bucket.

    Of two texts the lighter one asks.  With ``rest`` of its weight from a shared
    shingle on, it can only reach partners up to a total of ``rest / need - total``,
    so it joins the size classes from its own total to there, and no partner at
    all where that is below its own total: texts that share a passage too short
    never meet.  In a shingle that one class dominates, members of that class are
    not joined with each other."""
    p = sets.join(members, "doc_id").select("doc_id", "class", "hashes", "weights") \
        .mapInArrow(tidy(_prefixes(idf)), "doc_id long, class long, gram long, rest double, total double").transform(settled)
    counts = p.groupBy("gram", "class").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("gram").agg(F.max(F.struct("n", "class")).alias("m"), F.count("*").alias("classes")) \
        .where("classes > 1").select("gram", F.when(F.col("m.n") > 1, F.col("m.class")).alias("major"))
    x, y = asking_sides(p.join(mixed, "gram").transform(settled))
    need = THRESHOLD / (1 + THRESHOLD) * (1 - SLACK)
    lighter = (F.col("total1") < F.col("total2")) | ((F.col("total1") == F.col("total2")) & (F.col("doc_id1") < F.col("doc_id2")))
    can = lighter & (F.col("class1") != F.col("class2")) & (F.least("rest1", "rest2") >= need * (F.col("total1") + F.col("total2")))
    on = (x["gram"] == y["gram"]) & (x["size"] == y["size"]) & (x["side"] == y["side"])
    return x.join(y, on & can).select(F.least("doc_id1", "doc_id2").alias("a"), F.greatest("doc_id1", "doc_id2").alias("b")).distinct()


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, class): the smallest node reachable over ``links`` (a, b).

    Each round gives a node the smallest label among its neighbours and then
    the label of its label, so label chains halve; it ends when none changes."""
    label = nodes.select("node", F.col("node").alias("class"))
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().transform(settled)
    if both.isEmpty():
        return label
    touched = both.select(F.col("a").alias("node")).distinct().withColumn("class", F.col("node")).transform(settled)
    while True:
        seen = both.join(touched.select(F.col("node").alias("b"), "class"), "b").groupBy(F.col("a").alias("node")) \
            .agg(F.min("class").alias("near"))
        step = touched.join(seen, "node").select("node", F.col("class").alias("old"),
                                                 F.least("class", "near").alias("class")).transform(settled)
        jump = step.select(F.col("node").alias("class"), F.col("class").alias("far"))
        nxt = step.join(jump, "class").select("node", F.least("class", "far").alias("class"), "old").transform(settled)
        changed = nxt.where("class <> old").limit(1).count()
        touched = nxt.select("node", "class")
        if not changed:
            break
    rest = touched.withColumnRenamed("class", "found")
    return label.join(rest, "node", "left").select("node", F.coalesce("found", "class").alias("class"))


def relabelled(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (node, class) after further links (a, b); only the classes that
    they touch are walked."""
    ends = [found.select(F.col("node").alias(c), F.col("class").alias("class_" + c)) for c in "ab"]
    pairs = links.join(ends[0], "a").join(ends[1], "b").where("class_a <> class_b") \
        .select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct().transform(settled)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    to = components(nodes, pairs).select(F.col("node").alias("class"), F.col("class").alias("to")).transform(settled)
    return found.join(broadcast_if_small(to), "class", "left").select("node", F.coalesce("to", "class").alias("class"))


def still_split(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one class, with their class."""
    placed = shared.join(found.select(F.col("node").alias("doc_id"), "class"), "doc_id")
    split = placed.groupBy("band", "key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi")
    return placed.join(split.select("band", "key"), ["band", "key"])


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, copy_of, class_id, n_links): per document the smallest id with an
    equal text, its class, and the number of verified links of its text."""
    checkpoint_root(docs.sparkSession)
    with small_batches(docs.sparkSession):
        return _classes(docs)


def _classes(docs: DataFrame) -> DataFrame:
    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    base = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    idf = idf_table(base)
    signed = base.withColumn("copy", F.unhex(F.md5(F.col("text").cast("binary")))) \
        .mapInArrow(tidy(_sign(idf)), "doc_id long, copy binary, n_shingles long, bands array<long>")
    # rows that repeat an id are one document, by its smallest text hash
    signed = signed.groupBy("doc_id").agg(F.min(F.struct("copy", "n_shingles", "bands")).alias("s")) \
        .select("doc_id", "s.*").transform(settled)
    # only texts with copies need a representative, so a text of very many copies is one row of a small table
    reps = signed.groupBy("copy").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n").transform(settled)
    member = signed.select("doc_id", "copy", "n_shingles", "bands").join(broadcast_if_small(reps), "copy", "left") \
        .withColumn("rep", F.coalesce("rep", "doc_id")).drop("copy").transform(settled)
    texts = member.where((F.col("doc_id") == F.col("rep")) & (F.col("n_shingles") > 0)).drop("rep")
    member = member.select("doc_id", "rep")
    keys = texts.select("doc_id", F.posexplode("bands").alias("band", "key"))
    size = keys.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).where("n > 1")
    shared = keys.join(size.drop("n"), ["band", "key"]).transform(settled)
    first = shared.where("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct().transform(settled)
    wanted = first.select(F.col("a").alias("doc_id")).union(first.select(F.col("b").alias("doc_id"))).distinct().transform(settled)
    rows = base.join(broadcast_if_small(wanted), "doc_id", "left_semi")
    sets = rows.mapInArrow(tidy(_weighted_sets(idf)), "doc_id long, hashes binary, weights binary") \
        .groupBy("doc_id").agg(F.min(F.struct("hashes", "weights")).alias("s")).select("doc_id", "s.*").transform(settled)
    nodes = wanted.select(F.col("doc_id").alias("node"))
    links = verify(first, sets).transform(settled)
    found = components(nodes, links).transform(settled)
    for named in NAMED:
        open_ = still_split(shared, found).transform(settled)
        order = Window.partitionBy("band", "key").orderBy(F.xxhash64("doc_id", F.lit(named)), "doc_id")
        to = open_.withColumn("r", F.row_number().over(order)).where(F.col("r") <= named) \
            .select("band", "key", F.col("doc_id").alias("to"), F.col("class").alias("to_class"))
        pairs = open_.join(to, ["band", "key"]).where("class <> to_class").select(
            F.least("doc_id", "to").alias("a"), F.greatest("doc_id", "to").alias("b")).distinct()
        more = verify(pairs, sets).transform(settled)
        links, found = links.union(more), relabelled(found, more).transform(settled)
    left = still_split(shared, found).select("doc_id", "class").distinct().transform(settled)
    more = verify(unlinked_pairs(left, sets, idf), sets).transform(settled)
    links, found = links.union(more).distinct(), relabelled(found, more).transform(settled)
    degree = links.select(F.col("a").alias("n")).union(links.select(F.col("b").alias("n"))).groupBy("n") \
        .agg(F.count("*").alias("n_links"))
    return member.join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .join(degree.withColumnRenamed("n", "rep"), "rep", "left") \
        .select("doc_id", F.col("rep").alias("copy_of"), F.coalesce("class", "rep").alias("class_id"),
                F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class: that of the class's smallest id.  Rows
    without an id stay; rows that repeat the id stay together."""
    gone = classes(docs).where("doc_id <> class_id").select("doc_id").transform(settled)
    return docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(*docs.columns)
