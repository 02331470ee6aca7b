"""Benchmark decontamination: template canonicalisation.

Documents and benchmark items become templates: numbers, names and units turn
into typed placeholders, other words into lower case.  A number is a word that
starts with a digit (``1,000`` and ``3.5`` are one number); a unit is a word of
``UNITS`` right after a number; a name is a capitalised word that does not start
a sentence.  Windows of ``WINDOW`` template words with at least ``MIN_PLAIN``
plain words are hash-joined.  A matched window also gives the values that the
document puts into the placeholders; within one alignment of a document with an
item, each value of the item must always turn into the same value of the
document, so a re-parameterised question matches and a chance template does not.
A document contains an item when consistent alignments match at least
``COVERAGE`` of the item's windows.

Candidates come from a prefix filter: an item that reaches the coverage matches
at least one of its rarest ``windows - needed + 1`` windows, so a phrase that
many items share makes no candidates by itself, and nothing is lost.  The
benchmark's window hashes are sent to the tasks as a filter while they number at
most ``BROADCAST_WINDOWS``; beyond, all windows of the documents go to the join.

Items without such a window -- fewer than ``WINDOW`` words, or hardly a plain
word, as in arithmetic -- are matched whole: the hash of their complete
lower-case word sequence against the documents' runs of as many words, or, for
items of fewer than ``MIN_WHOLE`` words, against whole documents only, since
a word or two of a text prove nothing.

Defined cases: items without a word take no part; null and empty texts contain
nothing; rows that repeat a doc_id count as one document; items
that repeat an item_id count as one item with the windows of both; null ids are
ids like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpath.llm.common import Words, broadcast_if_small, gram_hashes, mix64, text_pieces, tidy, word_bytes
from reelpath.session import checkpoint_root

WINDOW = 5
MIN_PLAIN = 2
COVERAGE = 0.5
BROADCAST_WINDOWS = 2_000_000
#: words from which on an item without windows is searched inside documents
MIN_WHOLE = 3
RUN_BASE = 0x9FB21C651E98DF25

#: words that count as units after a number
UNITS = ("mm cm m km mi ft in inch inches foot feet yard yards mile miles meter meters metre metres g kg mg lb lbs oz "
         "gram grams kilogram kilograms pound pounds ounce ounces ton tons s sec second seconds min minute minutes h "
         "hr hour hours day days week weeks month months year years l ml liter liters litre litres gallon gallons "
         "percent usd eur dollar dollars euro euros cent cents degree degrees mph kmh w kw v a hz khz mhz kb mb gb").split()

NUMBER, NAME, UNIT = (np.uint64(x) for x in (0xA1, 0xB2, 0xC3))


def lower_bytes(buf: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters in UTF-8."""
    out = buf.copy()
    out[(buf >= 65) & (buf <= 90)] += 32
    if len(buf) > 1:
        latin = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        out[1:][latin] += 32
    return out


def unit_hashes() -> np.ndarray:
    text = " ".join(UNITS).encode()
    buf = np.frombuffer(text, np.uint8)
    return np.sort(Words(buf, np.array([0, len(buf)]), word_bytes()).hashes())


def run_hashes(h: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of each run of ``n`` words within one document, in
    the same steps for any ``n``: differences of running sums over powers of an
    odd number, which has an inverse modulo 2^64."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # per document, so that a run's hash does not depend on where the document starts
    inverse = np.uint64(pow(RUN_BASE, -1, 1 << 64))
    powers = np.cumprod(np.full(len(h), inverse, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers)])
    at = np.flatnonzero(docs[:m] == docs[n - 1:])
    lift = np.cumprod(np.full(len(h) + n, np.uint64(RUN_BASE), np.uint64))
    return mix64((sums[at + n] - sums[at]) * lift[at + n - 1] + np.uint64(n)), at


def whole_runs(known: dict[int, np.ndarray] | None, lengths: list[int], key: str, entire: bool):
    """Rows (key, hash, n) of runs of the given lengths; only hashes in ``known``
    if given.  Shorter lengths than ``MIN_WHOLE`` are compared with documents of
    just so many words.  With ``entire``, of every document the one run that it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes()
        for b in batches:
            ids = b.column(key)
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                w = Words(lower_bytes(buf), offs, table)
                h, docs = w.hashes(), w.docs()
                for n in (np.unique(w.counts[w.counts > 0]).tolist() if entire else lengths):
                    g, at = run_hashes(h, docs, n)
                    if entire or n < MIN_WHOLE:
                        ok = w.counts[docs[at]] == n
                        g, at = g[ok], at[ok]
                    if known is not None:
                        ok = np.isin(g, known[n])
                        g, at = g[ok], at[ok]
                    if len(g):
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(lo + docs[at])), pa.array(g.astype(np.int64)),
                             pa.array(np.full(len(g), n), pa.int64())], names=[key, "hash", "n"])
    return run


def _whole_matches(docs: DataFrame, benchmark: DataFrame, items: DataFrame) -> DataFrame:
    """The leaks of items that have no window."""
    without = benchmark.join(items.select(F.col("item_id").alias("w_item")).distinct(),
                             benchmark["item_id"].eqNullSafe(F.col("w_item")), "left_anti")
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    short = without.select("item_id", "text").mapInArrow(
        whole_runs(None, [], "item_id", True), f"item_id {kinds[1]}, hash long, n long").distinct().checkpoint()
    lengths = sorted(r.n for r in short.select("n").distinct().collect())
    known = None
    if short.count() <= BROADCAST_WINDOWS:
        rows = short.select("n", "hash").collect()                       # at most BROADCAST_WINDOWS pairs of numbers
        known = {n: np.array([r.hash for r in rows if r.n == n], np.int64).astype(np.uint64) for n in lengths}
    none = F.lit(False)
    if not lengths:
        runs = docs.select("doc_id", F.lit(0).cast("long").alias("hash"), F.lit(0).cast("long").alias("n")).where(none)
    else:
        runs = docs.select("doc_id", "text").mapInArrow(tidy(whole_runs(known, lengths, "doc_id", False)),
                                                        f"doc_id {kinds[0]}, hash long, n long")
    return runs.distinct().join(broadcast_if_small(short), ["hash", "n"]).select("doc_id", "item_id").distinct().select(
        "doc_id", "item_id", F.lit(1).cast("long").alias("n_windows"), F.lit(1).cast("long").alias("matched"),
        F.lit(1.0).alias("coverage"), none.alias("reparameterised"))


class Template:
    """Template words of one text piece: ``docs``, ``ids`` (hash or placeholder),
    ``values`` (hash of what a placeholder stands for) and ``slot``."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, table: np.ndarray, units: np.ndarray):
        low = lower_bytes(buf)
        w = Words(low, offs, table)
        h, docs = w.hashes(), w.docs()
        n = len(h)
        first = buf[w.starts] if n else np.zeros(0, np.uint8)
        second = buf[np.minimum(w.starts + 1, len(buf) - 1)] if n else first
        number = (first >= 48) & (first <= 57)
        upper = (first >= 65) & (first <= 90) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        follow = buf[np.minimum(w.starts + 1 + (first == 0xC3), len(buf) - 1)] if n else first
        small = ((follow >= 97) & (follow <= 122)) | (follow >= 0x80)
        stops = np.concatenate([[0], np.cumsum(np.isin(buf, np.frombuffer(b".!?\n", np.uint8)))])
        same = np.zeros(n, bool)
        same[1:] = docs[1:] == docs[:-1]
        opens = ~same
        if n:
            opens[1:] |= stops[w.starts[1:]] > stops[w.ends[:-1]]
        name = upper & small & ~opens & (w.ends - w.starts > 1 + (first == 0xC3))
        # 1,000 and 3.5: the later part joins the number before it
        joined = np.zeros(n, bool)
        if n:
            gap = buf[np.minimum(w.ends[:-1], len(buf) - 1)]
            joined[1:] = number[1:] & number[:-1] & same[1:] & (w.starts[1:] == w.ends[:-1] + 1) & ((gap == 44) | (gap == 46))
        after_number = np.zeros(n, bool)
        after_number[1:] = number[:-1] & same[1:]
        unit = after_number & np.isin(h, units) & ~number
        ids = h.copy()
        ids[name], ids[number], ids[unit] = NAME, NUMBER, UNIT
        heads = np.flatnonzero(~joined)
        parts = np.where(joined, h * np.uint64(0x9FB21C651E98DF25), h)
        values = np.add.reduceat(parts, heads) if n else h
        self.docs, self.ids, self.values = docs[heads], ids[heads], values
        self.slot = (name | number | unit)[heads]


def template_windows(known: np.ndarray | None, key: str):
    """Rows (key, pos, hash, slots) of windows; only hashes in ``known`` if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, units = word_bytes(), unit_hashes()
        for b in batches:
            ids = b.column(key)
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                t = Template(buf, offs, table, units)
                g, at = gram_hashes(t.ids, t.docs, WINDOW)
                if not len(g):
                    continue
                plain = np.concatenate([[0], np.cumsum(~t.slot)])
                ok = plain[at + WINDOW] - plain[at] >= MIN_PLAIN
                if known is not None:
                    where = np.searchsorted(known, g)
                    where[where == len(known)] = 0
                    ok &= known[where] == g if len(known) else False
                pick = np.flatnonzero(ok)
                if not len(pick):
                    continue
                g, at = g[pick], at[pick]
                heads = np.searchsorted(t.docs, np.arange(hi - lo))
                span = at[:, None] + np.arange(WINDOW)
                slot = t.slot[span]
                offsets = np.concatenate([[0], np.cumsum(slot.sum(1))]).astype(np.int32)
                values = t.values[span][slot].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(lo + t.docs[at])), pa.array(at - heads[t.docs[at]], pa.int64()),
                     pa.array(g.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    names=[key, "pos", "hash", "slots"])
    return run


def _windows(df: DataFrame, key: str, known: np.ndarray | None = None) -> DataFrame:
    kind = dict(df.dtypes)[key]
    return df.select(key, "text").mapInArrow(tidy(template_windows(known, key)),
                                             f"{key} {kind}, pos long, hash long, slots array<long>")


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_windows, matched, coverage, reparameterised) of every
    document and each benchmark item that it contains."""
    checkpoint_root(docs.sparkSession)
    items = _windows(benchmark, "item_id").withColumnRenamed("pos", "item_pos") \
        .withColumnRenamed("slots", "item_slots").checkpoint()
    sizes = items.groupBy("item_id").agg(F.count_distinct("item_pos").alias("n_windows"))
    spread = items.groupBy("hash").agg(F.count_distinct("item_id").alias("in_items"))
    n = spread.count()
    known = None
    if n <= BROADCAST_WINDOWS:
        # at most BROADCAST_WINDOWS numbers of 8 bytes
        known = np.sort(np.array([r.hash for r in spread.select("hash").collect()], np.int64).astype(np.uint64))
    hits = _windows(docs, "doc_id", known).checkpoint()
    # the rarest windows of each item, one more than it may lack
    ranked = items.join(spread, "hash").groupBy("item_id", "hash").agg(
        F.min("in_items").alias("in_items"), F.count_distinct("item_pos").alias("times"))
    order = F.array_sort(F.collect_list(F.struct("in_items", "hash", "times")))     # the windows of one item
    prefix = ranked.groupBy("item_id").agg(order.alias("w"))
    size = sizes.select(F.col("item_id").alias("z_item"), "n_windows")
    prefix = prefix.join(size, prefix["item_id"].eqNullSafe(size["z_item"])) \
        .withColumn("may_lack", F.col("n_windows") - F.ceil(F.col("n_windows") * coverage)) \
        .withColumn("upto", F.aggregate(
            "w", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).alias("k")),
            lambda a, x: F.when(a["seen"] > F.col("may_lack"), a).otherwise(
                F.struct((a["seen"] + x["times"]).alias("seen"), (a["k"] + 1).alias("k"))))["k"]) \
        .select("item_id", F.explode(F.slice("w", F.lit(1), F.col("upto"))).alias("w")).select("item_id", "w.hash")
    small = broadcast_if_small(prefix.distinct().checkpoint())
    pairs = hits.select("doc_id", "hash").distinct().join(small, "hash").select("doc_id", "item_id").distinct()
    pairs = pairs.checkpoint()
    wanted = pairs.select(F.col("doc_id").alias("p_doc"), F.col("item_id").alias("p_item"))
    # first the document's candidate items, then their windows: a window that many
    # documents and items share meets no item that is no candidate
    asked = hits.join(wanted, hits["doc_id"].eqNullSafe(wanted["p_doc"])).drop("p_doc")
    known_items = broadcast_if_small(items.withColumnRenamed("hash", "i_hash"))
    matched = asked.join(known_items, (F.col("hash") == F.col("i_hash")) & F.col("p_item").eqNullSafe(F.col("item_id"))) \
        .drop("p_item", "i_hash").withColumn("shift", F.col("pos") - F.col("item_pos")).checkpoint()
    # one value of the item must stay one value of the document
    slots = matched.withColumn("s", F.explode(F.arrays_zip("item_slots", "slots"))) \
        .groupBy("doc_id", "item_id", "shift", F.col("s.item_slots").alias("v")) \
        .agg(F.min("s.slots").alias("lo"), F.max("s.slots").alias("hi"))
    odd = slots.groupBy("doc_id", "item_id", "shift").agg(
        F.max(F.col("lo") != F.col("hi")).alias("odd"), F.max((F.col("lo") != F.col("v"))).alias("other"))
    odd = odd.select(F.col("doc_id").alias("o_doc"), F.col("item_id").alias("o_item"), F.col("shift").alias("o_shift"),
                     "odd", "other")
    good = matched.join(odd, matched["doc_id"].eqNullSafe(odd["o_doc"]) & matched["item_id"].eqNullSafe(odd["o_item"]) &
                        (matched["shift"] == odd["o_shift"]), "left").where(~F.coalesce("odd", F.lit(False)))
    found = good.groupBy("doc_id", "item_id").agg(F.count_distinct("item_pos").alias("matched"),
                                                  F.max(F.coalesce("other", F.lit(False))).alias("reparameterised"))
    by_windows = found.join(size, found["item_id"].eqNullSafe(size["z_item"])) \
        .withColumn("coverage", F.col("matched") / F.col("n_windows")).where(F.col("coverage") >= coverage) \
        .select("doc_id", "item_id", "n_windows", "matched", "coverage", "reparameterised")
    return by_windows.unionByName(_whole_matches(docs, benchmark, items))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    bad = find_leaks(docs, benchmark, coverage).select(F.col("doc_id").alias("_id")).distinct().checkpoint()
    return docs.join(broadcast_if_small(bad), docs["doc_id"].eqNullSafe(bad["_id"]), "left_anti")
