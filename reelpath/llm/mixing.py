"""Mixing sources to target weights: Pareto order sampling.

Each source gets a target number of words.  A document's expected copies are
its source's target over its source's size: the whole part is allocated for
certain, the fraction ``p`` is the inclusion probability of one more copy.
Documents are ranked by Pareto's ratio ``(u / (1 - u)) / (p / (1 - p))`` with
``u`` a fixed uniform number drawn from the document id and the seed, and the
ranks are taken from the front until the source's words are used up.  The
sample has a fixed size in words: the prefix whose total lies nearest to what
the whole copies left open, with one document more or fewer where its size
closes the remaining gap better.

No group is gathered: the cut in the ranking is found from sums per (source,
cell of ``u``), first over 4096 cells of the ratio's order, then over 4096
cells within the cell that holds the cut; only the documents of that last cell
(a 2^-24 share of a source) are ordered one by one.  Within a source the ratio
rises with ``u``, so the order of ``u`` is the order of the ratio.

Defined cases: a null text has size 0; documents of size 0 are taken 0 times
(``taken`` 0, no copies); a null source is a source of its own and comes last;
rows that repeat a ``doc_id`` are sampled as separate rows in the order of
(u, doc_id, size) and ties beyond that share the same decision cell by row
number; an empty table gives an empty result; other columns pass through
:func:`mix_documents` untouched, and the operator's own columns replace
columns of the same name only in the slim decision table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpath.session import checkpoint_root

#: fixed values of the contract: weights by source order, total share, cap
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_COPIES = 2.0

#: sources whose rules may be broadcast
MAX_RULES = 100_000
#: cells per level of the search for the cut in the ranking
CELLS = 4096


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) on a grid of 2^-48, fixed by id and seed."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
            max_copies: float = MAX_COPIES) -> DataFrame:
    """Rows (source, source_size) -> (source, source_size, target).

    Weights repeat over the sources in code point order, null last.  Sharing
    the total by weight, capping and resharing the excess until nothing is
    above its cap ends at one level ``c`` with ``target = min(cap, c * weight)``:
    capped are the sources with the smallest cap per weight, so ``c`` follows
    from running sums in that order."""
    key = F.col("source").cast("binary")          # UTF-8 order is code point order
    order = Window.orderBy(F.col("source").isNull(), key)
    n = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.cast("long").alias("w"), n.alias("n"))
    s = s.withColumn("ratio", F.col("source_size") / F.col("w"))
    ranked = Window.orderBy("ratio", "n")
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    upto = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("capped", F.coalesce(F.sum("source_size").over(before), F.lit(0))) \
         .withColumn("open_w", F.sum("w").over(upto)) \
         .withColumn("total", F.sum("source_size").over(everything))
    level = (F.lit(float(total_share)) * F.col("total") - F.lit(float(max_copies)) * F.col("capped")) / F.col("open_w")
    s = s.withColumn("level", level)
    # the first source, in this order, that stays within its cap sets the level
    fits = F.col("level") <= F.lit(float(max_copies)) * F.col("source_size") / F.col("w")
    s = s.withColumn("level", F.min(F.when(fits, F.struct("ratio", "n", "level"))).over(everything)["level"])
    cap = F.lit(float(max_copies)) * F.col("source_size")
    target = F.when(F.col("level").isNull(), cap).otherwise(F.least(cap, F.col("level") * F.col("w")))
    return s.select("source", "source_size", target.cast("double").alias("target"))


def decide(docs: DataFrame, seed: int = 17, weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
           max_copies: float = MAX_COPIES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Reads the texts once; everything after works on the slim checkpointed
    table of ids, sources and sizes."""
    both = _decided(docs, seed, weights, total_share, max_copies)
    n = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0).cast("long")
    return both.select("doc_id", "source", "size", "source_size", "target", n.alias("copies"),
                       (n * F.col("size")).alias("taken"))


def _decided(docs: DataFrame, seed: int = 17, weights: tuple = WEIGHTS, total_share: float = TOTAL_SHARE,
             max_copies: float = MAX_COPIES) -> DataFrame:
    """:func:`decide` before the copies are summed: u, whole, extra, moved."""
    checkpoint_root(docs.sparkSession)
    slim = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       uniform(F.col("doc_id"), seed).alias("u")).checkpoint()
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, total_share, max_copies).checkpoint()
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = goal.select(F.col("source").alias("g_source"), "source_size", "target", copies.alias("whole")) \
        .withColumn("open", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    same = slim["source"].eqNullSafe(plan["g_source"])
    d = slim.join(F.broadcast(plan), same).drop("g_source") if goal.count() <= MAX_RULES else \
        slim.join(plan, same).drop("g_source")
    cell = F.floor(F.col("u") * CELLS).cast("int")
    fine = F.floor((F.col("u") * CELLS - cell) * CELLS).cast("int")
    d = d.withColumn("cell", cell).withColumn("fine", fine)

    def boundary(rows: DataFrame, level: str, keep: list[str]) -> DataFrame:
        """Per source the first cell whose running words pass ``left``."""
        sums = rows.groupBy("source", level).agg(F.sum("size").alias("words"), *[F.first(k).alias(k) for k in keep])
        w = Window.partitionBy("source").orderBy(level)
        sums = sums.withColumn("upto", F.sum("words").over(w)).where(F.col("upto") > F.col("left"))
        first = F.min(F.struct(level, (F.col("left") - (F.col("upto") - F.col("words"))).alias("rest")))
        return sums.groupBy("source").agg(first.alias("b")) \
            .select(F.col("source").alias("b_source"), F.col(f"b.{level}").alias(f"b_{level}"),
                    F.col("b.rest").alias(f"rest_{level}"))

    b1 = boundary(d.withColumn("left", F.col("open")), "cell", ["left"])
    d = d.join(b1, d["source"].eqNullSafe(b1["b_source"]), "left").drop("b_source")
    inside = d.where(F.col("cell") == F.col("b_cell")).withColumn("left", F.col("rest_cell"))
    b2 = boundary(inside, "fine", ["left"])
    d = d.join(b2, d["source"].eqNullSafe(b2["b_source"]), "left").drop("b_source")
    before = F.col("b_cell").isNull() | (F.col("cell") < F.col("b_cell")) | \
        ((F.col("cell") == F.col("b_cell")) & (F.col("b_fine").isNull() | (F.col("fine") < F.col("b_fine"))))
    at_cut = (F.col("cell") == F.col("b_cell")) & (F.col("fine") == F.col("b_fine"))
    has_open = (F.col("open") > 0) & (F.col("size") > 0)
    sure = d.where(~F.coalesce(at_cut, F.lit(False))).withColumn("extra", (before & has_open).cast("int"))
    w = Window.partitionBy("source").orderBy("u", "doc_id", "size")
    # within the last cell: a document is in while that brings the words nearer
    upto = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = d.where(at_cut).withColumn("upto", upto)
    nearer = (F.col("upto") - F.col("size") / 2.0) <= F.col("rest_fine")
    cut = cut.withColumn("extra", (nearer & has_open).cast("int")).drop("upto")
    both = sure.unionByName(cut).select("doc_id", "source", "size", "u", "source_size", "target", "whole", "extra",
                                        has_open.alias("has_open")).checkpoint()
    return _close_gap(both)


def _close_gap(d: DataFrame) -> DataFrame:
    """Per source, one document more or one fewer where that brings the words
    nearer to the target: the one whose size is nearest to the gap.  Rows equal
    in id and size count as one document here."""
    words = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0) * F.col("size")
    gaps = d.groupBy("source").agg((F.first("target") - F.sum(words)).alias("gap"))
    g = gaps.select(F.col("source").alias("g_source"), "gap")
    with_gap = d.join(g, d["source"].eqNullSafe(g["g_source"])).drop("g_source")
    movable = F.col("has_open") & (F.col("extra") == F.when(F.col("gap") > 0, 0).otherwise(1))
    off = F.abs(F.abs(F.col("gap")) - F.col("size"))
    best = with_gap.where(movable & (off < F.abs(F.col("gap")))).groupBy("source") \
        .agg(F.min(F.struct(off.alias("off"), "u", "doc_id", "size")).alias("b")) \
        .select(F.col("source").alias("b_source"), "b")
    out = with_gap.join(best, with_gap["source"].eqNullSafe(best["b_source"]), "left")
    moved = movable & (F.col("u") == F.col("b.u")) & F.col("doc_id").eqNullSafe(F.col("b.doc_id")) & \
        (F.col("size") == F.col("b.size"))
    extra = F.when(F.col("moved"), 1 - F.col("extra")).otherwise(F.col("extra"))
    return out.withColumn("moved", F.coalesce(moved, F.lit(False))).withColumn("extra", extra).drop("b_source", "b", "gap")


def rules_by_source(decided: DataFrame) -> DataFrame:
    """What ``decided`` (see :func:`decide`) amounts to per source: whole copies,
    the last place (u, doc_id, size) with one copy more, and the one place that
    was moved to close the gap.  As exact as the rows where no id repeats."""
    place = F.struct("u", "doc_id", "size")
    taken = F.when(F.col("moved"), 1 - F.col("extra")).otherwise(F.col("extra")) == 1
    return decided.groupBy(F.col("source").alias("_mix_of")).agg(
        F.max("whole").alias("_mix_whole"), F.max(F.when(taken, place)).alias("_mix_cut"),
        F.max(F.when(F.col("moved"), place)).alias("_mix_moved"))


def _mix_by_rules(docs: DataFrame, decided: DataFrame, seed: int) -> DataFrame:
    """The mix without a shuffle of the texts: a row follows from its own id,
    size and source and its source's rule."""
    rules = rules_by_source(decided).checkpoint()
    n = rules.count()
    rows = docs.withColumn("_mix_size", word_count(F.col("text"))) \
        .withColumn("_mix_place", F.struct(uniform(F.col("doc_id"), seed).alias("u"), F.col("doc_id").alias("doc_id"),
                                           F.col("_mix_size").alias("size")))
    got = rows.join(F.broadcast(rules) if n <= MAX_RULES else rules, rows["source"].eqNullSafe(rules["_mix_of"]))
    prefix = F.coalesce(F.col("_mix_place") <= F.col("_mix_cut"), F.lit(False))
    moved = F.coalesce(F.col("_mix_place") == F.col("_mix_moved"), F.lit(False))
    copies = F.when(F.col("_mix_size") > 0, F.col("_mix_whole") + (prefix != moved).cast("int")).otherwise(0)
    return got.withColumn("_mix_copies", copies.cast("int")).where("_mix_copies > 0") \
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)


def mix_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it.

    Where no id repeats, every row decides by itself from its source's rule.
    Otherwise rows that share a ``doc_id`` are matched to their decisions by their
    rank among the rows of that id, so repeated rows stay separate."""
    repeated = docs.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    if not repeated:
        return _mix_by_rules(docs, _decided(docs, seed, **options), seed)
    of_id = Window.partitionBy("doc_id", "_mix_size").orderBy("_mix_source")
    rows = docs.withColumn("_mix_size", word_count(F.col("text"))).withColumn("_mix_source", F.col("source"))
    rows = rows.withColumn("_mix_n", F.row_number().over(of_id))
    chosen = decide(docs, seed, **options).where("copies > 0").withColumn(
        "_mix_m", F.row_number().over(Window.partitionBy("doc_id", "size").orderBy("source")))
    chosen = chosen.select(F.col("doc_id").alias("_mix_id"), F.col("size").alias("_mix_words"), F.col("source").alias("_mix_of"),
                           F.col("copies").alias("_mix_copies"), "_mix_m")
    match = rows["doc_id"].eqNullSafe(chosen["_mix_id"]) & (rows["_mix_size"] == chosen["_mix_words"]) & \
        rows["_mix_source"].eqNullSafe(chosen["_mix_of"]) & (rows["_mix_n"] == chosen["_mix_m"])
    return rows.join(chosen, match).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))) \
        .select(*docs.columns)
