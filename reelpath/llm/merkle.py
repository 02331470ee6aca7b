"""Merkle manifest of a data set in postorder append logs.

Every document is a leaf.  The leaves of one language, ascending by doc_id, form
a tree of arity 8; the roots of the languages, in code point order with the null
language first, form the tree above them.

Aligned builders.  A tree is cut into segments of ``SPAN`` = 8^4 consecutive
leaves, which are complete subtrees.  A builder takes one segment and appends
its nodes in the order of completion: leaves as they come, an inner node as soon
as its eighth child (or the last one) is there.  The segments' tops are the
leaves of the next stage, until one segment is left; a stage is a table of the
manifest, partitioned by Spark, and no builder holds more than one segment.

Closed-form positions.  In postorder the node ``i`` of level ``l`` that ends
with leaf ``e`` (``e = min((i + 1) 8^l, leaves)``) stands at
``e - 1 + sum_q floor((e - 1) / 8^q) + l``: the leaves and the subtrees completed
before it.  Logs hold digests of 32 bytes only, and a proof finds the siblings of
a node by these positions, without pointers or a search.

Proofs go from the top stage down: a segment hands each of its leaves, the
segments below, the siblings above them, and at the bottom each segment meets its
documents.  So a proof is assembled from one row per stage, and the upper
siblings are sent once per segment, not once per document.

Tables of a manifest, below one folder: ``leaves`` (tree, number, size, doc_id,
leaf, presented), ``log/stage=k`` and ``trees/stage=k`` (tree, segment, size, nodes).

Defined cases: null fields enter a leaf as ``-``, and an empty text as ``0:``; a
null doc_id comes first in its tree and counts as empty text for the tampering
share; rows that repeat a doc_id are leaves of their own, in the order of their
digests; a language with one document has that leaf as its root, a table with
one language that language's root; an empty table has no rows; other columns, also
those with names of the result, are not read.
"""

from __future__ import annotations

import hashlib
from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpath.operators.ranking import rank_within
from reelpath.session import checkpoint_root, scratch_path

ARITY = 8
#: levels of a segment, and its leaves
LEVELS = 4
SPAN = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LOG = "tree string, segment long, size long, nodes binary"
STEPS = "array<struct<left: string, right: string>>"


# ------------------------------------------------------------------ positions

def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    h, width = 0, leaves
    while width > 1:
        width, h = -(-width // ARITY), h + 1
    return h


def postorder(level: int, index: np.ndarray, leaves: int) -> np.ndarray:
    """Places of nodes ``index`` of ``level`` in the postorder of a tree."""
    end = np.minimum((np.asarray(index, np.int64) + 1) * ARITY ** level, leaves) - 1
    at, width = end + level, ARITY
    while width <= leaves:
        at = at + end // width
        width *= ARITY
    return at


def parent(children: str) -> str:
    """Digest of a node from its children's hex digests."""
    return hashlib.sha256(children.encode()).hexdigest()


def append_log(digests: list[bytes], levels: int) -> bytes:
    """All nodes over ``digests`` up to ``levels``, in completion order."""
    out = bytearray()
    runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def put(level: int, digest: bytes) -> None:
        out.extend(digest)
        if level < levels:
            runs[level].append(digest.hex())
            if len(runs[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        done = hashlib.sha256("".join(runs[level]).encode()).digest()
        runs[level].clear()
        put(level + 1, done)

    for d in digests:
        put(0, d)
    for level in range(levels):
        if runs[level]:
            close(level)
    return bytes(out)


def segment_levels(size: int) -> int:
    """Levels of a segment: those of the tree if it has one segment only."""
    return height(size) if size <= SPAN else LEVELS


class Segment:
    """Reads the siblings of a segment's leaves out of its log."""

    def __init__(self, nodes: bytes, segment: int, size: int):
        self.leaves = min(SPAN, size - segment * SPAN)
        self.levels = segment_levels(size)
        self.rows, width = [], self.leaves
        for level in range(self.levels):
            at = (postorder(level, np.arange(width), self.leaves) * 32).tolist()
            self.rows.append([nodes[a:a + 32].hex() for a in at])
            width = -(-width // ARITY)

    def siblings(self, leaf: int) -> list[tuple[str, str]]:
        """Per level, the digests left and right of the node above ``leaf``."""
        out = []
        for row in self.rows:
            lo = leaf - leaf % ARITY
            out.append(("".join(row[lo:leaf]), "".join(row[leaf + 1:lo + ARITY])))
            leaf //= ARITY
        return out


def fold(digest: str, steps: list[tuple[str, str]]) -> str:
    """The root that a digest and its siblings lead to."""
    for left, right in steps:
        digest = parent(left + digest + right)
    return digest


# ------------------------------------------------------------------ columns

def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hex digest of a document's fields, each with its byte count."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tree_key(lang: Column) -> Column:
    """A name for each language that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    upper = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
    return F.translate(text, upper, upper.lower())


# ------------------------------------------------------------------ building

def _build(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches).sort_by("number")
    size = table.column("size")[0].as_py()
    nodes = append_log([x.as_py() for x in table.column("digest")], segment_levels(size))
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.string()), pa.array([key[1].as_py()], pa.int64()),
         pa.array([size], pa.int64()), pa.array([nodes], pa.binary())], names=["tree", "segment", "size", "nodes"])


def write_log(leaves: DataFrame, path: str, largest: int) -> int:
    """Write all stages over ``leaves`` (tree, number from 0, size, digest);
    ``largest`` is the size of the largest tree.  Returns the number of stages."""
    spark, stage = leaves.sparkSession, 0
    while True:
        rows = leaves.select("tree", "number", "size", "digest", F.floor(F.col("number") / SPAN).cast("long").alias("segment"))
        rows.groupBy("tree", "segment").applyInArrow(_build, LOG).write.parquet(f"{path}/stage={stage}")
        if largest <= SPAN:
            return stage + 1
        done = read_stage(spark, path, stage).where(F.col("size") > SPAN)
        leaves = done.select("tree", F.col("segment").alias("number"), F.ceil(F.col("size") / SPAN).cast("long").alias("size"),
                             top("nodes").alias("digest"))
        largest, stage = -(-largest // SPAN), stage + 1


def read_stage(spark: SparkSession, path: str, stage: int) -> DataFrame:
    return spark.read.schema(LOG).parquet(f"{path}/stage={stage}")


def top(nodes: str) -> Column:
    """The last node of a log, the top of its segment."""
    return F.substring(F.col(nodes), -32, 32)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``number`` (from 0) of each row in its tree, and the tree's ``size``;
    a large tree is numbered by many tasks."""
    out = rank_within(rows, [tree], order, rank_col="number", size_col="size", ties="row")
    return out.withColumn("number", F.col("number") - 1)


def write_manifest(docs: DataFrame, path: str, presented: Column | None = None) -> dict[str, int]:
    """Write the manifest of ``docs`` below ``path``; returns the stages of the
    documents' logs and of the log over the trees.

    ``presented`` is the hex digest that is later shown for a document (null:
    the leaf itself)."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    leaf = leaf_digest({c: F.col(c) for c in FIELDS})
    shown = F.lit(None).cast("string") if presented is None else presented
    slim = docs.select(tree_key(F.col("lang")).alias("tree"), "doc_id", F.unhex(leaf).alias("leaf"),
                       F.unhex(shown).alias("presented")).checkpoint()
    numbered(slim, "tree", ["doc_id", "leaf"]).select("tree", "number", "size", "doc_id", "leaf", "presented") \
        .write.parquet(f"{path}/leaves")
    leaves = spark.read.parquet(f"{path}/leaves")
    largest = leaves.agg(F.max("size")).first()[0] or 0
    stages = write_log(leaves.withColumnRenamed("leaf", "digest"), f"{path}/log", largest)
    roots = tree_roots(spark, path, stages).withColumn("forest", F.lit("all"))
    over = numbered(roots, "forest", ["tree"])
    over.select("forest", "tree", "number", "size", "digest").write.parquet(f"{path}/roots")
    over = spark.read.parquet(f"{path}/roots").select(F.col("forest").alias("tree"), "number", "size", "digest")
    return {"log": stages, "trees": write_log(over, f"{path}/trees", over.agg(F.max("size")).first()[0] or 0)}


def tree_roots(spark: SparkSession, path: str, stages: int) -> DataFrame:
    """The root of each tree: the top of the one segment of its last stage."""
    out = None
    for stage in range(stages):
        one = read_stage(spark, f"{path}/log", stage).where(F.col("size") <= SPAN).select("tree", top("nodes").alias("digest"))
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------ proofs

def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's leaves with the siblings above each."""
    for b in batches:
        for r in b.to_pylist():
            seg = Segment(r["nodes"], r["segment"], r["size"])
            above = [(s["left"], s["right"]) for s in r["steps"]]
            steps = [[{"left": x, "right": y} for x, y in seg.siblings(i) + above] for i in range(seg.leaves)]
            n, first = len(steps), r["segment"] * SPAN
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["tree"]] * n, pa.string()), pa.array(range(first, first + n), pa.int64()),
                 pa.array(steps, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
                 pa.array([r["subroot"]] * n, pa.string()), pa.array([r["root"]] * n, pa.string())],
                names=["tree", "segment", "steps", "subroot", "root"])


CONTEXT = f"tree string, segment long, steps {STEPS}, subroot string, root string"


def hand_down(spark: SparkSession, path: str, stages: int, tops: DataFrame) -> DataFrame:
    """Segments of stage 0 with the siblings above them.  ``tops`` (tree, steps,
    subroot, root) says what stands above each tree."""
    context = None
    for stage in range(stages - 1, -1, -1):
        log = read_stage(spark, path, stage)
        last = log.where(F.col("size") <= SPAN).select("tree", "segment").join(tops, "tree")
        context = last if context is None else context.unionByName(last)
        if stage:
            rows = log.join(context, ["tree", "segment"])
            context = rows.select("tree", "segment", "size", "nodes", "steps", "subroot", "root") \
                .mapInArrow(_hand_down, CONTEXT).checkpoint()
    return context


def _verify(docs: pa.Table, logs: pa.Table) -> pa.Table:
    """The documents of one segment against its log and the siblings above."""
    leaves = [x.as_py().hex() for x in docs.column("leaf")]
    proofs, folded, subroot, root = [], [], "", ""
    for r in logs.to_pylist():                      # one row
        subroot, root = r["subroot"], r["root"]
        seg = Segment(r["nodes"], r["segment"], r["size"])
        above = [(s["left"], s["right"]) for s in r["steps"]]
        for number, leaf, shown in zip(docs.column("number").to_pylist(), leaves, docs.column("presented").to_pylist()):
            steps = seg.siblings(number - r["segment"] * SPAN) + above
            proofs.append(parent("".join([x + y for x, y in steps])))
            folded.append(fold(leaf if shown is None else shown.hex(), steps))
    n = len(proofs)
    return pa.table({"doc_id": docs.column("doc_id"), "leaf": pa.array(leaves, pa.string()),
                     "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                     "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})


def prove(spark: SparkSession, path: str, stages: dict[str, int]) -> DataFrame:
    """Per document of the manifest: doc_id, leaf, subroot, root, the digest of
    its siblings, the root folded from the presented digest, and ``verified``."""
    roots = spark.read.parquet(f"{path}/roots")
    whole = tree_roots_of_forest(spark, path, stages["trees"])
    top_rows = whole.select("tree", F.expr(f"cast(array() as {STEPS})").alias("steps"),
                            F.lit("").alias("subroot"), F.lower(F.hex("digest")).alias("root"))
    segments = hand_down(spark, f"{path}/trees", stages["trees"], top_rows)
    above = read_stage(spark, f"{path}/trees", 0).join(segments, ["tree", "segment"]) \
        .select("tree", "segment", "size", "nodes", "steps", "subroot", "root").mapInArrow(_hand_down, CONTEXT)
    tops = roots.join(above.select(F.col("segment").alias("number"), "steps", "root"), "number") \
        .select("tree", "steps", F.lower(F.hex("digest")).alias("subroot"), "root").checkpoint()
    context = hand_down(spark, f"{path}/log", stages["log"], tops)
    logs = read_stage(spark, f"{path}/log", 0).join(context, ["tree", "segment"]) \
        .select("tree", "segment", "size", "nodes", "steps", "subroot", "root")
    docs = spark.read.parquet(f"{path}/leaves") \
        .select("tree", F.floor(F.col("number") / SPAN).cast("long").alias("segment"), "number", "doc_id", "leaf", "presented")
    got = docs.groupBy("tree", "segment").cogroup(logs.groupBy("tree", "segment")).applyInArrow(
        _verify, f"doc_id {dict(docs.dtypes)['doc_id']}, leaf string, subroot string, root string, "
                 "proof_sha256 string, folded_root string")
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def tree_roots_of_forest(spark: SparkSession, path: str, stages: int) -> DataFrame:
    """The one root over all trees."""
    return read_stage(spark, f"{path}/trees", stages - 1).select("tree", top("nodes").alias("digest"))


def tampered_digest() -> Column:
    """The digest of a document whose text was lower-cased, for every third
    document by the crc32 of its id; null for the others and for null texts."""
    lowered = {c: F.col(c) for c in FIELDS} | {"text": lower_ascii(F.col("text"))}
    chosen = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    return F.when(chosen & F.col("text").isNotNull(), leaf_digest(lowered))


def audit(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the manifest of ``docs`` and prove every document against it,
    presenting a tampered text for every third one."""
    spark = docs.sparkSession
    where = path or scratch_path(spark, "merkle")
    return prove(spark, where, write_manifest(docs, where, tampered_digest()))
