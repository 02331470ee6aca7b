"""Helpers shared by the corpus operators.

Texts reach numpy as one byte buffer per Arrow batch.  ``Words`` cuts such a
buffer into words without a Python loop over words: a word is a maximal run of
ASCII letters and digits or bytes of non-ASCII characters, and never spans two
documents.  Hashes are 64-bit multilinear sums over byte positions, so the hash
of any prefix of a word comes from the same running sum.
"""

from __future__ import annotations

import contextlib
from typing import Callable, Iterator, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a side with at most this many rows may be broadcast; larger sides are shuffled
BROADCAST_ROWS = 2_000_000
#: bytes of text that numpy handles at a time (one longer document is one piece)
PIECE_BYTES = 1 << 21


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def broadcast_if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint when its counted rows stay under
    ``BROADCAST_ROWS``; otherwise unchanged, and Spark shuffles."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


@contextlib.contextmanager
def small_batches(spark: SparkSession, records: int = 1_000) -> Iterator[None]:
    """Arrow batches of at most ``records`` rows for the jobs that run inside:
    rows of long texts and packed sets are held several times, by the JVM and by
    the worker, while a batch is on its way."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= records:
        yield
        return
    spark.conf.set(key, str(records))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tidy(run: Callable, keep: str = "") -> Callable:
    """``run`` over batches, as a task that begins without what another
    operator's tasks kept in the reused worker (all but ``keep``), and gives
    freed memory back to the system when it ends."""
    def give_back() -> None:
        import ctypes
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):             # not every system's allocator has it
            pass

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sys
        held = sys.modules.get("_reelpath_worker")
        if held is not None:
            for name in [k for k in vars(held) if not k.startswith("__") and k != keep]:
                delattr(held, name)
        give_back()
        yield from run(batches)
        give_back()
    return task


def text_pieces(col: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a string array; nulls are empty."""
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(o, o[lo] + piece_bytes, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[o[lo]:o[hi]], o[lo:hi + 1] - o[lo]
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(n + 1)) * step)


def word_bytes(digits: bool = True) -> np.ndarray:
    """Table byte -> is part of a word."""
    t = np.zeros(256, bool)
    t[ord("a"):ord("z") + 1] = t[ord("A"):ord("Z") + 1] = True
    t[128:] = True
    if digits:
        t[ord("0"):ord("9") + 1] = True
    return t


class Words:
    """Word starts, ends and per-document ranges of one text piece.

    ``splits[d]:splits[d + 1]`` are the words of document ``d``."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        inside = table[buf]
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            heads = offsets[:-1][offsets[:-1] < n]
            first[heads] = inside[heads]
            tails = offsets[1:][offsets[1:] > 0] - 1
            last[tails] = inside[tails]
        self.inside, self.first = inside, first
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.splits = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.splits)

    def docs(self) -> np.ndarray:
        """Document index of each word."""
        return np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)

    def running(self) -> np.ndarray:
        """Running sums from which the hash of any word or word prefix follows."""
        n = len(self.buf)
        if not len(self.starts):
            return np.zeros(n + 1, np.uint64)
        order = np.cumsum(self.first, dtype=np.int32) - 1
        at = np.arange(n, dtype=np.int32) - self.starts.astype(np.int32)[order]
        part = uniform_words(1024, 7)[at & 1023]
        far = np.flatnonzero(at >= 1024)            # later places get multipliers of their own
        if len(far):
            part[far] = mix64(part[far] + (at[far] >> 10).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        part *= self.buf.astype(np.uint64) + np.uint64(1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(part, out=out[1:])
        return out

    def hashes(self, running: np.ndarray | None = None, length: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first ``length`` bytes."""
        s = self.running() if running is None else running
        ends = self.ends if length is None else np.minimum(self.starts + length, self.ends)
        h = s[ends] - s[self.starts]
        return mix64(h + (ends - self.starts).astype(np.uint64))


def gram_hashes(h: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of its first word) of each run of ``n`` words that lies
    within one document."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(docs[:m] == docs[n - 1:])
    out = h[at].copy()
    for k in range(1, n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += h[at + k]
    return mix64(out + np.uint64(n)), at


def sum_blocks(partial: DataFrame, keys: list[str]) -> DataFrame:
    """Add up packed int64 count blocks: rows (keys..., cells) to one per key.

    Every block has the same fixed length, so a group is folded block by block
    in the memory of two blocks."""
    names = list(keys)
    schema = ", ".join(f"{k} {dict(partial.dtypes)[k]}" for k in keys) + ", cells binary"

    def fold(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for cell in b.column("cells"):
                one = np.frombuffer(cell.as_buffer(), np.int64)
                total = one.copy() if total is None else np.add(total, one, out=total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k.as_py()], type=k.type) for k in key] + [pa.array([total.tobytes()], pa.binary())],
            names=[*names, "cells"])

    return partial.groupBy(*keys).applyInArrow(fold, schema)
