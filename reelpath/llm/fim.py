"""Fill-in-middle transformation over Roaring-style boundary sets.

A text is cut into units (white space and the word after it, or white space at
the end), and two draws pick the units after which prefix and middle end.  The
offsets at which units end, in code points, and 0 form the document's boundary
set: ``select(k)`` is the end of the k-th unit, and both cuts are selections.

The set is held as Roaring bitmaps are: offsets are split by their upper 16
bits into containers, and a container is an array of the lower halves, a bitmap
of 2^16 bits or a list of runs, whichever is smallest.  Cumulative cardinalities
over the containers make ``select`` a binary search for the container and a
local select within it (array: index; bitmap: search in the running popcounts,
then in one word; runs: search in the running lengths).  A set never takes more
than 8 KB per 65,536 code points, and is filled block by block, so a very long
text costs no array of its own length.

``units="char"`` makes every code point a unit (one run per container).

Output: plain, the text; psm, ``<P>prefix<S>suffix<M>middle``; spm,
``<S>suffix<P>prefix<M>middle``.  :func:`restored` gives the text back from
output and form.

One pass over the texts, without a shuffle.

Defined cases: a null text counts as empty; empty texts and texts that contain
a sentinel are plain; a null doc_id draws as the text ``null``; rows that repeat
a doc_id are cut by the same draws, each in its own text; an empty table gives
no rows; other columns, also those with names of the result, are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpath.llm.common import text_pieces

# Fixed values of the contract: seed, shares in percent, sentinels
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: an array container holds at most so many offsets before a bitmap is smaller
ARRAY_LIMIT = 4096
#: bytes of one long text that are looked at together
BLOCK_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


class BoundarySet:
    """A growing sorted set of offsets in containers of 2^16."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.containers: list[tuple] = []
        self.upto: list[int] = [0]                  # cardinality before each container
        self._open: list[np.ndarray] = []

    def add(self, offsets: np.ndarray) -> None:
        """Take ``offsets``, ascending and above all earlier ones."""
        if not len(offsets):
            return
        keys = offsets >> 16
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for part in np.split(offsets, cuts) if len(cuts) else [offsets]:
            if self._open and int(self._open[0][0]) >> 16 != int(part[0]) >> 16:
                self._close()
            self._open.append(part)

    def _close(self) -> None:
        if not self._open:
            return
        every = np.concatenate(self._open) if len(self._open) > 1 else self._open[0]
        self._open = []
        low = (every & 0xFFFF).astype(np.uint16)
        self.keys.append(int(every[0]) >> 16)
        self.containers.append(self._pack(low))
        self.upto.append(self.upto[-1] + len(low))

    @staticmethod
    def _pack(low: np.ndarray) -> tuple:
        """The smallest container for the lower halves ``low``."""
        breaks = np.flatnonzero(np.diff(low.astype(np.int32)) != 1) + 1
        if 4 * (len(breaks) + 1) < min(2 * len(low), 8192):
            first = np.concatenate([[0], breaks])
            return "run", low[first], first.astype(np.int32)    # a run's start, and the offsets before it
        if len(low) <= ARRAY_LIMIT:
            return "array", low
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        before = np.zeros(len(words) + 1, np.int32)
        np.cumsum(bits.reshape(-1, 64).sum(1, dtype=np.int32), out=before[1:])
        return "bitmap", words, before

    def __len__(self) -> int:
        self._close()
        return self.upto[-1]

    def kinds(self) -> list[str]:
        self._close()
        return [c[0] for c in self.containers]

    def nbytes(self) -> int:
        self._close()
        return sum(a.nbytes for c in self.containers for a in c[1:])

    def select(self, k: int) -> int:
        """The ``k``-th offset, from 0."""
        self._close()
        if not 0 <= k < self.upto[-1]:
            raise IndexError(k)
        at = bisect_right(self.upto, k) - 1
        k -= self.upto[at]
        kind, *parts = self.containers[at]
        if kind == "array":
            low = int(parts[0][k])
        elif kind == "run":
            run = int(np.searchsorted(parts[1], k, side="right")) - 1
            low = int(parts[0][run]) + k - int(parts[1][run])
        else:
            word = int(np.searchsorted(parts[1], k, side="right")) - 1
            bits = int(parts[0][word])
            for _ in range(k - int(parts[1][word])):
                bits &= bits - 1
            low = 64 * word + (bits & -bits).bit_length() - 1
        return (self.keys[at] << 16) | low


def unit_ends(buf: np.ndarray, ends: np.ndarray, lo: int, hi: int, chars: bool) -> np.ndarray:
    """Byte offsets in (lo, hi] at which units end; ``ends`` are document ends."""
    part = buf[lo:hi]
    follows = np.ones(hi - lo, bool)                # whether the next byte cannot go on with the unit
    if chars:
        follows[:-1] = (part[1:] & 0xC0) != 0x80
        if hi < len(buf):
            follows[-1] = (buf[hi] & 0xC0) != 0x80
        return np.flatnonzero(follows) + lo + 1
    white = WHITE[part]
    follows[:-1] = white[1:]
    if hi < len(buf):
        follows[-1] = WHITE[buf[hi]]
    closes = ends[(ends > lo) & (ends <= hi)] - lo - 1
    follows[closes] = True
    done = follows & ~white
    done[closes] = True
    return np.flatnonzero(done) + lo + 1


def code_points(part: np.ndarray) -> np.ndarray:
    """Code points that begin before each byte offset of ``part``."""
    out = np.zeros(len(part) + 1, np.int64)
    np.cumsum((part & 0xC0) != 0x80, out=out[1:])
    return out


class Cutter:
    """Unit counts, boundary sets and byte places of the documents of a piece."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, chars: bool = False):
        self.buf, self.offs, self.chars = buf, offs, chars
        self.long = len(offs) == 2 and len(buf) > BLOCK_BYTES
        if self.long:
            self.set = BoundarySet()
            self.set.add(np.zeros(1, np.int64))
            self.starts = [0]                       # code points before each block
            for lo in range(0, len(buf), BLOCK_BYTES):
                hi = min(lo + BLOCK_BYTES, len(buf))
                upto = code_points(buf[lo:hi])
                self.set.add(upto[unit_ends(buf, offs[1:], lo, hi, chars) - lo] + self.starts[-1])
                self.starts.append(self.starts[-1] + int(upto[-1]))
            self.n = np.array([len(self.set) - 1])
        else:
            self.upto = code_points(buf)
            self.ends = unit_ends(buf, offs[1:][offs[:-1] < offs[1:]], 0, len(buf), chars) if len(buf) else np.zeros(0, np.int64)
            self.splits = np.searchsorted(self.ends, offs, side="right")
            self.n = np.diff(self.splits)

    def boundaries(self, d: int) -> BoundarySet:
        if self.long:
            return self.set
        out = BoundarySet()
        out.add(np.concatenate([[0], self.upto[self.ends[self.splits[d]:self.splits[d + 1]]] - self.upto[self.offs[d]]]))
        return out

    def byte_of(self, d: int, offset: int) -> int:
        """Byte offset in the piece of code point ``offset`` of document ``d``."""
        if not self.long:
            return int(np.searchsorted(self.upto, self.upto[self.offs[d]] + offset, side="right")) - 1
        block = min(bisect_right(self.starts, offset) - 1, len(self.starts) - 2)
        lo = block * BLOCK_BYTES
        upto = code_points(self.buf[lo:lo + BLOCK_BYTES])
        return lo + int(np.searchsorted(upto, offset - self.starts[block], side="right")) - 1


def marked(raw: bytes, offs: np.ndarray, sentinels: list[bytes]) -> set[int]:
    """Documents of a piece that contain a sentinel."""
    out = set()
    for s in sentinels:
        at = raw.find(s)
        while at >= 0:
            d = int(np.searchsorted(offs, at, side="right")) - 1
            if at + len(s) <= offs[d + 1]:
                out.add(d)
            at = raw.find(s, at + 1)
    return out


def cut(units: str, fim_percent: int, spm_percent: int, sentinels: tuple[str, str, str]):
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [b.column(f"h{k}").to_numpy() for k in range(1, 5)]
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                cutter = Cutter(buf, offs, units == "char")
                raw = buf.tobytes()
                whole = marked(raw, offs, [p, s, m])
                forms, prefixes, middles, out = [], [], [], []
                for d in range(hi - lo):
                    a, z, n, row = int(offs[d]), int(offs[d + 1]), int(cutter.n[d]), lo + d
                    if not n or d in whole or h[2][row] % 100 >= fim_percent:
                        forms.append("plain"), prefixes.append(None), middles.append(None), out.append(raw[a:z])
                        continue
                    first, second = sorted((int(h[0][row]) % (n + 1), int(h[1][row]) % (n + 1)))
                    ends = cutter.boundaries(d)
                    x, y = ends.select(first), ends.select(second)
                    i, j = cutter.byte_of(d, x), cutter.byte_of(d, y)
                    prefixes.append(x), middles.append(y - x)
                    if h[3][row] % 100 < spm_percent:
                        forms.append("spm")
                        out.append(b"".join([s, raw[j:z], p, raw[a:i], m, raw[i:j]]))
                    else:
                        forms.append("psm")
                        out.append(b"".join([p, raw[a:i], s, raw[j:z], m, raw[i:j]]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(cutter.n, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
              sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), units: str = "token") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row."""
    if units not in ("token", "char"):
        raise ValueError(f"unknown units {units}")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), drawn.alias("_h"))
    parts = [F.conv(F.substring("_h", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    return rows.select("doc_id", "text", *parts).mapInArrow(
        cut(units, fim_percent, spm_percent, sentinels), f"doc_id {dict(rows.dtypes)['doc_id']}, {SCHEMA}")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``output`` was made from.  Its parts hold no sentinel, so
    the three sentinels of a cut output are the only ones."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels))
    first, second, third = parts[1], parts[2], parts[3]      # the part before the first sentinel is empty
    return F.when(form == "psm", F.concat(first, third, second)) \
        .when(form == "spm", F.concat(second, third, first)).otherwise(output)
