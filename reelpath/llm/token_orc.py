"""Token ids in ORC: integer run-length encoding, row indexes, Bloom filters.

File format.  A data set is a folder of ORC files in ascending ``doc_id``
order: every file holds one contiguous range of ids, and part numbers follow
the ranges.  A row is (``doc_id`` long, ``file_start`` long, ``n_tokens`` long,
``ids`` array<int>): ``ids`` are the document's token ids followed by the end
id, ``file_start`` the number of ids in the file before the document.  ORC
stores the ids with its integer run-length encoding, writes a row index every
``ROW_INDEX_STRIDE`` rows and a Bloom filter on ``doc_id``; a read of some
documents prunes files, stripes and row groups from that metadata, and a full
read splits at stripes.

Texts are range-partitioned by ``doc_id`` before they are encoded, so the ids
themselves never pass a shuffle.  Encoding cuts a text at single spaces between
two other characters: byte-level BPE always starts a new pre-token there, so a
piece (one word, its leading space included) has the same ids alone and within
the text.  Pieces are looked up in a bounded table per worker and only new pieces
go to the tokenizer.  A piece is found by its hash and then compared byte by
byte, with the table's copy and with the piece that stands for it; a document
with a piece of which only the hash agrees is encoded whole.  So are texts with other
white space next to a space, or white space beyond ASCII.

Defined cases: a null or empty text has the end id alone; rows that repeat a
``doc_id`` are separate rows, ordered by their text's hash; a null ``doc_id``
comes first; an empty table writes a data set without rows, and reads back as
none; further columns are not written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelpath.llm.common import Words, small_batches, text_pieces, tidy
from reelpath.session import scratch_path

END_ID = 0
ROW_INDEX_STRIDE = 1_000
STRIPE_BYTES = 16 << 20
BLOOM_FPP = 0.01
#: pieces remembered per Python worker, and their bytes
TABLE_PIECES = 500_000
TABLE_BYTES = 32 << 20
#: bytes of text that are encoded at a time
PIECE_BYTES = 1 << 20
#: new pieces given to the tokenizer at a time
LEARN_PIECES = 4_000

#: name of the encoder among what a worker keeps between tasks
HELD = "encoder"

SCHEMA = "doc_id long, file_start long, n_tokens long, ids array<int>"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def space_table() -> np.ndarray:
    t = np.ones(256, bool)
    t[32] = False
    return t


def odd_documents(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Documents in which a space stands at an end or beside other white space,
    or which have white space beyond ASCII; these are encoded whole."""
    n = len(buf)
    space = buf == 32
    white = ((buf >= 9) & (buf <= 13)) | ((buf >= 28) & (buf <= 31)) | space
    bad = np.zeros(n + 1, bool)
    if n > 1:
        bad[1:n] = (space[1:] & white[:-1]) | (white[1:] & space[:-1])
    filled = offs[:-1] < offs[1:]
    bad[offs[:-1][filled]] = space[offs[:-1][filled]]
    bad[offs[1:][filled] - 1] |= space[offs[1:][filled] - 1]
    for at in np.flatnonzero((buf == 0xC2) | (buf == 0xE1) | (buf == 0xE2) | (buf == 0xE3)):
        if bytes(buf[at:at + 2]) in (b"\xc2\x85", b"\xc2\xa0") or bytes(buf[at:at + 3]).decode(errors="replace").isspace():
            bad[at] = True
    return np.unique(np.searchsorted(offs, np.flatnonzero(bad), side="right") - 1)


def same_bytes(a: np.ndarray, a_starts: np.ndarray, a_lens: np.ndarray, b: np.ndarray, b_starts: np.ndarray,
               b_lens: np.ndarray) -> np.ndarray:
    """Whether each range of ``a`` holds the same bytes as its range of ``b``."""
    out = a_lens == b_lens
    if not out.all():
        out[out] = same_bytes(a, a_starts[out], a_lens[out], b, b_starts[out], b_lens[out])
        return out
    if len(out):
        ends = np.cumsum(b_lens)
        step = np.arange(int(ends[-1]), dtype=np.int64)
        differ = a[np.repeat(a_starts - (ends - b_lens), b_lens) + step] != b[np.repeat(b_starts - (ends - b_lens), b_lens) + step]
        if differ.any():
            out[np.searchsorted(ends, np.flatnonzero(differ), side="right")] = False
    return out


class PieceEncoder:
    """Encodes texts piece by piece with a table of known pieces.

    Pieces are found and told apart by hash in numpy; the tokenizer sees each
    new piece once, many joined into one text: a piece has one space, its first
    character, so its tokens start at the token that begins with a space."""

    def __init__(self, tokenizer, table_pieces: int = TABLE_PIECES):
        self.tokenizer, self.limit = tokenizer, table_pieces
        self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        vocabulary = tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for v, i in vocabulary.items() if v.startswith("\u0120")]] = True     # its sign for a space
        self.table = space_table()
        self.reset()

    def reset(self) -> None:
        """Forget all pieces.  The table is two sorted arrays (hash, place), and
        the ids and the bytes by place; it takes about 60 bytes a piece."""
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.bytes, self.byte_ends = np.zeros(1 << 16, np.uint8), np.zeros(1 << 14, np.int64)
        self.used = self.count = self.held = 0

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 for new ones."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.place[at], -1).astype(np.int64)

    def add(self, keys: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> None:
        n, total = self.count, len(ids)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(keys) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used:self.used + total] = ids
        self.ends[n + 1:n + 1 + len(keys)] = self.used + np.cumsum(lens)
        self.used += total
        self.count += len(keys)

    def remember(self, pieces: list[bytes]) -> None:
        """Keep the bytes of the pieces that are added next, in their order."""
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        total = int(lens.sum())
        while self.held + total > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)])
        while self.count + len(pieces) + 1 > len(self.byte_ends):
            self.byte_ends = np.concatenate([self.byte_ends, np.zeros_like(self.byte_ends)])
        self.bytes[self.held:self.held + total] = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_ends[self.count + 1:self.count + 1 + len(pieces)] = self.held + np.cumsum(lens)
        self.held += total

    def known(self, places: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the bytes of each piece are those of its place in the table."""
        lo = self.byte_ends[places]
        return same_bytes(self.bytes, lo, self.byte_ends[places + 1] - lo, buf, starts, ends - starts)

    def learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        """Encode new pieces (``keys`` sorted) and put them into the table."""
        first = self.count
        alone = [k for k, p in enumerate(pieces) if p[:1] != b" " or p[-1:].isspace()]
        for lo in range(0, len(alone), LEARN_PIECES):
            part = alone[lo:lo + LEARN_PIECES]
            coded = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[k].decode() for k in part],
                                                                     add_special_tokens=False)]
            self.remember([pieces[k] for k in part])
            self.add(keys[part], np.array([i for ids in coded for i in ids], np.int32),
                     np.fromiter(map(len, coded), np.int64, len(coded)))
        left = np.ones(len(pieces), bool)
        left[alone] = False
        joined = np.flatnonzero(left)
        for lo in range(0, len(joined), LEARN_PIECES):
            part = joined[lo:lo + LEARN_PIECES]
            text = b"".join([pieces[k] for k in part.tolist()]).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            starts = np.flatnonzero(self.opens[ids])
            self.remember([pieces[k] for k in part.tolist()])
            self.add(keys[part], ids, np.diff(np.append(starts, len(ids))))
        fresh = np.concatenate([keys[alone], keys[joined]])
        every = np.concatenate([self.keys, fresh])
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.place = np.concatenate([self.place, np.arange(first, self.count, dtype=np.int32)])[order]

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per document) of a text piece (see ``text_pieces``)."""
        raw = buf.tobytes()
        whole = set(odd_documents(buf, offs).tolist())
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                whole.add(int(np.searchsorted(offs, at, side="right")) - 1)
                at = raw.find(s, at + 1)
        w = Words(buf, offs, self.table)
        docs = w.docs()
        spaced = w.starts > offs[docs]
        starts, ends = w.starts - spaced, w.ends
        keys = w.hashes() * np.uint64(2) + spaced.astype(np.uint64)
        if whole:
            keep = ~np.isin(docs, list(whole))
            docs, starts, ends, keys = docs[keep], starts[keep], ends[keep], keys[keep]
        distinct, first, inv = np.unique(keys, return_index=True, return_inverse=True)
        at = self.places(distinct)
        new = np.flatnonzero(at < 0)
        size = int((ends - starts)[first[new]].sum())
        if self.count + len(new) > self.limit or self.held + size > TABLE_BYTES:
            self.reset()
            at[:], new = -1, np.arange(len(distinct))
        old = np.flatnonzero(at >= 0)
        agrees = np.ones(len(distinct), bool)
        agrees[old] = self.known(at[old], buf, starts[first[old]], ends[first[old]])
        if len(new):
            lo, hi = starts[first[new]].tolist(), ends[first[new]].tolist()
            self.learn(distinct[new], [raw[a:b] for a, b in zip(lo, hi)])
            at[new] = self.places(distinct[new])
        # every piece is compared with the one that stands for its key
        good = agrees[inv] & same_bytes(buf, starts[first][inv], (ends - starts)[first][inv], buf, starts, ends - starts)
        if not good.all():
            whole.update(docs[~good].tolist())
            keep = ~np.isin(docs, list(whole))
            docs, inv = docs[keep], inv[keep]
        lo = self.ends[at][inv]
        lens = self.ends[at + 1][inv] - lo
        out_at = np.cumsum(lens) - lens
        ids = self.flat[np.repeat(lo - out_at, lens) + np.arange(int(lens.sum()))]
        per = np.bincount(docs, weights=lens, minlength=len(offs) - 1).astype(np.int64)
        if whole:
            parts = np.split(ids, np.cumsum(per)[:-1])
            for d in whole:
                if d < len(parts):
                    text = raw[offs[d]:offs[d + 1]].decode()
                    parts[d] = np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            per = np.fromiter(map(len, parts), np.int64, len(parts))
            ids = np.concatenate(parts)
        return ids, per


def worker_encoder(tokenizer_path: str) -> PieceEncoder:
    """The encoder of this Python worker: the tasks it runs one after another
    share the tokenizer and the table of known pieces."""
    import os
    import sys
    import types

    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"           # Spark runs one task per core
    held = sys.modules.setdefault("_reelpath_worker", types.ModuleType("_reelpath_worker")).__dict__
    path, one = held.get(HELD, ("", None))
    if path != tokenizer_path:
        one = PieceEncoder(Tokenizer.from_file(tokenizer_path))
        held[HELD] = tokenizer_path, one
    return one


def encoder(tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(tokenizer_path)
        start = 0
        for b in batches:
            for lo, hi, buf, offs in text_pieces(b.column("text"), PIECE_BYTES):
                ids, per = enc.encode(buf, offs)
                # the end id goes after each document's ids
                ids = np.insert(ids, np.cumsum(per), end_id).astype(np.int32)
                per = per + 1
                ends = np.concatenate([[0], np.cumsum(per)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), pa.array(start + ends[:-1]), pa.array(per),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))],
                    names=["doc_id", "file_start", "n_tokens", "ids"])
                start += int(ends[-1])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID,
                 partitions: int | None = None) -> str:
    """Encode every document and write the ORC data set to ``path``."""
    keys = ["doc_id", "_hash"]
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    # by both keys, so that an id of very many rows spans many files
    spread = slim.repartitionByRange(partitions, *keys) if partitions else slim.repartitionByRange(*keys)
    ordered = spread.sortWithinPartitions(*keys).select("doc_id", "text")
    coded = ordered.mapInArrow(tidy(encoder(tokenizer_path or default_tokenizer(), end_id), HELD), SCHEMA)
    with small_batches(docs.sparkSession):
        coded.write.mode("overwrite").option("orc.bloom.filter.columns", "doc_id") \
            .option("orc.bloom.filter.fpp", BLOOM_FPP).option("orc.row.index.stride", ROW_INDEX_STRIDE) \
            .option("orc.stripe.size", STRIPE_BYTES).option("orc.compress", "ZSTD").orc(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The data set with ``start``, the ids of all documents before a row.

    Only per-file totals are summed globally; a row adds its ``file_start``."""
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("_file", F.col("_metadata.file_name"))
    files = rows.groupBy("_file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("lo"))
    before = Window.orderBy(F.col("lo").asc_nulls_first(), "_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select(F.col("_file").alias("_f"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), F.col("_file") == F.col("_f")) \
        .select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids")


def ids_digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian uint32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        for b in batches:
            ids = b.column("ids")
            offs = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().astype("<u4").tobytes()
            crc = [zlib.crc32(flat[4 * lo:4 * hi]) for lo, hi in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"),
                                              pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return rows.select("doc_id", "start", "n_tokens", "ids") \
        .mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_round_trip(docs: DataFrame, path: str | None = None, tokenizer_path: str | None = None) -> DataFrame:
    """Write ``docs`` to ORC, read the files back and digest every document."""
    spark = docs.sparkSession
    where = write_tokens(docs, path or scratch_path(spark, "token-orc"), tokenizer_path)
    return ids_digest(read_tokens(spark, where))
