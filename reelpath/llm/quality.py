"""Quality rules and perplexity bands of a modified Kneser-Ney model.

Rules (fixed): a document fails with fewer than 20 words, or when more than 30 %
of its words stand in windows of 8 words that occur twice or more in it.

Model.  Per language, an n-gram model of the bytes of words: a word is predicted
byte by byte and then its end, each from the ``ORDER - 1`` symbols before it in
the word.  Symbols take 9 bits (256 bytes, end, start), so an n-gram is packed
into one whole number without loss.  Spark counts the n-grams over all documents
(each task sums its own first), takes continuation counts order by order, and
computes discounts (D1, D2, D3+ from the counts of counts), context weights and
interpolated probabilities as joins per order.  The result is two tables of
(order-tagged n-gram, value), stored as arrays sorted by the n-gram's hash, a
bijection of the packed number, so two n-grams never meet.

Scores.  A task scores each distinct word of a piece once, by binary search in
the arrays, backing off from the longest order.  The arrays are broadcast while
the model has at most ``MODEL_ENTRIES`` entries; a larger model stays a table,
and the distinct words' n-grams are joined with it (:func:`_joined_scores`).

Bands.  A document's value is its mean negative log probability per symbol.
Per language, quartiles over the documents that pass the rules give a lower and
an upper bound, ``FENCE`` quartile distances out; short texts get a slack that
falls with the root of their symbols.  Outside the band a document is rejected:
above, it reads like no text of its language, below, like one phrase repeated.

Words of the rules and of the model are runs of bytes other than ASCII white space.

Defined cases: a null text counts as empty, has no words and fails; a null
language is a language of its own; rows that repeat a doc_id each get a row; a
document of a language that only it has is judged by itself and kept if it passes
the rules; an empty table gives no rows; other columns, also those with names of
the result, are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpath.llm.common import Words, gram_hashes, mix64, text_pieces
from reelpath.session import checkpoint_root

# Fixed values of the contract
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"

ORDER = 5
BITS = 9
END, START = 256, 257
#: entries (n-grams and contexts of all orders and languages) that may be broadcast, 12 bytes each
MODEL_ENTRIES = 6_000_000
#: n-grams a task sums up before it hands them on
FLUSH_GRAMS = 1_000_000
#: bytes of one long text that are looked at together
BLOCK_BYTES = 1 << 21
FENCE = 3.0
#: nats per symbol that a text of one symbol may lie outside its band
SLACK = 8.0
MIN_SPREAD = 0.02
ACCURACY = 10_000

_RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _table(without: list[int]) -> np.ndarray:
    t = np.ones(256, bool)
    t[without] = False
    return t


WORD_BYTES = _table([9, 10, 11, 12, 13, 32])
LINE_BYTES = _table([10])


def lang_key(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))


# ------------------------------------------------------------------ pieces

def _blocks(buf: np.ndarray, offs: np.ndarray, block: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(offset, bytes, document offsets): the piece itself, or a single long
    text cut before white space into blocks (a longer word is one block)."""
    if len(offs) > 2 or len(buf) <= block:
        yield 0, buf, offs
        return
    lo, n = 0, len(buf)
    while lo < n:
        hi = min(lo + block, n)
        while hi < n and WORD_BYTES[buf[hi]]:
            step = buf[hi:hi + block]
            white = np.flatnonzero(~WORD_BYTES[step])
            hi += int(white[0]) if len(white) else len(step)
        yield lo, buf[lo:hi], np.array([0, hi - lo])
        lo = hi


def _per_doc(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    upto = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=upto[1:])
    return upto[offs[1:]] - upto[offs[:-1]]


def repeated_words(h: np.ndarray, docs: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document, the words in windows that occur twice or more in it."""
    g, at = gram_hashes(h, docs, WINDOW)
    if not len(g):
        return np.zeros(n_docs, np.int64)
    own = mix64(g + docs[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    step = np.zeros(len(h) + 1, np.int32)
    np.add.at(step, at[twice], 1)
    np.subtract.at(step, at[twice] + WINDOW, 1)
    return np.bincount(docs, weights=np.cumsum(step)[:-1] > 0, minlength=n_docs).astype(np.int64)


def repeated_lines(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per document, lines with a word that equal an earlier line of it."""
    n_docs = len(offs) - 1
    if n_docs == 1 and len(buf) > BLOCK_BYTES:
        lines = [x for x in buf.tobytes().split(b"\n") if x.translate(None, b"\t\x0b\x0c\r ")]
        return np.array([len(lines) - len(set(lines))])
    w = Words(buf, offs, LINE_BYTES)
    upto = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(WORD_BYTES[buf], out=upto[1:])
    filled = upto[w.ends] > upto[w.starts]
    docs = w.docs()[filled].astype(np.int64)
    h = w.hashes()[filled]
    order = np.lexsort((h, docs))
    same = (h[order][1:] == h[order][:-1]) & (docs[order][1:] == docs[order][:-1])
    return np.bincount(docs[order][1:][same], minlength=n_docs)


def _word_list(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of one example, occurrences, index per word) of distinct words."""
    _, first, inv, n = np.unique(w.hashes(), return_index=True, return_inverse=True, return_counts=True)
    return first, n, inv


def word_symbols(w: Words, which: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the chosen words, each after ``order - 1`` starts and before
    an end; the places that are predicted, and the word of each of them."""
    size = w.ends[which] - w.starts[which]
    total = size + order
    ends = np.cumsum(total)
    begins = ends - total
    out = np.full(int(ends[-1]) if len(ends) else 0, START, np.int64)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begins + order - 1, size) + inner] = w.buf[np.repeat(w.starts[which], size) + inner]
    out[ends - 1] = END
    at = np.flatnonzero(out != START)
    return out, at, np.repeat(np.arange(len(which)), size + 1)


def packed(symbols: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The n-gram of ``order`` symbols that ends at each place."""
    g = np.zeros(len(at), np.int64)
    for k in range(order - 1, -1, -1):
        g = (g << BITS) | symbols[at - k]
    return g


# ------------------------------------------------------------------ counting

def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                g, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(inv, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)],
                                                 names=["lang", "gram", "n"])
            held.clear()

        for b in batches:
            langs = b.column("lang").dictionary_encode()
            code, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                for _, part, cut in _blocks(buf, offs, BLOCK_BYTES):
                    w = Words(part, cut, WORD_BYTES)
                    of = code[lo:hi][w.docs()] if len(cut) > 2 else np.full(len(w.starts), code[lo])
                    h = w.hashes()
                    for c in np.unique(of):
                        mine = np.flatnonzero(of == c)
                        _, first, n = np.unique(h[mine], return_index=True, return_counts=True)
                        symbols, at, word = word_symbols(w, mine[first], order)
                        g, inv = np.unique(packed(symbols, at, order), return_inverse=True)
                        held.setdefault(names[c], []).append((g, np.bincount(inv, weights=n[word])))
                        waiting += len(g)
                    if waiting > FLUSH_GRAMS:
                        yield from flush()
                        waiting = 0
        yield from flush()
    return run


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): how often each n-gram of the highest order occurs."""
    rows = docs.select(lang_key(F.col("lang")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    part = rows.mapInArrow(_count(order), "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ the model

def _low(order: int) -> Column:
    """The last ``order`` symbols of a gram."""
    return F.col("gram").bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def discounts(counts: DataFrame) -> DataFrame:
    """D1, D2 and D3+ per language from the counts of counts; where these are
    too few (a zero among them, or an estimate outside 0..k), 0.5, 1 and 1.5."""
    n = [F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in range(1, 5)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    raw = [F.lit(float(k)) - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
    cols = [F.when((r > 0) & (r <= k), r).otherwise(F.lit(0.5 * k)).alias(f"d{k}") for k, r in zip((1, 2, 3), raw)]
    return counts.groupBy("lang").agg(*n).select("lang", *cols)


def model_tables(top: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Interpolated modified Kneser-Ney as (lang, key, value) tables.

    First the log probabilities of n-grams, second the log weights of contexts;
    a key is the packed n-gram with its order above bit 56."""
    checkpoint_root(top.sparkSession)
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        higher = levels[k + 1]
        # n-grams that begin a word have no symbol before them: their counts stay counts
        begins = F.shiftright(_low(k), BITS * (k - 1)) == START
        levels[k] = higher.select("lang", _low(k).alias("gram"), F.when(begins, F.col("n")).otherwise(F.lit(1)).alias("n")) \
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).checkpoint()
    logp = back = lower = None
    for k in range(1, order + 1):
        counts = levels[k].withColumn("context", F.shiftright("gram", BITS)).join(discounts(levels[k]), "lang")
        kinds = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") >= 3)]
        left = sum((F.first(f"d{i + 1}") * c for i, c in enumerate(kinds)), F.lit(0.0))
        weights = counts.groupBy("lang", "context").agg(F.sum("n").alias("total"), left.alias("open")) \
            .withColumn("weight", F.col("open") / F.col("total"))
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        p = counts.join(weights, ["lang", "context"]).select(
            "lang", "gram", _low(k - 1).alias("suffix"), (F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total")).alias("own"),
            "weight")
        if lower is None:
            p = p.withColumn("below", F.lit(1.0 / 257))
        else:
            p = p.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
        lower = p.select("lang", "gram", (F.col("own") + F.col("weight") * F.col("below")).alias("p")).checkpoint()
        tag = F.lit(k << 56)
        one = lower.select("lang", F.col("gram").bitwiseOR(tag).alias("key"), F.log("p").alias("value"))
        two = weights.select("lang", F.col("context").bitwiseOR(tag).alias("key"), F.log("weight").alias("value"))
        logp = one if logp is None else logp.unionByName(one)
        back = two if back is None else back.unionByName(two)
    return logp, back.checkpoint()


def hashed(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    return mix64(keys.astype(np.uint64))


def sorted_arrays(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language (hashes ascending, values) of a (lang, key, value) table."""
    got = table.select("lang", "key", F.col("value").cast("float").alias("value")).toArrow()
    langs = got.column("lang").combine_chunks().dictionary_encode()
    if isinstance(langs, pa.ChunkedArray):
        langs = langs.combine_chunks()
    code, keys, values = langs.indices.to_numpy(), hashed(got.column("key").to_numpy()), got.column("value").to_numpy()
    out = {}
    for c, lang in enumerate(langs.dictionary.to_pylist()):
        h, v = keys[code == c], values[code == c]
        order = np.argsort(h)
        out[lang] = (h[order], v[order])
    return out


def find(arrays: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, value) of each key."""
    at, values = arrays
    if not len(at):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
    h = hashed(keys)
    place = np.minimum(np.searchsorted(at, h), len(at) - 1)
    return at[place] == h, values[place]


def log_probabilities(grams: np.ndarray, logp, back, order: int) -> np.ndarray:
    """Log probability of the last symbol of each gram of ``order`` symbols."""
    out = np.zeros(len(grams))
    open_ = np.arange(len(grams))
    for k in range(order, 0, -1):
        g = grams[open_] & ((1 << (BITS * k)) - 1)
        ok, value = find(logp, g | (k << 56))
        out[open_[ok]] += value[ok]
        open_, g = open_[~ok], g[~ok]
        if not len(open_):
            return out
        known, weight = find(back, (g >> BITS) | (k << 56))
        out[open_[known]] += weight[known]
    out[open_] -= np.log(257)
    return out


# ------------------------------------------------------------------ measuring

def _measure(logp: dict, back: dict, order: int):
    nothing = (np.zeros(0, np.uint64), np.zeros(0, np.float32))
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("lang").dictionary_encode()
            code, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
            for lo, hi, buf, offs in text_pieces(b.column("text")):
                n = hi - lo
                words, chars, signs, sum_log, n_sym = (np.zeros(n, t) for t in (np.int64, np.int64, np.int64, float, np.int64))
                hashes, owners = [], []
                for _, part, cut in _blocks(buf, offs, BLOCK_BYTES):
                    w = Words(part, cut, WORD_BYTES)
                    docs, h = w.docs(), w.hashes()
                    words += w.counts
                    chars += _per_doc(WORD_BYTES[part] & ((part & 0xC0) != 0x80), cut)
                    signs += _per_doc(symbol[part], cut)
                    hashes.append(h), owners.append(docs)
                    of = code[lo:hi][docs]
                    for c in np.unique(of):
                        mine = np.flatnonzero(of == c)
                        _, first, inv = np.unique(h[mine], return_index=True, return_inverse=True)
                        symbols, at, word = word_symbols(w, mine[first], order)
                        each = log_probabilities(packed(symbols, at, order), logp.get(names[c], nothing),
                                                 back.get(names[c], nothing), order)
                        score = np.bincount(word, weights=each, minlength=len(first))
                        sum_log += np.bincount(docs[mine], weights=score[inv], minlength=n)
                        n_sym += np.bincount(docs[mine], weights=(w.ends - w.starts)[mine] + 1, minlength=n).astype(np.int64)
                h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
                docs = np.concatenate(owners) if owners else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, n), b.column("lang").slice(lo, n), pa.array(words), pa.array(chars),
                     pa.array(signs), pa.array(repeated_lines(buf, offs).astype(np.int64)),
                     pa.array(repeated_words(h, docs, n)), pa.array(n_sym), pa.array(sum_log)],
                    names=["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "n_predicted", "log_p"])
    return run


def _word_rows(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(row, lang, word, n) of the distinct words of each row."""
    langs = b.column("lang").to_pylist()
    for lo, hi, buf, offs in text_pieces(b.column("text")):
        raw = buf.tobytes()
        for d in range(hi - lo):
            found: dict[bytes, int] = {}
            for x in raw[offs[d]:offs[d + 1]].translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" "):
                if x:
                    found[x] = found.get(x, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column("row")[lo + d].as_py()] * len(found), pa.int64()), pa.array([langs[lo + d]] * len(found), pa.string()),
                 pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["row", "lang", "word", "n"])


def _gram_rows(order: int):
    """(lang, word, place, k, key, context) of every order at every place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.ones(256, bool)
        for b in batches:
            for lo, hi, buf, offs in text_pieces(b.column("word").cast(pa.string(), safe=False)
                                                 if pa.types.is_string(b.column("word").type) else b.column("word")):
                w = Words(buf, offs, whole)
                symbols, at, word = word_symbols(w, np.arange(hi - lo), order)
                grams = packed(symbols, at, order)
                place = np.arange(len(at))
                for k in range(order, 0, -1):
                    g = grams & ((1 << (BITS * k)) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("lang").take(pa.array(lo + word)), b.column("word").take(pa.array(lo + word)), pa.array(place),
                         pa.array(np.full(len(at), k, np.int32)), pa.array(g | (k << 56)), pa.array((g >> BITS) | (k << 56))],
                        names=["lang", "word", "place", "k", "key", "context"])
    return run


def _joined_scores(rows: DataFrame, logp: DataFrame, back: DataFrame, order: int) -> DataFrame:
    """(row, log_p) by joins, for models too large to broadcast: distinct words
    give their n-grams of every order, these meet the tables by (lang, key), and
    a place takes its longest known n-gram and the weights of longer contexts."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _word_rows(b)

    words = rows.mapInArrow(split, "row long, lang string, word binary, n long")
    grams = words.select("lang", "word").distinct().mapInArrow(
        _gram_rows(order), "lang string, word binary, place long, k int, key long, context long")
    found = grams.join(logp.withColumnRenamed("value", "logp"), ["lang", "key"], "left") \
        .join(back.select("lang", F.col("key").alias("context"), F.col("value").alias("weight")), ["lang", "context"], "left")
    best = found.groupBy("lang", "word", "place").agg(
        F.max(F.when(F.col("logp").isNotNull(), F.struct("k", "logp"))).alias("best"),
        F.collect_list(F.struct("k", F.coalesce("weight", F.lit(0.0)).alias("weight"))).alias("weights"))   # one per order
    lost = F.aggregate(F.filter("weights", lambda x: F.col("best").isNull() | (x["k"] > F.col("best.k"))), F.lit(0.0),
                       lambda acc, x: acc + x["weight"])
    each = best.select("lang", "word", (F.coalesce("best.logp", F.lit(-float(np.log(257)))) + lost).alias("p"))
    scores = each.groupBy("lang", "word").agg(F.sum("p").alias("p"))
    return words.join(scores, ["lang", "word"]).groupBy("row").agg(F.sum(F.col("n") * F.col("p")).alias("log_p"))


def measure(docs: DataFrame, order: int = ORDER, model_entries: int | None = None) -> DataFrame:
    """doc_id, lang (key), the rules' counts, n_predicted and log_p per row."""
    checkpoint_root(docs.sparkSession)
    logp, back = model_tables(gram_counts(docs, order).checkpoint(), order)
    rows = docs.select("doc_id", lang_key(F.col("lang")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, lang string, {_RULES}, n_predicted long, log_p double"
    if logp.count() + back.count() <= (MODEL_ENTRIES if model_entries is None else model_entries):
        return rows.mapInArrow(_measure(sorted_arrays(logp), sorted_arrays(back), order), schema)
    kept = rows.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    base = kept.select(F.col("row").alias("doc_id"), "lang", "text").mapInArrow(
        _measure({}, {}, order), schema.replace(f"doc_id {dict(rows.dtypes)['doc_id']}", "doc_id long")) \
        .withColumnRenamed("doc_id", "row").drop("log_p", "lang")
    scores = _joined_scores(kept.select("row", "lang", "text"), logp, back, order)
    return kept.select("row", "doc_id", "lang").join(base, "row").join(scores, "row", "left") \
        .withColumn("log_p", F.coalesce("log_p", F.lit(0.0))).drop("row")


def bands(measured: DataFrame) -> DataFrame:
    """(lang, low, high) from the documents that pass the rules."""
    q = F.percentile_approx("loss", [0.25, 0.75], ACCURACY)
    quarters = measured.where(~F.col("base_failed")).groupBy("lang").agg(q.alias("q"))
    spread = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(MIN_SPREAD))
    return quarters.select("lang", (F.col("q")[0] - FENCE * spread).alias("low"), (F.col("q")[1] + FENCE * spread).alias("high"))


def judge(docs: DataFrame, order: int = ORDER, model_entries: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, the rules' counts, base_failed, perplexity,
    the bounds on the mean loss (low, high) and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    loss = F.when(F.col("n_predicted") > 0, -F.col("log_p") / F.col("n_predicted"))
    rows = measure(docs, order, model_entries).withColumn("base_failed", failed).withColumn("loss", loss).checkpoint()
    judged = rows.join(bands(rows), "lang", "left")
    slack = SLACK / F.sqrt(F.greatest(F.col("n_predicted"), F.lit(1)))
    inside = F.col("loss").between(F.col("low") - slack, F.col("high") + slack)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
                         F.exp("loss").alias("perplexity"), "low", "high")
