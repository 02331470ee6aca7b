"""The ORC data set: exact ids whatever the hashes do, and what its footers hold."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelpath.llm import token_orc
from reelpath.llm.common import Words, text_pieces


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(token_orc.default_tokenizer())


def encoded(tokenizer, texts, piece=1 << 21, **options):
    enc = token_orc.PieceEncoder(tokenizer, **options)
    out = []
    for _, _, buf, offs in text_pieces(pa.array(texts), piece):
        ids, per = enc.encode(buf, offs)
        out += [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])]
    return out


def plain(tokenizer, texts):
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_blocks_in_another_order_are_other_pieces(tokenizer):
    a, b = ("".join(random.Random(k).choices("abcdefgh", k=1024)) for k in (1, 2))
    texts = [f"x {a}{b} y", f"x {b}{a} y", f"{a}{b}", f"{b}{a} {a}{b}"]
    assert encoded(tokenizer, texts) == plain(tokenizer, texts)
    assert encoded(tokenizer, texts, piece=1) == plain(tokenizer, texts)


@pytest.mark.parametrize("piece", [1, 40, 1 << 21])
@pytest.mark.parametrize("values", [1, 3, 50])
def test_ids_are_exact_under_any_hash(tokenizer, monkeypatch, piece, values):
    """With hashes of a few values most pieces collide, in a batch and in the table."""
    hashes = Words.hashes
    monkeypatch.setattr(Words, "hashes", lambda self, *a, **k: hashes(self, *a, **k) % np.uint64(values))
    rnd = random.Random(7)
    texts = [" ".join(rnd.choices(["one", "two", "Three", "four,", "fünf", "日本", "six\n", "<|endoftext|>", "x" * 30], k=rnd.randint(0, 12)))
             for _ in range(60)]
    assert encoded(tokenizer, texts, piece) == plain(tokenizer, texts)


def test_a_full_table_starts_anew(tokenizer, monkeypatch):
    rnd = random.Random(8)
    texts = [" ".join("".join(rnd.choices("abcdef", k=rnd.randint(1, 9))) for _ in range(40)) for _ in range(50)]
    assert encoded(tokenizer, texts, 200, table_pieces=60) == plain(tokenizer, texts)
    monkeypatch.setattr(token_orc, "TABLE_BYTES", 300)
    assert encoded(tokenizer, texts, 200) == plain(tokenizer, texts)


def footers(spark, folder):
    """(file, stripe footer, row index stride) through the ORC reader."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in sorted(os.listdir(folder)):
        if not name.startswith("part-"):
            continue
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        reader = jvm.org.apache.orc.OrcFile.createReader(path, jvm.org.apache.orc.OrcFile.readerOptions(conf))
        rows = reader.rows()
        for stripe in reader.getStripes():
            yield name, rows.readStripeFooter(stripe), reader.getRowIndexStride()
        rows.close()


def test_footers_hold_run_lengths_row_indexes_and_bloom_filters(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_orc, "STRIPE_BYTES", 100_000)
    docs = spark.range(24_000).select((F.col("id") * 3).alias("doc_id"), F.concat(
        F.lit("word and "), F.col("id").cast("string"), F.md5(F.col("id").cast("string"))).alias("text"))
    folder = str(tmp_path / "orc")
    token_orc.write_tokens(docs, folder, partitions=3)
    found = list(footers(spark, folder))
    assert len({f[0] for f in found}) == 3 and len(found) > 3               # several stripes a file
    for _, footer, stride in found:
        assert stride == token_orc.ROW_INDEX_STRIDE
        streams = [(s.getColumn(), str(s.getKind())) for s in footer.getStreamsList()]
        kinds = [str(c.getKind()) for c in footer.getColumnsList()]
        # columns: 0 row, 1 doc_id, 2 file_start, 3 n_tokens, 4 the list, 5 the ids
        assert (1, "BLOOM_FILTER_UTF8") in streams and {c for c, k in streams if k == "ROW_INDEX"} == set(range(6))
        assert kinds[1:6] == ["DIRECT_V2"] * 5                                # run lengths, second version
    back = token_orc.read_tokens(spark, folder)
    assert back.count() == 24_000
    one = spark.read.schema(token_orc.SCHEMA).orc(folder).where("doc_id = 9000")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,9000)]" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1
    # ids between two ids of the data: the Bloom filter leaves no row group to read
    for doc_id, most in ((9000, 1000), (9001, 0)):
        read = spark.read.schema(token_orc.SCHEMA).orc(folder).where(f"doc_id = {doc_id}").select("doc_id")
        scan = read._jdf.queryExecution().executedPlan()
        read_rows = scan.collectLeaves().head().metrics().apply("numOutputRows")
        scan.executeCollect()
        assert read_rows.value() <= most
