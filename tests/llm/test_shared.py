"""Words, n-grams and edge cases that every operator shares."""

import pyarrow as pa
import pytest

from reelpath.llm import (decontam, html_extract, language, mixing, near_dup, ngram_lm, pii, token_orc, topk, toxicity)
from reelpath.llm.common import Words, gram_hashes, text_pieces, word_bytes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, score double, chunk long, size long, u double"
LABELS = "doc_id long, quality int, toxic int"


def words_of(texts):
    out = []
    for _, _, buf, offs in text_pieces(pa.array(texts), 16):
        w = Words(buf, offs, word_bytes())
        raw = buf.tobytes()
        for d in range(len(offs) - 1):
            out.append([raw[a:b].decode() for a, b in zip(w.starts[w.splits[d]:w.splits[d + 1]], w.ends[w.splits[d]:w.splits[d + 1]])])
    return out


def test_words_do_not_span_documents():
    assert words_of(["ab", "cd e", "", None, ".x.", "é1 Ü"]) == [["ab"], ["cd", "e"], [], [], ["x"], ["é1", "Ü"]]


def test_equal_words_hash_alike_and_grams_stay_inside():
    (_, _, buf, offs), = text_pieces(pa.array(["the cat the cat", "the", "cat the"]))
    w = Words(buf, offs, word_bytes())
    h = w.hashes()
    assert h[0] == h[2] == h[4] == h[6] and h[1] == h[3] == h[5] and h[0] != h[1]
    g, at = gram_hashes(h, w.docs(), 2)
    assert list(at) == [0, 1, 2, 5] and g[0] == g[2] and g[1] == g[3] and g[0] != g[1]
    assert w.hashes(length=2)[0] == w.hashes(length=2)[4]


def edge_docs(spark, empty=False):
    long = "word " * 60_000
    rows = [(1, None, "en", "a", None, 1, 0.5, 1, 1, 0.1), (2, "", "en", None, 0, 1, 0.5, 1, 1, 0.1),
            (3, "  \n\t", None, "a", 4, 1, 0.5, 1, 1, 0.1), (4, long, "en", "b", 1, 1, 0.5, 1, 1, 0.1),
            (5, "same text here for both of them", "de", "a", 1, 1, 0.5, 1, 1, 0.1),
            (5, "same text here for both of them", "de", "a", 1, 1, 0.5, 1, 1, 0.1),
            (None, "no id but a text +1 202 555 0100", "en", "a", 1, 1, 0.5, 1, 1, 0.1),
            (7, "日本 語 😀 ünïcode", "de", "b", 1, 1, 0.5, 1, 1, 0.1), (8, "### *** 123 !!!", "en", "b", 1, 1, 0.5, 1, 1, 0.1)]
    return spark.createDataFrame([] if empty else rows, DOCS)


@pytest.mark.parametrize("empty", [False, True])
def test_operators_take_odd_documents(spark, empty, tmp_path):
    docs = edge_docs(spark, empty)
    n = docs.count()
    labels = spark.createDataFrame([] if empty else [(4, 1, 1), (5, None, 0), (5, 1, None), (None, 1, 1), (7, 0, 0)], LABELS)
    bench = spark.createDataFrame([] if empty else [(1, None), (2, "four words are few"), (None, "same text here for both of them")],
                                  "item_id long, text string")
    tox = toxicity.score_documents(docs, labels).collect()
    assert len(tox) == n and all(0 <= r.score <= 1 for r in tox)
    lang = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    mix = mixing.decide(docs).collect()
    assert len(mix) == n
    lm = ngram_lm.score_documents(docs, chunk_bytes=1 << 16).collect()
    assert len(lm) == n
    found = pii.digest(pii.find_personal_data(docs)).collect()
    assert len(found) == n
    tokens = token_orc.tokens_round_trip(docs, str(tmp_path / f"orc{empty}")).collect()
    assert len(tokens) == n
    classes = near_dup.classes(docs).collect()
    leaks = decontam.find_leaks(docs, bench).collect()
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns and language.keep_identified(docs).columns == docs.columns
    assert decontam.drop_leaks(docs, bench).columns == docs.columns
    assert mixing.mix_documents(docs).columns == docs.columns
    if empty:
        assert not classes and not leaks and mixing.mix_documents(docs).count() == 0
        return
    assert lang[1] == lang[2] == lang[3] == lang[8] == ("und", 0.0) and lang[7][0] != "und"
    assert {r.doc_id: r.n_phone for r in found}[None] == 1
    assert {r.doc_id: r.n_tokens for r in tokens}[1] == 1
    assert {r.doc_id: r.class_id for r in classes} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 7: 7, 8: 8}
    assert {(r.doc_id, r.item_id) for r in leaks} == {(5, None)}
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == ["1", "3", "4", "5", "5", "7", "8", "None"]
    assert all(r.taken <= 2 * r.size for r in mix)


def test_pages_and_vectors_take_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", ""), (None, None, "<p>x"), (3, "u", "<script>never ends")],
                                  "page_id long, url string, html string")
    got = html_extract.extract(pages).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(pages.limit(0)).count() == 0
    nan, inf = float("nan"), float("inf")
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]),
                               (5, [1.0, 0.0]), (5, [0.5, 0.5]), (6, [1.0]), (7, [None, 1.0]), (8, [0.0, 0.0])],
                              "vec_id long, embedding array<float>")
    s = topk.scaled_vectors(v)
    got = topk.top_products(s, s.where("vec_id = 0"), 3).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(5, 4096), (5, 2048), (8, 0)]
    assert topk.top_products(s.limit(0), s.limit(0)).count() == 0
