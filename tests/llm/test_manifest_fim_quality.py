"""Merkle manifest, quality bands and fill-in-middle against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_operators import same_as_sql

from reelpath.llm import fim, merkle, quality
from reelpath.llm.common import Words, read_table
from reelpath.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WHITE = "\x20\x09-\x0d"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, n long, number long, size long, row int"


def odd_docs(spark, empty=False):
    line = "one line that comes back with more than eight words in it"
    rows = [(1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \n\t ", None, "a", 4), (4, "word " * 60_000, "en", "b", 1),
            (5, "Same Text here", "de", "a", 1), (5, "Same Text here", "de", "a", 1), (5, "Other text", "de", "a", 1),
            (None, "no id at all", "en", "a", 1), (7, "日本 語 😀 ünï code ", "ja", "b", 1), (8, "a <M> b", "en", "b", 1),
            (9, f"{line}\n{line}\n\n{line} \nsome other words", "en", "b", 1), (10, "x" * 3000 + " y", "", "b", 1),
            (11, "<P", "en", "b", 2)]
    rows += [(100 + i, " ".join(random.Random(i).choices("alpha beta gamma, delta. Épsilon zeta\n".split(" "), k=30)), "en", "c", i)
             for i in range(40)]
    return spark.createDataFrame([] if empty else [(*r, "x", 0, 0, 0, 0) for r in rows], DOCS)


# -- 13 fill in middle

@pytest.mark.parametrize("density", [0.01, 0.3, 1.0])
def test_select_equals_a_sorted_list(density):
    rng = np.random.default_rng(int(density * 100))
    every = np.flatnonzero(rng.random(300_000) < density).astype(np.int64)
    ends = fim.BoundarySet()
    for part in np.array_split(every, 7):
        ends.add(part)
    assert len(ends) == len(every)
    assert all(ends.select(int(k)) == every[k] for k in rng.integers(0, len(every), 400))
    assert ends.select(len(every) - 1) == every[-1] and ends.select(0) == every[0]
    assert set(ends.kinds()) == {{0.01: "array", 0.3: "bitmap", 1.0: "run"}[density]}
    assert ends.nbytes() <= len(ends.kinds()) * (8192 + 4 * 1025)
    with pytest.raises(IndexError):
        ends.select(len(every))


def plain_cut(doc_id, text, units=rf"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+"):
    text = text or ""
    parts = re.findall(units, text, re.S)
    h = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(parts)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (parts[:i], parts[i:j], parts[j:]))
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("units", ["token", "char"])
def test_cuts_equal_brute_force_and_give_the_text_back(spark, units, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK_BYTES", 1000)
    long = "".join(random.Random(3).choices(["ä", "word", " ", "\n ", "😀", "x", "日本 "], k=40_000))
    docs = odd_docs(spark).select("doc_id", "text", "n").unionByName(
        spark.createDataFrame([(i, long[i:], 0) for i in range(500, 512)] + [(i, "ab cd " * 700_000, 0) for i in range(512, 516)],
                              "doc_id long, text string, n long"))
    rows = fim.transform(docs, units=units)
    got = rows.withColumn("text", fim.restored(rows.output, rows.form)).collect()
    pattern = {"pattern": "."} if units == "char" else {}
    want = collections.Counter((r.doc_id, *plain_cut(r.doc_id, r.text, *pattern.values()), r.text or "") for r in docs.collect())
    assert collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in got) == want
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_fim_takes_an_empty_table(spark):
    assert fim.transform(odd_docs(spark, True)).count() == 0


def test_fim_equals_sql(spark):
    same_as_sql(spark, "op13_fim")


# -- 11 Merkle manifest

@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 513, 700])
def test_positions_and_log_follow_the_order_of_completion(leaves):
    order = []

    def walk(level, index):
        if level:
            width = -(-leaves // 8 ** (level - 1))
            for child in range(8 * index, min(8 * index + 8, width)):
                walk(level - 1, child)
        order.append((level, index))

    top = merkle.height(leaves)
    walk(top, 0)
    assert [int(merkle.postorder(level, np.array([index]), leaves)[0]) for level, index in order] == list(range(len(order)))
    digests = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(leaves)]
    log = merkle.append_log(digests, top)
    assert len(log) == 32 * len(order)
    nodes = {}
    for k, (level, index) in enumerate(order):
        nodes[level, index] = log[32 * k:32 * k + 32]
        if level:
            children = [nodes[level - 1, c].hex() for c in range(8 * index, 8 * index + 8) if (level - 1, c) in nodes]
            assert nodes[level, index] == hashlib.sha256("".join(children).encode()).digest()


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(hashes):
    """(root, siblings per leaf and level) by the definition."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for leaf, i in enumerate(at):
            lo = i - i % 8
            paths[leaf].append(("".join(level[lo:i]), "".join(level[i + 1:lo + 8])))
        level = [H("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
        at = [i // 8 for i in at]
    return level[0], paths


def plain_manifest(rows):
    def leaf(r, text):
        values = [r.doc_id, r.source, r.lang, r.n_chars, text]
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = collections.defaultdict(list)
    for r in rows:
        mine = leaf(r, r.text)
        crc = zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode())
        shown = leaf(r, r.text.translate(lower)) if crc % 3 == 0 and r.text is not None else mine
        trees[r.lang].append((r.doc_id is not None, r.doc_id or 0, mine, shown, r.doc_id))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    below = {}
    for x in langs:
        trees[x].sort(key=lambda t: t[:3])
        below[x] = plain_tree([t[2] for t in trees[x]])
    root, above = plain_tree([below[x][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        subroot, paths = below[x]
        for t, path in zip(trees[x], paths):
            steps = path + above[k]
            folded = t[3]
            for left, right in steps:
                folded = H(left + folded + right)
            out.append((t[4], t[2], subroot, root, H("".join(a + b for a, b in steps)), folded, folded == root))
    return collections.Counter(out)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_equals_brute_force_over_any_number_of_stages(spark, levels, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "SPAN", 8 ** levels)
    for docs in (odd_docs(spark), read_table(spark, SF, "documents")) if levels == 1 else (odd_docs(spark),):
        got = merkle.audit(docs)
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        rows = collections.Counter(tuple(r) for r in got.collect())
        assert rows == plain_manifest(docs.collect())
    assert {r[-1] for r in rows} == {True, False}


def test_manifest_of_many_trees_one_document_and_none(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "SPAN", 8)
    some = odd_docs(spark).drop("lang").selectExpr("*", "cast(doc_id % 11 as string) as lang")
    assert collections.Counter(tuple(r) for r in merkle.audit(some).collect()) == plain_manifest(some.collect())
    one = some.where("doc_id = 2")
    (r,) = merkle.audit(one).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == H("")
    assert merkle.audit(odd_docs(spark, True)).count() == 0


def test_manifest_equals_sql(spark):
    same_as_sql(spark, "op11_merkle")


# -- 12 quality rules

def plain_rules(text):
    text = text or ""
    words = re.findall(rf"[^{WHITE}]+", text)
    lines = [x for x in text.split("\n") if re.search(rf"[^{WHITE}]", x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_rules_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_BYTES", 1000)
    for docs in (odd_docs(spark), read_table(spark, SF, "documents")):
        got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                                  for r in quality.judge(docs).collect())
        assert got == collections.Counter((r.doc_id, *plain_rules(r.text)) for r in docs.collect())
    assert quality.judge(odd_docs(spark, True)).count() == 0


def plain_kneser_ney(words, order):
    """Probability function of an interpolated modified Kneser-Ney model."""
    top = collections.Counter()
    for w, n in words.items():
        s = (257,) * (order - 1) + tuple(w) + (256,)
        for i in range(order - 1, len(s)):
            top[s[i - order + 1:i + 1]] += n
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        c = collections.Counter()
        for g, n in levels[k + 1].items():
            c[g[1:]] += n if g[1] == 257 else 1
        levels[k] = c
    tables = {}
    for k, c in levels.items():
        n = [None] + [sum(1 for v in c.values() if v == j) for j in range(1, 5)]
        d = []
        for j in (1, 2, 3):
            try:
                x = j - (j + 1) * n[1] / (n[1] + 2 * n[2]) * n[j + 1] / n[j]
            except ZeroDivisionError:
                x = None
            d.append(x if x is not None and 0 < x <= j else 0.5 * j)
        by = collections.defaultdict(list)
        for g, v in c.items():
            by[g[:-1]].append(v)
        tables[k] = c, d, {h: (sum(v), sum(d[min(x, 3) - 1] for x in v) / sum(v)) for h, v in by.items()}

    def p(g):
        if not g:
            return 1 / 257
        c, d, contexts = tables[len(g)]
        if g[:-1] not in contexts:
            return p(g[1:])
        total, weight = contexts[g[:-1]]
        own = max(c[g] - d[min(c[g], 3) - 1], 0) / total if g in c else 0
        return own + weight * p(g[1:])

    def score(w):
        s = (257,) * (order - 1) + tuple(w) + (256,)
        return sum(math.log(p(s[i - order + 1:i + 1])) for i in range(order - 1, len(s)))
    return score


@pytest.mark.parametrize("entries", [None, 0])
def test_losses_equal_a_plain_kneser_ney_model(spark, entries):
    docs = odd_docs(spark).where("doc_id <> 4 or doc_id is null").unionByName(
        read_table(spark, SF, "documents").where("lang = 'de'").selectExpr(*[
            c if c in ("doc_id", "text", "lang", "source", "n_chars") else f"null as {c}" for c in odd_docs(spark).columns]))
    corpus = collections.defaultdict(collections.Counter)
    rows = docs.collect()
    words = lambda t: re.findall(rf"[^{WHITE}]+".encode(), (t or "").encode())
    for r in rows:
        corpus[r.lang].update(words(r.text))
    models = {x: plain_kneser_ney(c, 5) for x, c in corpus.items()}
    cache = {}
    want = []
    for r in rows:
        found = words(r.text)
        for w in found:
            if (r.lang, w) not in cache:
                cache[r.lang, w] = models[r.lang](w)
        want.append((r.doc_id or 0, sum(len(w) + 1 for w in found), sum(cache[r.lang, w] for w in found)))
    got = [(r.doc_id or 0, r.n_predicted, r.log_p) for r in quality.measure(docs, model_entries=entries).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want, key=lambda x: (x[0], x[1], x[2]))):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4, abs=1e-3)


def test_bands_reject_what_reads_like_no_other_text(spark):
    rnd = random.Random(5)
    known = "the house of every small river with some green old trees stands near that wide road and many birds".split()
    rows = [(i, " ".join(rnd.choices(known, k=120)), "en") for i in range(300)]
    rows += [(1000, " ".join("".join(rnd.choices("qxzjkvwQXZ0123456789", k=7)) for _ in range(120)), "en"),
             (1001, " ".join(f"{'a' * (k % 9 + 1)}" for k in rnd.choices(range(90), k=120)), "en")]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[1000].kept and not got[1000].base_failed and not got[1001].kept
    assert sum(got[i].kept for i in range(300)) == 300


def test_hash_places_do_not_repeat():
    a, b = ("".join(random.Random(k).choices("abc", k=1024)) for k in (1, 2))
    texts = pa.array([f"x{a}{b}", f"x{b}{a}", f"x{a}{b}"])
    buf = np.frombuffer(texts.buffers()[2], np.uint8)
    w = Words(buf[:sum(map(len, texts.to_pylist()))], np.array([0, 2049, 4098, 6147]), quality.WORD_BYTES)
    h = w.hashes()
    assert h[0] == h[2] != h[1]


def test_query_results_have_the_contract_columns(spark):
    want = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert QUERIES["op12_quality"](spark, SF).columns[:8] == want
