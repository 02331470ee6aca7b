"""Each operator against a brute-force version, or its held-out accuracy."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelpath.llm import (decontam, html_extract, language, mixing, near_dup, ngram_lm, pii, token_orc, topk, toxicity)
from reelpath.llm.common import read_table, text_pieces
from reelpath.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"
WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def same_as_sql(spark, name, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    cols = sorted(d[0] for d in cur.description)
    want = sorted(tuple(r[[d[0] for d in cur.description].index(c)] for c in cols) for r in cur.fetchall())
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == cols
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == want and want


# -- 1 toxicity

def recursive_segments(s, lo, hi):
    """Maximal segments by their definition: the best segment, then either side."""
    best = max(((sum(s[a:b]), a - b, -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, _, a, b = best
    return recursive_segments(s, lo, a) + [(a, b, best[0])] + recursive_segments(s, b, hi)


def test_segments_are_all_maximal_ones():
    rnd = random.Random(4)
    for _ in range(150):
        s = [rnd.choice([-0.5, -0.5, -0.5, 1.0 + rnd.random()]) for _ in range(rnd.randint(0, 22))]
        at = np.array([i for i, x in enumerate(s) if x > 0], int)
        got = toxicity.maximal_segments(at, np.array([s[i] for i in at]), -0.5)
        want = recursive_segments(s, 0, len(s))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want))


def test_toxic_documents_score_higher(spark):
    got = QUERIES["op1_toxicity"](spark, SF_LARGER).join(read_table(spark, SF_LARGER, "labels"), "doc_id").where("held_out")
    rows = [(r.score, r.toxic) for r in got.collect()]
    good = [(a, b) for a, x in rows for b, y in rows if x == 1 and y == 0]
    assert len(good) > 100 and np.mean([(a > b) + 0.5 * (a == b) for a, b in good]) > 0.8


def test_extreme_value_fit_recovers_the_law(spark):
    rng = np.random.default_rng(2)
    n = rng.integers(50, 2000, 4000)
    best = (np.log(0.05 * n) - np.log(rng.exponential(size=4000))) / 0.7
    rows = spark.createDataFrame([(int(a), float(b)) for a, b in zip(n, best)], "n_tokens long, best double")
    scale, k = toxicity.fit_extreme_value(rows)
    assert scale == pytest.approx(0.7) and 0.04 < k < 0.06


# -- 2 decontamination

def test_reparameterised_questions_match_consistent_slots(spark):
    item = "If Tom Baker has 12 apples and gives 3 to Mary how many apples does Tom have when 12 kg of pears cost 3 dollars today"
    docs = [item, "nothing", None, "x so: if Anna Wong has 77 apples and gives 1,005 to Bob how many apples does Anna have when 77 "
            "kg of pears cost 1,005 dollars today. End",
            "if Anna Wong has 77 apples and gives 5 to Bob how many apples does Paul have when 73 kg of pears cost 8 dollars today."]
    got = decontam.find_leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
                              spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.reparameterised) for r in got} == {(0, 9, False), (3, 9, True)}


def test_leaks_equal_brute_force_on_plain_windows(spark):
    docs = {r.doc_id: WORD.findall(r.text.lower()) for r in read_table(spark, SF_LARGER, "documents").collect()}
    items = {r.item_id: WORD.findall(r.text.lower()) for r in read_table(spark, SF_LARGER, "benchmark").collect()}
    grams = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    shares = {(d, i): len(grams(w) & grams(x)) / len(grams(x)) for d, w in docs.items() for i, x in items.items()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontam"](spark, SF_LARGER).collect()}
    assert {k for k, v in shares.items() if v >= 0.9} <= got <= {k for k, v in shares.items() if v >= 0.4}


def test_leaks_without_the_filter_are_the_same(spark, monkeypatch):
    want = sorted(QUERIES["op2_decontam"](spark, SF).collect())
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert sorted(QUERIES["op2_decontam"](spark, SF).collect()) == want and want


def test_items_without_windows_are_matched_whole(spark, monkeypatch):
    items = [(1, "Name four sorting methods"), (2, "Compute 12 + 34 * 5 - 7"), (3, "Paris"), (4, "Why now?"), (None, "one two three"),
             (6, "..."), (7, "A question with a number of plain words in it")]
    docs = ["Please name FOUR sorting methods, briefly.", "so compute 12 + 34 * 5 - 7 now", "Paris is a town", "paris!", "why now", None, "",
            "why now of all times", "one two. Three", "compute 12 + 34 * 5 - 8", "one two", "x a question with a number of plain words in it"]
    want = {(0, 1), (1, 2), (3, 3), (4, 4), (8, None), (11, 7)}
    for most in (decontam.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", most)
        got = decontam.find_leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string")).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want


def test_runs_of_any_length_hash_alike_everywhere():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 50, 400).astype(np.uint64)
    docs = np.repeat(np.arange(8), 50)
    for n in (1, 2, 7, 50):
        g, at = decontam.run_hashes(h, docs, n)
        assert len(at) == 8 * (51 - n)
        by = collections.defaultdict(set)
        for x, i in zip(g.tolist(), at.tolist()):
            by[x].add(tuple(h[i:i + n].tolist()))
        assert all(len(v) == 1 for v in by.values()) and len(by) == len({tuple(h[i:i + n].tolist()) for i in at})


def plain_template(text):
    """Template words and slot values by the definition, word by word."""
    words = [(m.start(), m.group()) for m in re.finditer(r"[A-Za-z0-9\u0080-\U0010ffff]+", text)]
    out, prev = [], None
    for k, (at, w) in enumerate(words):
        end = prev[0] + len(prev[1]) if prev else 0
        opens = prev is None or re.search(r"[.!?\n]", text[end:at])
        number = w[0] in "0123456789"
        if number and prev and prev[1][0] in "0123456789" and at == end + 1 and text[end] in ",.":
            out[-1] = ("#", out[-1][1] + "," + w)
        elif number:
            out.append(("#", w))
        elif prev and prev[1][0] in "0123456789" and w.lower() in decontam.UNITS:
            out.append(("unit", w.lower()))
        elif w[0].isupper() and len(w) > 1 and not opens and w[1].islower():
            out.append(("name", w.lower()))
        else:
            out.append((w.lower(), None))
        prev = (at, w)
    return out


def plain_leaks(docs, items):
    """Slot-consistent coverage of every document and item, all alignments."""
    def windows(t):
        return [(k, tuple("\0" + x if v is not None else x for x, v in t[k:k + 5]), [v for _, v in t[k:k + 5] if v is not None])
                for k in range(len(t) - 4) if sum(v is None for _, v in t[k:k + 5]) >= decontam.MIN_PLAIN]
    found = set()
    item_windows = {i: windows(plain_template(x)) for i, x in items.items()}
    for d, text in docs.items():
        mine = collections.defaultdict(list)
        for k, w, v in windows(plain_template(text)):
            mine[w].append((k, v))
        for i, ws in item_windows.items():
            shifts = collections.defaultdict(list)
            for p, w, v in ws:
                for k, u in mine.get(w, ()):
                    shifts[k - p].append((p, v, u))
            good = set()
            for rows in shifts.values():
                maps = collections.defaultdict(set)
                for _, v, u in rows:
                    for x, y in zip(v, u):
                        maps[x].add(y)
                if all(len(s) == 1 for s in maps.values()):
                    good |= {p for p, _, _ in rows}
            if ws and len(good) / len(ws) >= decontam.COVERAGE:
                found.add((d, i))
    return found


def test_leaks_equal_brute_force_with_placeholders_and_slots(spark):
    rnd = random.Random(12)
    names, words = ["Tom", "Anna", "Maria", "Paul"], "gives apples with pears together in the small blue basket today".split()

    def question(values, who):
        return (f"If {who[0]} has {values[0]} apples and gives {values[1]} kg to {who[1]} in the blue basket how many of the {values[0]} apples "
                f"does {who[0]} keep today")
    items = {1: question((12, 3), ("Tom", "Anna")), 2: "Small blue basket today with 5 kg of pears and 7 apples in the small basket",
             3: "gives apples with pears together 1,000 in the small"}
    docs = {}
    for d in range(120):
        parts = [rnd.choice(words + [str(rnd.randint(1, 9)), "kg", "Paul"]) for _ in range(rnd.randint(0, 25))]
        if rnd.random() < 0.6:
            v = (rnd.randint(1, 20), rnd.randint(1, 20))
            text = question(v, rnd.sample(names, 2))
            if rnd.random() < 0.4:
                text = text.replace(f"the {v[0]} apples", f"the {v[0] + 1} apples")        # a slot that breaks the rule
            parts.insert(rnd.randint(0, len(parts)), "x. " + text)
        if rnd.random() < 0.3:
            parts.append(rnd.choice([items[2], items[3], items[2].replace("5", "9")]))
        docs[d] = " ".join(parts)
    got = decontam.find_leaks(spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
                              spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    want = plain_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and 40 < len(want) < 200


# -- 3 near duplicates

def test_samples_collide_like_weighted_jaccard():
    tables = near_dup.sampling_tables()
    rng = np.random.default_rng(1)
    hits = trials = 0
    want = []
    for _ in range(300):
        g = np.unique(rng.integers(0, 2 ** 63, 60).astype(np.uint64))
        w1 = rng.uniform(0.5, 8, len(g))
        w2 = np.where(rng.random(len(g)) < 0.8, w1, rng.uniform(0.5, 8, len(g)))
        near_dup_rows, near_dup.ROWS = near_dup.ROWS, 1
        try:
            a = near_dup.weighted_samples(np.zeros(len(g), np.int32), g, w1, 1, tables)
            b = near_dup.weighted_samples(np.zeros(len(g), np.int32), g, w2, 1, tables)
        finally:
            near_dup.ROWS = near_dup_rows
        hits, trials = hits + int((a == b).sum()), trials + a.size
        want.append(np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum())
    assert abs(hits / trials - np.mean(want)) < 0.03


def test_near_duplicates_equal_brute_force(spark):
    docs = {r.doc_id: r.text.lower() for r in read_table(spark, SF_LARGER, "documents").collect()}
    sets = {}
    for i, t in docs.items():
        w = WORD.findall(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    cls = {r.doc_id: r.class_id for r in QUERIES["op3_near_dup"](spark, SF_LARGER).collect()}
    assert set(cls) == set(docs)
    near = {}
    by = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    for ids in by.values():
        for a, b in itertools.combinations(ids, 2) if len(ids) < 50 else ():
            near[a, b] = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(cls[a] == cls[b] for (a, b), s in near.items() if s >= 0.82)
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (a, b), s in near.items():
        if s >= 0.78 or docs[a] == docs[b]:
            root[max(find(a), find(b))] = min(find(a), find(b))
    assert all(find(i) == find(c) for i, c in cls.items())


def weighted_sets(spark, texts):
    """(documents, packed sets, idf) as the operator makes them."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = near_dup.idf_table(df)
    sets = df.select("doc_id", F.lower("text").alias("text")).mapInArrow(
        near_dup._weighted_sets(idf), "doc_id long, hashes binary, weights binary").checkpoint()
    return df, sets, idf


def similarities(sets):
    """Weighted Jaccard of all pairs that share a shingle, hot ones included."""
    rows = {r.doc_id: (np.frombuffer(r.hashes, np.uint64), np.frombuffer(r.weights, np.float32)) for r in sets.collect()}
    return {(a, b): near_dup.weighted_jaccard(*rows[a], *rows[b]) for a, b in itertools.combinations(sorted(rows), 2)}


def varied_texts(seed, n=150):
    """Families of texts with words replaced here and there; a third of all
    texts also share one long passage."""
    rnd = random.Random(seed)
    passage = [f"hot{k}" for k in range(60)]
    out = []
    while len(out) < n:
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(40, 160))]
        if rnd.random() < 0.34:
            words[10:10] = passage
        for _ in range(rnd.choice([1, 1, 2, 4])):
            mine = list(words)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 5])):
                mine[rnd.randrange(len(mine))] = f"n{rnd.randrange(10 ** 6)}"
            out.append(" ".join(mine[rnd.choice([0, 0, 3]):]))
    return out


def test_recall_of_all_pairs_hot_shingles_included(spark):
    texts = varied_texts(3, 400)
    df, sets, _ = weighted_sets(spark, texts)
    near = [k for k, s in similarities(sets).items() if s >= near_dup.THRESHOLD]
    cls = {r.doc_id: r.class_id for r in near_dup.classes(df).collect()}
    found = sum(cls[a] == cls[b] for a, b in near)
    assert len(near) > 100 and found / len(near) >= 0.99, (found, len(near))


@pytest.mark.parametrize("one_class", [False, True])
def test_the_finish_gives_every_pair(spark, one_class):
    df, sets, idf = weighted_sets(spark, varied_texts(5))
    sim = similarities(sets)
    label = (lambda i: 0 if i % 3 else i) if one_class else (lambda i: i)
    members = spark.createDataFrame([(i, label(i)) for i in range(df.count())], "doc_id long, class long")
    got = {(r.a, r.b) for r in near_dup.unlinked_pairs(members, sets, idf).collect()}
    assert {k for k, s in sim.items() if s >= near_dup.THRESHOLD and label(k[0]) != label(k[1])} <= got
    assert not any(label(a) == label(b) for a, b in got) and got


def test_a_shared_passage_too_short_joins_nothing(spark):
    passage = " ".join(f"hot{k}" for k in range(100))
    texts = [f"{passage} " + " ".join(f"d{i}x{k}" for k in range(14 + i % 2)) for i in range(400)]
    df, sets, idf = weighted_sets(spark, texts)
    p = sets.join(df.select("doc_id", F.col("doc_id").alias("class")), "doc_id").select("doc_id", "class", "hashes", "weights").mapInArrow(
        near_dup._prefixes(idf), "doc_id long, class long, gram long, rest double, total double").withColumn("major", F.lit(None).cast("long"))
    assert p.groupBy("gram").count().agg(F.max("count")).first()[0] == 400           # hot shingles are in the prefixes
    x, y = near_dup.asking_sides(p)
    shared = x.join(y, ["gram", "size", "side"]).where("doc_id1 <> doc_id2").count()
    assert shared < 10 * 400, shared


def test_a_large_bucket_is_compared_whole(spark, monkeypatch):
    def one_bucket(idf, sign=near_dup._sign):
        def run(batches):
            for b in sign(idf)(batches):
                bands = pa.array([[1]] * b.num_rows, pa.list_(pa.int64()))
                yield b.set_column(b.schema.get_field_index("bands"), "bands", bands)
        return run
    monkeypatch.setattr(near_dup, "_sign", one_bucket)
    texts = [" ".join(f"w{pair}x{k}" for k in range(60)) + f" end{pair}x{side}" for pair in range(40) for side in range(2)]
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(80)}


def test_pairs_of_a_hot_group_are_found(spark):
    hot = " ".join(f"hot{k}" for k in range(100))
    texts = [" ".join([hot] + [f"p{i // 2}q{k}" for k in range(6)] + [f"o{i}x{k}" for k in range(11)]) for i in range(120)]
    texts += [" ".join(f"r{i}w{k}" for k in range(30)) for i in range(240)]
    got = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[i] == i - i % 2 for i in range(1, 120, 2) if got[i] != i) and all(got[i] == i for i in range(120, 360))
    assert sum(got[i] == i - 1 for i in range(1, 120, 2)) >= 58


# -- 4 mixing

def test_mix_equals_sql(spark):
    same_as_sql(spark, "op4_mixing", SF_LARGER)


def test_mix_comes_near_targets_and_repeats(spark):
    docs = read_table(spark, SF_LARGER, "documents")
    one, two = (mixing.decide(docs.repartition(k)).collect() for k in (1, 5))
    assert sorted(one) == sorted(two)
    by = collections.defaultdict(lambda: [0, 0.0])
    for r in one:
        by[r.source][0] += r.taken
        by[r.source][1] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(t - goal) <= 0.02 * goal + 1 for t, goal in by.values())
    taken = {r.doc_id: r.copies for r in one}
    got = collections.Counter(r.doc_id for r in mixing.mix_documents(docs).select("doc_id").collect())
    assert all(got[i] == n for i, n in taken.items())


# -- 5 language

def test_held_out_languages(spark):
    got = QUERIES["op5_language"](spark, SF_LARGER).join(read_table(spark, SF_LARGER, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_mixture_finds_both_languages(spark):
    docs = read_table(spark, SF_LARGER, "documents")
    one = {lang: docs.where(F.col("lang") == lang).where("n_chars between 1500 and 2500").orderBy("doc_id").first().text
           for lang in ("en", "de")}
    model = language.learn(docs)
    mixed = spark.createDataFrame([(1, one["en"] + "\n" + one["de"]), (2, one["en"])], "doc_id long, text string")
    got = {r.doc_id: dict(zip(r.langs, r.shares)) for r in language.identify(mixed, model).collect()}
    assert got[1]["en"] > 0.25 and got[1]["de"] > 0.25 and got[2]["en"] > 0.95


# -- 6 top k

def test_top_products_equal_sql(spark):
    same_as_sql(spark, "op6_top_products")


def test_top_products_with_ties_and_dimensions(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rng = np.random.default_rng(0)
    vecs = {i: [float(x) for x in rng.integers(-3, 4, 3 if i % 5 else 2) / 8] for i in range(150)}
    v = topk.scaled_vectors(spark.createDataFrame(list(vecs.items()), "vec_id long, embedding array<float>"))
    got = topk.top_products(v, v.where("vec_id % 10 = 0"), 7).collect()
    whole = {i: [math.floor(64 * x) for x in e] for i, e in vecs.items()}
    want = set()
    for q in range(0, 150, 10):
        s = sorted((-sum(a * b for a, b in zip(whole[q], c)), i) for i, c in whole.items() if i != q and len(c) == len(whole[q]))
        want |= {(q, k + 1, i, -x) for k, (x, i) in enumerate(s[:7])}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want


# -- 7 language model

def test_backoff_scores_equal_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    got = {r.doc_id: r for r in ngram_lm.score_documents(docs, chunk_bytes=1 << 16).collect()}
    words = {r.doc_id: WORD.findall(r.text.lower()) for r in docs.collect()}
    grams = lambda w, n: collections.Counter(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    own = {i: [None] + [grams(w, n) for n in (1, 2, 3)] for i, w in words.items()}
    every = [None] + [sum((o[n] for o in own.values()), collections.Counter()) for n in (1, 2, 3)]
    total = sum(map(len, words.values()))
    for i, w in words.items():
        count = lambda g: every[len(g)][g] - own[i][len(g)][g]
        rest, score, used = max(total - len(w), 1), 0.0, [0] * 4
        for k in range(len(w)):
            top = min(k + 1, 3)
            for n in range(top, 0, -1):
                g = tuple(w[k - n + 1:k + 1])
                below = count(g[:-1]) if n > 1 else rest
                if count(g) > 0 and below > 0:
                    score += (top - n) * math.log(0.4) + math.log(count(g) / below)
                    used[n] += 1
                    break
            else:
                score += (top - 1) * math.log(0.4) - math.log(rest)
                used[0] += 1
        assert got[i].n_tokens == len(w) and list(got[i].longest) == used
        assert got[i].log_score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_packed_and_relational_scores_are_the_same(spark):
    odd = [(1, None), (1, ""), (2, "one"), (2, "one two"), (None, "one two three one two three"), (5, "... !"), (6, "two three " * 40)]
    for docs in (read_table(spark, SF, "documents").select("doc_id", "text"), spark.createDataFrame(odd, "doc_id long, text string"),
                 spark.createDataFrame([], "doc_id long, text string")):
        key = lambda r: (r.doc_id or 0, r.n_tokens, list(r.longest))
        a, b = (sorted(f(docs).collect(), key=key) for f in (ngram_lm.score_documents, ngram_lm.relational_scores))
        assert list(map(key, a)) == list(map(key, b)) and len(a) == docs.count()
        assert all(x.log_score == pytest.approx(y.log_score, rel=1e-9, abs=1e-9) for x, y in zip(a, b))


@pytest.mark.parametrize("seed", [17, 3])
def test_rows_of_the_mix_follow_the_decisions(spark, seed):
    """Without repeated ids the rows decide by their source's rule, with them by a
    join; both give each document as often as decide says."""
    docs = read_table(spark, SF_LARGER, "documents").withColumn("_mix_size", F.lit(1)).withColumn("u", F.lit("x"))
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.col("source"))) \
        .withColumn("text", F.when(F.col("doc_id") % 50 > 0, F.col("text")))
    want = {r.doc_id: r.copies for r in mixing.decide(docs, seed).collect()}
    mixed = mixing.mix_documents(docs, seed)
    got = collections.Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and all(got[i] == n for i, n in want.items()) and set(want.values()) >= {0, 1, 2}
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan          # no text is shuffled
    twice = docs.union(docs.where("doc_id < 20"))
    want = collections.Counter()
    for r in mixing.decide(twice, seed).collect():
        want[r.doc_id] += r.copies
    assert collections.Counter(r.doc_id for r in mixing.mix_documents(twice, seed).collect()) == +want


# -- 5 languages: the selection against the plain algorithm

def plain_selection(like):
    """Proportions of the selected languages of one document, step by step."""
    n, langs = like.shape

    def em(share):
        for _ in range(language.EM_STEPS):
            r = like * share
            share = (r / r.sum(1, keepdims=True)).mean(0)
        return share, np.log((like * share).sum(1)).sum()

    def value(ll, k):
        return ll - language.PENALTY * k * 0.5 * math.log(max(n, 2))

    share, ll = em(np.full(langs, 1 / langs))
    best, current, best_value = share, share, value(ll, langs)
    for left in range(langs - 1, 0, -1):
        trial = current.copy()
        trial[min((s, j) for j, s in enumerate(trial) if s > 0)[1]] = 0
        if not trial.sum():                          # the others have vanished already
            break
        share, ll = em(trial / trial.sum())
        if value(ll, left) < best_value:
            break
        best, current, best_value = share, share, value(ll, left)
    return best


def test_language_selection_equals_the_plain_algorithm():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 60, 80)
    splits = np.concatenate([[0], np.cumsum(sizes)])
    rows = []
    for n in sizes:
        of = rng.choice(4, n, p=rng.dirichlet([0.3] * 4))
        like = rng.uniform(0.01, 0.4, (n, 4))
        like[np.arange(n), of] = 1.0
        rows.append(like)
    got = language.select_languages(np.concatenate(rows), splits)
    counts = set()
    for like, share in zip(rows, got):
        want = plain_selection(like)
        assert np.allclose(share, want, atol=1e-9) and share.sum() == pytest.approx(1)
        counts.add(int((share > 0).sum()))
    assert len(counts) >= 3


def test_language_of_every_document_equals_brute_force(spark):
    """Trigram likelihoods, mixture and selection, document by document."""
    docs = read_table(spark, SF, "documents")
    rows = docs.collect()
    words = lambda t: re.findall(rb"[a-zA-Z\x80-\xff]+", (t or "").lower().encode())

    def classes(w):
        b = b" " + w + b" "
        return [((b[k] << 16 | b[k + 1] << 8 | b[k + 2]) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - language.BITS for k in range(len(w))]

    counts = collections.defaultdict(collections.Counter)
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            for w in words(r.text):
                counts[r.lang].update(classes(w))
    langs = sorted(counts)
    total = {x: sum(c.values()) + language.SMOOTHING * 2 ** language.BITS for x, c in counts.items()}
    cache = {}
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got.keys() == {r.doc_id for r in rows} and got[rows[0].doc_id].langs == langs
    for r in rows:
        mine = words(r.text)
        if not mine:
            assert got[r.doc_id].lang_pred == "und"
            continue
        for w in mine:
            if w not in cache:
                cache[w] = np.array([sum(math.log((counts[x][c] + language.SMOOTHING) / total[x]) for c in classes(w)) for x in langs])
        ll = np.array([cache[w] for w in mine])
        want = plain_selection(np.exp(ll - ll.max(1, keepdims=True)))
        assert got[r.doc_id].lang_pred == langs[int(want.argmax())] and got[r.doc_id].score == pytest.approx(want.max(), abs=2e-3)


# -- 8 personal data

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 1 and any(int(x) > 255 for x in m[0].split("."))) or (k == 3 and not 8 <= len(d) <= 15) or \
                    (k == 2 and not (16 <= len(d) <= 19 and pii.luhn(d))):
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rnd = random.Random(3)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab1234567890  ..--@@++()%_\n") for _ in range(rnd.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text)


def test_digest_of_every_document(spark):
    got = {r.doc_id: r for r in QUERIES["op8_pii"](spark, SF_LARGER).collect()}
    for r in read_table(spark, SF_LARGER, "documents").collect():
        base = plain_spans(r.text)
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(base))
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(k == x for k, _, _ in base) for x in range(4)]
        assert set(text.split(",")) - {""} <= set(g.spans.split(","))


def plain_groups(text):
    """Every stretch of whole digit groups of card or telephone length."""
    out = set()
    starts = [m.start() for m in re.finditer(r"(?<![0-9])[0-9]", text)]
    ends = [m.end() for m in re.finditer(r"[0-9](?![0-9])", text)]
    for a in starts:
        for b in ends:
            if b <= a or not re.fullmatch(r"[0-9]+([ ().\-/]{1,3}[0-9]+)*", text[a:b]):
                continue
            sizes = tuple(map(len, re.findall("[0-9]+", text[a:b])))
            if sizes in pii.CARD_GROUPS:
                out.add((2, a, b))
            if 7 <= sum(sizes) <= 15 and len(sizes) <= pii.PHONE_GROUPS and min(sizes[1:], default=9) > 1:
                s = a - (text[:a][-1:] == "(")
                out.add((3, s - (text[:s][-1:] == "+"), b))
    return out


def test_proposals_equal_every_stretch_of_groups():
    rnd = random.Random(6)
    found = 0
    for _ in range(4000):
        text = "".join(rnd.choice(["1", "23", "456", "4567", "4111", " ", " ", "-", "(", ") ", ".", "+", "x", "/"]) for _ in range(rnd.randint(0, 22)))
        got = set(pii.group_spans(text))
        assert got == plain_groups(text), text
        found += len(got)
    assert found > 1000
    assert not pii.group_spans("1 2 3 4 5 6 7 8 9 " * 50) and len(pii.group_spans("4567 " * 500)) < 500 * 6


@pytest.mark.parametrize("text, kind, want", [
    ("bob (at) example dot com", 0, "bob (at) example dot com"), ("joe [at] mail [dot] example.org", 0, "joe [at] mail [dot] example.org"),
    ("addr 2001:db8::1 here", 1, "2001:db8::1"), ("555-123-4567 12 3", 3, "555-123-4567"),
    ("pay 4111 1111 1111 1111 7 12/26", 2, "4111 1111 1111 1111"), ("+1 (575) 555-9977 4107636997782755", 3, "+1 (575) 555-9977"),
    ("+1 (575) 555-9977 4107636997782755", 2, "4107636997782755"), ("x 4107636997782756", 2, None), ("at 12:30:45 o'clock", 1, None),
    ("a@b", 0, None), ("abc4107636997782755", 2, None), ("v 300.1.1.1", 1, None), ("call 020 7946 0018 now", 3, "020 7946 0018")])
def test_labels_do_not_ask_the_base_patterns(text, kind, want):
    good = [text[a:b] for k, a, b in pii.proposals(text) if k == kind and pii.weak_label(text, k, a, b)]
    assert max(good, key=len, default=None) == want


def test_added_spans_are_the_greedy_choice_of_what_the_trees_accept(spark, monkeypatch):
    rnd = random.Random(9)

    def card():
        body = "4" + "".join(rnd.choices("0123456789", k=14))
        return next(body + c for c in "0123456789" if pii.luhn(body + c))

    texts = []
    for i in range(400):
        phone = f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
        texts.append(rnd.choice([f"call {phone} now", f"card {card()} used", f"{phone} {card()} both", f"id {rnd.randint(10 ** 15, 10 ** 16)} no",
                                 f"mail u{i}@mail.example.com and 10.2.{i % 250}.7 too", f"u{i} (at) mail dot org", f"sum 12345 67 {i} 99999 x"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = {}
    whole = pii.probability

    def kept(model, df):
        out = whole(model, df)
        if "row" in df.columns:
            seen["judged"] = out = out.checkpoint()
        return out

    monkeypatch.setattr(pii, "probability", kept)
    limits = {}
    learn = pii.learn
    monkeypatch.setattr(pii, "learn", lambda c: limits.update(got=learn(c)) or limits["got"])
    got = {r.doc_id: ({tuple(x) for x in r.base}, {tuple(x) for x in r.added}) for r in pii.find_personal_data(docs).collect()}
    by_text = {}
    for r in seen["judged"].collect():
        if r.p >= limits["got"][1].get(r.kind, 2.0):
            by_text.setdefault(r.row, []).append((-math.floor(r.p * 100), r.start - r.end, r.start, r.end, r.kind))
    want = []
    for r in by_text.values():
        want.append(sorted(r))
    chosen = 0
    for i, text in enumerate(texts):
        base, added = got[i]
        assert base == {(k, a, b) for k, a, b in plain_spans(text)}
        assert not any(a < f and e < b for _, a, b in added for _, e, f in base)
        assert not any(x < y and x[1] < y[2] and y[1] < x[2] for x in added for y in added)
        chosen += len(added)
        if "both" in text:                           # the base patterns run into each other here
            assert not base and {text[a:b] for _, a, b in added} == set(re.findall(r"\+1 \(\d+\) 555-\d+|\d{16}", text))
        if text.startswith("id "):
            assert not added
    # the same greedy choice, text by text, from what the trees accept
    greedy = 0
    for spans in want:
        taken = []
        for _, _, a, b, k in spans:
            taken += [(k, a, b)] if not any(a < f and e < b for _, e, f in taken) else []
        greedy += len(taken)
    assert 0 < chosen <= greedy


# -- 9 pages

def test_minimum_cut_equals_enumeration():
    rnd = random.Random(8)
    for _ in range(120):
        n = rnd.randint(1, 8)
        odds = [rnd.uniform(-2, 2) for _ in range(n)]
        links = [(i, j, rnd.uniform(0, 1.5)) for i in range(n) for j in range(i) if rnd.random() < 0.5]

        def cost(keep):
            return sum(max(o, 0) if not k else max(-o, 0) for o, k in zip(odds, keep)) + \
                sum(w for i, j, w in links if keep[i] != keep[j])
        best = min(cost(k) for k in itertools.product((False, True), repeat=n))
        assert cost(html_extract.minimum_cut(odds, links)) == pytest.approx(best)


def test_article_text_of_every_page(spark):
    import html
    got = {r.page_id: r.text for r in QUERIES["op9_html_extract"](spark, SF_LARGER).collect()}
    for r in read_table(spark, SF_LARGER, "pages").collect():
        body = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", body))
        assert got[r.page_id] == "\n".join(p for p in parts if p)


def test_pages_without_semantic_tags():
    odds = {"words 5": 2.0, "words 4": 1.0, "tag p": 1.5, "links 4": -4.0, "tag li": -2.0, "words 1": -1.0}
    page = ('<div id="cookie-notice"><p>We use cookies.</p></div><ul><li><a href=a>Home</a><li><a href=b>News</a></ul>'
            '<div><h2>Title &amp; more</h2><p>First paragraph of some length with text and an <a href=x>odd link</a> in it too.</p>'
            '<p>Second one is long enough, too, so that it counts as text.</p><form><label>Your mail</label></form>'
            '<div class="comments"><p>Nice post, I agree with every word of it, thank you so much.</p></div></div>')
    assert html_extract.main_blocks(page, odds) == [
        "Title & more", "First paragraph of some length with text and an odd link in it too.",
        "Second one is long enough, too, so that it counts as text."]


PARAGRAPHS = ["First paragraph of some length, with text and commas in it, and it goes on for a while.",
              "Second one is long enough, too, so that it counts as text of the article here."]
MODELS = [html_extract.PRIOR, {}, {"words 5": 2.0, "words 4": 1.0, "tag p": 1.5, "links 4": -4.0, "tag li": -2.0, "words 1": -1.0}]


@pytest.mark.parametrize("odds", MODELS)
def test_an_article_stays_whatever_is_mentioned_around_it(odds):
    p = "".join(f"<p>{x}</p>" for x in PARAGRAPHS)
    for page in (f'<article class="post has-sidebar">{p}</article>', f'<main id="content-with-comments">{p}</main>',
                 f'<section class="promo-layout"><article>{p}</article></section>', f"<svg/><article>{p}</article>",
                 f'<div class="post-share-page"><article>{p}</article></div>', f'<form id="aspnetForm"><main>{p}</main></form>',
                 f'<aside><main>{p}</main></aside>', f'<article>{p}</article><svg/><nav>menu</nav>', f'<div role="main">{p}</div>'):
        assert html_extract.main_blocks(page, odds) == PARAGRAPHS, page


@pytest.mark.parametrize("odds", MODELS)
def test_named_boilerplate_goes_even_where_it_reads_like_text(odds):
    p, text = "".join(f"<p>{x}</p>" for x in PARAGRAPHS), "<p>I read all of it, twice, and liked every single word that you wrote.</p>"
    for page in (f'<article>{p}</article><section id="comments"><article class="comment">{text}{text}</article></section>',
                 f'<article>{p}</article><div class="comment-list">{text}{text}{text}</div>',
                 f'<article>{p}<div class="ad-container">{text}</div></article>', f'<nav>{text}</nav><article>{p}</article>',
                 f'<article>{p}</article><aside><article>{text}</article></aside>', f'<article>{p}<p hidden>x</p></article>',
                 f'<article>{p}</article><form>{text}</form>', f'<div id="cookie-notice">{text}</div><article>{p}</article>'):
        assert html_extract.main_blocks(page, odds) == PARAGRAPHS, page


def test_the_flow_turns_blocks_against_their_own_cost():
    """A short line between paragraphs costs more in than out by itself, also
    inside a marked page; its neighbours turn it.  A name against it they do not."""
    odds = {"words 5": 2.0, "words 4": 2.0, "words 1": -1.4}
    page = f"<div><p>{PARAGRAPHS[0]}</p><p>Aha!</p><p>{PARAGRAPHS[1]}</p></div>"

    def own(source, odds):
        b = html_extract.page_blocks(source)[1]
        return max(-html_extract.CLIP, sum(odds.get(f, 0.0) for f in html_extract.form(b))) + b.says

    assert own(page, odds) < 0 and html_extract.main_blocks(page, odds) == [PARAGRAPHS[0], "Aha!", PARAGRAPHS[1]]
    assert html_extract.main_blocks("<div><p>Aha!</p></div>", odds) == []
    marked = f"<article><p>{PARAGRAPHS[0]}</p><p class='with-ads'>Aha!</p><p>{PARAGRAPHS[1]}</p></article>"
    low = {**odds, "words 1": -2.4}
    assert own(marked, low) < 0 and html_extract.main_blocks(marked, low) == [PARAGRAPHS[0], "Aha!", PARAGRAPHS[1]]
    assert html_extract.main_blocks(marked.replace("with-ads", "banner"), low) == PARAGRAPHS


def test_pages_of_odd_tables(spark):
    long = "<article>" + "<p>word and word, again.</p>" * 60_000 + "</article>"
    rows = [(1, "u", long, 5, "x"), (1, "u", "<article><p>a b c.</p></article>", 5, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = sorted(html_extract.extract(df).collect(), key=lambda r: -r.n_chars)
    assert [r.n_chars for r in got] == [60_000 * 22 - 1, 6] and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}


# -- 10 token output

def test_pieces_encode_like_whole_texts():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_orc.default_tokenizer())
    enc = token_orc.PieceEncoder(tokenizer, 50)
    rnd = random.Random(1)
    parts = ["a", "the", "Wo", "é", " ", "  ", "\n", "\t", "12", "'s", "!", "<|endoftext|>", "日本", "😀", "\r\n", " y", "’", "\xa0", " w"]
    for _ in range(500):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20))) for _ in range(5)]
        (_, _, buf, offs), = text_pieces(pa.array(texts))
        ids, per = enc.encode(buf, offs)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert list(per) == list(map(len, want)) and list(ids) == [i for w in want for i in w]


def test_round_trip_of_every_document(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_orc.default_tokenizer())
    got = sorted(QUERIES["op10_token_orc"](spark, SF).collect())
    start = 0
    docs = sorted(read_table(spark, SF, "documents").select("doc_id", "text").collect())
    assert len(got) == len(docs)
    for g, d in zip(got, docs):
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0]
        assert tuple(g) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_files_hold_ascending_ranges(spark, tmp_path):
    path = token_orc.write_tokens(read_table(spark, SF, "documents"), str(tmp_path / "orc"), partitions=3)
    rows = spark.read.orc(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).orderBy("f").collect()
    assert len(rows) == 3 and all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
