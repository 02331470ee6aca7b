"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpath.llm import (decontam, fim, html_extract, language, merkle, mixing, near_dup, ngram_lm, pii, quality, token_orc,
                          topk, toxicity)
from reelpath.llm.common import read_table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(read_table(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = topk.scaled_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk.top_products(v, v.where(F.col("vec_id") % 20 == 0))


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(read_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(read_table(spark, sf_dir, "documents")))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.tokens_round_trip(read_table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.transform(read_table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontam": op2_decontam,
    "op3_near_dup": op3_near_dup,
    "op4_mixing": op4_mixing,
    "op5_language": op5_language,
    "op6_top_products": op6_top_products,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_pii": op8_pii,
    "op9_html_extract": op9_html_extract,
    "op10_token_orc": op10_token_orc,
    "op11_merkle": op11_merkle,
    "op12_quality": op12_quality,
    "op13_fim": op13_fim,
}

def _merkle_sql(levels: int = 6, over: int = 2) -> str:
    """The trees level by level (up to 8^levels documents a language and
    8^over languages), and each proof folded along them."""
    empty = "coalesce({}, '')"
    doc = ["doc_id", "source", "lang", "n_chars", "text"]

    def leaf(text: str) -> str:
        values = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in doc]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = ("list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, y: "
            "CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384) ELSE b // 2 END)")
    crc = ("xor(list_reduce(list_prepend(4294967295, list_transform(range(1, 1 + length(i)), lambda k: "
           f"CAST(ascii(substr(i, CAST(k AS INT), 1)) AS BIGINT))), lambda c, x: {bits}), 4294967295)")
    cte = [f"""d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf(lower)} AS lowered,
                     coalesce(CAST(doc_id AS VARCHAR), '') AS i FROM documents)""",
           f"c AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN lowered ELSE leaf END AS shown FROM d)",
           """l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM c)""",
           "t0 AS (SELECT lang AS g, pos, leaf AS h FROM l)"]

    def level(name: str, k: int) -> list[str]:
        near = "PARTITION BY g, pos // 8 ORDER BY pos"
        return [f"""{name}{k}n AS (SELECT *, count(*) OVER (PARTITION BY g) AS n,
            lag(h, 1) OVER ({near}) AS b1, lag(h, 2) OVER ({near}) AS b2, lag(h, 3) OVER ({near}) AS b3,
            lag(h, 4) OVER ({near}) AS b4, lag(h, 5) OVER ({near}) AS b5, lag(h, 6) OVER ({near}) AS b6,
            lag(h, 7) OVER ({near}) AS b7, lead(h, 1) OVER ({near}) AS a1, lead(h, 2) OVER ({near}) AS a2,
            lead(h, 3) OVER ({near}) AS a3, lead(h, 4) OVER ({near}) AS a4, lead(h, 5) OVER ({near}) AS a5,
            lead(h, 6) OVER ({near}) AS a6, lead(h, 7) OVER ({near}) AS a7 FROM {name}{k})""",
                f"""{name}{k}s AS (SELECT g, pos, n, h, {' || '.join(empty.format(f'b{j}') for j in range(7, 0, -1))} AS lhs,
            {' || '.join(empty.format(f'a{j}') for j in range(1, 8))} AS rhs FROM {name}{k}n)""",
                f"""{name}{k + 1} AS (SELECT g, pos // 8 AS pos, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos))
            ELSE max(h) END AS h FROM {name}{k}s GROUP BY g, pos // 8)"""]

    for k in range(levels):
        cte += level("t", k)
    cte += [f"""s0 AS (SELECT row_number() OVER (ORDER BY g IS NOT NULL, encode(g)) - 1 AS pos, h, g AS lang
               FROM t{levels})""",
            "r0 AS (SELECT 0 AS g, pos, h FROM s0)"]
    for k in range(over):
        cte += level("r", k)
    cte.append("f0 AS (SELECT l.doc_id, l.leaf, l.lang, l.pos, l.shown AS x, '' AS p FROM l)")

    def step(name: str, k: int, n: int, match: str) -> str:
        return f"""f{n + 1} AS (SELECT f.doc_id, f.leaf, f.lang, f.pos // 8 AS pos,
            CASE WHEN s.n > 1 THEN sha256(s.lhs || f.x || s.rhs) ELSE f.x END AS x,
            CASE WHEN s.n > 1 THEN f.p || s.lhs || s.rhs ELSE f.p END AS p
            FROM f{n} f JOIN {name}{k}s s ON {match} AND s.pos = f.pos)"""

    for k in range(levels):
        cte.append(step("t", k, k, "s.g IS NOT DISTINCT FROM f.lang"))
    cte.append(f"""f{levels + 1} AS (SELECT f.doc_id, f.leaf, f.lang, s.pos, f.x, f.p
               FROM f{levels} f JOIN s0 s ON s.lang IS NOT DISTINCT FROM f.lang)""")
    for k in range(over):
        cte.append(step("r", k, levels + 1 + k, "s.g = 0"))
    return "WITH " + ",\n".join(cte) + f"""
SELECT f.doc_id, f.leaf, s.h AS subroot, r.h AS root, sha256(f.p) AS proof_sha256, f.x AS folded_root, f.x = r.h AS verified
FROM f{levels + 1 + over} f JOIN s0 s ON s.lang IS NOT DISTINCT FROM f.lang CROSS JOIN r{over} r"""


ORACLE_SQL: dict[str, str] = {
    "op11_merkle": _merkle_sql(),
    "op13_fim": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS us,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(us) AS BIGINT) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS i,
        greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS j,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT *, array_to_string(list_slice(us, 1, i), '') AS p, array_to_string(list_slice(us, i + 1, j), '') AS m,
        array_to_string(list_slice(us, j + 1, n), '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m
              ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM s""",
    "op4_mixing": """
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT)
           / 281474976710656.0::DOUBLE AS u
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS n FROM s0),
s2 AS (SELECT *, [5, 2, 1][CAST(n % 3 AS INT) + 1] AS w FROM s1),
s3 AS (SELECT *, source_size::DOUBLE / w AS ratio FROM s2),
s4 AS (SELECT *,
         coalesce(sum(source_size) OVER (ORDER BY ratio, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY ratio, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
         sum(source_size) OVER () AS total FROM s3),
s5 AS (SELECT *, (1.5::DOUBLE * total::DOUBLE - 2.0::DOUBLE * capped::DOUBLE) / open_w::DOUBLE AS lv FROM s4),
lv AS (SELECT arg_min(lv, n2) AS level FROM (
         SELECT lv, row_number() OVER (ORDER BY ratio, n) AS n2 FROM s5
         WHERE lv <= 2.0::DOUBLE * source_size::DOUBLE / w::DOUBLE)),
goal AS (SELECT source, source_size, CASE WHEN level IS NULL THEN 2.0::DOUBLE * source_size
           ELSE least(2.0::DOUBLE * source_size::DOUBLE, level * w::DOUBLE) END AS target
         FROM s5 CROSS JOIN lv),
p AS (SELECT d.doc_id, d.source, d.size, d.u, g.source_size, g.target,
        CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS whole
      FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
r AS (SELECT *, greatest(0.0::DOUBLE, target - whole * source_size) AS open,
        sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM p),
x AS (SELECT *, CASE WHEN open > 0 AND size > 0 AND upto - size / 2.0::DOUBLE <= open THEN 1 ELSE 0 END AS extra FROM r),
g AS (SELECT *, target - sum(CASE WHEN size > 0 THEN (whole + extra) * size ELSE 0 END) OVER (PARTITION BY source) AS gap
      FROM x),
m AS (SELECT *, open > 0 AND size > 0 AND extra = CASE WHEN gap > 0 THEN 0 ELSE 1 END
             AND abs(abs(gap) - size) < abs(gap) AS movable FROM g),
b AS (SELECT source, min({'a': abs(abs(gap) - size), 'u': u, 'i': doc_id, 's': size}) AS b FROM m WHERE movable GROUP BY source)
SELECT m.doc_id, m.size, m.source_size, m.target,
       CAST(CASE WHEN m.size > 0 THEN (whole + CASE WHEN movable AND u = b.b.u AND doc_id IS NOT DISTINCT FROM b.b.i
         AND m.size = b.b.s THEN 1 - extra ELSE extra END) * m.size ELSE 0 END AS BIGINT) AS taken
FROM m LEFT JOIN b ON m.source IS NOT DISTINCT FROM b.source""",
    "op6_top_products": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
