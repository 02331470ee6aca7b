"""DuckDB twins of the funnel stages, as CTE bodies.

``with_stages(body)`` prefixes a query body with the fixture views and every
stage below (DuckDB drops the CTEs a query does not use).  Literal numbers
are cast to DOUBLE so DuckDB's decimal literals never change a result type.
The split is the default one: base 2024-01-30, test = 8 days, train = 22.
"""

from __future__ import annotations

from reelpath.sources.fixtures import fixture_ctes

TRAIN_FROM, TRAIN_TO = "DATE '2024-01-01'", "DATE '2024-01-22'"
TEST_FROM, TEST_TO = "DATE '2024-01-23'", "DATE '2024-01-30'"
BASE = "DATE '2024-01-30'"

_DECAY = (f"CAST(1.0 AS DOUBLE) - CAST(0.5 AS DOUBLE) * "
          f"((date_diff('day', day, {BASE}) - 8) / CAST(21 AS DOUBLE))")

STAGES: dict[str, str] = {
    # ---- S1 + C3 + J1 on playtime and clicks
    "pt_train0": f"""SELECT userId, item_id, total_play_time_sec, day,
                            date_diff('day', day, {BASE}) AS days_ago, {_DECAY} AS decay_factor
                     FROM playtime WHERE day BETWEEN {TRAIN_FROM} AND {TRAIN_TO}""",
    "pt_test0": f"""SELECT userId, item_id, total_play_time_sec, day, CAST(1.0 AS DOUBLE) AS decay_factor
                    FROM playtime WHERE day BETWEEN {TEST_FROM} AND {TEST_TO}""",
    "pt_train": "SELECT * FROM pt_train0 WHERE userId IN (SELECT userId FROM pt_test0)",
    "pt_test": "SELECT * FROM pt_test0 WHERE userId IN (SELECT userId FROM pt_train0)",
    "ck_train0": f"""SELECT userId, item_id, quality_click_flag, day,
                            date_diff('day', day, {BASE}) AS days_ago, {_DECAY} AS decay_factor
                     FROM clicks WHERE day BETWEEN {TRAIN_FROM} AND {TRAIN_TO}""",
    "ck_test0": f"""SELECT userId, item_id, quality_click_flag, day, CAST(1.0 AS DOUBLE) AS decay_factor
                    FROM clicks WHERE day BETWEEN {TEST_FROM} AND {TEST_TO}""",
    "ck_train": "SELECT * FROM ck_train0 WHERE userId IN (SELECT userId FROM ck_test0)",
    "ck_test": "SELECT * FROM ck_test0 WHERE userId IN (SELECT userId FROM ck_train0)",
    # ---- A1 + F3
    "pt_stats": """SELECT * FROM (
                     SELECT userId, item_id, (round((sum(total_play_time_sec)) * 1e6) / 1e6) AS total_playtime_combined,
                            max(decay_factor) AS recent_decay_factor
                     FROM pt_train GROUP BY userId, item_id)
                   WHERE total_playtime_combined IS NOT NULL AND NOT isnan(total_playtime_combined)""",
    "pt_test_stats": """SELECT * FROM (
                     SELECT userId, item_id, (round((sum(total_play_time_sec)) * 1e6) / 1e6) AS total_playtime_combined,
                            max(decay_factor) AS recent_decay_factor
                     FROM pt_test GROUP BY userId, item_id)
                   WHERE total_playtime_combined IS NOT NULL AND NOT isnan(total_playtime_combined)""",
    # ---- F13 + W3 + C1
    "labels": """SELECT userId, item_id, recent_decay_factor,
                        CAST(CASE WHEN pr <= 0.2 THEN 0.2 WHEN pr <= 0.4 THEN 1.0 WHEN pr <= 0.6 THEN 2.0
                                  WHEN pr <= 0.8 THEN 3.0 ELSE 4.0 END AS DOUBLE) AS confidence
                 FROM (SELECT *, percent_rank() OVER (PARTITION BY item_id
                                                      ORDER BY total_playtime_combined) AS pr
                       FROM (SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM pt_stats)
                       WHERE n >= 5)""",
    # ---- C5 + C6 + F6 + F7
    "ck_sig": """SELECT userId, item_id, max(decay_factor) AS recent_decay_factor,
                        CAST(2.0 AS DOUBLE) AS confidence
                 FROM ck_train WHERE quality_click_flag = 1 GROUP BY userId, item_id""",
    "merged_train": """SELECT userId, item_id, max(confidence) AS confidence,
                              max(recent_decay_factor) AS recent_decay_factor
                       FROM (SELECT userId, item_id, confidence, recent_decay_factor FROM labels
                             UNION ALL
                             SELECT userId, item_id, confidence, recent_decay_factor FROM ck_sig)
                       WHERE NOT contains(item_id, 'MATCH') AND NOT contains(item_id, 'HIGHLIGHTS')
                       GROUP BY userId, item_id""",
    "merged_test": """SELECT DISTINCT userId, item_id FROM (
                        SELECT userId, item_id FROM pt_test_stats
                        UNION ALL
                        SELECT userId, item_id FROM ck_test WHERE quality_click_flag = 1)
                      WHERE NOT contains(item_id, 'MATCH') AND NOT contains(item_id, 'HIGHLIGHTS')""",
    # ---- C4, C7, C8, J7, W1 + F11
    "decayed_train": """SELECT userId, item_id, confidence * recent_decay_factor AS confidence,
                               recent_decay_factor FROM merged_train""",
    "item_counts": "SELECT item_id, count(userId) AS user_count FROM decayed_train GROUP BY item_id",
    "popularity": """SELECT item_id, user_count,
                            CAST(round(CASE WHEN hi > lo
                                            THEN (user_count - lo) / (hi - lo) * CAST(99 AS DOUBLE) + CAST(1 AS DOUBLE)
                                            ELSE CAST(1 AS DOUBLE) END) AS INTEGER) AS popularity_score,
                            CAST(1 AS DOUBLE) / log10(user_count + CAST(10 AS DOUBLE)) AS popularity_penalty
                     FROM item_counts CROSS JOIN
                          (SELECT min(user_count) AS lo, max(user_count) AS hi FROM item_counts)""",
    "weighted_train": """SELECT d.userId, d.item_id, d.confidence * p.popularity_penalty AS confidence,
                                d.recent_decay_factor
                         FROM decayed_train d JOIN popularity p USING (item_id)""",
    "als_input": """SELECT w.*, c.distinct_content_count FROM weighted_train w
                    JOIN (SELECT userId, count(*) AS distinct_content_count FROM weighted_train
                          GROUP BY userId) c USING (userId)
                    WHERE c.distinct_content_count >= 3""",
    # ---- I2 + J3 + A20
    "user_lookup": """SELECT userId, CAST(row_number() OVER (ORDER BY userId) - 1 AS INTEGER) AS userIndex
                      FROM (SELECT DISTINCT userId FROM als_input)""",
    "item_lookup": """SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS itemIndex
                      FROM (SELECT DISTINCT item_id FROM als_input)""",
    "indexed_train": """SELECT u.userIndex, i.itemIndex, a.confidence FROM als_input a
                        JOIN user_lookup u USING (userId) JOIN item_lookup i USING (item_id)""",
    "indexed_test": """SELECT u.userIndex, i.itemIndex FROM merged_test t
                       JOIN user_lookup u USING (userId) JOIN item_lookup i USING (item_id)""",
    "truth": "SELECT DISTINCT userIndex, itemIndex FROM indexed_test",
    # ---- catalogue (F8)
    "metadata": """SELECT DISTINCT * FROM (
                     SELECT CAST(unnest(content_ids) AS VARCHAR) AS item_id, title,
                            CAST(OriginalLanguage AS VARCHAR) AS original_language, Genres
                     FROM catalogue_tv WHERE len(content_ids) > 0 AND published
                     UNION ALL
                     SELECT CAST(unnest(content_ids) AS VARCHAR) AS item_id, title,
                            CAST(OriginalLanguage AS VARCHAR) AS original_language, Genres
                     FROM catalogue_movie WHERE len(content_ids) > 0 AND published)""",
    # ---- 1 -> 1 item rules over (user, day) baskets of the train window
    "bk": f"""SELECT DISTINCT userId, day, item_id FROM interactions
              WHERE day BETWEEN {TRAIN_FROM} AND {TRAIN_TO}""",
    "bk_n": "SELECT count(*) AS n FROM (SELECT DISTINCT userId, day FROM bk)",
    "bk_items": "SELECT item_id, count(*) AS f FROM bk GROUP BY item_id",
    "bk_pairs": """SELECT a.item_id, b.item_id AS rec_item_id, count(*) AS f
                   FROM bk a JOIN bk b ON a.userId = b.userId AND a.day = b.day
                                      AND a.item_id <> b.item_id
                   GROUP BY 1, 2""",
    "rules11": """SELECT p.item_id, p.rec_item_id, p.f / a.f AS confidence,
                         (p.f / a.f) / (c.f / n.n) AS lift, p.f / n.n AS support
                  FROM bk_pairs p JOIN bk_items a ON a.item_id = p.item_id
                                  JOIN bk_items c ON c.item_id = p.rec_item_id
                                  CROSS JOIN bk_n n
                  WHERE p.f >= ceil(CAST(0.0005 AS DOUBLE) * n.n) AND p.f / a.f >= 0.01""",
    # ---- M8: similarity scores, seen removed, indexed, top k
    "sim_raw": """SELECT a.userId, r.rec_item_id,
                         (round((sum(r.confidence * a.recent_decay_factor)) * 1e9) / 1e9) AS total_score
                  FROM als_input a JOIN rules11 r USING (item_id) GROUP BY 1, 2""",
    "sim_scores": """SELECT * FROM sim_raw s WHERE NOT EXISTS (
                       SELECT 1 FROM als_input a WHERE a.userId = s.userId AND a.item_id = s.rec_item_id)""",
    "sim_indexed": """SELECT u.userIndex, i.itemIndex, s.total_score FROM sim_scores s
                      JOIN user_lookup u USING (userId) JOIN item_lookup i ON i.item_id = s.rec_item_id""",
    "sim_ranked": """SELECT *, row_number() OVER (PARTITION BY userIndex
                                                 ORDER BY total_score DESC, itemIndex) AS rank
                     FROM sim_indexed""",
    "sim_top15": "SELECT * FROM sim_ranked WHERE rank <= 15",
    "sim_top50": "SELECT * FROM sim_ranked WHERE rank <= 50",
    "sim_top5": "SELECT * FROM sim_ranked WHERE rank <= 5",
    "sim_raw_indexed": """SELECT u.userIndex, i.itemIndex, s.total_score FROM sim_raw s
                          JOIN user_lookup u USING (userId) JOIN item_lookup i ON i.item_id = s.rec_item_id""",
    "sim_raw_top30": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userIndex
                                                 ORDER BY total_score DESC, itemIndex) AS rank
                                      FROM sim_raw_indexed) WHERE rank <= 30""",
    "titles": "SELECT item_id, min(title) AS title, min(original_language) AS original_language FROM metadata GROUP BY item_id",
}


def metrics_cte(preds: str, k: int) -> str:
    """Per-user ranking metrics of ``preds`` (userIndex, itemIndex, rank) against ``truth``."""
    return f"""
      SELECT u.userIndex, t.n_actual, CAST(coalesce(h.hits, 0) AS BIGINT) AS hits,
             coalesce(h.hits, 0) / {k} AS precision_at_k,
             coalesce(h.hits, 0) / t.n_actual AS recall_at_k,
             coalesce(h.ps, 0) / t.n_actual AS ap
      FROM (SELECT DISTINCT userIndex FROM {preds} WHERE rank <= {k}) u
      JOIN (SELECT userIndex, count(*) AS n_actual FROM truth GROUP BY userIndex) t USING (userIndex)
      LEFT JOIN (SELECT userIndex, count(*) AS hits, sum(cum / rank) AS ps FROM (
                   SELECT p.userIndex, p.rank,
                          count(*) OVER (PARTITION BY p.userIndex ORDER BY p.rank
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
                   FROM {preds} p
                   WHERE p.rank <= {k} AND EXISTS (SELECT 1 FROM truth t
                                      WHERE t.userIndex = p.userIndex AND t.itemIndex = p.itemIndex))
                 GROUP BY userIndex) h USING (userIndex)"""


def with_stages(body: str, extra: dict[str, str] | None = None) -> str:
    """Full DuckDB query: fixtures, stages, optional extra CTEs, then ``body``."""
    parts = [fixture_ctes()]
    parts += [f"{k} AS ({v})" for k, v in STAGES.items()]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
