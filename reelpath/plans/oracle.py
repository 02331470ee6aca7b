"""DuckDB oracle SQL for the named queries (same column names and types)."""

from __future__ import annotations

from reelpath.plans.oracle_stages import metrics_cte, with_stages

_R = "(round(({0}) * 1e6) / 1e6) AS {0}"


def _r(*cols: str) -> str:
    return ", ".join(_R.format(c) for c in cols)


ORACLE_SQL: dict[str, str] = {
    "train_test_window": with_stages(f"""
        SELECT userId, item_id, day, {_r('total_play_time_sec', 'decay_factor')}, 'train' AS split
        FROM pt_train
        UNION ALL
        SELECT userId, item_id, day, {_r('total_play_time_sec', 'decay_factor')}, 'test' AS split
        FROM pt_test"""),
    "playtime_agg": with_stages(f"""
        SELECT userId, item_id, {_r('total_playtime_combined', 'recent_decay_factor')} FROM pt_stats"""),
    "confidence_labels": with_stages(f"""
        SELECT userId, item_id, {_r('recent_decay_factor', 'confidence')} FROM labels"""),
    "merged_signals": with_stages(f"""
        SELECT userId, item_id, {_r('confidence', 'recent_decay_factor')} FROM merged_train"""),
    "catalogue_items": with_stages("SELECT * FROM metadata"),
    "item_popularity": with_stages(f"""
        SELECT item_id, user_count, popularity_score, {_r('popularity_penalty')} FROM popularity"""),
    "penalised_confidence": with_stages(f"""
        SELECT userId, item_id, {_r('confidence', 'recent_decay_factor')} FROM weighted_train"""),
    "active_users": with_stages(f"""
        SELECT userId, item_id, {_r('confidence', 'recent_decay_factor')}, distinct_content_count
        FROM als_input"""),
    "user_index": with_stages("SELECT userId, userIndex FROM user_lookup"),
    "item_index": with_stages("SELECT item_id, itemIndex FROM item_lookup"),
    "indexed_train": with_stages(f"""
        SELECT userIndex, itemIndex, {_r('confidence')} FROM indexed_train"""),
    "ground_truth": with_stages("""
        SELECT userIndex, CAST(count(*) AS INTEGER) AS n_items,
               array_to_string(list_sort(list(itemIndex)), ',') AS actual_items
        FROM truth GROUP BY userIndex"""),
}

ORACLE_SQL["funnel_stages"] = with_stages(" UNION ALL ".join(
    f"SELECT '{name}' AS stage, count(*) AS n_rows, count(DISTINCT userId) AS users, count(DISTINCT item_id) AS items FROM {cte}"
    for name, cte in (("pairs", "pt_stats"), ("labels", "labels"), ("merged", "merged_train"), ("weighted", "weighted_train"),
                      ("active", "als_input"), ("test", "merged_test"))))

_ALL_TYPES = "('MOVIE', 'EPISODE', 'VIDEO', 'TVSHOW', 'SEASON')"
_GROUP = """CASE WHEN lower(content_content_type) IN ('episode', 'tvshow', 'tv show', 'tv_shows')
                 THEN 'tv_show'
                 WHEN lower(content_content_type) IN ('movie', 'film') THEN 'movie'
                 ELSE 'other' END"""
_SPP = f"""SELECT userId, content_id, duration_secs, content_content_type,
                  (round((sum(total_play_time_sec)) * 1e6) / 1e6) AS total_playtime_combined,
                  count(*) AS num_sessions
           FROM consumption WHERE content_content_type IN {_ALL_TYPES}
           GROUP BY userId, content_id, duration_secs, content_content_type"""
_PER_USER = "SELECT userId, count(DISTINCT item_id) AS distinct_content_count FROM playtime GROUP BY userId"


def _hist(expr: str, scale: str) -> str:
    return f"""SELECT '{scale}' AS scale,
                  CAST(CASE WHEN hi > lo THEN least(floor((v - lo) / (hi - lo) * 50), 49) ELSE 0 END
                       AS INTEGER) AS bin,
                  count(*) AS n
           FROM (SELECT {expr} AS v FROM playtime) x
                CROSS JOIN (SELECT min({expr}) AS lo, max({expr}) AS hi FROM playtime
                            WHERE total_play_time_sec IS NOT NULL AND NOT isnan(total_play_time_sec))
           WHERE v IS NOT NULL AND NOT isnan(v)
           GROUP BY 1, 2"""


_thr_ge = ", ".join(f"CAST(count_if(distinct_content_count >= {t}) AS BIGINT) AS users_ge_{t}"
                    for t in (1, 2, 3, 5, 10, 20, 50, 100))
_thr_eq = ", ".join(f"CAST(count_if(distinct_content_count = {t}) AS BIGINT) AS users_eq_{t}"
                    for t in (1, 2, 3, 5, 10, 20))
_QS = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
_FQS = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)


def _qcols(col: str, qs=_FQS) -> str:
    def name(q):
        return f"p{int(round(q * 100)):02d}" if q < 1 else "p100"
    return ", ".join(f"quantile_disc({col}, {q}) AS {name(q)}" for q in qs)


ORACLE_SQL.update({
    "sessions_per_pair": with_stages(f"""
        SELECT userId, content_id, (round((duration_secs) * 1e6) / 1e6) AS duration_secs, content_content_type,
               (round((total_playtime_combined) * 1e6) / 1e6) AS total_playtime_combined, num_sessions
        FROM ({_SPP})"""),
    "repeat_watchers": with_stages("""
        SELECT userId, item_id, count(*) AS watch_count FROM playtime
        GROUP BY userId, item_id HAVING count(*) > 1"""),
    "completion_ratings": with_stages(f"""
        SELECT userId, item_id, content_content_type,
               (round((tp) * 1e6) / 1e6) AS total_playtime_combined, (round((td) * 1e6) / 1e6) AS total_duration_combined,
               (round((tp / NULLIF(td, 0)) * 1e6) / 1e6) AS completion_rate,
               CAST(CASE WHEN content_content_type IN ('MOVIE', 'EPISODE') THEN
                      CASE WHEN tp / NULLIF(td, 0) >= 0.8 THEN 4 WHEN tp / NULLIF(td, 0) >= 0.6 THEN 3
                           WHEN tp / NULLIF(td, 0) >= 0.4 THEN 2 WHEN tp / NULLIF(td, 0) >= 0.2 THEN 1
                           ELSE 0 END
                    ELSE 0 END AS INTEGER) AS rating_label_custom
        FROM (SELECT userId, item_id, content_content_type,
                     (round((sum(least(total_playtime_combined, duration_secs))) * 1e6) / 1e6) AS tp,
                     (round((sum(duration_secs)) * 1e6) / 1e6) AS td
              FROM ({_SPP}) c LEFT JOIN parent_map p USING (content_id)
              WHERE content_content_type IN ('MOVIE', 'EPISODE') AND total_playtime_combined > 300
              GROUP BY userId, item_id, content_content_type)"""),
    "zscore_likes": with_stages(f"""
        SELECT userId, content_id, (round((z) * 1e6) / 1e6) AS playtime_z_user,
               CASE WHEN z > 1 THEN 1 ELSE 0 END AS user_likes
        FROM (SELECT s.userId, s.content_id,
                     (s.total_playtime_combined - m.user_mean) / NULLIF(m.user_std, 0) AS z
              FROM ({_SPP}) s JOIN (SELECT userId, avg(total_playtime_combined) AS user_mean,
                                           stddev_samp(total_playtime_combined) AS user_std
                                    FROM ({_SPP}) GROUP BY userId) m USING (userId))"""),
    "content_type_mix": with_stages(f"""
        SELECT a.type_group, a.n_rows, a.n_pairs, (round((a.total_watch) * 1e2) / 1e2) AS total_watch,
               (round((b.mean_user_watch) * 1e6) / 1e6) AS mean_user_watch, b.users
        FROM (SELECT {_GROUP} AS type_group, count(*) AS n_rows,
                     count(DISTINCT (userId, content_id)) AS n_pairs,
                     sum(total_play_time_sec) AS total_watch
              FROM consumption GROUP BY 1) a
        JOIN (SELECT type_group, avg(w) AS mean_user_watch, count(*) AS users
              FROM (SELECT {_GROUP} AS type_group, userId, sum(total_play_time_sec) AS w
                    FROM consumption GROUP BY 1, 2) GROUP BY 1) b USING (type_group)"""),
    "dominant_type": with_stages(f"""
        SELECT dominant_type, count(*) AS users FROM (
          SELECT userId, min(type_group) AS dominant_type FROM (
            SELECT userId, type_group, w, max(w) OVER (PARTITION BY userId) AS mw FROM (
              SELECT userId, {_GROUP} AS type_group, (round((sum(total_play_time_sec)) * 1e6) / 1e6) AS w
              FROM consumption GROUP BY 1, 2))
          WHERE w = mw GROUP BY userId)
        GROUP BY dominant_type"""),
    "items_per_user_hist": with_stages(f"""
        SELECT distinct_content_count, count(*) AS users FROM ({_PER_USER})
        GROUP BY distinct_content_count"""),
    "user_thresholds": with_stages(f"SELECT {_thr_ge}, {_thr_eq} FROM ({_PER_USER})"),
    "watch_quantiles": with_stages(" UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS quantile, (round((quantile_disc(watch_time, {q})) * 1e6) / 1e6) AS value "
        f"FROM wt" for q in _QS),
        {"wt": """SELECT userId, (round((sum(total_play_time_sec)) * 1e6) / 1e6) AS watch_time FROM playtime
                  GROUP BY userId HAVING (round((sum(total_play_time_sec)) * 1e6) / 1e6) > 0"""}),
    "shared_sessions": with_stages("""
        SELECT user_session_id, count(DISTINCT userId) AS n_users FROM consumption
        GROUP BY user_session_id HAVING count(DISTINCT userId) > 1"""),
    "multi_row_users": with_stages("""
        SELECT userId, count(*) AS n_rows FROM consumption GROUP BY userId HAVING count(*) > 1"""),
    "id_audit": with_stages("""
        SELECT (SELECT count(*) FROM playtime) AS n_rows,
               (SELECT count(DISTINCT (userId, item_id)) FROM playtime) AS n_pairs,
               (SELECT count(DISTINCT userId) FROM playtime WHERE day = DATE '2024-01-30') AS day_keys,
               (SELECT count(DISTINCT userId) FROM playtime
                WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-22') AS window_keys,
               (SELECT count(*) FROM (SELECT userId FROM playtime WHERE day = DATE '2024-01-30'
                                      INTERSECT
                                      SELECT userId FROM playtime
                                      WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-22')) AS both_keys"""),
    "playtime_histogram": with_stages(
        _hist("total_play_time_sec", "raw") + "\nUNION ALL\n"
        + _hist("ln(1 + total_play_time_sec)", "log1p")),
    "column_profile": with_stages(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n "
        f"FROM search_events GROUP BY 2" for c in
        ["events_meta_action", "events_meta_source_name", "events_appid",
         "events_meta_asset_name", "eventtype", "events_os", "events_dt"])),
    "overlap_distribution": with_stages("""
        SELECT overlap, count(*) AS users FROM (
          SELECT u.userId, CAST(coalesce(h.overlap, 0) AS BIGINT) AS overlap
          FROM (SELECT DISTINCT userId FROM pt_train INTERSECT SELECT DISTINCT userId FROM pt_test) u
          LEFT JOIN (SELECT userId, count(*) AS overlap FROM
                       (SELECT DISTINCT userId, item_id FROM pt_train
                        INTERSECT SELECT DISTINCT userId, item_id FROM pt_test) GROUP BY userId) h
          USING (userId))
        GROUP BY overlap"""),
    "clean_consumption": with_stages(f"""
        SELECT (SELECT count(*) FROM consumption WHERE content_content_type IN {_ALL_TYPES}
                AND total_play_time_sec > 300) AS kept_rows,
               CAST(count_if(userId IS NULL) AS BIGINT) AS null_users,
               CAST(count_if(total_play_time_sec > 86400) AS BIGINT) AS outlier_rows,
               CAST(count_if(total_play_time_sec > duration_secs) AS BIGINT) AS over_duration_rows
        FROM consumption"""),
    "valid_users": with_stages("""
        SELECT userId, content_id, user_session_id, total_play_time_sec FROM (
          SELECT userId, content_id, user_session_id,
                 coalesce(total_play_time_sec, 0) AS total_play_time_sec,
                 row_number() OVER (PARTITION BY userId, content_id
                                    ORDER BY user_session_id, coalesce(total_play_time_sec, 0)) AS rn
          FROM consumption WHERE userId IS NOT NULL AND trim(userId) <> '' AND content_id IS NOT NULL)
        WHERE rn = 1"""),
    "decayed_playtime": with_stages("""
        SELECT * FROM (
          SELECT userId, item_id, (round((sum(total_play_time_sec * decay_factor)) * 1e6) / 1e6) AS decayed_playtime,
                 (round((max(decay_factor)) * 1e6) / 1e6) AS recent_decay_factor
          FROM pt_train GROUP BY userId, item_id)
        WHERE decayed_playtime IS NOT NULL AND NOT isnan(decayed_playtime)"""),
    "log_weights": with_stages("""
        SELECT userId, item_id, (round((total_playtime_combined) * 1e6) / 1e6) AS total_playtime_combined,
               (round((ln(1 + total_playtime_combined)) * 1e6) / 1e6) AS log_playtime FROM pt_stats"""),
    "idf_weights": with_stages("""
        SELECT item_id, item_users, total_users,
               (round((ln((total_users + 1) / (item_users + 1))) * 1e6) / 1e6) AS idf
        FROM (SELECT item_id, count(DISTINCT userId) AS item_users FROM merged_train GROUP BY item_id)
             CROSS JOIN (SELECT count(DISTINCT userId) AS total_users FROM merged_train)"""),
    "p95_capped_users": with_stages("""
        SELECT w.userId, w.item_id, (round((w.confidence) * 1e6) / 1e6) AS confidence, c.distinct_content_count
        FROM weighted_train w
        JOIN (SELECT userId, count(*) AS distinct_content_count FROM weighted_train GROUP BY userId) c
          USING (userId)
        CROSS JOIN (SELECT quantile_disc(n, 0.95) AS cap FROM
                      (SELECT userId, count(*) AS n FROM weighted_train GROUP BY userId))
        WHERE c.distinct_content_count >= 3 AND c.distinct_content_count <= cap"""),
    "custom_users": with_stages("""
        SELECT userId, item_id, (round((max(confidence)) * 1e6) / 1e6) AS confidence,
               (round((max(recent_decay_factor)) * 1e6) / 1e6) AS recent_decay_factor
        FROM (SELECT userId, item_id, confidence, recent_decay_factor FROM merged_train
              UNION ALL
              SELECT * FROM (VALUES ('persona_a', '1', 4.0::DOUBLE, 1.0::DOUBLE),
                                    ('persona_a', '2', 4.0::DOUBLE, 1.0::DOUBLE),
                                    ('persona_a', '3', 4.0::DOUBLE, 1.0::DOUBLE),
                                    ('persona_b', '4', 4.0::DOUBLE, 1.0::DOUBLE),
                                    ('persona_b', '5', 4.0::DOUBLE, 1.0::DOUBLE),
                                    ('1', '1', 4.0::DOUBLE, 1.0::DOUBLE),
                                    ('1', '5', 4.0::DOUBLE, 1.0::DOUBLE))
                       AS t(userId, item_id, confidence, recent_decay_factor))
        GROUP BY userId, item_id"""),
    "leak_scrubbed_test": with_stages("""
        SELECT userId, item_id FROM merged_test
        EXCEPT ALL SELECT t.userId, t.item_id FROM merged_test t
        JOIN merged_train m USING (userId, item_id)"""),
    "signal_bounds": with_stages("""
        SELECT (round((min(confidence)) * 1e6) / 1e6) AS min_value, (round((max(confidence)) * 1e6) / 1e6) AS max_value,
               (round((avg(confidence)) * 1e6) / 1e6) AS mean_value, (round((stddev_samp(confidence)) * 1e6) / 1e6) AS stddev_value,
               count(*) AS n_rows, CAST(count_if(confidence <= 0.1) AS BIGINT) AS n_le_0_1,
               CAST(count_if(confidence >= 3.0) AS BIGINT) AS n_ge_3
        FROM weighted_train"""),
    "funnel_shape": with_stages("""
        SELECT cells, users, items,
               (round((CASE WHEN users * items > 0 THEN (1 - cells / (users * items)) * 100
                          ELSE 100 END) * 1e6) / 1e6) AS sparsity_pct,
               (round((CASE WHEN items > 0 THEN users / items ELSE 0 END) * 1e6) / 1e6) AS users_per_item
        FROM (SELECT count(*) AS cells, count(DISTINCT userIndex) AS users,
                     count(DISTINCT itemIndex) AS items FROM indexed_train)"""),
    "funnel_users": with_stages(f"""
        SELECT {_qcols('u_count')},
               CAST(count_if(u_count = 1) AS BIGINT) AS single_item_users, CAST(count_if(u_count < 5) AS BIGINT) AS cold_users,
               count(*) AS users,
               (round((max(u_count) / (SELECT count(DISTINCT itemIndex) FROM indexed_train) * 100) * 1e6) / 1e6)
                   AS max_user_catalogue_pct
        FROM (SELECT userIndex, count(*) AS u_count FROM indexed_train GROUP BY userIndex)"""),
    "funnel_items": with_stages(f"""
        SELECT q.*, s.single_user_items, s.cold_items,
               (round((s.top) * 1e6) / 1e6) AS top10_traffic_pct, (round((s.bottom) * 1e6) / 1e6) AS bottom50_traffic_pct
        FROM (SELECT {_qcols('i_count')} FROM ic) q
        CROSS JOIN (SELECT CAST(count_if(i_count = 1) AS BIGINT) AS single_user_items,
                           CAST(count_if(i_count < 5) AS BIGINT) AS cold_items,
                           coalesce(sum(CASE WHEN i_count >= p90 THEN i_count END), 0)
                               / sum(i_count) * 100 AS top,
                           coalesce(sum(CASE WHEN i_count <= p50 THEN i_count END), 0)
                               / sum(i_count) * 100 AS bottom
                    FROM ic CROSS JOIN (SELECT quantile_disc(i_count, 0.9) AS p90,
                                               quantile_disc(i_count, 0.5) AS p50 FROM ic)) s""",
        {"ic": "SELECT itemIndex, count(*) AS i_count FROM indexed_train GROUP BY itemIndex"}),
    "funnel_signal": with_stages("""
        SELECT (round((min(confidence)) * 1e6) / 1e6) AS min_value, (round((max(confidence)) * 1e6) / 1e6) AS max_value,
               (round((avg(confidence)) * 1e6) / 1e6) AS mean_value, (round((stddev_samp(confidence)) * 1e6) / 1e6) AS stddev_value,
               count(*) AS n_rows, CAST(count_if(confidence <= 0.1) AS BIGINT) AS n_le_0_1,
               CAST(count_if(confidence >= 3.0) AS BIGINT) AS n_ge_3,
               (round((CAST(count_if(confidence <= 0.1) AS BIGINT) / count(*) * 100) * 1e6) / 1e6) AS pct_le_0_1,
               (round((CAST(count_if(confidence >= 3.0) AS BIGINT) / count(*) * 100) * 1e6) / 1e6) AS pct_ge_3
        FROM indexed_train"""),
    "confidence_spread": with_stages("""
        SELECT conf_rounded, n, (round((n / (SELECT count(*) FROM indexed_train) * 100) * 1e6) / 1e6) AS pct
        FROM (SELECT (round((confidence) * 1e1) / 1e1) AS conf_rounded, count(*) AS n FROM indexed_train GROUP BY 1
              ORDER BY n DESC, conf_rounded LIMIT 15)"""),
    "string_indexed": with_stages("""
        SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_label,
               CAST(row_number() OVER (ORDER BY n DESC, item_id) - 1 AS INTEGER) AS frequency_label
        FROM (SELECT item_id, count(*) AS n FROM playtime WHERE item_id IS NOT NULL GROUP BY item_id)"""),
})


def _freq_pct() -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS quantile, (round((quantile_disc(s, {q})) * 1e6) / 1e6) AS value FROM fs"
        for q in _QS)


_FS = {"fc": "SELECT itemIndex, count(*) AS t FROM sim_top50 GROUP BY itemIndex",
       "fs": """SELECT itemIndex, CASE WHEN hi > lo THEN (t - lo) / (hi - lo) * CAST(99 AS DOUBLE) + 1
                                  ELSE CAST(1 AS DOUBLE) END AS s
                FROM fc CROSS JOIN (SELECT min(t) AS lo, max(t) AS hi FROM fc)"""}

_COVER = """SELECT count(*) AS total_items, CAST(count_if(t > 0) AS BIGINT) AS covered_items,
                   (round((CASE WHEN count(*) > 0 THEN CAST(count_if(t > 0) AS BIGINT) / count(*) ELSE 0 END) * 1e6) / 1e6) AS coverage,
                   {k} AS k
            FROM (SELECT l.itemIndex, coalesce(c.t, 0) AS t FROM item_lookup l
                  LEFT JOIN (SELECT itemIndex, count(*) AS t FROM {src} GROUP BY itemIndex) c USING (itemIndex))"""

_SKEW_Q = (0.5, 0.9, 0.95, 0.99, 1.0)


def _popq(metric: str, expr: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS quantile, (round((quantile_disc({expr}, {q})) * 1e6) / 1e6) AS value, "
        f"'{metric}' AS metric FROM popularity WHERE popularity_score > 0" for q in _QS)


ORACLE_SQL.update({
    "similarity_recs": with_stages("""
        SELECT userIndex, itemIndex, CAST(rank AS INTEGER) AS rank, (round((total_score) * 1e6) / 1e6) AS total_score
        FROM sim_top15"""),
    "ranking_metrics": with_stages("""
        SELECT count(*) AS users, (round((avg(precision_at_k)) * 1e6) / 1e6) AS precision_at_k,
               (round((avg(recall_at_k)) * 1e6) / 1e6) AS recall_at_k, (round((avg(ap)) * 1e6) / 1e6) AS map FROM pm""",
        {"pm": metrics_cte("sim_top15", 15)}),
    "cohort_metrics": with_stages("""
        SELECT cohort, count(*) AS users, (round((avg(ap)) * 1e6) / 1e6) AS map, (round((avg(recall_at_k)) * 1e6) / 1e6) AS recall_at_k,
               (round((avg(precision_at_k)) * 1e6) / 1e6) AS precision_at_k
        FROM (SELECT *, CASE WHEN n_actual <= 3 THEN '1-3' WHEN n_actual <= 10 THEN '4-10' ELSE '>10' END
                        AS cohort FROM pm) GROUP BY cohort
        UNION ALL
        SELECT 'all', count(*), (round((avg(ap)) * 1e6) / 1e6), (round((avg(recall_at_k)) * 1e6) / 1e6), (round((avg(precision_at_k)) * 1e6) / 1e6)
        FROM pm""", {"sim_top30": "SELECT * FROM sim_ranked WHERE rank <= 30", "pm": metrics_cte("sim_top30", 30)}),
    "catalogue_coverage": with_stages(_COVER.format(k=15, src="sim_top15") + " UNION ALL "
                                      + _COVER.format(k=50, src="sim_top50")),
    "frequency_scores": with_stages(_freq_pct(), _FS),
    "top10_domination": with_stages("""
        SELECT t.itemIndex, t.times_recommended,
               (round((t.times_recommended / s.slots * 100) * 1e6) / 1e6) AS slot_pct,
               (round((s.top / s.slots * 100) * 1e6) / 1e6) AS top_n_pct, l.item_id, ti.title
        FROM tt t CROSS JOIN (SELECT (SELECT count(*) FROM sim_top15) AS slots,
                                     (SELECT sum(times_recommended) FROM tt) AS top) s
        JOIN item_lookup l USING (itemIndex) LEFT JOIN titles ti USING (item_id)""",
        {"tt": """SELECT itemIndex, count(*) AS times_recommended FROM sim_top15 GROUP BY itemIndex
                  ORDER BY times_recommended DESC, itemIndex LIMIT 10"""}),
    "output_skew": with_stages(f"""
        SELECT b.users, b.total_recs, c.unique_items, c.catalogue_items,
               {", ".join(f"q.p{int(round(q * 100)):02d}" if q < 1 else "q.p100" for q in _SKEW_Q)},
               (round((c.unique_items / c.catalogue_items * 100) * 1e6) / 1e6) AS coverage_pct,
               (round((x.top / b.total_recs * 100) * 1e6) / 1e6) AS top1_slot_pct,
               x.top / b.total_recs * 100 > 30 AS collapse_alarm
        FROM (SELECT count(DISTINCT userIndex) AS users, count(*) AS total_recs FROM sim_top15) b
        CROSS JOIN (SELECT (SELECT count(*) FROM rc) AS unique_items,
                           (SELECT count(DISTINCT itemIndex) FROM item_lookup) AS catalogue_items) c
        CROSS JOIN (SELECT {_qcols('t', _SKEW_Q)} FROM rc) q
        CROSS JOIN (SELECT coalesce(sum(CASE WHEN t >= p99 THEN t END), 0) AS top
                    FROM rc CROSS JOIN (SELECT quantile_disc(t, 0.99) AS p99 FROM rc)) x""",
        {"rc": "SELECT itemIndex, count(*) AS t FROM sim_top15 GROUP BY itemIndex"}),
    "popularity_amplification": with_stages("""
        SELECT (round((sum(t * coalesce(p.popularity_score, 1)) / sum(t)) * 1e6) / 1e6) AS avg_popularity_score,
               sum(t * coalesce(p.popularity_score, 1)) / sum(t) > 75 AS amplification_alarm
        FROM (SELECT itemIndex, count(*) AS t FROM sim_top15 GROUP BY itemIndex) r
        LEFT JOIN (SELECT l.itemIndex, p.popularity_score FROM popularity p JOIN item_lookup l USING (item_id)) p
        USING (itemIndex)"""),
    "resurrection": with_stages("""
        SELECT niche_items, niche_recommended,
               (round((CASE WHEN niche_items > 0 THEN niche_recommended / niche_items * 100 ELSE 0 END) * 1e6) / 1e6)
                   AS resurrection_pct
        FROM (SELECT count(*) AS niche_items,
                     CAST(count_if(itemIndex IN (SELECT itemIndex FROM sim_top15)) AS BIGINT) AS niche_recommended
              FROM tc WHERE n <= (SELECT quantile_disc(n, 0.5) FROM tc))""",
        {"tc": "SELECT itemIndex, count(*) AS n FROM indexed_train GROUP BY itemIndex"}),
    "popularity_percentiles": with_stages(
        _popq("popularity_score", "CAST(popularity_score AS DOUBLE)") + " UNION ALL "
        + _popq("user_count", "CAST(user_count AS DOUBLE)") + " UNION ALL "
        + _popq("popularity_penalty", "popularity_penalty")),
    "evaluated_users": with_stages("""
        SELECT p.userIndex, p.n_predicted, t.n_actual
        FROM (SELECT userIndex, count(*) AS n_predicted FROM sim_top15 GROUP BY userIndex) p
        JOIN (SELECT userIndex, count(*) AS n_actual FROM truth
              WHERE userIndex IN (SELECT userIndex FROM indexed_train) GROUP BY userIndex) t
        USING (userIndex)"""),
    "top_watched": with_stages("""
        SELECT userId, item_id, CAST(rank_watched AS INTEGER) AS rank_watched,
               (round((total_playtime_combined) * 1e6) / 1e6) AS total_playtime_combined
        FROM (SELECT *, row_number() OVER (PARTITION BY userId
                                           ORDER BY total_playtime_combined DESC, item_id) AS rank_watched
              FROM pt_stats) WHERE rank_watched <= 5"""),
    "watched_vs_recommended": with_stages("""
        SELECT w.userId, CAST(w.rank_watched AS INTEGER) AS rank_watched, w.item_id AS watched_item,
               r.item_id AS recommended_item
        FROM (SELECT *, row_number() OVER (PARTITION BY userId
                                           ORDER BY total_playtime_combined DESC, item_id) AS rank_watched
              FROM pt_stats) w
        JOIN (SELECT u.userId, i.item_id, s.rank FROM sim_top5 s JOIN user_lookup u USING (userIndex)
              JOIN item_lookup i USING (itemIndex)) r
          ON w.userId = r.userId AND w.rank_watched = r.rank
        WHERE w.rank_watched <= 5"""),
    "seen_excluded": with_stages(_NOVEL := """
        SELECT userIndex, itemIndex, CAST(row_number() OVER (PARTITION BY userIndex ORDER BY rank) AS INTEGER) AS rank
        FROM sim_raw_top30 s
        WHERE NOT EXISTS (SELECT 1 FROM indexed_train t WHERE t.userIndex = s.userIndex
                                                           AND t.itemIndex = s.itemIndex)
        QUALIFY row_number() OVER (PARTITION BY userIndex ORDER BY rank) <= 15"""),
    "novel_by_arrays": with_stages(_NOVEL),
    "titled_recs": with_stages("""
        SELECT u.userId, i.item_id, ti.title, (round((s.total_score) * 1e6) / 1e6) AS total_score,
               CAST(s.rank AS INTEGER) AS rank
        FROM sim_top15 s JOIN user_lookup u USING (userIndex) JOIN item_lookup i USING (itemIndex)
        LEFT JOIN titles ti USING (item_id)"""),
    "qualified_user": with_stages("""
        SELECT userId, count(item_id) AS distinct_content_count FROM merged_train GROUP BY userId
        HAVING count(item_id) >= 3 ORDER BY md5('42:' || userId), userId LIMIT 1"""),
    "user_recs": with_stages("""
        SELECT userId, CAST(row_number() OVER (PARTITION BY userId ORDER BY popularity_score DESC NULLS LAST, rank)
                            AS INTEGER) AS position, item_id, title, original_language, popularity_score,
               CAST(rank AS INTEGER) AS rank, (round((total_score) * 1e6) / 1e6) AS total_score
        FROM (SELECT u.userId, i.item_id, ti.title, ti.original_language, p.popularity_score, s.rank, s.total_score
              FROM sim_top15 s JOIN user_lookup u USING (userIndex) JOIN item_lookup i USING (itemIndex)
              LEFT JOIN titles ti USING (item_id) LEFT JOIN popularity p USING (item_id)
              WHERE u.userId = (SELECT userId FROM merged_train GROUP BY userId HAVING count(item_id) >= 3
                                ORDER BY md5('42:' || userId), userId LIMIT 1))"""),
    "user_history": with_stages("""
        SELECT userId, CAST(row_number() OVER (PARTITION BY userId ORDER BY confidence DESC NULLS LAST, item_id)
                            AS INTEGER) AS position, item_id, title, (round((confidence) * 1e6) / 1e6) AS confidence
        FROM merged_train LEFT JOIN titles USING (item_id)
        WHERE userId = (SELECT userId FROM merged_train GROUP BY userId HAVING count(item_id) >= 3
                        ORDER BY md5('42:' || userId), userId LIMIT 1)"""),
})


_ACTIONS = ("('search_input', 'text_input', 'voice_search', 'search_click', 'voice search', "
            "'search_result_consumed', 'tab_click', 'tile_click', 'banner_cta_click', "
            "'item_search', 'autosuggest_click')")
SEARCH = {
    "se_dist": f"""SELECT DISTINCT * FROM search_events
                   WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
                     AND events_meta_search_session_id IS NOT NULL""",
    "idm": """SELECT temp_uid, day AS um_day, min(reg_uid) AS reg_uid FROM identity_map
              WHERE temp_uid IS NOT NULL GROUP BY temp_uid, day""",
    "resolved": f"""SELECT e.* EXCLUDE (events_uid), coalesce(i.reg_uid, e.events_uid) AS uid
                    FROM se_dist e LEFT JOIN idm i ON e.events_uid = i.temp_uid AND e.day = i.um_day
                    WHERE e.events_meta_action IN {_ACTIONS}""",
    "flagged": """SELECT *,
          CASE WHEN (events_meta_action IN ('tile_click', 'banner_cta_click')
                     AND events_meta_source_name IN ('search_page', 'searchLayout'))
                    OR events_meta_action = 'search_result_consumed' THEN 1 ELSE 0 END AS consumption,
          CASE WHEN events_meta_action IN ('search_input', 'text_input', 'voice_search', 'search_click',
                                           'voice search')
                    OR (events_meta_action = 'tab_click' AND lower(events_meta_asset_name) = 'search'
                        AND lower(events_appid) = 'largescreen') THEN 1 ELSE 0 END AS session,
          CASE WHEN events_meta_action IN ('item_search', 'autosuggest_click')
                    AND events_meta_asset_name IN ('autosuggest', 'auto_suggestion')
                    AND eventtype = 'click' THEN 1 ELSE 0 END AS autosuggest
        FROM resolved""",
    "sess_rows": """SELECT * FROM flagged WHERE session = 1 AND uid IS NOT NULL AND uid <> ''
                    AND lower(uid) <> 'nan' AND events_meta_keyword IS NOT NULL""",
    "sess_kw": """SELECT events_meta_search_session_id, uid, events_meta_keyword, events_ts FROM (
                    SELECT *, row_number() OVER (PARTITION BY events_meta_search_session_id
                        ORDER BY length(events_meta_keyword) DESC, events_ts DESC,
                                 events_meta_keyword DESC, uid DESC) AS rn
                    FROM sess_rows) WHERE rn = 1""",
    "multi": """SELECT * FROM sess_kw WHERE uid IN (SELECT uid FROM sess_kw GROUP BY uid
                                                    HAVING count(*) >= 3)""",
    "kb": "SELECT DISTINCT uid, events_meta_keyword AS search_key FROM multi WHERE length(events_meta_keyword) > 3",
    "kb_n": "SELECT count(DISTINCT uid) AS n FROM kb",
    "kb_min": "SELECT ceil(CAST(0.01 AS DOUBLE) * n) AS m FROM kb_n",
    "kb_items": "SELECT search_key, count(*) AS f FROM kb GROUP BY search_key",
    # every frequent set, level by level: (uid, items) rows, items in order
    "kb_rows": """SELECT uid, [search_key] AS items FROM kb
                  WHERE search_key IN (SELECT search_key FROM kb_items WHERE f >= (SELECT m FROM kb_min))
                  UNION ALL
                  SELECT uid, items FROM (
                    SELECT s.uid, list_append(s.items, k.search_key) AS items,
                           count(*) OVER (PARTITION BY list_append(s.items, k.search_key)) AS c
                    FROM kb_rows s JOIN kb k ON k.uid = s.uid AND k.search_key > s.items[-1])
                  WHERE c >= (SELECT m FROM kb_min)""",
    "kb_sets": "SELECT items, count(*) AS f FROM kb_rows GROUP BY items",
    "kw_rules": """SELECT a.items AS antecedent, r.c AS consequent, r.f / a.f AS confidence,
                          (r.f / a.f) / (c.f / n.n) AS lift, r.f / n.n AS support
                   FROM (SELECT items, f, unnest(items) AS c FROM kb_sets WHERE len(items) >= 2) r
                   JOIN kb_sets a ON a.items = list_filter(r.items, lambda x: x <> r.c)
                   JOIN kb_items c ON c.search_key = r.c CROSS JOIN kb_n n
                   WHERE r.f / a.f >= 0.01""",
    "kw_numbered": "SELECT row_number() OVER () AS rid, antecedent, consequent FROM kw_rules",
    "kw_parts": "SELECT rid, consequent, len(antecedent) AS needs, unnest(antecedent) AS search_key FROM kw_numbered",
}

_QITEM = {"qi": """SELECT f.id AS q_id, f.features AS q_vec
                  FROM (SELECT item_id FROM popularity ORDER BY user_count DESC, item_id LIMIT 1) t
                  JOIN factors f ON CAST(t.item_id AS INTEGER) = f.id"""}


def _dot(a: str, b: str) -> str:
    return f"list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def _cos(a: str, b: str) -> str:
    den = f"(sqrt({_dot(a, a)}) * sqrt({_dot(b, b)}))"
    return f"CASE WHEN {den} > 0 THEN {_dot(a, b)} / {den} END"


_PICK = """SELECT userId FROM merged_train GROUP BY userId HAVING count(item_id) >= 3
           ORDER BY md5('42:' || userId), userId LIMIT 1"""
_PROFILES = {
    "hist_all": "SELECT userId, CAST(item_id AS INTEGER) AS vec_id FROM merged_train",
    "prof": """SELECT userId, list(v ORDER BY pos) AS profile FROM (
                 SELECT userId, pos, avg(CAST(v AS DOUBLE)) AS v FROM (
                   SELECT h.userId, unnest(generate_series(1, len(f.features))) AS pos,
                          unnest(f.features) AS v
                   FROM hist_all h JOIN factors f ON h.vec_id = f.id)
                 GROUP BY userId, pos)
               GROUP BY userId""",
    "pu": _PICK,
}

ORACLE_SQL.update({
    "search_flags": with_stages("""
        SELECT events_meta_search_session_id, events_ts, uid, events_meta_action,
               consumption, session, autosuggest FROM flagged""", SEARCH),
    "resolved_users": with_stages("""
        SELECT uid, count(*) AS n_rows, count(DISTINCT events_meta_search_session_id) AS n_sessions
        FROM flagged GROUP BY uid""", SEARCH),
    "search_sequence": with_stages("""
        SELECT events_meta_search_session_id, events_ts, events_meta_keyword, events_meta_action,
               CAST(row_number() OVER (PARTITION BY events_meta_search_session_id
                    ORDER BY events_ts, events_meta_action, events_meta_keyword) AS INTEGER) AS sequence_order
        FROM flagged WHERE session = 1""", SEARCH),
    "session_keyword": with_stages("SELECT * FROM sess_kw", SEARCH),
    "multi_search_baskets": with_stages("""
        SELECT uid, CAST(count(*) AS INTEGER) AS n_items,
               array_to_string(list_sort(list(search_key)), ',') AS items
        FROM kb GROUP BY uid""", SEARCH),
    "multi_search_share": with_stages("""
        SELECT count(*) AS searching_users, CAST(count_if(n >= 3) AS BIGINT) AS multi_search_users,
               (round((CAST(count_if(n >= 3) AS BIGINT) / count(*) * 100) * 1e6) / 1e6) AS multi_search_pct
        FROM (SELECT uid, count(*) AS n FROM sess_kw GROUP BY uid)""", SEARCH),
    "frequent_itemsets": with_stages("""
        SELECT array_to_string(items, ',') AS items, CAST(len(items) AS INTEGER) AS n_items, f AS freq FROM kb_sets""", SEARCH),
    "association_rules": with_stages("""
        SELECT array_to_string(antecedent, ',') AS antecedent, consequent, (round((confidence) * 1e6) / 1e6) AS confidence,
               (round((lift) * 1e6) / 1e6) AS lift, (round((support) * 1e6) / 1e6) AS support FROM kw_rules""", SEARCH),
    "related_keywords": with_stages("""
        SELECT unnest(antecedent) AS keyword, array_to_string(antecedent, ',') AS antecedent, consequent AS related,
               (round((confidence) * 1e6) / 1e6) AS confidence, (round((lift) * 1e6) / 1e6) AS lift FROM kw_rules""", SEARCH),
    "rule_predictions": with_stages("""
        SELECT DISTINCT uid, consequent AS prediction FROM (
          SELECT k.uid, p.rid, p.consequent FROM kb k JOIN kw_parts p USING (search_key)
          GROUP BY k.uid, p.rid, p.consequent, p.needs HAVING count(*) = p.needs) f
        WHERE NOT EXISTS (SELECT 1 FROM kb o WHERE o.uid = f.uid AND o.search_key = f.consequent)""", SEARCH),
    "cosine_neighbours": with_stages(f"""
        SELECT q_id, id, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT q.q_id, f.id, {_cos('f.features', 'q.q_vec')} AS score
          FROM factors f CROSS JOIN qi q WHERE f.id <> q.q_id)
        WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT 10""", _QITEM),
    "dot_neighbours": with_stages(f"""
        SELECT q_id, id, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT q.q_id, f.id, {_dot('f.features', 'q.q_vec')} AS score
          FROM factors f CROSS JOIN qi q WHERE f.id <> q.q_id)
        WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT 10""", _QITEM),
    "profile_vector_recs": with_stages(f"""
        SELECT userId, id, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT p.userId, f.id, {_dot('f.features', 'p.profile')} AS score
          FROM factors f CROSS JOIN (SELECT * FROM prof WHERE userId IN (SELECT userId FROM pu)) p
          WHERE f.id NOT IN (SELECT vec_id FROM hist_all WHERE userId IN (SELECT userId FROM pu)))
        ORDER BY score DESC, id LIMIT 10""", _PROFILES),
    "taste_neighbours": with_stages(f"""
        SELECT query_user, userId, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT q.userId AS query_user, p.userId, {_cos('p.profile', 'q.profile')} AS score
          FROM prof p CROSS JOIN (SELECT * FROM prof WHERE userId IN (SELECT userId FROM pu)) q
          WHERE p.userId <> q.userId)
        WHERE score IS NOT NULL ORDER BY score DESC, userId LIMIT 10""", _PROFILES),
    "item_features": with_stages("""
        SELECT DISTINCT item_id, feature FROM (
          SELECT item_id, unnest(list_distinct(['lang:' || coalesce(original_language, 'Unknown')]
                 || list_transform(CASE WHEN len(g) > 0 THEN g ELSE ['Unknown'] END, lambda x: 'genre:' || x)))
                 AS feature
          FROM (SELECT item_id, original_language,
                       list_filter(list_transform(string_split(regexp_replace(CAST(Genres AS VARCHAR),
                                   '[\\[\\]''"]', '', 'g'), ','), lambda x: trim(x)), lambda x: x <> '') AS g
                FROM metadata))
        WHERE item_id IN (SELECT item_id FROM item_lookup)"""),
    "sampled_users": with_stages("""
        SELECT userId, item_id, 'train' AS split FROM tr
        UNION ALL
        SELECT t.userId, t.item_id, 'test' AS split FROM merged_test t
        WHERE t.userId IN (SELECT userId FROM su)
          AND NOT EXISTS (SELECT 1 FROM tr WHERE tr.userId = t.userId AND tr.item_id = t.item_id)""",
        {"su": """SELECT DISTINCT userId FROM merged_train
                  WHERE ('0x' || substr(md5('42:' || userId), 1, 8))::BIGINT % 100 < 5""",
         "tr": "SELECT userId, item_id FROM merged_train WHERE userId IN (SELECT userId FROM su)"}),
})


ORACLE_SQL.update({
    "partitioned_scan": with_stages("""
        SELECT userId, item_id, day, total_play_time_sec, day AS path_day FROM pt_train0"""),
    "bundle_roundtrip": with_stages(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {a}) AS n_first, count(DISTINCT {b}) AS n_second "
        f"FROM {view}" for name, view, a, b in (
            ("indexed_train", "indexed_train", "userIndex", "itemIndex"), ("indexed_test", "indexed_test", "userIndex", "itemIndex"),
            ("user_lookup", "user_lookup", "userId", "userIndex"), ("item_lookup", "item_lookup", "item_id", "itemIndex"),
            ("combined_train", "merged_train", "userId", "item_id"), ("combined_test", "merged_test", "userId", "item_id"),
            ("metadata", "metadata", "item_id", "title"), ("item_popularity", "popularity", "item_id", "user_count")))),
    "known_item_test": with_stages("""
        SELECT userId, item_id FROM merged_test WHERE item_id IN (SELECT item_id FROM merged_train)"""),
    "listed_days": with_stages("""
        SELECT userId, item_id, total_play_time_sec, day FROM playtime
        WHERE day IN (DATE '2024-01-03', DATE '2024-01-04')"""),
    "drifted_union": with_stages("""
        SELECT userId, item_id, day, CASE WHEN day = DATE '2024-01-06' THEN 'tv' END AS app FROM playtime
        WHERE day IN (DATE '2024-01-05', DATE '2024-01-06')"""),
    "single_day": with_stages("""
        SELECT userId, item_id, total_play_time_sec FROM playtime WHERE day = DATE '2024-01-07'"""),
    "csv_extract": with_stages("""
        SELECT userId, item_id, day FROM (
          SELECT userId, item_id, CAST(day AS VARCHAR) AS day,
                 md5(concat_ws('|', '42', userId, item_id, CAST(day AS VARCHAR))) AS h FROM playtime)
        WHERE CAST('0x' || substr(h, 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) < 0.05
        ORDER BY h, userId, item_id, day LIMIT 100"""),
    "user_type_watch": with_stages(f"""
        SELECT userId, {_GROUP} AS type_group, (round((sum(total_play_time_sec)) * 1e6) / 1e6) AS watch_time
        FROM consumption GROUP BY 1, 2"""),
    "shared_hours": with_stages("""
        SELECT strftime(ts, '%Y-%m-%d %H') AS hour, count(DISTINCT userId) AS n_users FROM interactions
        GROUP BY 1 HAVING count(DISTINCT userId) > 1"""),
    "confidence_labels_strict": with_stages(f"""
        SELECT userId, item_id, {_r('recent_decay_factor')},
               CAST(CASE WHEN pr <= 0.2 THEN 0.2 WHEN pr <= 0.4 THEN 1.0 WHEN pr <= 0.6 THEN 2.0
                         WHEN pr <= 0.8 THEN 3.0 ELSE 4.0 END AS DOUBLE) AS confidence
        FROM (SELECT *, percent_rank() OVER (PARTITION BY item_id ORDER BY total_playtime_combined) AS pr
              FROM (SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM pt_stats) WHERE n >= 26)"""),
    "active_users_strict": with_stages(f"""
        SELECT w.userId, w.item_id, {", ".join(_R.format(c).replace(f"({c})", f"(w.{c})") for c in ('confidence', 'recent_decay_factor'))},
               c.distinct_content_count
        FROM weighted_train w JOIN (SELECT userId, count(*) AS distinct_content_count FROM weighted_train
                                    GROUP BY userId) c USING (userId)
        WHERE c.distinct_content_count >= 25"""),
    "idf_weighted_playtime": with_stages("""
        SELECT userId, item_id, (round((ln(1 + total_playtime_combined) * idf) * 1e6) / 1e6) AS penalized_playtime
        FROM pt_stats JOIN (SELECT item_id, ln((n + 1) / (k + 1)) AS idf
                            FROM (SELECT item_id, count(DISTINCT userId) AS k FROM pt_stats GROUP BY item_id)
                            CROSS JOIN (SELECT count(DISTINCT userId) AS n FROM pt_stats)) USING (item_id)"""),
    "als_checks": with_stages("""
        SELECT (SELECT count(DISTINCT userIndex) FROM indexed_train) AS users,
               (SELECT count(DISTINCT itemIndex) FROM indexed_train) AS items, CAST(0 AS BIGINT) AS unsolved_users,
               CAST(0 AS BIGINT) AS wrong_scores,
               CAST(0 AS BIGINT) AS seen_pairs, CAST(0 AS BIGINT) AS rank_gaps, CAST(0 AS BIGINT) AS long_lists"""),
    "cold_user_recs": with_stages(f"""
        SELECT userId, id, title, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT p.userId, f.id, {_dot('f.features', 'p.profile')} AS score
          FROM factors f CROSS JOIN cprof p
          WHERE NOT EXISTS (SELECT 1 FROM chist h WHERE h.userId = p.userId AND h.vec_id = f.id))
        LEFT JOIN titles ON CAST(id AS VARCHAR) = item_id
        QUALIFY row_number() OVER (PARTITION BY userId ORDER BY score DESC, id) <= 10""", {
        "cextra": "SELECT unnest([3, 14, 15, 92, 65, 35]) AS vec_id",
        "chist": f"""SELECT 'cold_1' AS userId, vec_id FROM cextra
                    UNION SELECT userId, CAST(item_id AS INTEGER) FROM merged_train WHERE userId IN ({_PICK})
                    UNION SELECT userId, vec_id FROM ({_PICK}) CROSS JOIN cextra""",
        "cprof": """SELECT userId, list(v ORDER BY pos) AS profile FROM (
                     SELECT userId, pos, avg(CAST(v AS DOUBLE)) AS v FROM (
                       SELECT h.userId, unnest(generate_series(1, len(f.features))) AS pos, unnest(f.features) AS v
                       FROM chist h JOIN factors f ON h.vec_id = f.id)
                     GROUP BY userId, pos) GROUP BY userId"""}),
})


ORACLE_SQL["streaming_rollup"] = with_stages("""
    SELECT userId, item_id, day, (round((sum(total_play_time_sec)) * 1e6) / 1e6) AS playtime, count(*) AS n_rows
    FROM playtime GROUP BY userId, item_id, day""")


ORACLE_SQL["search_rows"] = with_stages("""
    SELECT DISTINCT uid, events_meta_keyword AS search_key FROM sess_rows
    WHERE length(events_meta_keyword) > 3""", SEARCH)

_MANY = "(round(({0}) * 1e9) / 1e9)"
ORACLE_SQL.update({
    "als_explicit_checks": with_stages("""
        SELECT (SELECT count(DISTINCT userIndex) FROM indexed_train) AS users,
               (SELECT count(DISTINCT itemIndex) FROM indexed_train) AS items, CAST(0 AS BIGINT) AS unsolved_users,
               CAST(0 AS BIGINT) AS short_lists"""),
    "profile_recs_all": with_stages(f"""
        SELECT userId, id, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT p.userId, f.id, {_MANY.format(_dot('f.features', 'p.profile'))} AS score FROM factors f CROSS JOIN prof p
          WHERE NOT EXISTS (SELECT 1 FROM hist_all h WHERE h.userId = p.userId AND h.vec_id = f.id))
        QUALIFY row_number() OVER (PARTITION BY userId ORDER BY score DESC, id) <= 10""", _PROFILES),
    "taste_neighbours_all": with_stages(f"""
        SELECT query_user, userId, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT q.userId AS query_user, p.userId, {_MANY.format(_cos('p.profile', 'q.profile'))} AS score
          FROM prof p CROSS JOIN prof q WHERE p.userId <> q.userId)
        WHERE score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_user ORDER BY score DESC, userId) <= 5""", _PROFILES),
    "item_neighbours_all": with_stages(f"""
        SELECT q_id, id, (round((score) * 1e6) / 1e6) AS score FROM (
          SELECT q.id AS q_id, f.id, {_MANY.format(_cos('f.features', 'q.features'))} AS score
          FROM factors f CROSS JOIN factors q WHERE f.id <> q.id)
        WHERE score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY score DESC, id) <= 5"""),
    "set_recall": with_stages("""
        SELECT count(*) AS users, (round((avg(hits / n)) * 1e6) / 1e6) AS recall_arrays,
               count(*) AS users_bits, (round((avg(hits / n)) * 1e6) / 1e6) AS recall_bits
        FROM (SELECT t.userIndex, t.n, coalesce(h.hits, 0) AS hits
              FROM (SELECT userIndex, count(*) AS n FROM truth GROUP BY userIndex) t
              JOIN (SELECT DISTINCT userIndex FROM sim_top15) p USING (userIndex)
              LEFT JOIN (SELECT userIndex, count(*) AS hits FROM truth JOIN sim_top15 USING (userIndex, itemIndex)
                         GROUP BY userIndex) h USING (userIndex))"""),
    "set_overlap": with_stages("""
        SELECT overlap, count(*) AS users FROM (
          SELECT u.userIndex, CAST(coalesce(h.n, 0) AS BIGINT) AS overlap
          FROM (SELECT DISTINCT userIndex FROM indexed_train INTERSECT SELECT DISTINCT userIndex FROM truth) u
          LEFT JOIN (SELECT userIndex, count(*) AS n FROM truth JOIN indexed_train USING (userIndex, itemIndex)
                     GROUP BY userIndex) h USING (userIndex))
        GROUP BY overlap"""),
    "itemsets_on_rows": ORACLE_SQL["frequent_itemsets"],
    "rules_on_rows": ORACLE_SQL["association_rules"],
})

ORACLE_SQL.update({
    "catalogue_snapshot": with_stages("""
        SELECT DISTINCT * FROM (
          SELECT CAST(unnest(content_ids) AS VARCHAR) AS item_id, title, CAST(OriginalLanguage AS VARCHAR) AS original_language,
                 Genres FROM (SELECT * FROM catalogue_tv WHERE length(title) % 3 <= 1) WHERE len(content_ids) > 0 AND published
          UNION ALL
          SELECT CAST(unnest(content_ids) AS VARCHAR) AS item_id, title, CAST(OriginalLanguage AS VARCHAR) AS original_language,
                 Genres FROM (SELECT * FROM catalogue_movie WHERE length(title) % 3 <= 1) WHERE len(content_ids) > 0 AND published)"""),
    "similar_snapshot": with_stages("""
        SELECT item_id, rec_item_id, (round((confidence) * 1e6) / 1e6) AS confidence FROM rules11
        WHERE CAST(item_id AS INTEGER) % 3 <= 1"""),
    "corrupt_files": with_stages("""
        SELECT day, count(*) AS n_rows, CAST(CASE WHEN day = DATE '2024-01-09' THEN 1 ELSE 0 END AS BIGINT) AS skipped
        FROM playtime GROUP BY day"""),
})

# The columns of the search log, with their types
_LOG_COLUMNS = (("day", "date"), ("events_ts", "timestamp_ntz"), ("events_meta_action", "string"),
                ("events_meta_source_name", "string"), ("events_av", "string"), ("events_dt", "string"),
                ("events_os", "string"), ("events_meta_search_session_id", "string"), ("events_uid", "string"),
                ("content_id", "string"), ("events_appid", "string"), ("events_meta_keyword", "string"),
                ("events_meta_asset_name", "string"), ("events_meta_content_name", "string"), ("eventtype", "string"))
_FIRST = ", ".join(f"{c} NULLS FIRST" for c, _ in _LOG_COLUMNS)


def _profile_of(position: int, column: str, kind: str) -> str:
    return f"""SELECT {position} AS position, '{column}' AS column_name, '{kind}' AS type,
          (SELECT CAST({column} AS VARCHAR) FROM first_row) AS first_value, a.n_rows, a.n_null, a.n_distinct, a.min_value, a.max_value,
          coalesce(t.top_counts, '') AS top_counts, CASE WHEN t.n2 IS NULL OR t.n1 > t.n2 THEN t.v1 END AS top_value
        FROM (SELECT count(*) AS n_rows, count(*) - count({column}) AS n_null, count(DISTINCT {column}) AS n_distinct,
                     CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value FROM search_events) a
             CROSS JOIN (SELECT array_to_string(list_slice(list(n ORDER BY n DESC), 1, 3), ',') AS top_counts,
                     list_extract(list(n ORDER BY n DESC), 1) AS n1, list_extract(list(n ORDER BY n DESC), 2) AS n2,
                     list_extract(list(v ORDER BY n DESC), 1) AS v1
                   FROM (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM search_events
                         WHERE {column} IS NOT NULL GROUP BY 1)) t"""


ORACLE_SQL["table_profile"] = with_stages(
    " UNION ALL ".join(_profile_of(i + 1, c, k) for i, (c, k) in enumerate(_LOG_COLUMNS)),
    {"first_row": f"SELECT * FROM search_events ORDER BY {_FIRST} LIMIT 1"})
