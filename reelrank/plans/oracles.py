"""The same results in plain SQL over the parquet tables, for DuckDB.

``CTES`` holds named building blocks with the blocks they need; ``ORACLES`` one final select per
query. ``oracle(key)`` strings the needed blocks together and projects the columns of ``COLUMNS``,
the list the Spark side is projected to as well.
"""

from __future__ import annotations

import re

# Name and kind per output column: i bigint, d double rounded to 6 digits (dN: N digits), s text, t timestamp.
COLUMNS = {
    "scan_interactions": "user_id i, item_id i, ts t, duration d",
    "parse_mixed_datetime": "item_id i, published_ts t",
    "mixed_layout_datetime": "order_id i, line i, ts t",
    "date_layouts": "layout s, n i",
    "datetime_features": "user_id i, item_id i, ts t, day i, day_of_week i, day_of_year i, hour i, day_part s, is_weekend i, week_number i",
    "item_release_year": "item_id i, release_year i",
    "item_age_days": "item_id i, age_days i",
    "parse_list_column": "item_id i, n i, joined s",
    "genre_count": "item_id i, len_genres i",
    "clean_text": "item_id i, text s",
    "genre_top3_label": "item_id i, label s",
    "staff_by_role": "item_id i, actor s, producer s, editor s, director s, writer s, composer s, presenter s, commentator s",
    "staff_other_roles": "item_id i, staff s",
    "staff_text": "item_id i, staff s, director s, actor s",
    "dense_item_ids": "item_id i, dense_id i",
    "interactions_dedup": "user_id i, item_id i, ts t, duration d, day i, day_of_week i, day_of_year i, hour i, day_part s, is_weekend i, week_number i",
    "interactions_known_items": "user_id i, item_id i, duration d",
    "interactions_enriched": "user_id i, item_id i, duration d, genres s, countries s",
    "outer_merge_common": "user_id i, item_id i, n_first i, n_second i",
    "item_views": "item_id i, views i",
    "items_by_views": "item_id i, views i",
    "users_by_watches": "user_id i, n i",
    "user_watch_counts": "user_id i, n i",
    "split_train_d1": "user_id i, item_id i, week_idx i",
    "split_target_d2": "user_id i, item_id i, week_idx i",
    "split_holdout": "user_id i, item_id i, week_idx i, part s",
    "item_duration_stats": "item_id i, approx_duration d, mean_duration d, mean_percentage d",
    "percent_of_watch": "user_id i, item_id i, percent_of_watch d",
    "activation_score": "user_id i, item_id i, score d",
    "implied_rating": "user_id i, item_id i, rating i",
    "item_score_stats": "item_id i, mean_score d, median_score d, std_score d, q25_score d, q75_score d",
    "item_rating_shares": "item_id i, rating_1 d, rating_2 d, rating_3 d, rating_4 d, rating_5 d",
    "item_trend_slope": "item_id i, trend_slope d, watched_in_window i",
    "item_popularity": "item_id i, popularity i, sum_watch_time d, mean_watch_time d",
    "item_feature_table": "item_id i, approx_duration d, mean_duration d, mean_percentage d, rating_1 d, rating_2 d, rating_3 d, rating_4 d, rating_5 d, mean_score d, median_score d, std_score d, q25_score d, q75_score d, trend_slope d, watched_in_window i",
    "user_target_items": "user_id i, item_id i",
    "user_history": "user_id i, position i, item_id i",
    "yearly_sequence_in_ranges": "year i, position i, user_id i, item_id i, next_item i",
    "yearly_quantiles_in_ranges": "year i, q10 d, median d, q90 d",
    "local_top_items": "item_id i, n i, rank i",
    "user_favourite_genres": "user_id i, genre i, n i, rank i",
    "bm25_item_weights": "user_id i, item_id i, weight d",
    "bm25_item_similarity": "item_i i, item_j i, similarity d, rank i",
    "bm25_candidates": "user_id i, item_id i, score d, rank i",
    "bm25_candidates_by_history": "user_id i, item_id i, score d, rank i",
    "cooccurrence_pairs": "item_id i, next_item i, n i, rank i",
    "cooccurrence_recommend": "user_id i, item_id i, cooc_score_0 d, cooc_rank_0 i",
    "candidate_union": "user_id i, item_id i, cooc_score d, cooc_rank d, nn_score d, nn_rank d",
    "candidate_hits": "user_id i, item_id i",
    "candidate_buckets": "user_id i, item_id i, bucket s",
    "users_without_hits": "user_id i",
    "user_split": "user_id i, part s",
    "ranker_training_set": "user_id i, item_id i, bucket s, label i",
    "candidate_normalised_scores": "user_id i, item_id i, popularity_rel d, sum_time_rel d, cooc_score_rel d, nn_score_rel d",
    "bm25_similarity_stats": "user_id i, item_id i, similarity_mean d, similarity_min d, similarity_max d, similarity_std d, similarity_var d3",
    # Values to 1e5 and variances to 1e9: ten digits and more that count.
    "bm25_similarity_stats_purchases": "user_id i, item_id i, similarity_mean d5, similarity_min d5, similarity_max d5, similarity_std d5, similarity_var d1",
    "factor_similarity_stats": "user_id i, item_id i, als_similarity_mean d, als_similarity_min d, als_similarity_max d, als_similarity_std d, als_similarity_var d",
    "candidate_features": (
        "user_id i, item_id i, cooc_score d, cooc_rank d, nn_score d, nn_rank d, popularity d, popularity_rel d, "
        "approx_duration d, mean_duration d, mean_percentage d, rating_1 d, rating_2 d, rating_3 d, rating_4 d, rating_5 d, "
        "mean_score d, median_score d, std_score d, q25_score d, q75_score d, trend_slope d, watched_in_window d, pub_date d, "
        "sum_time d, sum_time_rel d, mean_watch_time d, mean_time_rel d, similarity_mean d, similarity_min d, "
        "similarity_max d, similarity_std d, similarity_var d3, als_similarity_mean d, als_similarity_min d, "
        "als_similarity_max d, als_similarity_std d, als_similarity_var d, cooc_score_rel d, nn_score_rel d, len_genres d, "
        "text s, staff s, name s, director s, actor s"
    ),
    "cold_start_local": "user_id i, item_id i, rank i",
    "cold_start_global": "user_id i, item_id i, rank i",
    "recommendations_bm25": "user_id i, rank i, item_id i, source s",
    "processed_round_trip": "user_id i, item_id i, ts t, duration d, name s, description s, genres s, n_staff i",
    "predictions_round_trip": "users i, movies s",
    "average_precision_at_k": "user_id i, ap d",
    "map_at_k": "map d, n_users i",
    "candidate_recall_by_history": "budget s, history_len i, hits i, targets i, recall d",
    "weekly_interactions": "week_number i, n i",
    "users_by_min_history": "min_views i, n_users i",
    "watch_share_histogram": "bin s, n i",
    "top_items_weekly_views": "item_id i, week_number i, n i",
    "als_candidates": "user_id i, item_id i, score d, rank i",
    "ranker_scores": "user_id i, item_id i, score d",
    "top20_per_user": "user_id i, item_id i, rank i",
    "recommendations": "user_id i, rank i, item_id i, source s",
    "predictions_wide": "users i, movies s",
}

CALENDAR = """day(ts) AS day, isodow(ts) - 1 AS day_of_week, dayofyear(ts) AS day_of_year, hour(ts) AS hour,
    CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
         WHEN hour(ts) < 18 THEN 'day' ELSE 'evening' END AS day_part,
    CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, weekofyear(ts) AS week_number"""

WEEK = "CAST(floor(date_diff('day', DATE '1970-01-05', CAST(ts AS DATE)) / 7) AS BIGINT)"

# Trend weights of a window of seven days, oldest first.
TREND_7 = [0, 0, -0.024096385542, -0.069277108434, -0.16265060241, -0.138554216867, 0.394578313253]

CTES: dict[str, str] = {
    # adapters
    "e_raw": """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts, value AS duration FROM events""",
    "p_raw": """SELECT o_custkey AS user_id, l_partkey AS item_id, o_orderdate AS ts, l_quantity AS duration
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "i_made": """SELECT l_partkey AS item_id, list_sort(list(DISTINCT l_suppkey)) AS staff,
        list_sort(list(DISTINCT s_nationkey)) AS countries, min(l_shipdate) AS first
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
    "i": """SELECT p_partkey AS item_id, p_name AS name,
        CASE WHEN p_partkey % 23 = 0 THEN '[]' ELSE '[' || (p_size % 12) || ', ' ||
            (12 + CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) % 8) || ']' END AS genres,
        CASE WHEN p_partkey % 19 = 0 OR m.staff IS NULL THEN '[]' ELSE '[' || array_to_string(m.staff, ', ') || ']' END AS staff,
        CASE WHEN m.countries IS NULL THEN '[]' ELSE '[' || array_to_string(m.countries, ', ') || ']' END AS countries,
        CASE WHEN p_partkey % 17 = 0 THEN 'unknown' ELSE strftime(m.first, '%Y-%m-%d %H:%M:%S') END AS date_publication,
        strftime(m.first, '%Y-%m-%d') AS year, d.text AS description
        FROM part LEFT JOIN i_made m ON m.item_id = p_partkey LEFT JOIN documents d ON d.doc_id = p_partkey""",
    "people": """SELECT s_suppkey AS id, CASE r_name WHEN 'AMERICA' THEN 'actor' WHEN 'EUROPE' THEN 'director'
            WHEN 'ASIA' THEN 'producer' WHEN 'AFRICA' THEN 'writer' WHEN 'MIDDLE EAST' THEN 'composer' END AS role
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "ship_dates": """SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(l_shipdate AS TIMESTAMP) AS d,
        (l_orderkey + l_linenumber) % 7 AS k FROM lineitem""",
    # log
    "e": """SELECT user_id, item_id, min(ts) AS ts, coalesce(round(sum(duration), 6), 0) AS duration FROM e_raw GROUP BY 1, 2""",
    "p": """SELECT user_id, item_id, min(ts) AS ts, coalesce(round(sum(duration), 6), 0) AS duration FROM p_raw GROUP BY 1, 2""",
    "e_items": "SELECT DISTINCT item_id FROM e",
    # item attributes
    "genre_rows": "SELECT item_id, unnest(CAST(genres AS BIGINT[])) AS genre FROM i",
    "genre_freq": "SELECT genre, count(*) AS n FROM genre_rows GROUP BY 1",
    "roles": """SELECT i.item_id, CAST(i.staff AS BIGINT[]) AS staff_ids, {role_lists}
        FROM i LEFT JOIN (SELECT item_id, unnest(CAST(staff AS BIGINT[])) AS id FROM i) c ON c.item_id = i.item_id
        LEFT JOIN people ON people.id = c.id GROUP BY i.item_id, i.staff""".format(
        role_lists=", ".join(
            f"coalesce(list(c.id ORDER BY c.id) FILTER (people.role = '{r}'), []) AS {r}"
            for r in ["actor", "producer", "editor", "director", "writer", "composer", "presenter", "commentator"]
        )
    ),
    "role_text": """SELECT item_id,
        array_to_string(list_filter(staff_ids, lambda x: NOT list_contains(actor, x) AND NOT list_contains(director, x)), ' ') AS staff,
        array_to_string(director, ' ') AS director, array_to_string(actor, ' ') AS actor FROM roles""",
    # splits; d1 and d2 of both logs
    **{
        f"{a}_{name}": sql.format(log=a, week=WEEK)
        for a in "ep"
        for name, sql in {
            "weeks": "SELECT *, {week} AS week_idx FROM {log}",
            "d1": "SELECT * FROM {log}_weeks WHERE week_idx < (SELECT max(week_idx) FROM {log}_weeks) - 2",
            "d2": """SELECT * FROM {log}_weeks WHERE week_idx >= (SELECT max(week_idx) FROM {log}_weeks) - 2
                AND user_id IN (SELECT user_id FROM {log}_d1)""",
            "local": """SELECT *, row_number() OVER (ORDER BY n DESC, item_id) AS rank FROM (
                SELECT item_id, count(*) AS n FROM {log}_weeks
                WHERE week_idx > (SELECT max(week_idx) FROM {log}_weeks) - 1
                GROUP BY 1 ORDER BY n DESC, item_id LIMIT 200)""",
        }.items()
    },
    "p_rest": "SELECT * FROM p_weeks WHERE week_idx < (SELECT max(week_idx) FROM p_weeks) - 2",
    "h_d1": "SELECT * FROM p_rest WHERE week_idx < (SELECT max(week_idx) FROM p_rest) - 2",
    "h_d2": """SELECT * FROM p_rest WHERE week_idx >= (SELECT max(week_idx) FROM p_rest) - 2
        AND user_id IN (SELECT user_id FROM h_d1)""",
    "h_test": """SELECT * FROM p_weeks WHERE week_idx >= (SELECT max(week_idx) FROM p_weeks) - 2
        AND user_id IN (SELECT user_id FROM h_d1)""",
    # item features
    "durations": """SELECT item_id, quantile_cont(duration, 0.9) AS approx_duration, round(sum(duration), 6) / count(duration) AS mean_duration,
        round(sum(duration), 6) / count(duration) / nullif(quantile_cont(duration, 0.9), 0) * 100 AS mean_percentage FROM e GROUP BY 1""",
    "shares": """SELECT e.user_id, e.item_id, e.ts, duration / nullif(approx_duration, 0) AS percent_of_watch
        FROM e LEFT JOIN durations USING (item_id)""",
    "scores": """SELECT *, CAST(ceil(score * 5) AS BIGINT) AS rating FROM (
        SELECT *, CASE WHEN percent_of_watch < 0.5e0 THEN 1 / (1 + exp(-10 * (percent_of_watch - 0.5e0)))
            ELSE 1 / (1 + exp(-3.6e0 * (percent_of_watch - 0.5e0))) END AS score FROM shares)""",
    "d1_scores": "SELECT scores.* FROM scores JOIN e_d1 USING (user_id, item_id)",
    "score_stats": """SELECT item_id, avg(score) AS mean_score, quantile_cont(score, 0.5) AS median_score,
        stddev_samp(score) AS std_score, quantile_cont(score, 0.25) AS q25_score, quantile_cont(score, 0.75) AS q75_score
        FROM d1_scores GROUP BY 1""",
    "rating_shares": "SELECT item_id, "
    + ", ".join(f"count(*) FILTER (rating = {r}) / nullif(count(rating), 0) AS rating_{r}" for r in range(1, 6))
    + " FROM d1_scores GROUP BY 1",
    "trend_slots": """SELECT item_id, date_diff('day', (SELECT max(CAST(ts AS DATE)) FROM e_d1), CAST(ts AS DATE)) + 6 AS slot FROM e_d1""",
    "trend": "SELECT e_items.item_id, "
    + " + ".join(f"{w}e0 * count(*) FILTER (slot = {k})" for k, w in enumerate(TREND_7))
    + " AS trend_slope, count(*) FILTER (slot >= 0) AS watched_in_window FROM e_items LEFT JOIN trend_slots USING (item_id) GROUP BY 1",
    "popularity": """SELECT e_items.item_id, count(user_id) AS popularity, coalesce(round(sum(duration), 6), 0) AS sum_watch_time,
        coalesce(round(sum(duration), 6) / nullif(count(duration), 0), 0) AS mean_watch_time FROM e_items LEFT JOIN e_d1 USING (item_id) GROUP BY 1""",
    "item_features": """SELECT * FROM e_items LEFT JOIN durations USING (item_id) LEFT JOIN score_stats USING (item_id)
        LEFT JOIN rating_shares USING (item_id) LEFT JOIN trend USING (item_id)""",
    # favourite genres on purchases and on events
    **{
        f"{a}_favourites": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, genre) AS rank
            FROM (SELECT user_id, genre, count(*) AS n FROM {a} JOIN genre_rows USING (item_id) GROUP BY 1, 2)) WHERE rank <= 10"""
        for a in "ep"
    },
    # co-occurrence on d1 and on the whole log
    **{
        f"{prefix}_{name}": sql.format(p=prefix, log=log)
        for prefix, log in [("ce", "e"), ("cd", "e_d1"), ("cp", "p_d1")]
        for name, sql in {
            "steps": "SELECT item_id, lead(item_id) OVER (PARTITION BY user_id ORDER BY ts, item_id) AS next_item FROM {log}",
            "pairs": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, next_item) AS rank
                FROM (SELECT item_id, next_item, count(*) AS n FROM {p}_steps WHERE next_item IS NOT NULL GROUP BY 1, 2))
                WHERE rank <= 500""",
            "last": """SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS back
                FROM {log}) WHERE back = 1""",
            "popular": """SELECT item_id, row_number() OVER (ORDER BY n DESC, item_id) AS place FROM (
                SELECT item_id, count(*) AS n FROM {log} GROUP BY 1) ORDER BY n DESC, item_id LIMIT 6""",
            "proposed": """SELECT user_id, next_item AS item_id, CAST(n AS DOUBLE) AS score, 0 AS place
                FROM {p}_last JOIN {p}_pairs USING (item_id)
                UNION ALL SELECT l.user_id, p.item_id, 0e0, p.place FROM {p}_last l, {p}_popular p
                WHERE l.item_id NOT IN (SELECT item_id FROM {p}_pairs)""",
            "cand": """SELECT * FROM (SELECT user_id, item_id, score,
                row_number() OVER (PARTITION BY user_id ORDER BY score DESC, place, item_id) AS rank
                FROM {p}_proposed WHERE (user_id, item_id) NOT IN (SELECT (user_id, item_id) FROM {log})) WHERE rank <= 300""",
        }.items()
    },
    # BM25: prefix, log, neighbours, list length
    **{
        f"{prefix}_{name}": sql.format(p=prefix, log=log, k=k, n=n)
        for prefix, log, k, n in [("be", "e", 20, 20), ("bd", "e_d1", 20, 20), ("bp", "p", 210, 100), ("bq", "p_d1", 210, 100), ("br", "p_d1", 210, 900)]
        for name, sql in {
            "items": """SELECT item_id, 2.1e0 / (1.1e0 * (0.6e0 + 0.4e0 * n_i / (avg(n_i) OVER ())) + 1) AS a
                FROM (SELECT item_id, count(*) AS n_i FROM {log} GROUP BY 1)""",
            "users": """SELECT user_id, ln(CAST((SELECT count(DISTINCT item_id) FROM {log}) AS DOUBLE)) - ln(1e0 + count(*)) AS b
                FROM {log} GROUP BY 1""",
            "rows": "SELECT user_id, item_id, a, b, CAST(round(b * b * 100000000) AS BIGINT) AS q FROM {log} JOIN {p}_items USING (item_id) JOIN {p}_users USING (user_id)",
            "sim": """SELECT * FROM (SELECT item_i, item_j, a_i * strength AS similarity,
                row_number() OVER (PARTITION BY item_i ORDER BY strength DESC, item_j) AS rank FROM (
                SELECT x.item_id AS item_i, y.item_id AS item_j, x.a AS a_i, y.a * (CAST(sum(x.q) AS DOUBLE) / 100000000e0) AS strength
                FROM {p}_rows x JOIN {p}_rows y USING (user_id) GROUP BY x.item_id, y.item_id, x.a, y.a)) WHERE rank <= {k}""",
            "cand": """SELECT * FROM (SELECT user_id, item_id, score,
                row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (
                SELECT user_id, item_j AS item_id, sum(similarity) AS score FROM {log} JOIN {p}_sim ON item_id = item_i GROUP BY 1, 2) s
                WHERE NOT EXISTS (SELECT 1 FROM {log} h WHERE h.user_id = s.user_id AND h.item_id = s.item_id)) WHERE rank <= {n}""",
        }.items()
    },
    # both lists, labels
    **{
        f"{u}_{name}": sql.format(u=u, first=first, second=second, target=target)
        for u, first, second, target in [("ue", "cd_cand", "bd_cand", "e_d2"), ("up", "cp_cand", "bq_cand", "p_d2")]
        for name, sql in {
            "union": """SELECT user_id, item_id, c.score AS cooc_score, 1e0 / c.rank AS cooc_rank,
                n.score AS nn_score, 1e0 / n.rank AS nn_rank FROM {first} c FULL JOIN {second} n USING (user_id, item_id)""",
            "labelled": """SELECT u.*, CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS label,
                CASE WHEN t.user_id IS NOT NULL THEN 'hit' WHEN nn_rank IS NULL THEN 'cooc_only'
                     WHEN cooc_rank IS NULL THEN 'nn_only' ELSE 'both' END AS bucket
                FROM {u}_union u LEFT JOIN {target} t USING (user_id, item_id)""",
        }.items()
    },
    "training": """SELECT * FROM (SELECT *, sum(label) OVER (PARTITION BY user_id) AS n_hits,
        row_number() OVER (PARTITION BY user_id, bucket ORDER BY md5(user_id || '|' || item_id || '|42'), item_id) AS draw
        FROM ue_labelled) WHERE n_hits > 0 AND (label = 1 OR draw <= n_hits)""",
    "normalised": """SELECT u.*, popularity, sum_watch_time, mean_watch_time, {rels}
        FROM ue_union u LEFT JOIN popularity USING (item_id)""".format(
        rels=", ".join(
            f"coalesce(CASE WHEN max({c}) OVER (PARTITION BY user_id) > 0 THEN {c} / max({c}) OVER (PARTITION BY user_id) END, 0) AS {out}"
            for out, c in [
                ("popularity_rel", "popularity"),
                ("sum_time_rel", "sum_watch_time"),
                ("cooc_score_rel", "cooc_score"),
                ("nn_score_rel", "nn_score"),
            ]
        )
    ),
    "triples": "SELECT u.user_id, u.item_id, h.item_id AS past FROM ue_union u JOIN e_d1 h ON h.user_id = u.user_id",
    "second": """SELECT x.item_i AS item_id, y.item_i AS past, sum(x.similarity * y.similarity) AS x
        FROM bd_sim x JOIN bd_sim y ON x.item_j = y.item_j GROUP BY 1, 2""",
    "p_triples": "SELECT u.user_id, u.item_id, h.item_id AS past FROM bq_cand u JOIN p_d1 h ON h.user_id = u.user_id",
    "p_second": """SELECT x.item_i AS item_id, y.item_i AS past, sum(x.similarity * y.similarity) AS x
        FROM bq_sim x JOIN bq_sim y ON x.item_j = y.item_j GROUP BY 1, 2""",
    "p_near_stats": """SELECT user_id, item_id, avg(coalesce(x, 0)) AS similarity_mean, min(coalesce(x, 0)) AS similarity_min,
        max(coalesce(x, 0)) AS similarity_max, stddev_pop(coalesce(x, 0)) AS similarity_std, var_pop(coalesce(x, 0)) AS similarity_var
        FROM p_triples LEFT JOIN p_second USING (item_id, past) GROUP BY 1, 2""",
    "vectors": "SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "cosines": """SELECT a.item_id, b.item_id AS past, list_cosine_similarity(a.v, b.v) AS x FROM vectors a, vectors b
        WHERE a.item_id IN (SELECT item_id FROM e_items) AND b.item_id IN (SELECT item_id FROM e_items)""",
    **{
        f"{name}_stats": f"""SELECT user_id, item_id, avg(coalesce(x, 0)) AS {p}mean, min(coalesce(x, 0)) AS {p}min,
            max(coalesce(x, 0)) AS {p}max, stddev_pop(coalesce(x, 0)) AS {p}std, var_pop(coalesce(x, 0)) AS {p}var
            FROM triples LEFT JOIN {values} USING (item_id, past) GROUP BY 1, 2"""
        for name, values, p in [("near", "second", "similarity_"), ("factor", "cosines", "als_similarity_")]
    },
    # cold start: prefix of the log
    **{
        f"{a}_{name}": sql.format(a=a)
        for a in "ep"
        for name, sql in {
            "pool": """SELECT u.user_id, l.item_id, l.rank, EXISTS (SELECT 1 FROM {a}_favourites f JOIN genre_rows g USING (genre)
                WHERE f.user_id = u.user_id AND g.item_id = l.item_id) AS liked
                FROM (SELECT DISTINCT user_id FROM {a}) u, {a}_local l
                WHERE NOT EXISTS (SELECT 1 FROM {a} h WHERE h.user_id = u.user_id AND h.item_id = l.item_id)""",
            "restricted": "SELECT user_id FROM {a}_pool GROUP BY 1 HAVING count(*) FILTER (liked) >= 20",
            "cold": """SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank FROM {a}_pool
                WHERE liked OR user_id NOT IN (SELECT user_id FROM {a}_restricted)) WHERE rank <= 20""",
        }.items()
    },
    "p_views": "SELECT i.item_id, count(DISTINCT user_id) AS views FROM i LEFT JOIN p USING (item_id) GROUP BY 1",
    "p_open": """SELECT u.user_id, v.item_id, v.views FROM (SELECT DISTINCT user_id FROM p) u, p_views v
        WHERE NOT EXISTS (SELECT 1 FROM p h WHERE h.user_id = u.user_id AND h.item_id = v.item_id)
        AND (u.user_id NOT IN (SELECT user_id FROM p_restricted) OR EXISTS (SELECT 1 FROM p_favourites f JOIN genre_rows g USING (genre)
            WHERE f.user_id = u.user_id AND g.item_id = v.item_id))""",
    "filled": """SELECT user_id, item_id, rank, 0 AS turn, 'ranked' AS source FROM be_cand
        UNION ALL SELECT user_id, item_id, rank, 1, 'cold_start' FROM e_cold c
        WHERE NOT EXISTS (SELECT 1 FROM be_cand b WHERE b.user_id = c.user_id AND b.item_id = c.item_id)""",
    # evaluation
    "ap": """SELECT u.user_id, coalesce(gained / least(n, 20), 0) AS ap
        FROM (SELECT user_id FROM bd_cand UNION SELECT user_id FROM e_d2) u
        LEFT JOIN (SELECT user_id, count(*) AS n FROM e_d2 GROUP BY 1) t USING (user_id)
        LEFT JOIN (SELECT user_id, sum(so_far / rank) AS gained FROM (
            SELECT b.user_id, b.rank, count(*) OVER (PARTITION BY b.user_id ORDER BY b.rank) AS so_far
            FROM bd_cand b JOIN e_d2 d USING (user_id, item_id)) GROUP BY 1) g USING (user_id)""",
}

ORACLES: dict[str, str] = {
    "scan_interactions": "SELECT * FROM e_raw",
    "parse_mixed_datetime": "SELECT item_id, try_cast(date_publication AS TIMESTAMP) AS published_ts FROM i",
    "mixed_layout_datetime": """SELECT order_id, line,
        CASE WHEN k IN (1, 3, 6) AND day(d) <= 12 THEN make_timestamp(year(d), day(d), month(d), 0, 0, 0) ELSE d END AS ts FROM ship_dates""",
    "date_layouts": """SELECT CASE WHEN k IN (0, 4) THEN 'year first' WHEN k = 5 THEN 'other'
            WHEN k <> 2 AND day(d) > 12 THEN 'day first' WHEN k = 2 AND day(d) > 12 THEN 'month first'
            WHEN day(d) = month(d) THEN 'month first' ELSE 'either' END AS layout, count(*) AS n FROM ship_dates GROUP BY 1""",
    "datetime_features": f"SELECT user_id, item_id, ts, {CALENDAR} FROM e_raw",
    "item_release_year": "SELECT item_id, year(try_cast(year AS TIMESTAMP)) AS release_year FROM i",
    "item_age_days": """SELECT item_id, trunc((epoch_us(TIMESTAMP '2023-08-22') - epoch_us(try_cast(date_publication AS TIMESTAMP)))
        / 86400000000.0) AS age_days FROM i""",
    "parse_list_column": "SELECT item_id, len(CAST(genres AS BIGINT[])) AS n, array_to_string(CAST(genres AS BIGINT[]), ' ') AS joined FROM i",
    "genre_count": "SELECT item_id, len(CAST(genres AS BIGINT[])) AS len_genres FROM i",
    "clean_text": "SELECT item_id, regexp_replace(lower(coalesce(description, '')), '[^ a-z]', '', 'g') AS text FROM i",
    "genre_top3_label": """SELECT i.item_id, coalesce(l.label, '') AS label FROM i LEFT JOIN (
        SELECT item_id, string_agg(genre, '.' ORDER BY place) AS label FROM (
            SELECT g.item_id, g.genre, row_number() OVER (PARTITION BY g.item_id ORDER BY f.n DESC, g.genre) AS place
            FROM (SELECT DISTINCT * FROM genre_rows) g JOIN genre_freq f USING (genre)) WHERE place <= 3 GROUP BY 1) l USING (item_id)""",
    "staff_by_role": "SELECT item_id, "
    + ", ".join(
        f"CASE WHEN len(staff_ids) > 0 THEN array_to_string({r}, ' ') END AS {r}"
        for r in ["actor", "producer", "editor", "director", "writer", "composer", "presenter", "commentator"]
    )
    + " FROM roles",
    "staff_other_roles": "SELECT item_id, staff FROM role_text",
    "staff_text": "SELECT * FROM role_text",
    "dense_item_ids": """SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS dense_id
        FROM (SELECT DISTINCT item_id FROM p JOIN i USING (item_id))""",
    "interactions_dedup": f"SELECT user_id, item_id, ts, duration, {CALENDAR} FROM e",
    "interactions_known_items": "SELECT user_id, item_id, duration FROM p WHERE item_id IN (SELECT 2 * item_id FROM i)",
    "interactions_enriched": """SELECT user_id, item_id, duration,
        CASE WHEN genres <> '[]' THEN replace(genres[2:-2], ',', '|') END AS genres,
        CASE WHEN countries <> '[]' THEN replace(countries[2:-2], ',', '|') END AS countries FROM p LEFT JOIN i USING (item_id)""",
    "outer_merge_common": """SELECT user_id, item_id, n_first, n_second
        FROM (SELECT user_id, item_id, count(*) AS n_first FROM e_raw GROUP BY 1, 2)
        FULL JOIN (SELECT user_id, item_id, count(*) AS n_second FROM p GROUP BY 1, 2) USING (user_id, item_id)""",
    "item_views": "SELECT i.item_id, count(DISTINCT user_id) AS views FROM i LEFT JOIN e USING (item_id) GROUP BY 1",
    "items_by_views": "SELECT i.item_id, count(DISTINCT user_id) AS views FROM i LEFT JOIN e USING (item_id) GROUP BY 1 HAVING views > 0",
    "users_by_watches": "SELECT user_id, count(*) AS n FROM e GROUP BY 1 HAVING n > 50",
    "user_watch_counts": "SELECT user_id, count(*) AS n FROM e GROUP BY 1",
    "split_train_d1": "SELECT * FROM e_d1",
    "split_target_d2": "SELECT * FROM e_d2",
    "split_holdout": """SELECT *, 'd1' AS part FROM h_d1 UNION ALL SELECT *, 'd2' FROM h_d2 UNION ALL SELECT *, 'test' FROM h_test""",
    "item_duration_stats": "SELECT * FROM e_items LEFT JOIN durations USING (item_id)",
    "percent_of_watch": "SELECT * FROM shares",
    "activation_score": "SELECT * FROM scores",
    "implied_rating": "SELECT * FROM scores",
    "item_score_stats": "SELECT * FROM e_items LEFT JOIN score_stats USING (item_id)",
    "item_rating_shares": "SELECT * FROM e_items LEFT JOIN rating_shares USING (item_id)",
    "item_trend_slope": "SELECT * FROM trend",
    "item_popularity": "SELECT * FROM popularity",
    "item_feature_table": "SELECT * FROM item_features",
    "user_target_items": "SELECT DISTINCT user_id, item_id FROM e_d2",
    "yearly_sequence_in_ranges": """SELECT year(ts) AS year, row_number() OVER w AS position, user_id, item_id, lead(item_id) OVER w AS next_item
        FROM p WINDOW w AS (PARTITION BY year(ts) ORDER BY ts, user_id, item_id)""",
    "yearly_quantiles_in_ranges": """SELECT year(ts) AS year, quantile_cont(duration, 0.1) AS q10, quantile_cont(duration, 0.5) AS median,
        quantile_cont(duration, 0.9) AS q90 FROM p GROUP BY 1""",
    "user_history": "SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS position FROM e_d1",
    "local_top_items": "SELECT * FROM e_local",
    "user_favourite_genres": "SELECT * FROM p_favourites",
    "bm25_item_weights": "SELECT user_id, item_id, a * b AS weight FROM bp_rows",
    "bm25_item_similarity": "SELECT * FROM be_sim",
    "bm25_candidates": "SELECT * FROM bp_cand",
    "bm25_candidates_by_history": """SELECT c.* FROM bp_cand c JOIN (SELECT user_id, count(*) AS n FROM p GROUP BY 1) USING (user_id)
        WHERE rank <= CASE WHEN n < 40 THEN 60 ELSE 30 END""",
    "cooccurrence_pairs": "SELECT * FROM ce_pairs",
    "cooccurrence_recommend": "SELECT user_id, item_id, score AS cooc_score_0, rank - 1 AS cooc_rank_0 FROM ce_cand",
    "candidate_union": "SELECT * FROM ue_union",
    "candidate_hits": "SELECT * FROM ue_labelled WHERE label = 1",
    "candidate_buckets": "SELECT * FROM ue_labelled WHERE label = 0",
    "users_without_hits": "SELECT DISTINCT user_id FROM p_d2 WHERE user_id NOT IN (SELECT user_id FROM up_labelled WHERE label = 1)",
    "user_split": """SELECT user_id, CASE WHEN CAST('0x' || md5(user_id || '|42')[1:8] AS BIGINT) % 1000000 < 800000
        THEN 'train' ELSE 'test' END AS part FROM (SELECT DISTINCT user_id FROM e)""",
    "ranker_training_set": "SELECT * FROM training",
    "candidate_normalised_scores": "SELECT * FROM normalised",
    "bm25_similarity_stats": "SELECT * FROM near_stats",
    "bm25_similarity_stats_purchases": "SELECT * FROM p_near_stats",
    "factor_similarity_stats": "SELECT * FROM factor_stats",
    "candidate_features": "SELECT n.user_id, n.item_id, "
    + ", ".join(
        f"coalesce({c}, 0) AS {c.split('.')[-1]}"
        for c in """cooc_score cooc_rank nn_score nn_rank popularity popularity_rel approx_duration mean_duration mean_percentage
        rating_1 rating_2 rating_3 rating_4 rating_5 mean_score median_score std_score q25_score q75_score trend_slope
        watched_in_window sum_time_rel mean_watch_time similarity_mean similarity_min similarity_max similarity_std similarity_var
        als_similarity_mean als_similarity_min als_similarity_max als_similarity_std als_similarity_var
        cooc_score_rel nn_score_rel""".split()
    )
    + """, coalesce(trunc((epoch_us(TIMESTAMP '2023-08-22') - epoch_us(try_cast(date_publication AS TIMESTAMP))) / 86400000000.0), 0) AS pub_date,
        coalesce(sum_watch_time, 0) AS sum_time, coalesce(mean_watch_time / (approx_duration + 1), 0) AS mean_time_rel,
        len(CAST(i.genres AS BIGINT[])) AS len_genres, regexp_replace(lower(coalesce(description, '')), '[^ a-z]', '', 'g') AS text,
        coalesce(r.staff, '') AS staff, coalesce(name, '') AS name, coalesce(r.director, '') AS director, coalesce(r.actor, '') AS actor
        FROM normalised n LEFT JOIN item_features USING (item_id) LEFT JOIN near_stats USING (user_id, item_id)
        LEFT JOIN factor_stats USING (user_id, item_id) LEFT JOIN i USING (item_id) LEFT JOIN role_text r USING (item_id)""",
    "cold_start_local": "SELECT * FROM p_cold",
    "cold_start_global": """SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY views DESC, item_id) AS rank
        FROM p_open) WHERE rank <= 20""",
    "recommendations_bm25": """SELECT * EXCLUDE (rank, place), place AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY turn, rank, item_id) AS place FROM filled) WHERE place <= 20""",
    "processed_round_trip": """SELECT user_id, item_id, ts, duration, name, description,
        array_to_string(CAST(genres AS BIGINT[]), ' ') AS genres, len(CAST(staff AS BIGINT[])) AS n_staff FROM e_raw JOIN i USING (item_id)""",
    "predictions_round_trip": """SELECT user_id AS users, string_agg(item_id, ' ' ORDER BY place) AS movies FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY turn, rank, item_id) AS place FROM filled) WHERE place <= 20 GROUP BY 1""",
    "average_precision_at_k": "SELECT * FROM ap",
    "map_at_k": "SELECT avg(ap) AS map, count(*) AS n_users FROM ap",
    "candidate_recall_by_history": """SELECT budget, n AS history_len, sum(hit) AS hits, count(*) AS targets, sum(hit) / count(*) AS recall
        FROM (SELECT budget, l.n, CASE WHEN c.user_id IS NOT NULL OR r.rank <= CASE WHEN l.n < 3 THEN few ELSE many END THEN 1 ELSE 0 END AS hit
            FROM p_d2 t JOIN (SELECT user_id, count(*) AS n FROM p_d1 GROUP BY 1) l USING (user_id)
            CROSS JOIN (VALUES ('by_history', 900, 400), ('same', 400, 400)) b(budget, few, many)
            LEFT JOIN cp_cand c ON c.user_id = t.user_id AND c.item_id = t.item_id
            LEFT JOIN br_cand r ON r.user_id = t.user_id AND r.item_id = t.item_id) GROUP BY 1, 2""",
    "weekly_interactions": "SELECT weekofyear(ts) AS week_number, count(*) AS n FROM e GROUP BY 1",
    "users_by_min_history": """SELECT min_views, count(n) AS n_users FROM range(41) r(min_views)
        LEFT JOIN (SELECT user_id, count(*) AS n FROM e GROUP BY 1) ON n > min_views GROUP BY 1""",
    "watch_share_histogram": """SELECT b || '-' || (b + 10) AS bin, count(share) AS n FROM range(0, 100, 10) r(b)
        LEFT JOIN (SELECT round(percent_of_watch * 100, 9) AS share FROM shares) ON share BETWEEN b AND b + 10 GROUP BY 1""",
    "top_items_weekly_views": """SELECT item_id, weekofyear(ts) AS week_number, count(*) AS n FROM p WHERE item_id IN (
        SELECT item_id FROM p GROUP BY 1 ORDER BY count(DISTINCT user_id) DESC, item_id LIMIT 100) GROUP BY 1, 2
        QUALIFY max(CASE WHEN weekofyear(ts) = 14 THEN 1 ELSE 0 END) OVER (PARTITION BY item_id) = 1""",
}


def columns(key: str) -> list[tuple[str, str]]:
    """(name, kind) of the output columns of a query."""
    return [tuple(part.split()) for part in COLUMNS[key].split(", ")]


def _projected(name: str, kind: str) -> str:
    if kind == "i":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind.startswith("d"):
        return f"round(CAST({name} AS DOUBLE), {kind[1:] or 6}) + 0e0 AS {name}"
    return f"CAST({name} AS {'TIMESTAMP' if kind == 't' else 'VARCHAR'}) AS {name}"


def _blocks(sql: str) -> list[str]:
    """Blocks a statement reads (names after FROM, JOIN or a comma), each after those it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN|,)\s+([a-z_0-9]+)\b", text):
            if name in CTES and name not in order:
                visit(CTES[name])
                order.append(name)

    visit(sql)
    return order


def oracle(key: str) -> str:
    """Complete statement for one query."""
    sql = ORACLES[key]
    head = ",\n".join(f"{name} AS (\n{CTES[name]})" for name in _blocks(sql))
    select = ", ".join(_projected(n, k) for n, k in columns(key))
    return (f"WITH {head}\n" if head else "") + f"SELECT {select} FROM (\n{sql})"
