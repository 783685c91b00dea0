"""The same questions in ANSI SQL (as DuckDB runs it) over the raw tables, written independently of the Spark code."""

from __future__ import annotations

from tidemark.sources.sample import ALLOWED_WORDS, BAD_IDS, STOPWORDS, lexicon_rows

_LEX = ", ".join(f"('{w}', {n})" for w, n in lexicon_rows())
_STOP = ", ".join(f"('{w}')" for w in STOPWORDS.split())
_BAD = ", ".join(str(i) for i in BAD_IDS)
_ALLOWED = ", ".join(f"'{w}'" for w in ALLOWED_WORDS)
_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def _st(column: str) -> str:
    return f"strftime({column}, {_STAMP})"


def _mean(score: str, keep: str = "") -> str:
    """Mean over exact whole billionths, so that both engines see the same number before rounding."""
    return f"CAST(sum(CAST(round({score} * 1e9) AS BIGINT)){keep} AS DOUBLE) / (count({score}){keep} * 1e9)"


def _features(bucket: str = "bucket", defaults: bool = False) -> str:
    parts = [f"count(*) FILTER ({bucket} = '{b}') AS nr_{b}" for b in ("neg", "pos", "neutral")]
    for b, default in (("neg", -0.4), ("pos", 0.4), ("neutral", 0.0)):
        mean = _mean("sentiment", f" FILTER ({bucket} = '{b}')")
        if defaults:
            mean = f"coalesce({mean}, CAST({default} AS DOUBLE))"
        parts.append(f"round({mean}, 6) AS mean_{b}")
    return ", ".join(parts)


_CTES = {
    "ticks": """SELECT event_type AS s, value AS p, CAST(ts AS TIMESTAMP) AS t, CAST(1.0 AS DOUBLE) AS v,
        CAST(ts AS DATE) AS ingestion_date, event_id FROM events""",
    "posts": """SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text, CAST(e.ts AS TIMESTAMP) AS created_at, d.source,
        CAST(e.ts AS DATE) AS ingestion_date, d.doc_id FROM documents d JOIN events e ON e.event_id = d.doc_id * 5""",
    "lexicon": f"SELECT * FROM (VALUES {_LEX}) AS lx(w, pol10)",
    "stopwords": f"SELECT * FROM (VALUES {_STOP}) AS st(w)",
    "tk": r"SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM documents",
    "totals": """SELECT doc_id, count(*) AS n_tokens, count(pol10) AS hits, CAST(coalesce(sum(pol10), 0) AS BIGINT) AS sum10,
        count(*) FILTER (pol10 > 0) AS pos_hits, count(*) FILTER (pol10 < 0) AS neg_hits
        FROM tk LEFT JOIN lexicon USING (w) GROUP BY doc_id""",
    "scored": """SELECT p.doc_id, p.created_at, p.source, coalesce(n_tokens, 0) AS n_tokens, coalesce(hits, 0) AS hits,
        coalesce(sum10, 0) AS sum10, coalesce(pos_hits, 0) AS pos_hits, coalesce(neg_hits, 0) AS neg_hits,
        CASE WHEN hits > 0 THEN sum10 / (hits * 10.0::DOUBLE) ELSE 0.0::DOUBLE END AS sentiment,
        CASE WHEN n_tokens > 0 THEN (pos_hits - neg_hits) / n_tokens::DOUBLE ELSE 0.0::DOUBLE END AS score2,
        CASE WHEN coalesce(sum10, 0) > 2 * coalesce(hits, 0) THEN 'pos'
             WHEN coalesce(sum10, 0) < -2 * coalesce(hits, 0) THEN 'neg' ELSE 'neutral' END AS bucket,
        coalesce(hits > 0 AND abs(sum10) = 2 * hits, FALSE) AS on_border
        FROM posts p LEFT JOIN totals USING (doc_id)""",
    "series": "SELECT t, avg(p) AS p FROM ticks GROUP BY t",
    "points": """SELECT t, p, CAST(rn AS BIGINT) AS rn, CAST(rn // 100 AS BIGINT) AS window_id, CAST(rn % 100 AS INTEGER) AS pos,
        CAST(round(p * 1000000) AS BIGINT) AS u
        FROM (SELECT t, p, row_number() OVER (ORDER BY t) - 1 AS rn FROM series) AS numbered""",
    "sent": "SELECT *, count(*) OVER (PARTITION BY window_id) AS size, window_id % 3 = 1 AND pos < 50 AS held FROM points",
    "summary": """SELECT window_id, count(*) AS n, min(t) AS start_t, max(t) AS stop_t,
        CAST(sum(u) FILTER (pos < 99) AS DOUBLE) / (count(u) FILTER (pos < 99) * 1000000)::DOUBLE AS present_mean,
        CAST(sum(u) FILTER (pos < 19) AS DOUBLE) / (count(u) FILTER (pos < 19) * 1000000)::DOUBLE AS head_mean,
        CAST(sum(u) FILTER (pos < 20) AS DOUBLE) / (count(u) FILTER (pos < 20) * 1000000)::DOUBLE AS head20_mean,
        CAST(sum(u) AS DOUBLE) / (count(u) * 1000000)::DOUBLE AS full_mean FROM points GROUP BY window_id""",
    "labelled": """SELECT window_id, start_t, stop_t, present_mean, future_mean,
        CASE WHEN abs(present_mean - future_mean) < 0.02::DOUBLE THEN 1 WHEN present_mean > future_mean THEN 0
             WHEN present_mean < future_mean THEN 2 END AS label
        FROM (SELECT *, CASE WHEN lead(n) OVER w = 100 THEN lead(head_mean) OVER w ELSE lead(full_mean) OVER w END AS future_mean
              FROM summary WINDOW w AS (ORDER BY window_id)) AS looked_ahead WHERE n = 100""",
    "inside": """SELECT l.window_id, s.* FROM labelled l JOIN scored s ON s.created_at >= l.start_t AND s.created_at <= l.stop_t""",
    "window_features": f"""SELECT l.window_id, l.start_t, l.stop_t, l.label, {_features()}, {_features(defaults=True).replace('AS nr_', 'AS x_nr_').replace('AS mean_', 'AS filled_')}
        FROM labelled l LEFT JOIN inside i ON i.window_id = l.window_id GROUP BY ALL""",
    "split": """SELECT window_id, label, present_mean,
        (CAST(concat('0x', substr(md5(concat(window_id, ':42')), 1, 8)) AS BIGINT) % 10000) < 7000 AS is_train FROM labelled""",
    "models": """SELECT window_id, [abs(a[1]::DOUBLE)/s1, abs(a[2]::DOUBLE)/s1, abs(a[3]::DOUBLE)/s1] AS ps,
             [abs(a[4]::DOUBLE)/s2, abs(a[5]::DOUBLE)/s2, abs(a[6]::DOUBLE)/s2] AS pp
        FROM (SELECT vec_id AS window_id, embedding AS a, abs(embedding[1]::DOUBLE) + abs(embedding[2]::DOUBLE) + abs(embedding[3]::DOUBLE) AS s1,
              abs(embedding[4]::DOUBLE) + abs(embedding[5]::DOUBLE) + abs(embedding[6]::DOUBLE) AS s2 FROM embeddings) AS e""",
    "paired": """SELECT window_id, ps, pp FROM models UNION ALL
        SELECT -1 - window_id, [ps[1], ps[2], 0.0::DOUBLE], [ps[2], ps[1], 0.0::DOUBLE] FROM models""",
    "fused": """SELECT window_id, ps, pp, ps[1] + pp[1] AS c0, ps[2] + pp[2] AS c1, ps[3] + pp[3] AS c2 FROM paired""",
    "fused_label": """SELECT *, CASE WHEN c0 >= c1 AND c0 >= c2 THEN 0 WHEN c1 >= c2 THEN 1 ELSE 2 END AS label FROM fused""",
    "timed": "SELECT *, strftime(created_at, '%H') AS hour, strftime(created_at, '%d') AS day FROM scored",
    "positive": "SELECT doc_id FROM scored WHERE sentiment > 0",
    "terms": r"""SELECT lower(w) AS term, count(*) AS n FROM
        (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w FROM documents WHERE doc_id IN (SELECT doc_id FROM positive)) AS raw
        WHERE w NOT IN (SELECT w FROM stopwords) GROUP BY 1""",
    "top_terms": "SELECT term, n FROM terms ORDER BY n DESC, term LIMIT 100",
    "confused": "SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL",
    "guesses": """SELECT truth AS label, guess AS prediction, count(*) AS n FROM
        (SELECT label AS guess, lead(label) OVER (ORDER BY window_id) AS truth FROM labelled) AS g
        WHERE truth IS NOT NULL AND guess IS NOT NULL GROUP BY ALL""",
}
_MATERIALIZED = {"totals", "scored", "points", "labelled"}
_NEEDS = {
    "totals": ["tk", "lexicon"],
    "scored": ["posts", "totals"],
    "series": ["ticks"],
    "points": ["series"],
    "summary": ["points"],
    "sent": ["points"],
    "labelled": ["summary"],
    "inside": ["labelled", "scored"],
    "window_features": ["inside"],
    "split": ["labelled"],
    "paired": ["models"],
    "fused": ["paired"],
    "fused_label": ["fused"],
    "timed": ["scored"],
    "positive": ["scored"],
    "terms": ["positive", "stopwords"],
    "top_terms": ["terms"],
    "guesses": ["labelled"],
}


def _with(names: str, body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    ctes = [f"{n} AS {'MATERIALIZED ' if n in _MATERIALIZED else ''}({_CTES[n]})" for n in ordered]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _metrics(matrix: str) -> str:
    return f"""SELECT CAST(sum(truth) AS BIGINT) AS n, round(sum(hit) / sum(truth)::DOUBLE, 6) AS accuracy,
        round(sum(truth * CASE WHEN truth + guess > 0 THEN 2.0::DOUBLE * hit / (truth + guess) ELSE 0 END) / sum(truth)::DOUBLE, 6) AS f1_weighted
        FROM (SELECT c.cls, (SELECT coalesce(sum(n), 0) FROM {matrix} WHERE label = c.cls) AS truth,
              (SELECT coalesce(sum(n), 0) FROM {matrix} WHERE prediction = c.cls) AS guess,
              (SELECT coalesce(sum(n), 0) FROM {matrix} WHERE label = c.cls AND prediction = c.cls) AS hit
              FROM (SELECT label AS cls FROM {matrix} UNION SELECT prediction FROM {matrix}) AS c) AS per_class"""


_POSTS_VIEW = f"""SELECT sha256('posts|{{day}}') AS key, count(*) AS count, {_features()}, '{{day}}' AS day FROM scored
    WHERE created_at >= TIMESTAMP '{{day}}' AND created_at < TIMESTAMP '{{day}}' + INTERVAL 1 DAY"""
_STOCKS_VIEW = """SELECT sha256('stocks|{day}') AS key, count(*) AS count, min(p) AS min_price, max(p) AS max_price,
    round(avg(p), 6) AS avg_price, '{day}' AS day FROM ticks
    WHERE CAST(ingestion_date AS TIMESTAMP) > TIMESTAMP '{day}' - INTERVAL 1 DAY AND CAST(ingestion_date AS TIMESTAMP) <= TIMESTAMP '{day}'"""
_POST_ROWS = f"SELECT id, md5(text) AS text_md5, {_st('created_at')} AS created_at, source FROM posts"
_TICK_FILE = f"SELECT window_id, CAST(pos + 1 AS INTEGER) AS num, {_st('t')} AS t, p FROM points"
_WINDOW_PRICES = f"""SELECT window_id, {_st('min(t)')} AS start, {_st('max(t)')} AS stop, arg_min(p, pos) AS first_p,
    arg_max(p, pos) AS last_p, round(sum(p), 6) AS sum_p"""
_FEATURE_ROWS = f"SELECT window_id, {_st('start_t')} AS start, {_st('stop_t')} AS stop, label, nr_neg, nr_pos, nr_neutral"
_ALL_BUCKETS = "nr_neg > 0 AND nr_pos > 0 AND nr_neutral > 0 AND label IS NOT NULL"
_BUCKET_COUNTS = f"""SELECT {{bucket}} AS bucket, count(*) AS n, count(*) FILTER (on_border) AS n_border,
    round({_mean("sentiment")}, 6) AS mean FROM scored GROUP BY 1"""
_F_COLUMNS = """CAST(nr_neg AS DOUBLE) AS f_0, CAST(nr_pos AS DOUBLE) AS f_1, CAST(nr_neutral AS DOUBLE) AS f_2,
    mean_neg AS f_3, mean_pos AS f_4, mean_neutral AS f_5"""
_INDEXED = ", ".join(
    f"CASE WHEN (SELECT count(DISTINCT {x}) FROM window_features WHERE {_ALL_BUCKETS}) <= 20 THEN CAST(dense_rank() OVER (ORDER BY f_{i}) - 1 AS DOUBLE) ELSE f_{i} END AS f_{i}"
    for i, x in enumerate(["nr_neg", "nr_pos", "nr_neutral", "mean_neg", "mean_pos", "mean_neutral"])
)

ORACLE: dict[str, str] = {
    "scan_ticks": _with("ticks", f"SELECT event_id, s, p, {_st('t')} AS t, v, CAST(ingestion_date AS VARCHAR) AS ingestion_date FROM ticks"),
    "latest_user_event": f"""SELECT user_id AS key, {_st('ts')} AS ts, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "scan_posts": _with("posts", f"SELECT id, md5(text) AS text_md5, {_st('created_at')} AS created_at, source, CAST(ingestion_date AS VARCHAR) AS ingestion_date FROM posts"),
    "partitioned_write_read": _with("ticks", f"""SELECT CAST(ingestion_date AS VARCHAR) AS ingestion_date, count(*) AS n,
        {_st('min(t)')} AS first_t, {_st('max(t)')} AS last_t, round(sum(p), 2) AS sum_p FROM ticks GROUP BY ingestion_date"""),
    "csv_roundtrip": _with("labelled", f"SELECT window_id, {_st('start_t')} AS start_timestamp, {_st('stop_t')} AS stop_timestamp, label FROM labelled"),
    "parse_post_lines": _with("posts", _POST_ROWS),
    "parse_window_payload": _with("points", _WINDOW_PRICES + ", count(*) AS n FROM points GROUP BY window_id"),
    "replay_windows_ticks": _with("points", _TICK_FILE),
    "replay_first_points": _with("points", """SELECT window_id, count(*) AS n, CAST(min(pos) + 1 AS BIGINT) AS first_num,
        CAST(max(pos) + 1 AS BIGINT) AS last_num, round(sum(p), 6) AS sum_p FROM (SELECT * FROM points ORDER BY t LIMIT 1500) AS first_points GROUP BY window_id"""),
    "replay_windows_posts": _with("inside", f"SELECT window_id, {_st('created_at')} AS created_at, round(sentiment, 6) AS sentiment FROM inside"),
    "view_append": _with("ticks", _STOCKS_VIEW.format(day="2024-01-04") + " UNION ALL " + _STOCKS_VIEW.format(day="2024-01-05")),
    "limit_preview": _with("ticks", f"SELECT event_id, s, p, {_st('t')} AS t FROM (SELECT * FROM ticks ORDER BY t, event_id LIMIT 100) AS first_rows"),
    "filter_last_day_ticks": _with("ticks", f"""SELECT event_id, s, p, {_st('t')} AS t FROM ticks
        WHERE CAST(ingestion_date AS TIMESTAMP) > TIMESTAMP '2024-01-05' - INTERVAL 1 DAY AND CAST(ingestion_date AS TIMESTAMP) <= TIMESTAMP '2024-01-05'"""),
    "filter_today_posts": _with("posts", f"""SELECT id, {_st('created_at')} AS created_at, source FROM posts
        WHERE CAST(created_at AS DATE) > DATE '2024-01-05' - 1 AND CAST(created_at AS DATE) <= DATE '2024-01-05'"""),
    "stocks_daily_view": _with("ticks", _STOCKS_VIEW.format(day="2024-01-05")),
    "posts_daily_view": _with("scored", _POSTS_VIEW.format(day="2024-01-05")),
    "posts_daily_view_partitioned": _with("scored", _POSTS_VIEW.format(day="2024-01-05")),
    "posts_daily_view_empty": _with("scored", _POSTS_VIEW.format(day="2030-01-01")),
    "quarantine_posts": _with("posts", f"""SELECT doc_id, {_st("date_trunc('second', created_at)")} AS created_at FROM posts
        WHERE doc_id % 50 <> 0 AND doc_id NOT IN ({_BAD})"""),
    "hour_day_parts": _with("posts", """SELECT doc_id, CASE WHEN doc_id % 50 <> 0 THEN strftime(created_at, '%H') END AS hour,
        CASE WHEN doc_id % 50 <> 0 THEN strftime(created_at, '%d') END AS day FROM posts"""),
    "posts_per_hour_selected_days": _with("timed", "SELECT hour, count(*) AS n FROM timed WHERE day IN ('05', '06') GROUP BY hour"),
    "mean_sentiment_by_hour": _with("timed", f"SELECT hour, round({_mean('sentiment')}, 6) AS mean FROM timed WHERE hour IS NOT NULL GROUP BY hour"),
    "mean_score2_by_hour": _with("timed", f"SELECT hour, round({_mean('score2')}, 6) AS mean FROM timed WHERE hour IS NOT NULL GROUP BY hour"),
    "polarity_lexicon": _with("scored", "SELECT doc_id, n_tokens, hits, sum10, round(sentiment, 6) AS polarity FROM scored"),
    "polarity_share": _with("scored", "SELECT doc_id, pos_hits, neg_hits, round(score2, 6) AS share FROM scored"),
    "sentiment_bucket": _with("scored", _BUCKET_COUNTS.format(bucket="bucket")),
    "sentiment_bucket_open": _with("scored", _BUCKET_COUNTS.format(bucket="CASE WHEN on_border THEN 'none' ELSE bucket END")),
    "sentiment_features_default": _with("scored", f"SELECT source, {_features(defaults=True)} FROM scored GROUP BY source"),
    "tokenize_counts": r"""SELECT lang, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct FROM
        (SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM documents) AS t GROUP BY lang""",
    "top_terms_positive": _with("top_terms", "SELECT term, n FROM top_terms"),
    "allowed_terms": _with("top_terms", f"SELECT term, n FROM top_terms WHERE term IN ({_ALLOWED})"),
    "sample_fixed": "SELECT doc_id, source FROM documents ORDER BY md5(concat(doc_id, ':42')), doc_id LIMIT 500",
    "distinct_posts": "SELECT lang, count(*) AS n, count(DISTINCT (text, source)) AS n_distinct FROM documents GROUP BY lang",
    "bottom_k_posts": _with("scored", "SELECT doc_id, round(s, 6) AS sentiment FROM (SELECT doc_id, sentiment AS s FROM scored ORDER BY sentiment, doc_id LIMIT 5) AS worst"),
    "bottom_k_score2": _with("scored", "SELECT doc_id, round(s, 6) AS score2 FROM (SELECT doc_id, score2 AS s FROM scored ORDER BY score2, doc_id LIMIT 5) AS worst"),
    "contains_slice": _with("scored", """SELECT doc_id, round(s, 6) AS score2 FROM (SELECT doc_id, score2 AS s FROM scored
        WHERE doc_id IN (SELECT doc_id FROM documents WHERE contains(text, 'tion')) ORDER BY score2 DESC, doc_id LIMIT 40 OFFSET 60) AS places"""),
    "price_series": _with("ticks", f"SELECT {_st('m')} AS t, round(avg(p), 6) AS p FROM (SELECT date_trunc('minute', t) AS m, p FROM ticks) AS by_minute GROUP BY m"),
    "daily_counts_dense": _with("series", """SELECT strftime(d.day, '%Y-%m-%d') AS day, count(s.t) AS n_t, count(s.p) AS n_p
        FROM (SELECT unnest(generate_series(date_trunc('day', min(t))::TIMESTAMP, max(t), INTERVAL 1 DAY)) AS day FROM series) AS d
        LEFT JOIN series s ON date_trunc('day', s.t) = d.day GROUP BY d.day"""),
    "minute_mean_price": _with("series", f"""SELECT {_st('m.bin')} AS minute, round(avg(s.p), 6) AS p FROM
        (SELECT unnest(generate_series(date_trunc('minute', min(t))::TIMESTAMP, max(t), INTERVAL 1 MINUTE)) AS bin FROM series WHERE day(t) = 16) AS m
        LEFT JOIN (SELECT date_trunc('minute', t) AS bin, p FROM series WHERE day(t) = 16) AS s USING (bin) GROUP BY m.bin"""),
    "minute_counts_posts": _with("posts", f"""SELECT {_st('m.bin')} AS minute, count(p.id) AS n_id, count(p.has_text) AS n_text,
        count(p.created_at) AS n_created_at, count(p.source) AS n_source FROM
        (SELECT unnest(generate_series(date_trunc('minute', min(created_at))::TIMESTAMP, max(created_at), INTERVAL 1 MINUTE)) AS bin FROM posts) AS m
        LEFT JOIN (SELECT date_trunc('minute', created_at) AS bin, id, CASE WHEN text IS NOT NULL THEN 1 END AS has_text, created_at, source FROM posts) AS p
        USING (bin) GROUP BY m.bin"""),
    "count_window_index": _with("points", f"SELECT {_st('t')} AS t, round(p, 6) AS p, rn, window_id, pos FROM points"),
    "count_window_days": _with("points", f"SELECT {_st('t')} AS t, round(p, 6) AS p, rn, window_id, pos FROM points"),
    "window_bounds": _with("summary", f"SELECT window_id, n, {_st('start_t')} AS start, {_st('stop_t')} AS stop FROM summary"),
    "window_pivot": _with("points", "SELECT window_id, " + ", ".join(f"round(max(p) FILTER (pos = {i}), 6) AS c_{i}" for i in range(100)) + " FROM points GROUP BY window_id"),
    "window_labels": _with("labelled", f"""SELECT window_id, {_st('start_t')} AS start, {_st('stop_t')} AS stop,
        round(present_mean, 6) AS present_mean, round(future_mean, 6) AS future_mean, label FROM labelled"""),
    "present_future_means": _with("summary", """SELECT window_id, round(present_mean, 6) AS present_mean,
        round(lead(head20_mean) OVER (ORDER BY window_id), 6) AS future_mean FROM summary"""),
    "quarantine_messages": _with("summary", """SELECT window_id, CASE WHEN window_id % 7 = 0 THEN 'bad point'
        WHEN n <> 100 THEN 'other length' ELSE 'ok' END AS reason FROM summary"""),
    "interval_join_counts": _with("labelled posts", """SELECT l.window_id, count(p.id) AS n FROM labelled l
        LEFT JOIN posts p ON p.created_at >= l.start_t AND p.created_at <= l.stop_t GROUP BY l.window_id"""),
    "window_post_features": _with("window_features", f"{_FEATURE_ROWS}, mean_neg, mean_pos, mean_neutral FROM window_features WHERE {_ALL_BUCKETS}"),
    "window_post_features_filled": _with("window_features", f"{_FEATURE_ROWS}, filled_neg AS mean_neg, filled_pos AS mean_pos, filled_neutral AS mean_neutral FROM window_features"),
    "split_assign": _with("split", "SELECT window_id, CAST(is_train AS INTEGER) AS is_train FROM split"),
    "split_join": _with("split", "SELECT window_id, label, round(present_mean, 6) AS present_mean FROM split WHERE is_train"),
    "true_labels_for_test": _with("split", "SELECT window_id, label - 1 AS label FROM split WHERE NOT is_train"),
    "vector_elements": _with("models", "SELECT window_id, round(ps[1], 6) AS prob_0, round(ps[2], 6) AS prob_1, round(ps[3], 6) AS prob_2 FROM models"),
    "prob_join": _with("paired", """SELECT window_id, round(ps[1], 6) AS stock_0, round(ps[2], 6) AS stock_1, round(ps[3], 6) AS stock_2,
        round(pp[1], 6) AS posts_0, round(pp[2], 6) AS posts_1, round(pp[3], 6) AS posts_2 FROM paired"""),
    "fuse_probabilities": _with("fused", "SELECT window_id, round(c0, 6) AS sum_0, round(c1, 6) AS sum_1, round(c2, 6) AS sum_2 FROM fused"),
    "fuse_argmax": _with("fused_label", "SELECT window_id, label FROM fused_label"),
    "fuse_bucketed": _with("fused_label", "SELECT window_id, label FROM fused_label"),
    "split_join_bucketed": _with("split", "SELECT window_id, is_train, label, round(present_mean, 6) AS present_mean FROM split"),
    "label_with_audit": _with("fused_label", """SELECT window_id, CAST(label AS VARCHAR) AS label,
        printf('[%.6f,%.6f,%.6f]', ps[1], ps[2], ps[3]) AS stock, printf('[%.6f,%.6f,%.6f]', pp[1], pp[2], pp[3]) AS posts FROM fused_label"""),
    "label_map": _with("labelled", "SELECT window_id, label - 1 AS label FROM labelled"),
    "confusion_matrix": _with("confused", "SELECT label, prediction, n FROM confused"),
    "eval_metrics": _with("confused", _metrics("confused")),
    "eval_previous_label": _with("guesses", _metrics("guesses")),
    "assemble_sentiment": _with("window_features", f"SELECT window_id, {_F_COLUMNS} FROM window_features WHERE {_ALL_BUCKETS}"),
    # Features with at most 20 distinct values become category numbers in value order.
    "index_features": _with("window_features", f"SELECT window_id, {_INDEXED} FROM (SELECT window_id, {_F_COLUMNS} FROM window_features WHERE {_ALL_BUCKETS}) AS f"),
    "index_labels": _with("labelled", """SELECT CAST(label AS VARCHAR) AS label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS indexed_label
        FROM (SELECT label, count(*) AS n FROM labelled WHERE label IS NOT NULL GROUP BY label) AS counted"""),
    **{
        name: _with("split", "SELECT window_id, label, 1 AS agrees FROM split WHERE NOT is_train AND label IS NOT NULL")
        for name in ("rf_stock", "ovr_rf", "ovr_svc", "ovr_gbt")
    },
    **{
        name: _with("window_features split", f"""SELECT window_id, w.label, 1 AS agrees FROM window_features w
            JOIN split s USING (window_id) WHERE NOT is_train AND {_ALL_BUCKETS.replace("label", "w.label")}""")
        for name in ("rf_posts", "ovr_rf_posts", "ovr_svc_posts", "ovr_gbt_posts")
    },
    "versioned_scores": _with("labelled", """SELECT window_id, 1 + window_id % 2 AS version, 3 * (1 + window_id % 2) AS trees, 1 AS as_that_version
        FROM labelled WHERE label IS NOT NULL"""),
    "stream_posts_accounted": """SELECT kind, count(*) AS n FROM (SELECT doc_id, unnest(['kept', 'repeated']) AS kind FROM documents) AS sent
        WHERE doc_id * 5 IN (SELECT event_id FROM events) GROUP BY kind""",
    "forest_tables": _with("labelled", "SELECT window_id, 3 AS n_classes, 1 AS same FROM labelled WHERE label IS NOT NULL"),
    "models_against_majority": _with("window_features split", f"""SELECT feed, model, CAST(sum(n) AS BIGINT) AS n, max(n) AS majority,
        CASE WHEN max(n) < sum(n) THEN 1 ELSE 0 END AS better
        FROM (SELECT 'stock' AS feed, label, count(*) AS n FROM split WHERE is_train AND label IS NOT NULL GROUP BY label
              UNION ALL SELECT 'posts', w.label, count(*) FROM window_features w JOIN split s USING (window_id)
              WHERE is_train AND {_ALL_BUCKETS.replace("label", "w.label")} GROUP BY w.label) AS by_label
        CROSS JOIN (VALUES ('rf'), ('ovr_rf'), ('ovr_gbt')) AS m(model) GROUP BY feed, model"""),
    "eval_fused": _with("window_features split", f"""SELECT count(*) AS n, 1 AS accuracy_agrees, 1 AS f1_agrees FROM window_features w
        JOIN split s USING (window_id) WHERE NOT is_train AND {_ALL_BUCKETS.replace("label", "w.label")}"""),
    "posts_view_append": _with("scored", _POSTS_VIEW.format(day="2024-01-04") + " UNION ALL " + _POSTS_VIEW.format(day="2024-01-05")),
    "split_files": _with("window_features split", f"""SELECT m.model, d.side, count(x.window_id) AS n
        FROM (VALUES ('posts'), ('stock')) AS m(model) CROSS JOIN (VALUES ('train'), ('test')) AS d(side) LEFT JOIN (
            SELECT 'stock' AS model, CASE WHEN is_train THEN 'train' ELSE 'test' END AS side, window_id FROM split WHERE label IS NOT NULL
            UNION ALL SELECT 'posts', CASE WHEN is_train THEN 'train' ELSE 'test' END, window_id FROM window_features w
            JOIN split s USING (window_id) WHERE {_ALL_BUCKETS.replace("label", "w.label")}) AS x
        ON x.model = m.model AND x.side = d.side GROUP BY 1, 2"""),
    "export_predictions": _with("fused_label", "SELECT window_id, label, round(c0, 6) AS prob_0, round(c1, 6) AS prob_1, round(c2, 6) AS prob_2 FROM fused_label"),
    "distinct_rows": "SELECT min(doc_id) AS doc_id, count(*) AS copies, source FROM documents GROUP BY text, source",
    # Invariants of models: which rows must come out, and what must hold for each.
    "score_windows": _with("labelled", "SELECT window_id, 3 AS n_classes, 1.0::DOUBLE AS prob_sum, 1 AS predicts_largest FROM labelled WHERE label IS NOT NULL"),
    "model_roundtrip": _with("split", "SELECT window_id, 1 AS same FROM split WHERE NOT is_train AND label IS NOT NULL"),
    "stream_file_scan": _with("points", _TICK_FILE),
    "stream_post_ingest": _with("posts", _POST_ROWS),
    "stream_acknowledged": _with("posts", _POST_ROWS),
    "stream_dedup": _with("posts", f"SELECT id, {_st('created_at')} AS created_at, source FROM posts"),
    "stream_sentiment_running": _with("scored", f"SELECT {_features('open_bucket', True)} FROM (SELECT sentiment, CASE WHEN on_border THEN 'none' ELSE bucket END AS open_bucket FROM scored) AS open_scored"),
    "stream_count_windows": _with("points", _WINDOW_PRICES + " FROM points GROUP BY window_id HAVING count(*) = 100"),
    "stream_accounted_windows": _with("sent", """SELECT window_id, kind, count(*) AS n, round(sum(p), 6) AS sum_p FROM (
        SELECT window_id, p, CASE WHEN held THEN 'late' WHEN size = 100 AND window_id % 3 <> 1 THEN 'full' ELSE 'expired' END AS kind FROM sent
        UNION ALL SELECT window_id, p, 'repeated' FROM sent WHERE NOT held AND (pos + 1) % 10 = 0) AS counted GROUP BY window_id, kind"""),
    "stream_daily_ticks": _with("ticks", """SELECT CAST(d AS VARCHAR) AS day, count(*) AS count, min(p) AS min_price, max(p) AS max_price, round(avg(p), 6) AS avg_price
        FROM (SELECT CAST(t AS DATE) AS d, p FROM ticks) AS by_day GROUP BY d
        HAVING CAST(d AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(t) - INTERVAL 1 HOUR FROM ticks)"""),
    "stream_interval_join": _with("labelled posts", """SELECT l.window_id, count(p.id) AS n FROM labelled l
        LEFT JOIN posts p ON p.created_at >= l.start_t AND p.created_at <= l.stop_t GROUP BY l.window_id"""),
    "stream_fused_labels": _with("window_features", f"""SELECT window_id, {_st('start_t')} AS start, {_st('stop_t')} AS stop, nr_neg, nr_pos, nr_neutral,
        filled_neg AS mean_neg, filled_pos AS mean_pos, filled_neutral AS mean_neutral, 1 AS as_batch FROM window_features"""),
    "latest_label_view": _with("labelled", "SELECT 'key' AS key, window_id, label FROM labelled WHERE label IS NOT NULL ORDER BY window_id DESC LIMIT 1"),
    "stream_score_windows": _with("labelled", "SELECT window_id, 1 AS known_label, 2.0::DOUBLE AS prob_sum, 1 AS labels_largest, 100 AS n_prices, 6 AS n_features FROM labelled"),
    "stream_pipeline_scores": _with("labelled", "SELECT window_id, 1 AS known_label FROM labelled"),
}
