"""For every registered query the same result in plain SQL over the supplied tables."""

from __future__ import annotations

# --- shared views --------------------------------------------------------------------------------------

REVIEWS_SRC = """reviews_src AS (
  SELECT doc_id AS review_id, source AS product_id, lang AS user_id,
         CASE WHEN doc_id % 89 = 0 THEN NULL WHEN doc_id % 97 = 0 THEN 99 ELSE 1 + doc_id % 5 END AS score,
         TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * (doc_id % 30) AS review_ts,
         text AS summary, text, 'B1' AS _batch_id
  FROM documents
  UNION ALL
  SELECT doc_id, source, lang, 1 + (doc_id + 2) % 5,
         TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * (doc_id % 30),
         text, concat(text, ' Revised <i>edition</i> http://x.co/1 &amp;'), 'B2'
  FROM documents WHERE doc_id % 7 = 0
)"""

POSTS_SRC = """posts_src AS (
  SELECT page_id AS post_id, regexp_extract(url, '^https?://([^/]+)', 1) AS subreddit,
         concat('u', CAST(page_id % 17 AS VARCHAR)) AS author,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS selftext,
         page_id % 40 - 5 AS score, CASE WHEN page_id % 23 = 0 THEN NULL ELSE page_id % 11 END AS num_comments,
         CAST(page_id % 100 AS DOUBLE) / 100 AS upvote_ratio,
         TIMESTAMP '2024-02-01 00:00:00' + INTERVAL '1' DAY * (page_id % 10) AS created_ts,
         'B1' AS _batch_id
  FROM pages
)"""

ORDER_CHANGES = """order_changes AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE seq WHEN 0 THEN 'created' WHEN 1 THEN 'paid' ELSE o_orderstatus END AS status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount, 'USD' AS currency, o_orderdate AS updated_at,
         CASE seq WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'd' END AS op,
         1700000000000 + o_orderkey * 1000
           + CASE WHEN seq = 1 AND o_orderkey % 4 = 0 THEN 0 ELSE seq END AS ts_ms,
         o_orderkey * 10 + seq AS lsn
  FROM orders CROSS JOIN (VALUES (0), (1), (2)) AS s(seq)
  WHERE seq = 0 OR (seq = 1 AND o_orderkey % 2 = 0) OR (seq = 2 AND o_orderkey % 10 = 0)
)"""

CUSTOMERS_SRC = """customers_src AS (
  SELECT CASE WHEN c_custkey % 50 = 0 THEN -c_custkey ELSE c_custkey END AS customer_id, c_name AS full_name, lower(concat(c_name, '@example.com')) AS email,
         c_mktsegment AS segment, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

PREDICTIONS = """predictions AS (
  SELECT doc_id AS id, quality AS label, CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 0 END AS pred,
         CAST(doc_id % 101 AS DOUBLE) / 101 AS proba
  FROM labels
)"""


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')"


def clean(text: str) -> str:
    out = f"coalesce({text}, '')"
    for pattern in ("<[^>]+>", r"http\S+", r"&\w+;", r"\s+"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return f"lower(trim({out}))"


SENTIMENT = "CASE WHEN score >= 4 THEN 'positive' WHEN score <= 2 THEN 'negative' ELSE 'neutral' END"


def conformed_reviews(source: str = "reviews_src", name: str = "conformed") -> str:
    return f"""{name} AS (
  SELECT review_id, product_id, user_id, score, review_ts, summary, text, _batch_id,
         {clean('text')} AS text_clean, {clean('summary')} AS summary_clean,
         CAST(review_ts AS DATE) AS review_date, {SENTIMENT} AS sentiment_label
  FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY _batch_id DESC) AS rn FROM {source}) AS d
  WHERE rn = 1
)"""


CONFORMED_POSTS = f"""conformed_posts AS (
  SELECT *, {clean('title')} AS title_clean, {clean('selftext')} AS body_clean,
         CAST(created_ts AS DATE) AS created_date, (num_comments >= 5 OR score >= 20) AS is_engaged
  FROM posts_src
)"""


def daily(source: str) -> str:
    return f"""SELECT review_date, product_id, count(*) AS review_count, round(avg(score), 3) AS avg_score,
       CAST(count(*) FILTER (WHERE sentiment_label = 'positive') AS BIGINT) AS positives,
       CAST(count(*) FILTER (WHERE sentiment_label = 'negative') AS BIGINT) AS negatives,
       round(avg(length(text_clean)), 1) AS avg_text_len
FROM {source} GROUP BY review_date, product_id"""


def engagement(source: str) -> str:
    return f"""SELECT created_date, subreddit, count(*) AS posts, round(avg(score), 2) AS avg_score,
       round(avg(num_comments), 2) AS avg_comments, round(avg(upvote_ratio), 4) AS avg_upvote_ratio,
       CAST(sum(CAST(is_engaged AS INT)) AS BIGINT) AS engaged_posts
FROM {source} GROUP BY created_date, subreddit"""


LAST_CHANGE = """last_change AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, lsn DESC) AS rn FROM order_changes
  ) AS r WHERE rn = 1
)"""


def enriched(source: str) -> str:
    return f"""SELECT o.order_id, o.customer_id, c.full_name, c.segment, c.country, o.status,
       CAST(o.amount AS DOUBLE) AS amount, o.currency, o.updated_at, CAST(o.updated_at AS DATE) AS order_date
FROM {source} AS o LEFT JOIN customers_src AS c ON o.customer_id = c.customer_id"""


def with_views(body: str, *views: str) -> str:
    return f"WITH {', '.join(views)}\n{body}" if views else body


ORACLE: dict[str, str] = {}

# --- landing -------------------------------------------------------------------------------------------

ORACLE["normalize_reviews"] = with_views(
    f"""SELECT review_id, product_id, user_id, CAST(score AS BIGINT) AS score, {moment('review_ts')} AS review_ts,
       summary, text FROM reviews_src""",
    REVIEWS_SRC,
)
ORACLE["normalize_posts"] = with_views(
    f"""SELECT CAST(post_id AS VARCHAR) AS post_id, subreddit, author, title, selftext,
       CAST(score AS BIGINT) AS score, CAST(num_comments AS BIGINT) AS num_comments, upvote_ratio,
       {moment('created_ts')} AS created_ts FROM posts_src""",
    POSTS_SRC,
)
ORACLE["batch_ids"] = with_views("SELECT DISTINCT _batch_id FROM reviews_src", REVIEWS_SRC)
ORACLE["bronze_replay"] = with_views(
    f"""SELECT review_id, product_id, score, {moment('review_ts')} AS review_ts, text, _batch_id
FROM reviews_src""",
    REVIEWS_SRC,
)

# --- silver --------------------------------------------------------------------------------------------

ORACLE["dedupe_latest"] = with_views(
    """SELECT review_id, score, summary, _batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY _batch_id DESC) AS rn FROM reviews_src
) AS d WHERE rn = 1""",
    REVIEWS_SRC,
)
ORACLE["clean_text_pages"] = f"SELECT page_id, {clean('html')} AS html_clean FROM pages"
ORACLE["clean_text_docs"] = f"SELECT doc_id, {clean('text')} AS text_clean FROM documents"
ORACLE["sentiment_label"] = with_views(
    f"SELECT review_id, _batch_id, score, {SENTIMENT} AS sentiment_label FROM reviews_src", REVIEWS_SRC
)
ORACLE["is_engaged"] = with_views(
    "SELECT post_id, CAST((num_comments >= 5 OR score >= 20) AS VARCHAR) AS is_engaged FROM posts_src", POSTS_SRC
)
ORACLE["silver_reviews"] = with_views(
    f"""SELECT review_id, product_id, user_id, score, {moment('review_ts')} AS review_ts, summary, text, _batch_id,
       text_clean, summary_clean, {day('review_date')} AS review_date, sentiment_label
FROM second_gate""",
    REVIEWS_SRC,
    conformed_reviews(),
    """first_gate AS (
  SELECT * FROM conformed
  WHERE (SELECT count(*) FROM conformed WHERE NOT (score BETWEEN 1 AND 5)) = 0
     OR coalesce(score BETWEEN 1 AND 5, FALSE)
)""",
    """second_gate AS (
  SELECT * FROM first_gate
  WHERE (SELECT count(*) FROM first_gate WHERE NOT (length(text_clean) > 0)) = 0
     OR coalesce(length(text_clean) > 0, FALSE)
)""",
)
ORACLE["silver_posts"] = with_views(
    f"""SELECT post_id, subreddit, author, title, selftext, score, num_comments, upvote_ratio,
       {moment('created_ts')} AS created_ts, _batch_id, title_clean, body_clean,
       {day('created_date')} AS created_date, CAST(is_engaged AS VARCHAR) AS is_engaged
FROM conformed_posts
WHERE (SELECT count(*) FROM conformed_posts WHERE NOT (subreddit IS NOT NULL)) = 0 OR subreddit IS NOT NULL""",
    POSTS_SRC,
    CONFORMED_POSTS,
)
ORACLE["merge_upsert"] = with_views(
    """SELECT review_id, score, summary, _batch_id FROM reviews_src AS t
WHERE _batch_id = 'B1' AND NOT EXISTS (
  SELECT 1 FROM reviews_src AS s WHERE s._batch_id = 'B2' AND s.review_id = t.review_id
)
UNION ALL SELECT review_id, score, summary, _batch_id FROM reviews_src WHERE _batch_id = 'B2'""",
    REVIEWS_SRC,
)

# --- quality -------------------------------------------------------------------------------------------

_PRESENT, _IN_RANGE = "length(text) > 0", "score BETWEEN 1 AND 5"
ORACLE["dq_counts"] = with_views(
    """SELECT rule, action, total_rows, violations, round(100.0 * violations / total_rows, 6) AS violation_pct
FROM (
  SELECT 'pk_not_null' AS rule, 'fail' AS action, count(*) AS violations FROM reviews_src WHERE NOT (review_id IS NOT NULL)
  UNION ALL SELECT 'text_present', 'drop', count(*) FROM reviews_src WHERE NOT (length(text) > 0)
  UNION ALL SELECT 'score_in_range', 'drop', count(*) FROM after_text WHERE NOT (score BETWEEN 1 AND 5)
  UNION ALL SELECT 'low_score', 'warn', count(*) FROM after_score WHERE NOT (score <= 3)
  UNION ALL SELECT 'known_language', 'warn', count(*) FROM after_score WHERE NOT (user_id IN ('en', 'de'))
) AS v CROSS JOIN (SELECT count(*) AS total_rows FROM reviews_src) AS t""",
    REVIEWS_SRC,
    f"""after_text AS (
  SELECT * FROM reviews_src
  WHERE (SELECT count(*) FROM reviews_src WHERE NOT ({_PRESENT})) = 0 OR coalesce({_PRESENT}, FALSE)
)""",
    f"""after_score AS (
  SELECT * FROM after_text
  WHERE (SELECT count(*) FROM after_text WHERE NOT ({_IN_RANGE})) = 0 OR coalesce({_IN_RANGE}, FALSE)
)""",
)
ORACLE["dq_warn"] = with_views("SELECT review_id, _batch_id, score FROM reviews_src", REVIEWS_SRC)
ORACLE["dq_drop"] = with_views(
    f"""SELECT review_id, _batch_id, score FROM after_first
WHERE (SELECT count(*) FROM after_first WHERE NOT ({_IN_RANGE})) = 0 OR coalesce({_IN_RANGE}, FALSE)""",
    REVIEWS_SRC,
    """after_first AS (
  SELECT * FROM reviews_src
  WHERE (SELECT count(*) FROM reviews_src WHERE NOT (score > -1)) = 0 OR coalesce(score > -1, FALSE)
)""",
)
ORACLE["dq_fail_pct"] = with_views(
    """SELECT rule, action, total_rows, violations, round(100.0 * violations / total_rows, 6) AS violation_pct,
       CASE WHEN action = 'fail' AND 100.0 * violations / total_rows > 5.0 THEN 'true' ELSE 'false' END AS failed
FROM (
  SELECT 'score_in_range' AS rule, 'drop' AS action, count(*) AS violations FROM reviews_src WHERE NOT (score BETWEEN 1 AND 5)
  UNION ALL SELECT 'good_score', 'fail', count(*) FROM reviews_src WHERE score BETWEEN 1 AND 5 AND NOT (score >= 2)
) AS v CROSS JOIN (SELECT count(*) AS total_rows FROM reviews_src) AS t""",
    REVIEWS_SRC,
)

# --- gold ----------------------------------------------------------------------------------------------

ORACLE["reviews_daily"] = with_views(
    f"SELECT * REPLACE ({day('review_date')} AS review_date) FROM ({daily('conformed')}) AS d",
    REVIEWS_SRC,
    conformed_reviews(),
)
ORACLE["engagement_daily"] = with_views(
    f"SELECT * REPLACE ({day('created_date')} AS created_date) FROM ({engagement('conformed_posts')}) AS d",
    POSTS_SRC,
    CONFORMED_POSTS,
)
_PLAIN_ORDER = f"* REPLACE ({moment('updated_at')} AS updated_at, {day('order_date')} AS order_date)"
ORACLE["orders_enriched"] = with_views(
    f"SELECT {_PLAIN_ORDER} FROM ({enriched('live')}) AS e",
    ORDER_CHANGES,
    LAST_CHANGE,
    "live AS (SELECT * FROM last_change WHERE op <> 'd')",
    CUSTOMERS_SRC,
)
ORACLE["text_features"] = with_views(
    f"""SELECT review_id AS id, text_clean AS text, CASE WHEN sentiment_label = 'positive' THEN 1 ELSE 0 END AS label,
       {day('review_date')} AS review_date
FROM conformed WHERE sentiment_label <> 'neutral' AND length(text_clean) >= 10""",
    REVIEWS_SRC,
    conformed_reviews(),
)
ORACLE["serving_view"] = with_views(
    f"""SELECT order_id, customer_id, segment, country, status, amount,
       {moment("date_trunc('millisecond', updated_at)")} AS updated_at
FROM ({enriched('live')}) AS e
WHERE updated_at >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL '90' DAY""",
    ORDER_CHANGES,
    LAST_CHANGE,
    "live AS (SELECT * FROM last_change WHERE op <> 'd')",
    CUSTOMERS_SRC,
)

ORACLE["serving_stream"] = with_views(
    f"""SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) AS amount,
       {moment("date_trunc('millisecond', updated_at)")} AS updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, lsn DESC) AS k
      FROM order_changes WHERE op <> 'd') AS v
WHERE k = 1 AND updated_at >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL '90' DAY""",
    ORDER_CHANGES,
)

# --- change data ---------------------------------------------------------------------------------------

ORACLE["cdc_unwrap"] = with_views(
    f"""SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) AS amount, currency,
       {moment('updated_at')} AS updated_at, op AS _op, ts_ms AS _event_ts_ms, lsn AS _lsn
FROM order_changes""",
    ORDER_CHANGES,
)
ORACLE["cdc_typed"] = with_views(
    f"""SELECT order_id, lsn,
       CASE WHEN lsn % 7 = 0 OR lsn % 13 = 0 THEN NULL ELSE CAST(amount AS DOUBLE) END AS amount,
       CASE WHEN lsn % 11 = 0 THEN NULL ELSE {moment('updated_at')} END AS updated_at
FROM order_changes""",
    ORDER_CHANGES,
)
ORACLE["latest_change"] = with_views(
    f"""SELECT order_id, customer_id, status, CAST(amount AS VARCHAR) AS amount, currency,
       {moment('updated_at')} AS updated_at, op, ts_ms, lsn FROM last_change""",
    ORDER_CHANGES,
    LAST_CHANGE,
)
ORACLE["cdc_merge"] = with_views(
    f"""SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) AS amount, {moment('updated_at')} AS updated_at
FROM last_change WHERE op <> 'd'""",
    ORDER_CHANGES,
    LAST_CHANGE,
)
ORACLE["cdc_merge_deletes"] = with_views(
    """SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) AS amount FROM target AS t
WHERE NOT EXISTS (SELECT 1 FROM source AS s WHERE s.order_id = t.order_id)
UNION ALL SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) FROM source WHERE op <> 'd'""",
    ORDER_CHANGES,
    "target AS (SELECT * FROM order_changes WHERE op = 'c' AND updated_at < TIMESTAMP '1998-06-01 00:00:00')",
    """source AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, lsn DESC) AS rn
    FROM order_changes WHERE op <> 'c'
  ) AS r WHERE rn = 1 AND updated_at >= TIMESTAMP '1996-01-01 00:00:00'
)""",
)
ORACLE["cdc_extract_since"] = f"""SELECT o_orderkey, o_custkey, {moment('o_orderdate')} AS o_orderdate
FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01 00:00:00'"""
ORACLE["cdc_watermark"] = with_views(
    "SELECT strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') AS watermark FROM order_changes", ORDER_CHANGES
)
ORACLE["watermark_latest"] = """SELECT event_type AS "table", lpad(CAST(event_id AS VARCHAR), 12, '0') AS watermark
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS e
WHERE rn = 1"""
ORACLE["cdc_batch_sync"] = with_views(
    f"""SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) AS amount, {moment('updated_at')} AS updated_at
FROM (
  SELECT * FROM source WHERE updated_at > TIMESTAMP '1999-01-01 00:00:00'
  UNION ALL
  SELECT *, 1 FROM order_changes WHERE op = 'c' AND NOT (updated_at > TIMESTAMP '1999-01-01 00:00:00')
) AS merged""",
    ORDER_CHANGES,
    """source AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, lsn DESC) AS rn
    FROM order_changes WHERE op <> 'd'
  ) AS r WHERE rn = 1
)""",
)
ORACLE["cdc_reconcile"] = with_views(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'd' AS _op FROM orders
WHERE o_orderkey IN (SELECT order_id FROM last_change WHERE op = 'd')""",
    ORDER_CHANGES,
    LAST_CHANGE,
)
ORACLE["cdc_reconcile_ranges"] = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'd' AS _op FROM orders
WHERE o_orderkey % 10 = 0 AND o_orderkey % 1000 < 100"""
ORACLE["cdc_stream"] = with_views(
    f"""SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) AS amount, currency,
       {moment('updated_at')} AS updated_at
FROM last_change WHERE op <> 'd'""",
    ORDER_CHANGES,
    LAST_CHANGE,
)

# --- delivery ------------------------------------------------------------------------------------------


def _upper(columns: str) -> str:
    return ", ".join(f"{name} AS {name.upper()}" for name in columns.split())


_DAILY = "review_count avg_score positives negatives avg_text_len"
ORACLE["deliver_reviews_daily"] = with_views(
    f"""SELECT {day('review_date')} AS REVIEW_DATE, {_upper('product_id ' + _DAILY)} FROM (
  SELECT * FROM new_days
  UNION ALL
  SELECT * FROM old_days AS o WHERE NOT EXISTS (
    SELECT 1 FROM new_days AS n WHERE n.review_date = o.review_date AND n.product_id = o.product_id)
) AS merged""",
    REVIEWS_SRC,
    "b1 AS (SELECT * FROM reviews_src WHERE _batch_id = 'B1')",
    "b2 AS (SELECT * FROM reviews_src WHERE _batch_id = 'B2')",
    conformed_reviews("b1", "c1"),
    conformed_reviews("b2", "c2"),
    f"old_days AS ({daily('c1')})",
    f"new_days AS ({daily('c2')})",
)
ORACLE["deliver_engagement"] = with_views(
    f"""SELECT {day('created_date')} AS CREATED_DATE,
       {_upper('subreddit posts avg_score avg_comments avg_upvote_ratio engaged_posts')} FROM (
  SELECT * FROM new_days
  UNION ALL
  SELECT * FROM old_days AS o WHERE NOT EXISTS (
    SELECT 1 FROM new_days AS n WHERE n.created_date = o.created_date AND n.subreddit = o.subreddit)
) AS merged""",
    POSTS_SRC,
    CONFORMED_POSTS,
    "engaged AS (SELECT * FROM conformed_posts WHERE is_engaged)",
    f"old_days AS ({engagement('conformed_posts')})",
    f"new_days AS ({engagement('engaged')})",
)
ORACLE["deliver_orders"] = with_views(
    f"""SELECT {_upper('order_id customer_id full_name segment country status amount currency')},
       {moment('updated_at')} AS UPDATED_AT, {day('order_date')} AS ORDER_DATE
FROM (
  {enriched('live')}
  UNION ALL
  {enriched('gone')}
) AS merged""",
    ORDER_CHANGES,
    LAST_CHANGE,
    CUSTOMERS_SRC,
    "live AS (SELECT * FROM last_change WHERE op <> 'd')",
    """gone AS (SELECT * FROM order_changes WHERE op = 'c'
         AND order_id IN (SELECT order_id FROM last_change WHERE op = 'd'))""",
)
ORACLE["contract_unique"] = with_views(
    "SELECT review_id, count(*) AS copies FROM reviews_src GROUP BY review_id HAVING count(*) > 1", REVIEWS_SRC
)

# --- features and models -------------------------------------------------------------------------------

ORACLE["sample_cap"] = """SELECT o_orderkey, o_custkey FROM orders
ORDER BY md5(concat('42-', CAST(o_orderkey AS VARCHAR))) LIMIT 4000"""

SPLIT = """split AS (
  SELECT id, label,
         CASE WHEN place <= (n + 4) // 5 THEN 'test'
              WHEN place <= (n + 4) // 5 + (n - (n + 4) // 5 + 7) // 8 THEN 'val'
              ELSE 'train' END AS split
  FROM (
    SELECT id, label, count(*) OVER (PARTITION BY label) AS n,
           row_number() OVER (PARTITION BY label ORDER BY md5(concat('42-', CAST(id AS VARCHAR)))) AS place
    FROM predictions WHERE label IS NOT NULL
  ) AS r
)"""
ORACLE["split_assign"] = with_views("SELECT id, label, split FROM split", PREDICTIONS, SPLIT)
ORACLE["split_counts"] = with_views(
    "SELECT split, label, count(*) AS n FROM split GROUP BY split, label", PREDICTIONS, SPLIT
)

TOKENS = r"""tokens AS (
  SELECT doc_id AS id, regexp_extract_all(lower(%s), '[\p{L}\p{N}_]{2,}') AS t FROM documents
)""" % clean("text")
COUNTS = """counts AS (
  SELECT id, term, count(*) AS tf FROM (
    SELECT id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
    FROM tokens
  ) AS u GROUP BY id, term
)"""
STATS = """stats AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM counts GROUP BY term HAVING count(*) >= 3
)"""
ORACLE["term_df"] = with_views("SELECT term, df, total FROM stats", TOKENS, COUNTS, STATS)
ORACLE["tfidf_weights"] = with_views(
    """SELECT id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)), 6) AS weight FROM (
  SELECT id, c.term, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1) AS raw
  FROM counts AS c JOIN kept AS k ON c.term = k.term
) AS w""",
    TOKENS,
    COUNTS,
    STATS,
    "kept AS (SELECT term, df FROM stats ORDER BY total DESC, term LIMIT 50000)",
)

NEIGHBOURS = """near AS (
  SELECT query_id, id, similarity, label, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (
      SELECT q.vec_id AS query_id, c.vec_id AS id, c.label,
             round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 10) AS similarity
      FROM embeddings AS q JOIN embeddings AS c ON q.vec_id % 5 = 0 AND c.vec_id % 5 <> 0
    ) AS s
  ) AS r WHERE rank <= 11
)"""
ORACLE["knn_neighbors"] = with_views(
    "SELECT query_id, id, round(similarity, 6) AS similarity, CAST(rank AS INT) AS rank FROM near", NEIGHBOURS
)
ORACLE["knn_vote"] = with_views(
    """SELECT query_id, label, round(vote, 6) AS vote,
       round(vote / sum(vote) OVER (PARTITION BY query_id), 6) AS proba,
       first_value(label) OVER (PARTITION BY query_id ORDER BY round(vote, 8) DESC, label) AS predicted
FROM votes""",
    NEIGHBOURS,
    """weighted AS (
  SELECT query_id, label, greatest(round(1 - similarity, 10), 0.0) AS d,
         min(greatest(round(1 - similarity, 10), 0.0)) OVER (PARTITION BY query_id) AS closest
  FROM near
)""",
    """votes AS (
  SELECT query_id, label, sum(CASE WHEN closest > 0 THEN 1 / d WHEN d = 0 THEN 1.0 ELSE 0.0 END) AS vote
  FROM weighted GROUP BY query_id, label
)""",
)

REPORT = """report AS (
  SELECT class, support, CASE WHEN predicted = 0 THEN 0.0 ELSE hits / CAST(predicted AS DOUBLE) END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE hits / CAST(support AS DOUBLE) END AS recall,
         2 * hits / CAST(support + predicted AS DOUBLE) AS f1, hits
  FROM (
    SELECT class, (SELECT count(*) FROM judged WHERE label = class) AS support,
           (SELECT count(*) FROM judged WHERE pred = class) AS predicted,
           (SELECT count(*) FROM judged WHERE label = class AND pred = class) AS hits
    FROM (SELECT label AS class FROM judged UNION SELECT pred FROM judged) AS classes
  ) AS c
)"""
_JUDGED = "judged AS (SELECT label, pred FROM predictions)"
ORACLE["class_report"] = with_views(
    """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM report""",
    PREDICTIONS,
    _JUDGED,
    REPORT,
)
ORACLE["metrics_macro"] = with_views(
    """SELECT round(CAST(sum(hits) AS DOUBLE) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro,
       round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro FROM report""",
    PREDICTIONS,
    _JUDGED,
    REPORT,
)
ORACLE["roc_auc"] = with_views(
    """SELECT round((sum(CASE WHEN label = 1 THEN mid END) - p * (p + 1) / 2.0) / (p * CAST(n AS DOUBLE)), 6) AS roc_auc
FROM (
  SELECT label, rank() OVER (ORDER BY proba) + (count(*) OVER (PARTITION BY proba) - 1) / 2.0 AS mid FROM predictions
) AS r CROSS JOIN (
  SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS n FROM predictions
) AS c GROUP BY p, n""",
    PREDICTIONS,
)
ORACLE["best_candidate"] = with_views(
    """SELECT position, threshold, round(f1_macro, 6) AS f1_macro FROM (
  SELECT position, threshold, avg(f1) AS f1_macro FROM (
    SELECT position, threshold, class,
           2 * count(*) FILTER (WHERE label = class AND pred = class)
             / CAST(count(*) FILTER (WHERE label = class) + count(*) FILTER (WHERE pred = class) AS DOUBLE) AS f1
    FROM (
      SELECT position, threshold, label, CASE WHEN proba >= threshold THEN 1 ELSE 0 END AS pred
      FROM predictions CROSS JOIN (VALUES (0, CAST(0.3 AS DOUBLE)), (1, 0.5), (2, 0.7)) AS t(position, threshold)
    ) AS j CROSS JOIN (VALUES (0), (1)) AS k(class)
    GROUP BY position, threshold, class
  ) AS per_class GROUP BY position, threshold
) AS m ORDER BY m.f1_macro DESC, position LIMIT 1""",
    PREDICTIONS,
)
ORACLE["promotion"] = with_views(
    """SELECT v.model, v.version AS challenger, coalesce(cs.value, -1.0) AS challenger_score, h.version AS champion,
       coalesce(hs.value, -1.0) AS champion_score,
       CAST(coalesce(cs.value, -1.0) >= coalesce(hs.value, -1.0) + 0.01 AS VARCHAR) AS promoted
FROM (SELECT model, max(version) AS version FROM versions GROUP BY model
      UNION ALL SELECT model || '-new', min(version) FROM versions GROUP BY model) AS v
LEFT JOIN (SELECT model, min(version) AS version FROM versions GROUP BY model) AS h
  ON v.model = h.model
LEFT JOIN scores AS cs ON cs.model = v.model AND cs.version = v.version
LEFT JOIN scores AS hs ON hs.model = h.model AND hs.version = h.version""",
    """versions AS (
  SELECT event_type AS model, CAST(date_diff('day', DATE '2020-01-01', CAST(ts AS DATE)) AS INT) AS version,
         round(avg(value), 6) AS value
  FROM events GROUP BY ALL
)""",
    "scores AS (SELECT * FROM versions)",
)
ORACLE["score_projection"] = with_views(
    """SELECT id, substring(text, 1, 120) AS text, pred AS label,
       CASE WHEN pred = 1 THEN 'positive' ELSE 'negative' END AS sentiment
FROM predictions JOIN documents ON doc_id = id""",
    PREDICTIONS,
)
ORACLE["seq_ids"] = with_views(
    r"""SELECT d.doc_id AS id, CASE WHEN coalesce(n, 0) = 0 THEN rtrim(repeat('0 ', 128)) ELSE ids || repeat(' 0', 128 - n) END AS ids
FROM documents AS d LEFT JOIN (
  SELECT h.id, count(*) AS n, string_agg(CAST(coalesce(word_id, 1) AS VARCHAR), ' ' ORDER BY pos) AS ids
  FROM head AS h LEFT JOIN vocabulary AS v ON h.word = v.word GROUP BY h.id
) AS s ON s.id = d.doc_id""",
    r"""split_words AS (
  SELECT doc_id AS id, list_filter(string_split_regex(
    regexp_replace(lower(%s), '[!"#$%%&()*+,\-./:;<=>?@\[\\\]^_`{|}~'']', '', 'g'), '\s+'), lambda w: w <> '') AS words
  FROM documents
)"""
    % clean("text"),
    """vocabulary AS (
  SELECT word, 1 + row_number() OVER (ORDER BY n DESC, word DESC) AS word_id
  FROM (SELECT unnest(words) AS word, count(*) AS n FROM split_words GROUP BY 1) AS c
  ORDER BY n DESC, word DESC LIMIT 29998
)""",
    """head AS (
  SELECT id, unnest(words[1:128]) AS word, generate_subscripts(words[1:128], 1) AS pos FROM split_words
)""",
)
