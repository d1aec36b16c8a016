"""DuckDB SQL that must return the same rows as each registered query.

Written independently of the Spark plans, over the raw benchmark views.
Conventions that keep the comparison exact (both engines agree bit for bit):

* money is summed as DECIMAL and cast to DOUBLE at the end;
* means of integers are exact ``sum / count`` doubles; 2-place means are
  HALF_UP from the exact integer ratio (``(2*100*s + n) // (2*n) / 100``);
* integer results are cast to the Spark type (``year``/``month``/ranks to
  INTEGER, integer sums to BIGINT).
"""

from __future__ import annotations

from quarry.functions.buckets import AGE_LABELS_DASH, AGE_LABELS_OVERLAP
from quarry.plans.bindings import (BALANCE_BOUNDS, MIN_RATINGS_FOR_BEST, REVENUE_YEAR,
                                   SCORE_DIVISOR, STOP_WORDS, TOP_K_WORDS, WORD_FREQ_THRESHOLD)
from quarry.sources.tables import TABLES

_STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)

_TOKENS = r"unnest(regexp_split_to_array(lower(regexp_replace({col}, '[^\p{{L}}\p{{N}}\s]', ' ', 'g')), '\s+'))"
_KEEP = f"word IS NOT NULL AND trim(word) <> '' AND word NOT IN ({_STOP_LIST})"

_LABELLED_DOCS = """
  docs AS (
    SELECT d.doc_id AS rid, d.text AS comment, d.lang AS category, d.source AS aspect,
           CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
                ELSE 'neutral' END AS sentiment
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

_WORDS = f"""
  toks AS (SELECT rid, category, aspect, sentiment, {_TOKENS.format(col='comment')} AS word FROM docs),
  words AS (SELECT * FROM toks WHERE {_KEEP})"""

_RATINGS_USER = """
  r AS (SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id, l.l_quantity AS rating
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_B0, _B1, _B2 = BALANCE_BOUNDS


def _bucket(col: str, labels: tuple[str, str, str, str]) -> str:
    return (f"CASE WHEN {col} <= {_B0} THEN '{labels[0]}' WHEN {col} <= {_B1} THEN '{labels[1]}' "
            f"WHEN {col} <= {_B2} THEN '{labels[2]}' WHEN {col} IS NOT NULL THEN '{labels[3]}' END")


def _half_up(num: str, den: str) -> str:
    """HALF_UP(num / den, 2) for integers, den > 0 (NULL otherwise)."""
    return (f"CASE WHEN ({den}) > 0 THEN CAST(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * "
            f"((abs({num}) * 200 + ({den})) // (2 * ({den}))) AS DOUBLE) / 100.0::DOUBLE END")


def _f32_mean(s: str, n: str) -> str:
    return f"CAST(CAST({s} AS FLOAT)::DOUBLE / CAST({n} AS FLOAT)::DOUBLE AS FLOAT)"


_SCORE = f"CAST(trunc(value / {SCORE_DIVISOR}) AS INTEGER)"
_VALID_SCORES = f"""
  v AS (SELECT event_id AS order_id, {_SCORE} AS score FROM events
        WHERE value IS NOT NULL AND trunc(value / {SCORE_DIVISOR}) BETWEEN 1 AND 5)"""

_REVENUE = ("CAST(l_extendedprice AS DECIMAL(18,2)) + "
            "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))")

_CUSTOMERS = """
  cust AS (SELECT c.c_custkey AS customer_id, n.n_name AS country
           FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_DUCK_TO_SPARK_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
      WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float'
      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
      WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END"""

_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)
_COUNTS = "\n    UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS n_rows FROM {t}" for t in TABLES)


def _top_words(sentiment: str | None) -> str:
    where = f"sentiment = '{sentiment}' AND " if sentiment else ""
    return f"""
WITH {_LABELLED_DOCS},{_WORDS},
  f AS (SELECT category, word, count(*) AS freq FROM words
        WHERE {where}category IS NOT NULL GROUP BY category, word),
  ranked AS (SELECT category, word, freq,
                    CAST(row_number() OVER (PARTITION BY category ORDER BY freq DESC, word) AS INTEGER)
                      AS rank_in_category
             FROM f)
SELECT category, word, freq, rank_in_category FROM ranked WHERE rank_in_category <= {TOP_K_WORDS}"""


def _aspect_counts(sentiment: str) -> str:
    return f"""
WITH {_LABELLED_DOCS}
SELECT aspect, count(rid) AS {sentiment}_count FROM docs WHERE sentiment = '{sentiment}' GROUP BY aspect"""


def _top_aspect(sentiment: str) -> str:
    return f"""
WITH {_LABELLED_DOCS},
  c AS (SELECT aspect, count(rid) AS {sentiment}_count FROM docs
        WHERE sentiment = '{sentiment}' GROUP BY aspect)
SELECT aspect, {sentiment}_count FROM c WHERE {sentiment}_count = (SELECT max({sentiment}_count) FROM c)"""


_MOVIE_STATS = """
  s AS (SELECT l_partkey AS movie_id, sum(l_quantity) AS sm, count(l_quantity) AS total_ratings
        FROM lineitem GROUP BY l_partkey),
  m AS (SELECT s.movie_id, coalesce(p.p_name, {default}) AS title,
               s.sm / s.total_ratings AS avg_rating, s.total_ratings
        FROM s LEFT JOIN part p ON s.movie_id = p.p_partkey)"""

_GENRE_BASE = """
WITH pm AS (SELECT l_partkey AS movie_id, sum(l_quantity) AS sm, count(l_quantity) AS n
            FROM lineitem GROUP BY l_partkey),
  t0 AS (SELECT p_partkey AS movie_id, trim(unnest(string_split(p_name, ' '))) AS genre FROM part),
  tags AS (SELECT movie_id, genre FROM t0 WHERE genre <> ''),
  g AS (SELECT genre, sum(sm) AS sm, sum(n) AS n FROM pm JOIN tags USING (movie_id) GROUP BY genre)"""


def _gender_aggs() -> str:
    parts = []
    for g in ("M", "F"):
        k = g.lower()
        parts.append(f"sum(CASE WHEN gender = '{g}' THEN rating END) AS s_{k}, "
                     f"count(CASE WHEN gender = '{g}' THEN rating END) AS {k}_count")
    return ", ".join(parts)


_AGE_OVERLAP = AGE_LABELS_OVERLAP
_AGE_DASH = AGE_LABELS_DASH
_AGE_COLS = ("age_0_18", "age_18_35", "age_35_50", "age_50_plus")


def _age_wide() -> str:
    aggs = ", ".join(
        f"sum(CASE WHEN age_group = '{lab}' THEN rating END) AS s_{c}, "
        f"count(CASE WHEN age_group = '{lab}' THEN rating END) AS {c}_count"
        for lab, c in zip(_AGE_OVERLAP, _AGE_COLS))
    cols = ", ".join(
        f"coalesce(CASE WHEN {c}_count > 0 THEN s_{c} / {c}_count END, 0.0::DOUBLE) AS {c}_avg, {c}_count"
        for c in _AGE_COLS)
    return f"""
WITH {_RATINGS_USER},
  x AS (SELECT r.movie_id, r.rating, {_bucket('c.c_acctbal', _AGE_OVERLAP)} AS age_group
        FROM r JOIN customer c ON r.user_id = c.c_custkey),
  s AS (SELECT movie_id, {aggs} FROM x WHERE age_group IS NOT NULL GROUP BY movie_id)
SELECT s.movie_id, coalesce(p.p_name, '?') AS title, {cols}
FROM s LEFT JOIN part p ON s.movie_id = p.p_partkey"""


def _age_by_title() -> str:
    aggs = ", ".join(
        f"sum(CASE WHEN age_group = '{lab}' THEN rating END) AS s_{c}, "
        f"count(CASE WHEN age_group = '{lab}' THEN rating END) AS {c}_count"
        for lab, c in zip(_AGE_OVERLAP, _AGE_COLS))
    cols = ", ".join(
        f"coalesce(CASE WHEN {c}_count > 0 THEN {_f32_mean('s_' + c, c + '_count')} END, CAST(0.0 AS FLOAT)) "
        f"AS {c}_avg, {c}_count" for c in _AGE_COLS)
    return f"""
WITH {_RATINGS_USER},
  x AS (SELECT p.p_name AS title, r.rating, {_bucket('c.c_acctbal', _AGE_OVERLAP)} AS age_group
        FROM r JOIN customer c ON r.user_id = c.c_custkey JOIN part p ON r.movie_id = p.p_partkey),
  s AS (SELECT title, {aggs} FROM x
        WHERE title IS NOT NULL AND age_group IS NOT NULL AND rating IS NOT NULL GROUP BY title)
SELECT title, {cols} FROM s"""


ORACLE_SQL: dict[str, str] = {
    # ------------------------------------------------------------ ratings
    "movie_stats": f"""
WITH {_MOVIE_STATS.format(default="'?'")}
SELECT movie_id, title, avg_rating, total_ratings FROM m""",

    "movie_stats_float32": f"""
WITH {_MOVIE_STATS.format(default="CAST(s.movie_id AS VARCHAR)")}
SELECT m.movie_id, m.title, {_f32_mean('s.sm', 's.total_ratings')} AS avg_rating, m.total_ratings
FROM m JOIN s ON m.movie_id = s.movie_id""",

    "best_movie": f"""
WITH {_MOVIE_STATS.format(default="'?'")}
SELECT movie_id, title, avg_rating, total_ratings FROM m WHERE total_ratings >= {MIN_RATINGS_FOR_BEST}
ORDER BY avg_rating DESC, total_ratings DESC, lower(title), movie_id LIMIT 1""",

    "best_movie_by_id_text": f"""
WITH {_MOVIE_STATS.format(default="CAST(s.movie_id AS VARCHAR)")}
SELECT m.movie_id, m.title, {_f32_mean('s.sm', 's.total_ratings')} AS avg_rating, m.total_ratings
FROM m JOIN s ON m.movie_id = s.movie_id WHERE m.total_ratings >= {MIN_RATINGS_FOR_BEST}
ORDER BY avg_rating DESC, CAST(m.movie_id AS VARCHAR) LIMIT 1""",

    "genre_stats": f"""{_GENRE_BASE}
SELECT genre, sm / n AS avg_rating, CAST(n AS BIGINT) AS total_ratings FROM g""",

    "genre_stats_float32": f"""{_GENRE_BASE}
SELECT genre, {_f32_mean('sm', 'n')} AS avg_rating, CAST(n AS BIGINT) AS total_ratings FROM g""",

    "gender_stats": f"""
WITH {_RATINGS_USER},
  x AS (SELECT r.movie_id, r.rating, substr(c.c_mktsegment, 1, 1) AS gender
        FROM r JOIN customer c ON r.user_id = c.c_custkey),
  s AS (SELECT movie_id, {_gender_aggs()} FROM x WHERE gender IN ('M', 'F') GROUP BY movie_id)
SELECT s.movie_id, coalesce(p.p_name, '?') AS title,
       CASE WHEN m_count > 0 THEN s_m / m_count END AS m_avg, m_count,
       CASE WHEN f_count > 0 THEN s_f / f_count END AS f_avg, f_count
FROM s LEFT JOIN part p ON s.movie_id = p.p_partkey""",

    "gender_means_by_title": f"""
WITH {_RATINGS_USER},
  x AS (SELECT p.p_name AS title, r.rating, upper(substr(c.c_mktsegment, 1, 1)) AS gender
        FROM r JOIN customer c ON r.user_id = c.c_custkey JOIN part p ON r.movie_id = p.p_partkey),
  s AS (SELECT title, {_gender_aggs()} FROM x WHERE title IS NOT NULL AND rating IS NOT NULL GROUP BY title)
SELECT title,
       coalesce(CASE WHEN m_count > 0 THEN {_f32_mean('s_m', 'm_count')} END, CAST(0.0 AS FLOAT)) AS m_avg,
       m_count,
       coalesce(CASE WHEN f_count > 0 THEN {_f32_mean('s_f', 'f_count')} END, CAST(0.0 AS FLOAT)) AS f_avg,
       f_count
FROM s""",

    "age_group_stats": f"""
WITH {_RATINGS_USER},
  x AS (SELECT r.movie_id, r.rating, {_bucket('c.c_acctbal', _AGE_DASH)} AS age_group
        FROM r JOIN customer c ON r.user_id = c.c_custkey),
  s AS (SELECT movie_id, age_group, sum(rating) AS sm, count(rating) AS total_ratings
        FROM x WHERE age_group IS NOT NULL GROUP BY movie_id, age_group)
SELECT s.movie_id, coalesce(p.p_name, '?') AS title, s.age_group, s.sm / s.total_ratings AS avg_rating,
       s.total_ratings
FROM s LEFT JOIN part p ON s.movie_id = p.p_partkey""",

    "age_group_stats_wide": _age_wide(),

    "age_group_means_by_title": _age_by_title(),

    "occupation_stats": """
WITH pu AS (SELECT o.o_custkey AS user_id, sum(l.l_quantity) AS sm, count(l.l_quantity) AS n
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey),
  j AS (SELECT c.c_nationkey AS occupation_id, sum(pu.sm) AS sm, sum(pu.n) AS n
        FROM pu JOIN customer c ON pu.user_id = c.c_custkey GROUP BY c.c_nationkey)
SELECT j.occupation_id, coalesce(nt.n_name, '?') AS occupation, j.sm / j.n AS avg_rating,
       CAST(j.n AS BIGINT) AS total_ratings
FROM j LEFT JOIN nation nt ON j.occupation_id = nt.n_nationkey""",

    "yearly_stats": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) / count(l_quantity) AS avg_rating,
       count(l_quantity) AS total_ratings
FROM lineitem GROUP BY year(l_shipdate)""",

    # ------------------------------------------------------------ text
    "clean_words": f"""
WITH {_LABELLED_DOCS},{_WORDS}
SELECT word, rid, category, aspect, sentiment FROM words""",

    "normalized_comments": f"""
WITH {_LABELLED_DOCS}
SELECT rid, lower(regexp_replace(comment, '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g')) AS clean_comment,
       category, aspect, sentiment
FROM docs""",

    "word_freq_over_threshold": f"""
WITH toks AS (SELECT {_TOKENS.format(col='text')} AS word FROM documents),
  words AS (SELECT word FROM toks WHERE {_KEEP})
SELECT word, count(*) AS freq FROM words GROUP BY word HAVING count(*) > {WORD_FREQ_THRESHOLD}""",

    "review_count_by_category": """
SELECT lang AS category, count(doc_id) AS review_count FROM documents GROUP BY lang""",

    "review_count_by_aspect": """
SELECT source AS aspect, count(doc_id) AS review_count FROM documents GROUP BY source""",

    "positive_aspect_counts": _aspect_counts("positive"),
    "negative_aspect_counts": _aspect_counts("negative"),
    "aspect_sentiment_counts": f"""
WITH {_LABELLED_DOCS}
SELECT aspect,
       CASE WHEN count(CASE WHEN sentiment = 'positive' THEN 1 END) > 0
            THEN count(CASE WHEN sentiment = 'positive' THEN rid END) END AS positive_count,
       CASE WHEN count(CASE WHEN sentiment = 'negative' THEN 1 END) > 0
            THEN count(CASE WHEN sentiment = 'negative' THEN rid END) END AS negative_count
FROM docs WHERE sentiment IN ('positive', 'negative') GROUP BY aspect""",
    "top_positive_aspect": _top_aspect("positive"),
    "top_negative_aspect": _top_aspect("negative"),
    "top_positive_words_by_category": _top_words("positive"),
    "top_negative_words_by_category": _top_words("negative"),
    "top_words_by_category": _top_words(None),

    # ------------------------------------------------------------ commerce
    "dataset_profile": f"""
WITH cols AS (
    SELECT table_name AS dataset, CAST(ordinal_position AS INTEGER) AS ordinal, column_name,
      {_DUCK_TO_SPARK_TYPE} AS data_type
    FROM information_schema.columns WHERE table_name IN ({_TABLE_LIST})),
  nc AS (SELECT dataset, CAST(count(*) AS INTEGER) AS n_cols FROM cols GROUP BY dataset),
  counts AS (
    {_COUNTS})
SELECT c.dataset, k.n_rows, nc.n_cols, c.ordinal, c.column_name, c.data_type
FROM cols c JOIN nc ON c.dataset = nc.dataset JOIN counts k ON c.dataset = k.dataset""",

    "overall_stats": f"""
WITH {_CUSTOMERS}
SELECT 'total_orders' AS metric, count(*) AS value FROM orders
UNION ALL SELECT 'unique_customers', count(DISTINCT customer_id) FROM cust
UNION ALL SELECT 'unique_sellers', count(DISTINCT l_suppkey) FROM lineitem""",

    "orders_by_country": f"""
WITH {_CUSTOMERS},
  pc AS (SELECT o_custkey AS customer_id, count(o_orderkey) AS n FROM orders GROUP BY o_custkey)
SELECT country, CAST(sum(n) AS BIGINT) AS order_count FROM pc JOIN cust USING (customer_id)
GROUP BY country""",

    "orders_by_year_month": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(o_orderkey) AS order_count
FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""",

    "review_score_distribution": f"""
WITH {_VALID_SCORES}
SELECT score, count(*) AS review_count FROM v GROUP BY score""",

    "review_score_summary": f"""
WITH {_VALID_SCORES}
SELECT {_half_up('sum(score)', 'count(*)')} AS avg_score, count(*) AS total_valid FROM v""",

    "revenue_by_category": f"""
WITH o AS (SELECT o_orderkey FROM orders
           WHERE o_orderdate >= TIMESTAMP '{REVENUE_YEAR}-01-01'
             AND o_orderdate < TIMESTAMP '{REVENUE_YEAR + 1}-01-01'),
  li AS (SELECT l.l_partkey AS product_id, {_REVENUE} AS rev
         FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey),
  pp AS (SELECT product_id, sum(rev) AS rev FROM li GROUP BY product_id)
SELECT p.p_type AS category, CAST(sum(pp.rev) AS DOUBLE) AS total_revenue
FROM pp JOIN part p ON pp.product_id = p.p_partkey GROUP BY p.p_type""",

    "top_products": f"""
WITH {_VALID_SCORES},
  po AS (SELECT order_id, sum(score) AS s, count(*) AS n FROM v GROUP BY order_id),
  io AS (SELECT l_partkey AS product_id, l_orderkey AS order_id, count(*) AS m
         FROM lineitem GROUP BY l_partkey, l_orderkey),
  w AS (SELECT io.product_id, sum(io.m * po.s) AS ws, sum(io.m * po.n) AS wn
        FROM io JOIN po ON io.order_id = po.order_id GROUP BY io.product_id),
  sales AS (SELECT l_partkey AS product_id, count(l_linenumber) AS sales_count
            FROM lineitem GROUP BY l_partkey)
SELECT sales.product_id, sales.sales_count, {_half_up('w.ws', 'w.wn')} AS avg_review_score
FROM sales LEFT JOIN w ON sales.product_id = w.product_id""",

    "seller_ranking": f"""
WITH s AS (SELECT l_suppkey AS seller_id, CAST(sum({_REVENUE}) AS DOUBLE) AS total_revenue,
                  count(DISTINCT l_orderkey) AS order_count
           FROM lineitem GROUP BY l_suppkey)
SELECT seller_id, total_revenue, order_count,
       CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS rank
FROM s""",

    "delivery_performance": f"""
WITH x AS (SELECT l.l_suppkey AS seller_id, datediff('day', o.o_orderdate, l.l_shipdate) AS d
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
  g AS (SELECT seller_id, count(*) AS items, sum(d) AS sd, max(d) AS max_delay_days,
               count(CASE WHEN d > 90 THEN 1 END) AS late_items
        FROM x WHERE d IS NOT NULL GROUP BY seller_id)
SELECT seller_id, items, {_half_up('sd', 'items')} AS avg_delay_days,
       CAST(max_delay_days AS INTEGER) AS max_delay_days, late_items
FROM g""",
}

_SEGMENTS = f"""
  p AS (SELECT o_custkey AS customer_id, count(*) AS order_count,
               sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS cents,
               min(CAST(o_orderdate AS DATE)) AS first_d, max(CAST(o_orderdate AS DATE)) AS last_d
        FROM orders GROUP BY o_custkey),
  q AS (SELECT customer_id, order_count, {_half_up('cents', 'order_count * 100')} AS avg_order_value,
               CASE WHEN order_count > 1 THEN
                 {_half_up("datediff('day', first_d, last_d)", 'order_count - 1')} END AS days_between_orders
        FROM p),
  seg AS (SELECT customer_id, order_count, avg_order_value, days_between_orders,
                 (CASE WHEN order_count >= 10 THEN 'frequent'
                       WHEN days_between_orders <= 120 THEN 'regular' ELSE 'occasional' END)
                 || '/' || (CASE WHEN avg_order_value >= 150000 THEN 'high' ELSE 'standard' END) AS segment
          FROM q)"""

ORACLE_SQL["customer_segments"] = f"""
WITH {_SEGMENTS}
SELECT customer_id, order_count, avg_order_value, days_between_orders, segment FROM seg"""

ORACLE_SQL["segment_summary"] = f"""
WITH {_SEGMENTS}
SELECT segment, count(*) AS customers, CAST(sum(order_count) AS BIGINT) AS orders FROM seg GROUP BY segment"""

_REQUIRED = (("orders", "order_id"), ("orders", "customer_id"), ("customers", "customer_id"),
             ("customers", "country"), ("items", "seller_id"), ("items", "price"),
             ("products", "category"), ("reviews", "score"))
_HAS_COLUMNS = "\n".join(
    f"  UNION ALL SELECT '{t}.has_column.{c}', 'eq', 1, 1" for t, c in _REQUIRED)

ORACLE_SQL["validation_report"] = f"""
WITH {_CUSTOMERS}, {_VALID_SCORES},
  q_items AS (SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_extendedprice AS price,
                     CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight
              FROM lineitem),
  sellers AS (SELECT l_suppkey AS seller_id, CAST(sum({_REVENUE}) AS DOUBLE) AS total_revenue
              FROM lineitem GROUP BY l_suppkey),
  ranked AS (SELECT dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS rk FROM sellers),
  year_items AS (SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                 WHERE o.o_orderdate >= TIMESTAMP '{REVENUE_YEAR}-01-01'
                   AND o.o_orderdate < TIMESTAMP '{REVENUE_YEAR + 1}-01-01'),
  checks AS (
  SELECT 'orders.row_count' AS "check", 'ge' AS rule, count(*) AS actual, 1 AS expected FROM orders
  UNION ALL SELECT 'customers.row_count', 'ge', count(*), 1 FROM cust
  UNION ALL SELECT 'items.row_count', 'ge', count(*), 1 FROM q_items
  UNION ALL SELECT 'items.negative_price', 'eq', count(CASE WHEN price < 0 THEN 1 END), 0 FROM q_items
  UNION ALL SELECT 'items.negative_freight', 'eq', count(CASE WHEN freight < 0 THEN 1 END), 0 FROM q_items
  UNION ALL SELECT 'products.row_count', 'ge', count(*), 1 FROM part
  UNION ALL SELECT 'products.null_category', 'eq', count(CASE WHEN p_type IS NULL THEN 1 END), 0 FROM part
  UNION ALL SELECT 'reviews.row_count', 'ge', count(*), 1 FROM events
  UNION ALL SELECT 'reviews.null_score', 'info', count(CASE WHEN value IS NULL THEN 1 END), NULL FROM events
  UNION ALL SELECT 'reviews.empty_score', 'info',
                   count(CASE WHEN CAST(value / {SCORE_DIVISOR} AS VARCHAR) = '' THEN 1 END), NULL FROM events
  UNION ALL SELECT 'reviews.valid_score', 'info', count(*), NULL FROM v
  UNION ALL SELECT 'reviews.mean_in_range', 'eq',
                   CASE WHEN sum(score) >= count(*) AND sum(score) <= 5 * count(*) THEN 1 ELSE 0 END, 1 FROM v
{_HAS_COLUMNS}
  UNION ALL SELECT 'orders_join_customers.rows', 'eq',
                   (SELECT count(*) FROM orders o JOIN cust c ON o.o_custkey = c.customer_id),
                   (SELECT count(*) FROM orders)
  UNION ALL SELECT 'orders_join_customers.null_country', 'eq',
                   (SELECT count(*) FROM orders o JOIN cust c ON o.o_custkey = c.customer_id
                    WHERE c.country IS NULL), 0
  UNION ALL SELECT 'orders_by_year_month.total', 'eq', (SELECT sum(n) FROM
                   (SELECT count(o_orderkey) AS n FROM orders GROUP BY year(o_orderdate), month(o_orderdate))),
                   count(*) FROM orders
  UNION ALL SELECT 'orders.null_purchase_ts', 'eq', count(*) - count(o_orderdate), 0 FROM orders
  UNION ALL SELECT 'year.orders', 'info', count(CASE WHEN year(o_orderdate) = {REVENUE_YEAR} THEN 1 END), NULL
            FROM orders
  UNION ALL SELECT 'orders.distinct_customers', 'info', count(DISTINCT o_custkey), NULL FROM orders
  UNION ALL SELECT 'customers.distinct_ids', 'info', count(DISTINCT customer_id), NULL FROM cust
  UNION ALL SELECT 'items.distinct_sellers', 'info', count(DISTINCT l_suppkey), NULL FROM lineitem
  UNION ALL SELECT 'sales_count.total', 'eq', (SELECT sum(n) FROM
                   (SELECT count(l_linenumber) AS n FROM lineitem GROUP BY l_partkey)), count(*) FROM lineitem
  UNION ALL SELECT 'sales_count.top_product', 'info', max(n), NULL FROM
                   (SELECT count(l_linenumber) AS n FROM lineitem GROUP BY l_partkey)
  UNION ALL SELECT 'score_distribution.total', 'eq', (SELECT sum(n) FROM
                   (SELECT count(*) AS n FROM v GROUP BY score)), count(*) FROM v
  UNION ALL SELECT 'reviews.mean_score_hundredths', 'info',
                   CAST(({_half_up('sum(score)', 'count(*)')}) * 100 AS BIGINT), NULL FROM v
  UNION ALL SELECT 'orders.rows_read', 'eq', count(*), count(*) FROM orders
  UNION ALL SELECT 'customers.rows_read', 'eq', count(*), (SELECT count(*) FROM customer) FROM cust
  UNION ALL SELECT 'items.rows_read', 'eq', count(*), count(*) FROM lineitem
  UNION ALL SELECT 'products.rows_read', 'eq', count(*), count(*) FROM part
  UNION ALL SELECT 'reviews.rows_read', 'eq', count(*), count(*) FROM events
  UNION ALL SELECT 'orders_join_customers.countries', 'info', count(*), NULL FROM
                   (SELECT DISTINCT c.country FROM orders o JOIN cust c ON o.o_custkey = c.customer_id)
  UNION ALL SELECT 'orders_join_customers.top_country_orders', 'info', max(n), NULL FROM
                   (SELECT c.country, count(*) AS n FROM orders o JOIN cust c ON o.o_custkey = c.customer_id
                    GROUP BY c.country)
  UNION ALL SELECT 'year.revenue_units', 'info', CAST(sum({_REVENUE}) * 10000 AS BIGINT), NULL
            FROM year_items y JOIN part p ON y.l_partkey = p.p_partkey
  UNION ALL SELECT 'ranking.sellers', 'eq', (SELECT count(*) FROM sellers), count(DISTINCT l_suppkey) FROM lineitem
  UNION ALL SELECT 'reviews.invalid_score', 'info', (SELECT count(*) FROM events) - count(*), NULL FROM v
  UNION ALL SELECT 'reviews.min_valid_score', 'info', min(score), NULL FROM v
  UNION ALL SELECT 'reviews.max_valid_score', 'info', max(score), NULL FROM v
  UNION ALL SELECT 'products.mean_out_of_range', 'eq', count(*), 0 FROM (
            SELECT l.l_partkey, sum(po.s) AS ws, sum(po.n) AS wn
            FROM lineitem l JOIN (SELECT order_id, sum(score) AS s, count(*) AS n FROM v GROUP BY order_id) po
              ON l.l_orderkey = po.order_id
            GROUP BY l.l_partkey) WHERE ws < wn OR ws > 5 * wn
  UNION ALL SELECT 'year.items', 'info', count(*), NULL FROM year_items
  UNION ALL SELECT 'year.items_after_product_join', 'eq',
                   (SELECT count(*) FROM year_items y JOIN part p ON y.l_partkey = p.p_partkey),
                   (SELECT count(*) FROM year_items)
  UNION ALL SELECT 'year.revenue_positive', 'eq',
                   CASE WHEN sum({_REVENUE}) > 0 THEN 1 ELSE 0 END, 1
            FROM year_items y JOIN part p ON y.l_partkey = p.p_partkey
  UNION ALL SELECT 'orders.duplicate_order_id', 'eq', count(*), 0
            FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'items.duplicate_item_key', 'eq', count(*), 0
            FROM (SELECT order_id, item_id FROM q_items GROUP BY order_id, item_id HAVING count(*) > 1)
  UNION ALL SELECT 'orders.orphan_customer', 'eq', count(*), 0
            FROM orders o WHERE NOT EXISTS (SELECT 1 FROM cust c WHERE c.customer_id = o.o_custkey)
  UNION ALL SELECT 'items.orphan_order', 'eq', count(*), 0
            FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
  UNION ALL SELECT 'reviews.orphan_order', 'eq', count(*), 0
            FROM events e WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = e.event_id)
  UNION ALL SELECT 'ranking.rank_gaps', 'eq', coalesce(max(rk) - count(DISTINCT rk), 0), 0 FROM ranked
  UNION ALL SELECT 'ranking.min_rank', 'eq', min(rk), 1 FROM ranked
  UNION ALL SELECT 'ranking.rank1_rows', 'ge', count(CASE WHEN rk = 1 THEN 1 END), 1 FROM ranked),
  report AS (
    SELECT "check", rule, CAST(actual AS BIGINT) AS actual, CAST(expected AS BIGINT) AS expected,
           coalesce(CASE WHEN rule = 'info' THEN true WHEN rule = 'ge' THEN actual >= expected
                         ELSE actual = expected END, false) AS ok
    FROM checks)
SELECT * FROM report
UNION ALL
SELECT 'summary.failed_checks', 'eq', count(CASE WHEN NOT ok THEN 1 END), CAST(0 AS BIGINT),
       count(CASE WHEN NOT ok THEN 1 END) = 0
FROM report"""

ORACLE_SQL["validation_leaders"] = f"""
WITH {_CUSTOMERS},
  pc AS (SELECT o_custkey AS customer_id, count(o_orderkey) AS n FROM orders GROUP BY o_custkey),
  bc AS (SELECT country, sum(n) AS n FROM pc JOIN cust USING (customer_id)
         WHERE country IS NOT NULL GROUP BY country),
  bp AS (SELECT l_partkey AS product_id, count(l_linenumber) AS n FROM lineitem GROUP BY l_partkey),
  bs AS (SELECT l_suppkey AS seller_id, CAST(sum({_REVENUE}) AS DOUBLE) AS total_revenue
         FROM lineitem GROUP BY l_suppkey),
  top_c AS (SELECT 'top_country' AS item, country AS key, CAST(n AS DOUBLE) AS value FROM bc
            ORDER BY n DESC, country LIMIT 1),
  top_p AS (SELECT 'top_product' AS item, CAST(product_id AS VARCHAR) AS key, CAST(n AS DOUBLE) AS value
            FROM bp ORDER BY n DESC, product_id LIMIT 1),
  top_s AS (SELECT 'top_seller' AS item, CAST(seller_id AS VARCHAR) AS key, total_revenue AS value
            FROM bs ORDER BY total_revenue DESC, seller_id LIMIT 1)
SELECT * FROM top_c UNION ALL SELECT * FROM top_p UNION ALL SELECT * FROM top_s"""

# ------------------------------------------------------------ text lines
# Written from the table values, not from the lines; what is bad is stated in lines.py.
_SECONDS = "CAST(epoch(l_shipdate) AS BIGINT)"
_KEPT_RATING = """NOT (l_linenumber = 4 AND l_returnflag = 'A') AND NOT (l_linenumber = 6 AND l_returnflag = 'A')
  AND NOT (l_linenumber = 7 AND l_returnflag = 'R')"""
_RATING_OF_LINE = "CAST(CASE WHEN l_linenumber = 6 THEN l_quantity + 0.5 ELSE l_quantity END AS FLOAT)"

ORACLE_SQL["rating_lines"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id, {_RATING_OF_LINE} AS rating,
       CASE WHEN l_linenumber = 5 OR (l_linenumber = 7 AND l_returnflag = 'N') THEN NULL ELSE {_SECONDS} END AS ts
FROM lineitem WHERE {_KEPT_RATING}"""

ORACLE_SQL["strict_rating_lines"] = f"""
SELECT CAST(l_orderkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id, l_quantity AS rating, {_SECONDS} AS ts
FROM lineitem"""

_TITLE = "CASE WHEN p_size % 2 = 1 THEN p_name || ', The' ELSE p_name END"

ORACLE_SQL["movie_line_tags"] = f"""
WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS movie_id, {_TITLE} AS title, p_type, p_brand, p_size FROM part
           WHERE p_size NOT IN (49, 50))
SELECT movie_id, title, p_type AS genre FROM m WHERE p_size % 7 <> 0
UNION ALL SELECT movie_id, title, p_brand FROM m WHERE p_size % 7 <> 0
UNION ALL SELECT movie_id, title, NULL FROM m WHERE p_size % 7 = 0"""

ORACLE_SQL["movie_lines_split3"] = """
WITH g AS (SELECT *, CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 5 = 0 THEN p_type || '|| ' || p_brand || '|'
                          ELSE p_type || '|' || p_brand END AS genres FROM part WHERE p_size <> 49)
SELECT CAST(p_partkey AS INTEGER) AS movie_id, p_name AS title,
       CASE WHEN p_size = 50 THEN '' WHEN p_size % 2 = 1 THEN 'The,' || genres ELSE genres END AS genres FROM g"""

_GENDER = "substr(c_mktsegment, 1, 1)"

ORACLE_SQL["user_lines"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS user_id, {_GENDER} AS gender,
       CASE WHEN c_nationkey IN (3, 5) THEN NULL ELSE CAST(c_custkey % 80 AS INTEGER) END AS age,
       CASE WHEN c_nationkey = 5 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS occupation,
       CASE WHEN c_nationkey = 5 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zip
FROM customer WHERE c_nationkey <> 4"""

ORACLE_SQL["user_age_lines"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_custkey % 80 AS INTEGER) AS age
FROM customer WHERE c_nationkey NOT IN (3, 4, 5)"""

ORACLE_SQL["strict_user_lines"] = f"""
SELECT CAST(c_custkey AS INTEGER) AS user_id, {_GENDER} AS gender, CAST(c_custkey % 80 AS INTEGER) AS age,
       CAST(c_nationkey AS INTEGER) AS occupation, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip
FROM customer"""

ORACLE_SQL["occupation_lines"] = """
SELECT CAST(n_nationkey AS INTEGER) AS occupation_id,
       CASE WHEN n_nationkey % 2 = 0 THEN n_name || ', retired' ELSE n_name END AS name
FROM nation WHERE n_nationkey % 10 <> 9"""

ORACLE_SQL["review_lines"] = """
SELECT CASE WHEN doc_id % 10 = 3 THEN NULL ELSE CAST(doc_id AS INTEGER) END AS rid,
       nullif(translate(coalesce(text, ''), chr(10) || chr(13) || ';', '   '), '') AS comment, lang AS category,
       CASE WHEN doc_id % 10 = 4 THEN NULL ELSE source END AS aspect,
       CASE WHEN doc_id % 10 = 4 THEN NULL ELSE 'neutral' END AS sentiment
FROM documents"""

ORACLE_SQL["word_lines"] = "SELECT DISTINCT p_name AS word FROM part WHERE p_size % 5 <> 0 AND p_name <> ''"

ORACLE_SQL["rejected_lines"] = f"""
SELECT 'ratings' AS reader, count(*) AS read, count(CASE WHEN {_KEPT_RATING} THEN 1 END) AS kept,
       count(CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 1 END) AS blank,
       count(CASE WHEN (l_linenumber = 6 AND l_returnflag = 'A') OR (l_linenumber = 7 AND l_returnflag = 'R') THEN 1 END)
         AS rejected FROM lineitem
UNION ALL SELECT 'movies', count(*), count(CASE WHEN p_size < 49 THEN 1 END), 0,
       count(CASE WHEN p_size >= 49 THEN 1 END) FROM part
UNION ALL SELECT 'users', count(*), count(CASE WHEN c_nationkey <> 4 THEN 1 END), 0,
       count(CASE WHEN c_nationkey = 4 THEN 1 END) FROM customer
UNION ALL SELECT 'user_ages', count(*), count(CASE WHEN c_nationkey NOT IN (3, 4, 5) THEN 1 END), 0,
       count(CASE WHEN c_nationkey IN (3, 4, 5) THEN 1 END) FROM customer
UNION ALL SELECT 'occupations', count(*), count(CASE WHEN n_nationkey % 10 <> 9 THEN 1 END), 0,
       count(CASE WHEN n_nationkey % 10 = 9 THEN 1 END) FROM nation"""

ORACLE_SQL["rating_line_union"] = f"""
WITH u AS (SELECT l_partkey, {_RATING_OF_LINE} AS rating FROM lineitem WHERE {_KEPT_RATING}
           UNION ALL SELECT l_partkey, CAST(l_quantity AS FLOAT) FROM lineitem)
SELECT CAST(l_partkey AS VARCHAR) AS movie_id, sum(CAST(rating AS DOUBLE)) AS rating_sum, count(*) AS total_ratings
FROM u GROUP BY l_partkey"""

ORACLE_SQL["orders_by_purchase_text"] = """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 OR o_orderkey % 3 = 1 THEN NULL ELSE o_orderdate END AS ts
           FROM orders)
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(o_orderkey) AS order_count
FROM t GROUP BY year(ts), month(ts)"""


def _fixed(s: str, n: str, places: int) -> str:
    """The non-negative ratio s / n with so many places, HALF_UP, as text."""
    scale = 10 ** places
    units = f"((CAST({s} AS HUGEINT) * {2 * scale} + {n}) // (2 * {n}))"
    return f"(CAST({units} // {scale} AS VARCHAR) || '.' || lpad(CAST({units} % {scale} AS VARCHAR), {places}, '0'))"


ORACLE_SQL["movie_report_lines"] = f"""
WITH {_MOVIE_STATS.format(default="'?'")},
  k AS (SELECT m.title, CAST(s.sm AS BIGINT) AS sm, m.total_ratings AS n FROM m JOIN s ON m.movie_id = s.movie_id)
SELECT title || ': ' || {_fixed('sm', 'n', 2)} || ' (' || {_fixed('sm', 'n', 4)} || ', ' || n || ' ratings)' AS line FROM k"""

# ------------------------------------------------------------ positions and tiles
_AGE_ORDINAL = "CASE age_group " + " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(_AGE_DASH)) + " ELSE 99 END"

# the jobs' orders, in SQL; nulls last
_SQL_ORDERS = {
    "movie_stats": "lower(title), movie_id", "gender_stats": "lower(title), movie_id",
    "age_group_stats": f"lower(title), {_AGE_ORDINAL}, movie_id", "occupation_stats": "lower(occupation), occupation_id",
    "genre_stats": "genre", "yearly_stats": "year", "word_freq_over_threshold": "freq DESC, word",
    "review_count_by_category": "review_count DESC, category", "review_count_by_aspect": "review_count DESC, aspect",
    "orders_by_country": "order_count DESC, country", "orders_by_year_month": "year, month DESC",
    "top_words_by_category": "category, rank_in_category, word", "revenue_by_category": "total_revenue DESC, category",
    "top_products": "sales_count DESC, product_id", "seller_ranking": "rank, seller_id",
    "review_score_distribution": "score", "movie_report_lines": "line",
}
for _job, _order in _SQL_ORDERS.items():
    _parts = ", ".join(f"{part} NULLS LAST" for part in _order.split(", "))
    ORACLE_SQL[f"ordered_{_job}"] = f"SELECT *, row_number() OVER (ORDER BY {_parts}) AS position FROM ({ORACLE_SQL[_job]}) AS job"

ORACLE_SQL["customer_quartiles"] = f"""
WITH {_SEGMENTS}
SELECT customer_id, order_count, avg_order_value, days_between_orders,
       CAST(ntile(4) OVER (ORDER BY order_count DESC NULLS LAST, customer_id) AS INTEGER) AS count_quartile,
       CAST(ntile(4) OVER (ORDER BY avg_order_value DESC NULLS LAST, customer_id) AS INTEGER) AS value_quartile,
       CAST(ntile(4) OVER (ORDER BY days_between_orders NULLS LAST, customer_id) AS INTEGER) AS gap_quartile
FROM seg"""

# ------------------------------------------------------------ sinks and files
ORACLE_SQL["published_tsv"] = ORACLE_SQL["orders_by_country"]
ORACLE_SQL["published_quoted_csv"] = f"SELECT comment, category, aspect FROM ({ORACLE_SQL['review_lines']}) AS r"
ORACLE_SQL["inferred_header_csv"] = """
SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, r_name, n_nationkey / 4.0::DOUBLE AS quarter
FROM nation JOIN region ON n_regionkey = r_regionkey"""
ORACLE_SQL["published_report"] = f"""
WITH y AS (SELECT year(l_shipdate) AS year, CAST(sum(l_quantity) AS BIGINT) AS sm, count(l_quantity) AS n FROM lineitem GROUP BY 1),
  k AS (SELECT year || ': ' || {_fixed('sm', 'n', 4)} || ' in ' || n || ' ratings' AS line FROM y)
SELECT 'report' AS output, line FROM k UNION ALL SELECT 'sorted', line FROM k"""
ORACLE_SQL["preview_of_words"] = f"""
WITH toks AS (SELECT {_TOKENS.format(col='text')} AS word FROM documents),
  f AS (SELECT word, count(*) AS freq FROM toks WHERE {_KEEP} GROUP BY word)
SELECT word, freq, (SELECT count(*) FROM f) AS total_rows, greatest((SELECT count(*) FROM f) - 40, 0) AS not_shown
FROM f ORDER BY freq DESC, word LIMIT 40"""
