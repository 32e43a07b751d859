"""SQL oracles for the queries registered in ``queries_more``.

The normaliser oracles compute the expected review rows straight from the
tables (no JSON / HTML round trip), so they check payload building,
parsing, defaults and filters together.
"""

from __future__ import annotations

from reviewlake.oracle import R, with_reviews
from reviewlake.sources.landing import FETCHED_AT

FETCHED = "'" + FETCHED_AT.replace(" ", "T") + "'"
TABLE_TS = "TIMESTAMP '2026-01-01 00:00:00'"
BATCH_TS = "TIMESTAMP '2026-02-01 00:00:00'"
REVIEW_COLS = ["source", "store_id", "store_name", "store_city", "rating", "text", "language", "date",
               "sport_category", "collected_at"]


def ISO(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S')"


def _D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


PLAY = f"""SELECT 'gp_' || CAST(doc_id AS VARCHAR) AS review_id, 'google_play' AS source,
       'app_' || language AS store_id, 'App (' || store_city || ')' AS store_name, store_city,
       coalesce(CAST(floor(rating) AS DOUBLE), {_D('3.0')}) AS rating, content AS text, language,
       coalesce({ISO('date')}, {FETCHED}) AS date, 'other' AS sport_category, {FETCHED} AS collected_at
FROM (SELECT *, CASE WHEN doc_id % 7 = 0 THEN substr(text, 1, 9) ELSE text END AS content FROM reviews) r
WHERE length(content) >= 10"""

FEED = f"""SELECT 'as_' || review_id AS review_id, 'app_store' AS source, 'appstore_' || language AS store_id,
       'App Store (' || store_city || ')' AS store_name, store_city, rating,
       trim(store_id || '. ' || text, '. ') AS text, language,
       coalesce({ISO('date')}, {FETCHED}) AS date, 'other' AS sport_category, {FETCHED} AS collected_at
FROM reviews WHERE rating IS NOT NULL AND length(trim(store_id || '. ' || text, '. ')) >= 10"""

LISTING = f"""SELECT 'rd_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS review_id, 'reddit' AS source,
       'reddit_' || role AS store_id, 'Forum r/' || role AS store_name, 'Online' AS store_city,
       CASE WHEN score > 100 THEN {_D('5.0')} WHEN score > 50 THEN {_D('4.0')} WHEN score > 10 THEN {_D('3.0')}
            WHEN score > 0 THEN {_D('2.0')} ELSE {_D('1.0')} END AS rating,
       t AS text, 'en' AS language,
       {ISO('make_timestamp(CAST((1700000000.0 + conv_id * 3600.0 + turn * 60.0) * 1000000 AS BIGINT))')} AS date,
       'other' AS sport_category, {FETCHED} AS collected_at
FROM (SELECT *, coalesce(nullif(text, ''), 'Conversation ' || CAST(conv_id AS VARCHAR)) AS t,
             (turn * 13) % 151 - 20 AS score FROM conversations) c
WHERE length(t) >= 20"""

REVIEW_PAGES = f"""SELECT 'tp_' || md5('user_' || CAST(doc_id AS VARCHAR) || chr(31) || coalesce({ISO('date')}, {FETCHED}) || chr(31) || text) AS review_id,
       'trustpilot' AS source, 'tp_' || language AS store_id, 'Review site (' || store_city || ')' AS store_name,
       store_city, coalesce(rating, {_D('3.0')}) AS rating, text, language,
       coalesce({ISO('date')}, {FETCHED}) AS date, 'other' AS sport_category, {FETCHED} AS collected_at
FROM reviews WHERE length(text) >= 10"""

PRODUCTS = f"""SELECT 'dc_' || md5(sport_category || chr(31) || coalesce({ISO('date')}, {FETCHED}) || chr(31) || text) AS review_id, 'product_site' AS source,
       'site_' || sport_category AS store_id, 'Product site (' || sport_category || ')' AS store_name,
       'Online' AS store_city, coalesce(rating, {_D('3.0')}) AS rating, text, 'pt' AS language,
       coalesce({ISO('date')}, {FETCHED}) AS date, 'other' AS sport_category, {FETCHED} AS collected_at
FROM classified WHERE length(text) >= 10"""


def _nf(cols):
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


UNION = f"""SELECT *, 1 AS source_priority FROM ({PLAY}) a
UNION ALL SELECT *, 2 FROM ({FEED}) b
UNION ALL SELECT *, 3 FROM ({REVIEW_PAGES}) c
UNION ALL SELECT *, 4 FROM ({LISTING}) d
UNION ALL SELECT *, 5 FROM ({PRODUCTS}) e"""

DEDUP_PRODUCTS = f"""SELECT review_id, {', '.join(REVIEW_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY date ASC NULLS FIRST, {_nf(REVIEW_COLS)}) AS rn
  FROM ({PRODUCTS}) p) q WHERE rn = 1"""

COLLECT = f"""SELECT review_id, {', '.join(REVIEW_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY source_priority ASC NULLS FIRST, date ASC NULLS FIRST,
                               {_nf(REVIEW_COLS + ['source_priority'])}) AS rn
  FROM ({UNION}) u) q WHERE rn = 1"""

TABLE_CTE = f"""tbl AS (
  SELECT review_id, source, store_id, CAST(NULL AS VARCHAR) AS store_name, store_city,
         TRY_CAST(rating AS DECIMAL(3,1)) AS rating, text AS review_text, language,
         CAST(date AS TIMESTAMP) AS review_date, sport_category, sentiment_label,
         TRY_CAST(sentiment_score AS DECIMAL(5,3)) AS sentiment_score,
         CAST(NULL AS TIMESTAMP) AS collected_at, {TABLE_TS} AS ingested_at
  FROM classified)"""

BATCH_CTE = f"""batch AS (
  SELECT review_id, source, store_id, CAST(NULL AS VARCHAR) AS store_name, store_city,
         TRY_CAST(rating AS DECIMAL(3,1)) AS rating, text AS review_text, language,
         TRY_CAST(date AS TIMESTAMP) AS review_date, sport_category, sentiment_label,
         TRY_CAST(sentiment_score AS DECIMAL(5,3)) AS sentiment_score,
         CAST(NULL AS TIMESTAMP) AS collected_at, {BATCH_TS} AS ingested_at
  FROM (
    SELECT 'r_' || CAST(doc_id AS VARCHAR) AS review_id, 'relabel' AS source, CAST(NULL AS VARCHAR) AS store_id,
           CAST(NULL AS VARCHAR) AS store_city, CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS VARCHAR) AS text,
           CAST(NULL AS VARCHAR) AS language, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS sport_category,
           CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment_label,
           CAST(quality - toxic AS DOUBLE) AS sentiment_score
    FROM labels
    UNION ALL
    SELECT 'b_' || CAST(item_id AS VARCHAR), 'benchmark', 'store_b', CAST(NULL AS VARCHAR), CAST(3.0 AS DOUBLE), text,
           'en', '2026-01-15T00:00:00', 'other', 'neutral', CAST(0.0 AS DOUBLE)
    FROM benchmark) u)"""

STORED_COLS = ["review_id", "source", "store_id", "store_name", "store_city", "rating", "review_text", "language",
               "review_date", "sport_category", "sentiment_label", "sentiment_score", "collected_at", "ingested_at"]


def _upsert(update_cols):
    sel = []
    for c in STORED_COLS:
        if c == "review_id":
            sel.append("coalesce(t.review_id, s.review_id) AS review_id")
        elif c == "ingested_at":
            sel.append(f"CASE WHEN s.review_id IS NOT NULL THEN {BATCH_TS} ELSE t.ingested_at END AS ingested_at")
        elif c in update_cols:
            sel.append(f"CASE WHEN s.review_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t.review_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
    return with_reviews("SELECT " + ",\n       ".join(sel) + "\nFROM tbl t FULL OUTER JOIN batch s ON t.review_id = s.review_id",
                        True, TABLE_CTE + ",\n" + BATCH_CTE)


_STARS = "CAST(doc_id % 5 + 1 AS INTEGER)"
_STAR_LABEL = f"CASE WHEN {_STARS} >= 4 THEN 'positive' WHEN {_STARS} <= 2 THEN 'negative' ELSE 'neutral' END"
_STAR_SCORE = R(f"(CAST({_STARS} AS DOUBLE) - 3.0) / 2.0", 3)

SQL: dict[str, str] = {
    "play_normalise": with_reviews(PLAY),
    "feed_normalise": with_reviews(FEED),
    "listing_normalise": LISTING,
    "jsonld_reviews": with_reviews(REVIEW_PAGES),
    "jsonld_products": with_reviews(PRODUCTS, True),
    "union_sources": with_reviews(UNION, True),
    "dedup_products": with_reviews(DEDUP_PRODUCTS, True),
    "collect_all_sources": with_reviews(COLLECT, True),
    "store_projection": with_reviews("SELECT * FROM tbl", True, TABLE_CTE),
    "upsert_sentiment": _upsert(("sentiment_label", "sentiment_score")),
    "upsert_touch": _upsert(()),
    "process_reviews": """SELECT 'r_' || CAST(doc_id AS VARCHAR) AS review_id, CAST(length(text) AS INTEGER) AS review_length,
       lower(text) AS review_text_lower,
       CASE WHEN length(text) < 50 THEN 'short' WHEN length(text) < 200 THEN 'medium' ELSE 'long' END AS length_category
FROM documents""",
    "sentiment_policy_override": with_reviews(
        f"SELECT review_id, {_STAR_LABEL} AS sentiment_label, {_STAR_SCORE} AS sentiment_score FROM reviews"),
    "sentiment_policy_fill": with_reviews(
        f"SELECT review_id, sentiment_label, {_STAR_SCORE} AS sentiment_score FROM reviews"),
}

SQL["dedup_first"] = SQL["dedup_products"]
SQL["jsonld_extract"] = with_reviews("""SELECT p.language AS lang, p.store_city AS city, p.page, b.block, b.parsed
FROM (SELECT DISTINCT language, store_city, doc_id // 100 AS page FROM reviews) p
CROSS JOIN (VALUES (CAST(0 AS BIGINT), true), (CAST(1 AS BIGINT), false)) b(block, parsed)""")
SQL["pages_jsonld_reviews"] = f"""SELECT 'tp_' || md5('page_' || page_id || chr(31) || {FETCHED} || chr(31) || text) AS review_id,
       'trustpilot' AS source, 'tp_' || language AS store_id, CAST(NULL AS VARCHAR) AS store_name, CAST(NULL AS VARCHAR) AS store_city,
       CAST(page_id % 5 + 1 AS DOUBLE) AS rating, text, language, {FETCHED} AS date, 'other' AS sport_category, {FETCHED} AS collected_at
FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) || ' ' || url AS text,
             regexp_extract(url, '/([a-z]{{2}})/', 1) AS language FROM pages) p WHERE length(text) >= 10"""
SQL["normalise_rejects"] = with_reviews("""SELECT source, CAST(count_if(NOT bad) AS BIGINT) AS good, CAST(count_if(bad) AS BIGINT) AS rejected, count(*) AS items FROM (
  SELECT 'google_play' AS source, doc_id % 11 = 0 AS bad FROM reviews WHERE length(CASE WHEN doc_id % 7 = 0 THEN substr(text, 1, 9) ELSE text END) >= 10
  UNION ALL SELECT 'app_store', doc_id % 11 = 0 FROM reviews WHERE (rating IS NOT NULL OR doc_id % 11 = 0) AND length(trim(store_id || '. ' || text, '. ')) >= 10
  UNION ALL SELECT 'trustpilot', doc_id % 11 = 0 FROM reviews WHERE length(text) >= 10
  UNION ALL SELECT 'product_site', doc_id % 11 = 0 FROM reviews WHERE length(text) >= 10
  UNION ALL SELECT 'reddit', false FROM conversations
            WHERE length(coalesce(nullif(text, ''), 'Conversation ' || CAST(conv_id AS VARCHAR))) >= 20) x GROUP BY source""")
SQL["product_ids_long_text"] = """SELECT count(*) AS rows_in, count(DISTINCT source || chr(31) || text) AS ids,
       count(DISTINCT source || chr(31) || text) AS contents, count(DISTINCT source || chr(31) || text) AS rows_after
FROM documents WHERE length(text) >= 10"""
SQL["feed_page_stop"] = with_reviews(f"""SELECT 'as_' || review_id AS review_id, 'appstore_' || language AS store_id, store_city, rating,
       trim(store_id || '. ' || text, '. ') AS text,
       CASE WHEN doc_id // 100 > s.stop THEN 'page after the first empty page' END AS reject_reason
FROM (SELECT *, doc_id // 100 AS page FROM reviews) r
LEFT JOIN (SELECT language AS l, store_city AS c, min(doc_id // 100) AS stop FROM reviews
           WHERE (doc_id // 100) % 4 = 1 OR (doc_id // 100) % 7 = 6 GROUP BY 1, 2) s
       ON l IS NOT DISTINCT FROM language AND c IS NOT DISTINCT FROM store_city
WHERE page % 4 <> 1 AND page % 7 <> 6 AND rating IS NOT NULL AND length(trim(store_id || '. ' || text, '. ')) >= 10""")
SQL["pages_script_forms"] = """SELECT page_id, CAST(count_if(page_id % 10 < 6) AS BIGINT) AS blocks,
       max(CASE WHEN page_id % 10 < 6 THEN '{"page": ' || CAST(page_id AS VARCHAR) || ', "tag": "<!--"}' END) AS first_block
FROM pages GROUP BY page_id"""
SQL["upsert_bucketed"] = SQL["upsert_sentiment"]
SQL["store_partitioned"] = with_reviews("""SELECT sentiment_label, n,
       row_number() OVER (ORDER BY n DESC, sentiment_label ASC NULLS FIRST) AS rank
FROM (SELECT sentiment_label, count(*) AS n FROM reviews WHERE source IN ('src1', 'src3', 'src5', 'src7')
      GROUP BY 1) g""")
