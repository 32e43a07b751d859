"""Independent SQL (DuckDB dialect) for each registered query.

These are written from the operator semantics, not generated from the
Spark plans: the ``reviews`` adapter as a CTE over the same parquet views
and each query in plain SQL.  Column names match the Spark outputs.
"""

from __future__ import annotations

from reviewlake import config as C
from reviewlake.sources.tables import PHRASES


def keyword_category_sql(text_sql: str = "text") -> str:
    """The keyword rule as stated, over the raw word lists in their order (no
    pruning): categories, then positive, then negative emotions."""
    rules = [*C.SPORT_KEYWORDS, (C.POSITIVE_EXPERIENCE, C.POSITIVE_EMOTIONS), (C.NEGATIVE_EXPERIENCE, C.NEGATIVE_EMOTIONS)]
    quoted = lambda w: "'" + w.lower().replace("'", "''") + "'"
    arms = " ".join("WHEN " + " OR ".join(f"contains(lower({text_sql}), {quoted(w)})" for w in words) + f" THEN '{cat}'"
                    for cat, words in rules)
    return f"CASE {arms} END"


def R(expr: str, scale: int) -> str:
    """Half-up rounding on the decimal value, back to double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def PCT(part: str, total: str, scale: int = 1) -> str:
    return (f"CASE WHEN coalesce({total}, 0) = 0 THEN CAST(0.0 AS DOUBLE) "
            f"ELSE {R(f'CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * CAST(100.0 AS DOUBLE)', scale)} END")


def BAR(count: str) -> str:
    return f"repeat('█', greatest(coalesce(CAST({count} AS INTEGER), 0), 0))"


def TITLE(col: str) -> str:
    # category keys are letters joined by '_'
    return f"array_to_string(list_transform(string_split({col}, '_'), lambda x: upper(x[1]) || lower(x[2:])), '_')"


_PHRASES_SQL = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in PHRASES) + "]"

REVIEWS_CTE = f"""reviews AS (
  SELECT 'r_' || CAST(d.doc_id AS VARCHAR) AS review_id,
         d.source AS source,
         'store_' || CAST(d.doc_id % 25 AS VARCHAR) AS store_id,
         CASE WHEN d.doc_id % 89 <> 0 THEN n.n_name END AS store_city,
         CASE WHEN d.doc_id % 97 <> 0 THEN CAST(1.0 + (d.n_chars % 9) * 0.5 AS DOUBLE) END AS rating,
         ({_PHRASES_SQL})[CAST(d.doc_id % 20 AS INTEGER) + 1] || coalesce(chr(10) || d.text, '') AS text,
         d.lang AS language,
         CASE WHEN d.doc_id % 83 <> 0 THEN o.o_orderdate END AS date,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
              WHEN l.quality = 0 THEN 'neutral' END AS sentiment_label,
         CAST((d.n_chars % 5) - 2 AS DOUBLE) / 2 AS sentiment_score,
         d.doc_id AS doc_id
  FROM documents d
  LEFT JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  JOIN nation n ON n.n_nationkey = d.doc_id % 25)"""

CLASSIFIED_CTE = f"""classified AS (
  SELECT *, coalesce({keyword_category_sql('text')}, 'other') AS sport_category FROM reviews)"""


def with_reviews(body: str, classified: bool = False, extra: str = "") -> str:
    ctes = REVIEWS_CTE + (",\n" + CLASSIFIED_CTE if classified else "") + (",\n" + extra if extra else "")
    return f"WITH {ctes}\n{body}"


DASH_PRED = ("coalesce(language IN ('en', 'fr', 'es'), false) "
             "AND coalesce(sentiment_label IN ('positive', 'neutral', 'negative'), false) "
             "AND coalesce(rating BETWEEN 2.0 AND 4.5, false)")

_COLOR_CASE = ("coalesce(CASE sentiment_label " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.SENTIMENT_COLORS.items()) + f" END, '{C.COLOR_DEFAULT}')")
_LANG_CASE = ("coalesce(CASE language " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.LANGUAGE_NAMES.items()) + " END, language)")


def _band(x: str) -> str:
    return (f"CASE WHEN {x} < {C.BAND_RED_BELOW} THEN '{C.COLOR_RED}' WHEN {x} < {C.BAND_AMBER_BELOW} "
            f"THEN '{C.COLOR_AMBER}' ELSE '{C.COLOR_GREEN}' END")


def _kpis(pred: str) -> str:
    delta = R(f"avg_rating - {C.RATING_TARGET}", 2)
    return with_reviews(f"""SELECT total, full_total, avg_rating,
       {PCT('positive_count', 'total')} AS pct_positive,
       {PCT('negative_count', 'total')} AS pct_negative,
       positive_count, negative_count,
       {delta} AS delta_to_target,
       CASE WHEN {delta} >= 0 THEN 'good' ELSE 'bad' END AS delta_class,
       CASE WHEN {delta} >= 0 THEN '↑' ELSE '↓' END AS delta_arrow
FROM a""", extra=f"""a AS (
  SELECT CAST(count_if({pred}) AS BIGINT) AS total, count(*) AS full_total,
         {R(f'avg(CASE WHEN {pred} THEN rating END)', 2)} AS avg_rating,
         CAST(count_if(({pred}) AND sentiment_label = 'positive') AS BIGINT) AS positive_count,
         CAST(count_if(({pred}) AND sentiment_label = 'negative') AS BIGINT) AS negative_count
  FROM reviews)""")


def _label_dist(src: str, col: str, non_null: bool, classified: bool) -> str:
    total = "sum(CASE WHEN label IS NOT NULL THEN n END) OVER ()" if non_null else "sum(n) OVER ()"
    return with_reviews(f"""SELECT label, n, {PCT('n', 'total')} AS pct,
       row_number() OVER (ORDER BY n DESC, label ASC) AS rank
FROM (SELECT label, n, {total} AS total
      FROM (SELECT {col} AS label, count(*) AS n FROM {src} GROUP BY 1) g) t
WHERE label IS NOT NULL""", classified)


def _explorer(where: str, order: str, start: int, per_page: int) -> str:
    return with_reviews(f"""SELECT CAST(row_number() OVER (ORDER BY {order}) + {start} AS BIGINT) AS pos, review_id,
       store_city AS "Location", language AS "Lang", rating AS "Rating",
       sentiment_label AS "Sentiment", text AS "Review", {_COLOR_CASE} AS sentiment_color
FROM (SELECT * FROM reviews {where} ORDER BY {order} LIMIT {per_page} OFFSET {start}) p""")


SQL: dict[str, str] = {
    "rating_by_category": with_reviews(f"""SELECT sport_category, avg_rating, rating_count,
       {R('avg_rating', 2)} AS avg_rating_2dp, {_band('avg_rating')} AS band_color,
       row_number() OVER (ORDER BY avg_rating ASC NULLS LAST, sport_category ASC) AS rank
FROM (SELECT sport_category, avg(rating) AS avg_rating, count(rating) AS rating_count
      FROM classified WHERE sport_category IS NOT NULL GROUP BY 1) g""", True),

    "verify_total": with_reviews("SELECT count(*) AS total FROM reviews"),
    "verify_avg_rating": with_reviews(f"SELECT {R('avg(rating)', 2)} AS avg_rating FROM reviews"),
    "verify_by_sentiment": with_reviews("""SELECT sentiment_label, n,
       row_number() OVER (ORDER BY n DESC, sentiment_label ASC NULLS FIRST) AS rank
FROM (SELECT sentiment_label, count(*) AS n FROM reviews GROUP BY 1) g"""),
    "verify_by_city": with_reviews(f"""SELECT store_city, {R('avg(rating)', 2)} AS avg_rating, count(*) AS total
FROM reviews GROUP BY store_city ORDER BY avg_rating ASC NULLS LAST, store_city ASC NULLS FIRST"""),

    "kpis": _kpis(DASH_PRED),
    "kpis_unfiltered": _kpis("true"),
    "label_distribution": _label_dist("reviews", "sentiment_label", False, False),
    "sentiment_pie": _label_dist("reviews", "sentiment_label", True, False),
    "category_distribution": _label_dist("classified", "sport_category", False, True),
    "category_rating_bars": with_reviews(f"""SELECT sport_category, {R('m', 2)} AS avg_rating,
       {BAR('floor(m * 2)')} AS bar,
       row_number() OVER (ORDER BY m ASC NULLS LAST, sport_category ASC) AS rank
FROM (SELECT sport_category, avg(rating) AS m FROM classified WHERE sport_category IS NOT NULL GROUP BY 1) g""", True),
    "sentiment_by_city": with_reviews("""SELECT store_city, sentiment_label, n,
       CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY store_city) AS DOUBLE) * CAST(100.0 AS DOUBLE) AS pct
FROM (SELECT store_city, sentiment_label, count(*) AS n FROM reviews
      WHERE store_city IS NOT NULL AND sentiment_label IS NOT NULL GROUP BY 1, 2) g"""),
    "negatives_by_category": with_reviews("""SELECT sport_category, n,
       row_number() OVER (ORDER BY n DESC, sport_category ASC) AS rank
FROM (SELECT sport_category, count(*) AS n FROM classified
      WHERE sentiment_label = 'negative' AND sport_category IS NOT NULL GROUP BY 1) g""", True),
    "top3_negative_categories": with_reviews("""SELECT * FROM (SELECT sport_category, n,
       row_number() OVER (ORDER BY n DESC, sport_category ASC) AS rank
FROM (SELECT sport_category, count(*) AS n FROM classified
      WHERE sentiment_label = 'negative' AND sport_category IS NOT NULL GROUP BY 1) g) r WHERE rank <= 3""", True),
    "rating_trend": with_reviews("""SELECT strftime(date, '%Y-%m') AS month, avg(rating) AS avg_rating,
       count(rating) AS rating_count
FROM reviews WHERE date IS NOT NULL GROUP BY 1 ORDER BY 1"""),
    "insight_worst_category": with_reviews(f"""SELECT sport_category, {TITLE('sport_category')} AS title, {R('m', 2)} AS value
FROM (SELECT sport_category, avg(rating) AS m FROM classified
      WHERE sport_category IS NOT NULL AND {DASH_PRED} GROUP BY 1 HAVING avg(rating) IS NOT NULL
      ORDER BY m ASC, sport_category ASC LIMIT 1) t
WHERE {R('m', 2)} < {C.WORST_CATEGORY_BELOW}""", True),
    "insight_best_category": with_reviews(f"""SELECT sport_category, {TITLE('sport_category')} AS title, {R('m', 2)} AS value
FROM (SELECT sport_category, avg(rating) AS m FROM classified
      WHERE sport_category IS NOT NULL GROUP BY 1 HAVING avg(rating) IS NOT NULL
      ORDER BY m DESC, sport_category ASC LIMIT 1) t""", True),
    "insight_negative_city": with_reviews("""SELECT store_city, count(*) AS n FROM reviews
WHERE sentiment_label = 'negative' AND store_city IS NOT NULL
GROUP BY 1 ORDER BY n DESC, store_city ASC LIMIT 1"""),
    "insight_low_language": with_reviews(f"""SELECT language, {_LANG_CASE} AS language_name, {R('m', 2)} AS value
FROM (SELECT language, avg(sentiment_score) AS m FROM reviews WHERE language IS NOT NULL
      GROUP BY 1 HAVING avg(sentiment_score) IS NOT NULL ORDER BY m ASC, language ASC LIMIT 1) t"""),
    "score_by_city": with_reviews(f"""SELECT store_city, {R('m', 2)} AS avg_score, m > 0 AS is_positive,
       {BAR('floor(abs(m) * 10)')} AS bar
FROM (SELECT store_city, avg(sentiment_score) AS m FROM reviews WHERE store_city IS NOT NULL GROUP BY 1) g
ORDER BY m ASC NULLS LAST, store_city ASC"""),
    "filter_options": with_reviews("""SELECT DISTINCT column_name, value FROM (
  SELECT 'source' AS column_name, CAST(source AS VARCHAR) AS value FROM reviews WHERE source IS NOT NULL
  UNION ALL
  SELECT 'language', CAST(language AS VARCHAR) FROM reviews WHERE language IS NOT NULL) u
ORDER BY column_name, value"""),
    "rating_bounds": with_reviews("SELECT min(rating) AS min_rating, max(rating) AS max_rating FROM reviews"),
    "source_counts": with_reviews("""SELECT source, store_city, count(*) AS n FROM reviews
GROUP BY 1, 2 ORDER BY source, store_city"""),

    "dashboard_filter": with_reviews(f"""SELECT review_id, source, language, sentiment_label, rating
FROM reviews WHERE {DASH_PRED}"""),
    "label_subset": with_reviews("""SELECT review_id, store_city, sentiment_label FROM reviews
WHERE sentiment_label = 'negative'"""),
    "dated_reviews": with_reviews("""SELECT review_id, date, strftime(date, '%Y-%m') AS month
FROM reviews WHERE date IS NOT NULL"""),
    "keyword_category": with_reviews(f"""SELECT review_id, text, {keyword_category_sql('text')} AS raw_category,
       coalesce({keyword_category_sql('text')}, 'other') AS sport_category FROM reviews"""),
    "unclassified_rows": with_reviews(f"""SELECT review_id, text FROM reviews
WHERE ({keyword_category_sql('text')}) IS NULL"""),
    "classified_counts": with_reviews(f"""SELECT count(c) AS classified, CAST(count_if(c IS NULL) AS BIGINT) AS unclassified
FROM (SELECT {keyword_category_sql('text')} AS c FROM reviews) t"""),
    "keyword_category_documents": f"""SELECT coalesce({keyword_category_sql('text')}, 'other') AS sport_category,
       count(*) AS n FROM documents GROUP BY 1""",

    "explorer_page_recent": _explorer("", "date DESC NULLS LAST, review_id ASC", 20, 20),
    "explorer_page_low": _explorer("WHERE sentiment_label = 'negative'", "rating ASC NULLS LAST, review_id ASC", 0, 50),
    "explorer_page_high": _explorer("WHERE sentiment_label = 'positive'", "rating DESC NULLS LAST, review_id ASC", 20, 10),
    "explorer_summary": with_reviews("""SELECT total, CAST(greatest(1, ceil(total / 20)) AS BIGINT) AS total_pages
FROM (SELECT count(*) AS total FROM reviews WHERE sentiment_label = 'negative') t"""),
    "lowest_scores": with_reviews("""SELECT CAST(row_number() OVER (ORDER BY sentiment_score ASC NULLS LAST, review_id ASC) AS BIGINT) AS pos,
       review_id, store_city, sentiment_score AS score, substr(text, 1, 60) || '...' AS preview
FROM (SELECT * FROM reviews ORDER BY sentiment_score ASC NULLS LAST, review_id ASC LIMIT 5) t"""),
}


def as_double(sql: str, cols: list[str]) -> str:
    """Wrap a query so its decimal columns come back as double (the Spark
    side presents decimals the same way)."""
    rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) __q"


DECIMAL_OUTPUTS = {
    "store_projection": ["rating", "sentiment_score"],
    "upsert_sentiment": ["rating", "sentiment_score"],
    "upsert_touch": ["rating", "sentiment_score"],
    "upsert_bucketed": ["rating", "sentiment_score"],
    "stream_upsert": ["rating", "sentiment_score"],
    "weekly_batch_load": ["rating", "sentiment_score"],
    "batch_load_incremental": ["rating", "sentiment_score"],
    "numeric_functions": ["rating_dec", "overflow_is_null"],
}


def all_sql() -> dict[str, str]:
    from reviewlake.plans import oracle_io, oracle_more, oracle_text
    out = dict(SQL)
    out.update(oracle_more.SQL)
    out.update(oracle_text.SQL)
    out.update(oracle_io.SQL)
    out["verify_by_city_sql"] = out["verify_by_city"]
    for k, cols in DECIMAL_OUTPUTS.items():
        out[k] = as_double(out[k], cols)
    return out
