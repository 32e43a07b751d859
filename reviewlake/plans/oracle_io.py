"""SQL oracles for ``queries_io``."""

from __future__ import annotations

from reviewlake.oracle import keyword_category_sql
from reviewlake.oracle import _COLOR_CASE, _LANG_CASE, BAR, PCT, R, TITLE, with_reviews
from reviewlake import config as C
from reviewlake.oracle import DASH_PRED
from reviewlake.plans.oracle_more import _STAR_LABEL, _STAR_SCORE, BATCH_TS, COLLECT, PLAY, SQL as MORE, STORED_COLS
from reviewlake.plans.oracle_text import _polarity
from reviewlake.sources import synth

EVENTS = "CAST(user_id AS VARCHAR) AS key, event_id, ts, user_id, event_type, value, props, false AS _malformed"

REVIEW_ROWS = with_reviews("""SELECT review_id, source, store_id, 'Store ' || store_id AS store_name, store_city, rating,
       text, language, strftime(date, '%Y-%m-%dT%H:%M:%S') AS date, 'other' AS sport_category,
       CAST(NULL AS VARCHAR) AS collected_at FROM reviews""")


def _D(x):
    return f"CAST({x} AS DOUBLE)"


_X = f"sentiment_score * {_D('0.37')} + CAST(doc_id AS DOUBLE) / {_D('1000.0')}"
_CLAMP_IN = f"rating + CAST(doc_id % 7 - 3 AS DOUBLE) * {_D('0.3')}"

WEEKLY_BATCH_LOAD = with_reviews(
    f"""SELECT review_id, source, store_id, store_name, store_city, TRY_CAST(rating AS DECIMAL(3,1)) AS rating,
       text AS review_text, language, TRY_CAST(date AS TIMESTAMP) AS review_date,
       coalesce({keyword_category_sql('text')}, 'other') AS sport_category,
       CASE WHEN mean > 0.1 THEN 'positive' WHEN mean < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       TRY_CAST({R('mean', 3)} AS DECIMAL(5,3)) AS sentiment_score,
       TRY_CAST(collected_at AS TIMESTAMP) AS collected_at, {BATCH_TS} AS ingested_at
FROM m""", True, extra=f"col AS ({COLLECT}),\n" + _polarity("col", "review_id"))

_AGAIN = PLAY.replace("content AS text, language", "'Worst, useless. ' || content AS text, language")
_STORE = f"""SELECT review_id, source, store_id, store_name, store_city, TRY_CAST(rating AS DECIMAL(3,1)) AS rating,
       text AS review_text, language, TRY_CAST(date AS TIMESTAMP) AS review_date,
       coalesce({keyword_category_sql('text')}, 'other') AS sport_category,
       CASE WHEN mean > 0.1 THEN 'positive' WHEN mean < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       TRY_CAST({R('mean', 3)} AS DECIMAL(5,3)) AS sentiment_score,
       TRY_CAST(collected_at AS TIMESTAMP) AS collected_at, TIMESTAMP '2026-03-01 00:00:00' AS ingested_at FROM m"""
_SECOND = with_reviews(_STORE, True, extra=f"one AS ({_AGAIN}), col AS (SELECT * FROM one UNION ALL SELECT * REPLACE ('new_' || review_id AS review_id) FROM one),\n"
                       + _polarity("col", "review_id"))
_KEPT = [c for c in STORED_COLS if c not in ("review_id", "sentiment_label", "sentiment_score", "ingested_at")]
INCREMENTAL = f"""SELECT coalesce(t.review_id, s.review_id) AS review_id,
       {', '.join(f"CASE WHEN t.review_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in _KEPT)},
       {', '.join(f"CASE WHEN s.review_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in ("sentiment_label", "sentiment_score", "ingested_at"))}
FROM ({WEEKLY_BATCH_LOAD}) t FULL OUTER JOIN ({_SECOND}) s ON t.review_id = s.review_id"""

_F = f"(SELECT * FROM classified WHERE {DASH_PRED})"
DASHBOARD_PAGE = with_reviews(f"""
SELECT 'kpis' AS panel, CASE WHEN {R(f'v - {C.RATING_TARGET}', 2)} >= 0 THEN 'good' ELSE 'bad' END AS item, v AS value
FROM (SELECT {R('avg(rating)', 2)} AS v FROM {_F} f) k
UNION ALL SELECT 'insight_worst_category', sport_category, v FROM (SELECT sport_category, {R('avg(rating)', 2)} AS v, avg(rating) AS m FROM {_F} f
  GROUP BY 1 HAVING m IS NOT NULL ORDER BY m ASC, sport_category ASC LIMIT 1) t WHERE v < {C.WORST_CATEGORY_BELOW}
UNION ALL SELECT 'insight_best_category', sport_category, v FROM (SELECT sport_category, {R('avg(rating)', 2)} AS v, avg(rating) AS m FROM {_F} f
  GROUP BY 1 HAVING m IS NOT NULL ORDER BY m DESC, sport_category ASC LIMIT 1) t
UNION ALL SELECT 'insight_negative_city', store_city, CAST(n AS DOUBLE) FROM (SELECT store_city, count(*) AS n FROM {_F} f
  WHERE sentiment_label = 'negative' AND store_city IS NOT NULL GROUP BY 1 ORDER BY n DESC, store_city ASC LIMIT 1) t
UNION ALL SELECT 'rating_by_category', sport_category, {R('avg(rating)', 2)} FROM {_F} f GROUP BY sport_category
UNION ALL SELECT 'sentiment_distribution', sentiment_label, {PCT('n', 'sum(n) OVER ()')} FROM (SELECT sentiment_label, count(*) AS n FROM {_F} f GROUP BY 1) g
UNION ALL SELECT 'negatives_by_category', sport_category, CAST(count(*) AS DOUBLE) FROM {_F} f WHERE sentiment_label = 'negative' GROUP BY sport_category
UNION ALL SELECT 'rating_trend', strftime(date, '%Y-%m'), CAST(count(rating) AS DOUBLE) FROM {_F} f WHERE date IS NOT NULL GROUP BY 2
UNION ALL SELECT 'explorer_page', review_id, CAST(row_number() OVER (ORDER BY rating ASC, review_id ASC) AS DOUBLE)
  FROM (SELECT * FROM {_F} f ORDER BY rating ASC, review_id ASC LIMIT 10) e
UNION ALL SELECT 'explorer_summary', CAST(count(*) AS VARCHAR), CAST(greatest(1, ceil(count(*) / 10)) AS DOUBLE) FROM {_F} f
UNION ALL SELECT 'filter_options', 'source', CAST(count(DISTINCT source) AS DOUBLE) FROM classified
UNION ALL SELECT 'filter_options', 'language', CAST(count(DISTINCT language) AS DOUBLE) FROM classified""", True)

SQL: dict[str, str] = {
    "topic_roundtrip": f"SELECT {EVENTS} FROM events",
    "bounded_consume": f"SELECT {EVENTS} FROM (SELECT * FROM events ORDER BY ts, event_id LIMIT 200) e",
    "props_decode": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "json_roundtrip": REVIEW_ROWS,
    "csv_roundtrip": REVIEW_ROWS,
    "first_available": REVIEW_ROWS,
    "stream_ingest": f"SELECT {EVENTS.removesuffix(', false AS _malformed')} FROM events",
    "stream_rejects": """SELECT count(*) AS received, CAST(count_if(event_id % 97 = 0) AS BIGINT) AS malformed,
       CAST(count_if(event_id % 97 <> 0) AS BIGINT) AS good, CAST(count_if(event_id % 97 = 0) AS BIGINT) AS rejected, CAST(9 AS BIGINT) AS raw_length FROM events""",
    "load_lexicon_only": with_reviews("SELECT review_id, sentiment_label, sentiment_score FROM reviews"),
    "load_model_only": with_reviews(f"SELECT review_id, {_STAR_LABEL} AS sentiment_label, {_STAR_SCORE} AS sentiment_score FROM reviews"),
    "explorer_page_after": with_reviews(f"""SELECT CAST(row_number() OVER (ORDER BY rating ASC NULLS LAST, review_id ASC) AS BIGINT) AS pos, review_id,
       rating AS sort_value, store_city AS "Location", language AS "Lang", rating AS "Rating",
       sentiment_label AS "Sentiment", text AS "Review", {_COLOR_CASE} AS sentiment_color
FROM (SELECT * FROM reviews WHERE sentiment_label = 'positive' ORDER BY rating ASC NULLS LAST, review_id ASC LIMIT 20 OFFSET 20) p"""),
    "dashboard_page": DASHBOARD_PAGE,
    "batch_load_incremental": INCREMENTAL,
    "stream_upsert": MORE["upsert_sentiment"],
    "gates": with_reviews("SELECT count(*) AS n FROM classified", True),
    "processing_job": """SELECT 'r_' || CAST(doc_id AS VARCHAR) AS review_id, CAST(length(text) AS INTEGER) AS review_length,
       CASE WHEN length(text) < 50 THEN 'short' WHEN length(text) < 200 THEN 'medium' ELSE 'long' END AS length_category
FROM documents""",
    "weekly_batch_load": WEEKLY_BATCH_LOAD,
    "string_functions": with_reviews(f"""SELECT review_id, CAST(length(text) AS INTEGER) AS n_chars, lower(text) AS lower,
       substr(text, 1, 12) AS head, substr(text, 1, 8) || '...' AS preview,
       trim('. ' || text || '. .', '. ') AS stripped,
       printf('%05d', doc_id % 1000) AS padded, 'syn_' || printf('%05d', doc_id) AS syn_id,
       (contains(lower(text), 'bike') OR contains(lower(text), 'swim') OR contains(lower(text), 'gym')) AS has_sport_word,
       {TITLE("language || '_water_sports'")} AS title,
       CASE WHEN length(language) < 4 THEN rpad(language, 4, ' ') ELSE language END AS lang_padded,
       {BAR('floor(rating * 2)')} AS bar,
       CAST(TRY_CAST(split_part(trim(CAST(CAST(floor(rating) AS BIGINT) AS VARCHAR) || ' stars'), ' ', 1) AS INTEGER) AS DOUBLE) AS stars,
       'tp_' || md5(text) AS hashed_id
FROM reviews"""),
    "numeric_functions": with_reviews(f"""SELECT review_id, {R(_X, 1)} AS r1, {R(_X, 2)} AS r2, {R(_X, 3)} AS r3, {R(_X, 4)} AS r4,
       CASE WHEN ({_CLAMP_IN}) IS NOT NULL THEN greatest({_D('1.0')}, least({_D('5.0')}, {_CLAMP_IN})) END AS clamped,
       abs(sentiment_score) AS abs_score, (doc_id + 6) // 7 AS pages,
       {PCT('doc_id % 13', 'doc_id % 17', 1)} AS share,
       TRY_CAST(rating AS DECIMAL(3,1)) AS rating_dec, TRY_CAST(rating * 20 AS DECIMAL(3,1)) AS overflow_is_null
FROM reviews"""),
    "default_values": with_reviews(f"""SELECT review_id, coalesce(store_city, 'unknown') AS city,
       coalesce(rating, {_D('3.0')}) AS rating,
       nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE language END, '') AS lang,
       coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE text END, ''), store_id) AS text_or_store
FROM reviews"""),
    "time_functions": """SELECT event_id,
       make_timestamp(CAST(round(CAST(epoch_us(ts) AS DOUBLE) / 1000000.0 * 1000000.0) AS BIGINT)) AS from_epoch,
       date_trunc('second', ts) - INTERVAL 2 HOUR AS utc_from_offset,
       ts AS naive_fraction, CAST(NULL AS TIMESTAMP) AS garbage,
       strftime(ts, '%Y-%m') AS month,
       ts - to_days(CAST(user_id % 180 AS INTEGER)) AS days_back,
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso
FROM events""",
    "forum_rating": f"""SELECT event_id, score,
       CASE WHEN score > 100 THEN {_D('5.0')} WHEN score > 50 THEN {_D('4.0')} WHEN score > 10 THEN {_D('3.0')}
            WHEN score > 0 THEN {_D('2.0')} ELSE {_D('1.0')} END AS rating
FROM (SELECT event_id, CAST(trunc(value * 10 - 100) AS BIGINT) AS score FROM events) e""",
    "label_lookup": with_reviews(f"SELECT review_id, {_LANG_CASE} AS language_name, {_COLOR_CASE} AS sentiment_color FROM reviews"),
    "canonical_record": with_reviews("""SELECT review_id, source, store_id, 'Store ' || store_id AS store_name, store_city,
       rating, text, language, strftime(date, '%Y-%m-%dT%H:%M:%S') AS date, 'other' AS sport_category,
       '2026-01-01T00:00:00' AS collected_at FROM reviews"""),
    "min_length_filter": """SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents
WHERE length(text) >= 2000""",
}

SQL["store_rejects"] = with_reviews("""SELECT review_id, rating * 25.0 AS rating FROM reviews
WHERE rating IS NOT NULL AND TRY_CAST(rating * 25.0 AS DECIMAL(3,1)) IS NULL""")
SQL["publish_counts"] = "SELECT count(*) AS published, count(*) AS received, CAST(0 AS BIGINT) AS failed FROM events"
SQL["label_lookup_table"] = with_reviews(f"SELECT review_id, {_LANG_CASE} AS language_name FROM reviews")


def _draw(n: int) -> str:
    return f"(CAST('0x' || substr(md5('42|{n}|' || CAST(doc_id AS VARCHAR)), 1, 7) AS BIGINT) / 268435456.0)"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else _D(v) for v in values) + "]"


_CITY = f"({_list(synth.CITIES)})[CAST(floor({_draw(2)} * {len(synth.CITIES)}) AS INTEGER) + 1]"
_TPL = f"CAST(floor({_draw(1)} * {len(synth.TEMPLATES)}) AS INTEGER) + 1"
_LANG = f"CASE WHEN {_draw(3)} < 0.4 THEN 'pt' WHEN {_draw(3)} < {0.4 + 0.4!r} THEN 'es' ELSE 'en' END"
SQL["synthetic_reviews"] = f"""SELECT 'syn_' || printf('%05d', doc_id) AS review_id, 'synthetic' AS source,
       'store_' || lower({_CITY}) AS store_id, 'Store ' || {_CITY} AS store_name, {_CITY} AS store_city,
       {R(f"greatest({_D(1.0)}, least({_D(5.0)}, ({_list([r for _, r, _ in synth.TEMPLATES])})[{_TPL}] + ({_draw(5)} * 2 - 1) * {_D(synth.JITTER)}))", 1)} AS rating,
       ({_list([t for t, _, _ in synth.TEMPLATES])})[{_TPL}] AS text, {_LANG} AS language,
       strftime(TIMESTAMP '2026-01-01 00:00:00' - to_days(CAST(floor({_draw(4)} * {synth.MAX_DAYS_BACK + 1}) AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS date,
       ({_list([c for _, _, c in synth.TEMPLATES])})[{_TPL}] AS sport_category, '2026-01-01T00:00:00' AS collected_at
FROM documents"""
