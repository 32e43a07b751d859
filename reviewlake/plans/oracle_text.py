"""SQL oracles for ``queries_text``."""

from __future__ import annotations

from reviewlake import config as C
from reviewlake.plans.lexicons import big_lexicon
from reviewlake.oracle import keyword_category_sql
from reviewlake.oracle import BAR, PCT, R, with_reviews  # noqa: F401

_LEX_VALUES = ", ".join(f"('{w}', CAST('{p}' AS DECIMAL(20,6)))" for w, p in C.DEFAULT_LEXICON.items())


def _polarity(src: str, key: str, lexicon: str = _LEX_VALUES) -> str:
    """CTEs: mean lexicon polarity per row of ``src`` (label from the unrounded mean)."""
    return f"""lex(word, pol) AS (VALUES {lexicon}),
toks AS (SELECT {key} AS k, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS w FROM {src}),
per AS (SELECT k, sum(pol) AS t, count(*) AS n FROM toks JOIN lex ON toks.w = lex.word GROUP BY k),
m AS (SELECT s.*, CASE WHEN coalesce(per.n, 0) > 0 THEN CAST(per.t AS DOUBLE) / CAST(per.n AS DOUBLE)
                       ELSE CAST(0.0 AS DOUBLE) END AS mean
      FROM {src} s LEFT JOIN per ON per.k = s.{key})"""


def _pol_cols() -> str:
    return (f"{R('mean', 3)} AS sentiment_score, CASE WHEN mean > {C.POLARITY_POSITIVE_ABOVE} THEN 'positive' "
            f"WHEN mean < {C.POLARITY_NEGATIVE_BELOW} THEN 'negative' ELSE 'neutral' END AS sentiment_label")


LEXICON = "WITH " + _polarity("documents", "doc_id") + f"\nSELECT doc_id, {_pol_cols()} FROM m"
ENRICH = with_reviews(
    f"SELECT review_id, {_pol_cols()}, coalesce({keyword_category_sql('text')}, 'other') AS sport_category FROM m",
    extra=_polarity("reviews", "review_id"))

_BIG_VALUES = ", ".join(f"('{w}', CAST('{p}' AS DECIMAL(20,6)))" for w, p in big_lexicon().items())
ENRICH_BIG = with_reviews(
    f"SELECT review_id, {_pol_cols()}, coalesce({keyword_category_sql('text')}, 'other') AS sport_category FROM m",
    extra=_polarity("reviews", "review_id", _BIG_VALUES))

def _words(src: str, key: str) -> str:
    return (f"SELECT {key} AS k, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: x <> ''))) AS w "
            f"FROM {src}")


def _stars(src: str, key: str) -> str:
    """CTEs: stars (null: no answer) of every row of ``src`` by log odds per word."""
    ln = lambda x: f"CAST(floor(1000 * ln({x}) + 0.5) AS BIGINT)"
    word = lambda t: f"CASE WHEN hi{t} > 0 AND lo{t} > 0 AND {apart(t)} * {apart(t)} > 20.0 * n::DOUBLE * hi{t} * lo{t} THEN {ln(f'((a{t}::DOUBLE * (hi{t} + lo{t}) + hi{t}) * lo{t}) / (((n - a{t})::DOUBLE * (hi{t} + lo{t}) + lo{t}) * hi{t})')} ELSE 0 END AS w{t}"
    apart = lambda t: f"(a{t}::DOUBLE * (hi{t} + lo{t}) - n::DOUBLE * hi{t})"
    bias = lambda t: f"CASE WHEN hi{t} = 0 THEN -1 WHEN lo{t} = 0 THEN 1 ELSE {ln(f'(hi{t} + 1)::DOUBLE / (lo{t} + 1)')} END AS b{t}"
    ts = (1, 2, 3, 4)
    return f"""told AS (SELECT d.doc_id, text, CASE WHEN toxic = 1 THEN 1 + quality ELSE 3 + 2 * quality END AS s
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE text IS NOT NULL AND quality IS NOT NULL),
sizes AS (SELECT {", ".join(f"count(*) FILTER (s > {t}) AS hi{t}, count(*) FILTER (s <= {t}) AS lo{t}" for t in ts)} FROM told),
told_words AS ({_words('told', 'doc_id')}),
counted AS (SELECT w, count(*) AS n, {", ".join(f"count(*) FILTER (s > {t}) AS a{t}" for t in ts)}
  FROM told_words JOIN told ON k = doc_id GROUP BY w HAVING count(*) >= 2),
weighed AS (SELECT w, {", ".join(word(t) for t in ts)} FROM counted, sizes),
bias AS (SELECT {", ".join(bias(t) for t in ts)} FROM sizes),
own_words AS ({_words(src, key)}),
sums AS (SELECT k, {", ".join(f"sum(w{t}) AS s{t}" for t in ts)} FROM own_words JOIN weighed USING (w) GROUP BY k),
sc AS (SELECT r.*, CASE WHEN sums.k IS NOT NULL THEN 1 + {" + ".join(f"(s{t} + b{t} > 0)::INTEGER" for t in ts)} END AS s
  FROM {src} r CROSS JOIN bias LEFT JOIN sums ON sums.k = r.{key})"""


def _star_cols(stars: str) -> str:
    return (f"CASE WHEN {stars} >= 4 THEN 'positive' WHEN {stars} <= 2 THEN 'negative' ELSE 'neutral' END AS bert_label, "
            f"coalesce({R(f'(CAST({stars} AS DOUBLE) - 3.0) / 2.0', 3)}, CAST(0.0 AS DOUBLE)) AS bert_score")


STAR = f"WITH {_stars('documents', 'doc_id')} SELECT doc_id, {_star_cols('s')} FROM sc"


def _topics() -> str:
    """CTEs: cosine of every unclassified review with the ten prototypes."""
    labels = ", ".join(f"({k}, '{c}')" for k, c in enumerate(C.ZERO_SHOT_LABELS))
    every = ", ".join(f"'{c}'" for c in C.ZERO_SHOT_LABELS)
    return f"""cand(i, label) AS (VALUES {labels}),
cat AS (SELECT *, {keyword_category_sql('text')} AS kw FROM reviews),
lab AS (SELECT review_id, CASE WHEN kw IN ({every}) THEN kw WHEN kw IS NOT NULL THEN 'other' END AS label FROM cat WHERE text IS NOT NULL),
sizes AS (SELECT label, count(*) AS n FROM lab GROUP BY 1),
words AS ({_words('cat', 'review_id')}),
freq AS (SELECT w, CAST(floor(100 * ln((SELECT count(*) FROM lab)::DOUBLE / count(*)) + 0.5) AS BIGINT) AS idf FROM words GROUP BY w),
proto AS (SELECT i, w, (count(*) * 1000) // any_value(n) AS share FROM words JOIN lab ON k = review_id JOIN sizes USING (label) JOIN cand USING (label)
          GROUP BY i, w HAVING (count(*) * 1000) // any_value(n) > 0),
norms AS (SELECT i, sum(share * share * idf * idf)::DOUBLE AS norm FROM proto JOIN freq USING (w) GROUP BY i),
mine AS (SELECT k, w, idf FROM words JOIN cat ON k = review_id JOIN freq USING (w) WHERE kw IS NULL AND w IN (SELECT w FROM proto)),
lens AS (SELECT k, sum(idf * idf)::DOUBLE AS len FROM mine GROUP BY k),
dots AS (SELECT k, i, sum(idf * idf * share)::DOUBLE AS dot FROM mine JOIN proto USING (w) GROUP BY k, i),
scored AS (SELECT k, i, label, CASE WHEN len > 0 AND norm > 0 THEN {R('coalesce(dot, 0) / (sqrt(len) * sqrt(norm))', 6)} ELSE CAST(0.0 AS DOUBLE) END AS score
  FROM lens CROSS JOIN cand LEFT JOIN dots USING (k, i) LEFT JOIN norms USING (i)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, i) - 1 AS place FROM scored),
best AS (SELECT k, CASE WHEN score > 0 THEN label ELSE 'other' END AS topic FROM ranked WHERE place = 0)"""


CASCADE = with_reviews("SELECT review_id, coalesce(kw, topic, 'other') AS sport_category FROM cat LEFT JOIN best ON k = review_id", extra=_topics())
ZERO_SHOT = with_reviews("SELECT review_id, coalesce(topic, 'other') AS sport_category FROM cat LEFT JOIN best ON k = review_id WHERE kw IS NULL",
                         extra=_topics())
ZERO_SHOT_SCORES = with_reviews("SELECT k AS review_id, place::INTEGER AS place, label, score FROM ranked", extra=_topics())

_M = [("total_reviews", "CAST(total AS DOUBLE)"), ("positive_count", "CAST(pos AS DOUBLE)"),
      ("negative_count", "CAST(neg AS DOUBLE)"), ("neutral_count", "CAST(neu AS DOUBLE)"),
      ("positive_pct", f"CASE WHEN total > 0 THEN {R('CAST(pos AS DOUBLE) / CAST(total AS DOUBLE) * 100', 2)} END"),
      ("negative_pct", f"CASE WHEN total > 0 THEN {R('CAST(neg AS DOUBLE) / CAST(total AS DOUBLE) * 100', 2)} END"),
      ("neutral_pct", f"CASE WHEN total > 0 THEN {R('CAST(neu AS DOUBLE) / CAST(total AS DOUBLE) * 100', 2)} END"),
      ("avg_sentiment_score", f"CASE WHEN total > 0 THEN {R('ssum / CAST(total AS DOUBLE)', 4)} END"),
      ("avg_rating", R("avg_rating", 4)),
      ("model_load_time_seconds", "CAST(NULL AS DOUBLE)"), ("inference_time_seconds", "CAST(NULL AS DOUBLE)")]
_P = [("model_name", "'cumulative-bayes'"), ("total_reviews", "CAST(total AS VARCHAR)"),
      ("languages", "langs"), ("sources", "srcs")]
_LAB = f"""{_stars('reviews', 'review_id')},
lab AS (SELECT *, {_star_cols('s')} FROM sc)"""
RUN_METRICS = with_reviews(
    "\nUNION ALL\n".join(
        [f"SELECT 'run-0001' AS run_id, 'metric' AS kind, '{n}' AS name, {e} AS value_num, "
         f"CAST(NULL AS VARCHAR) AS value_str, TIMESTAMP '2026-01-01 00:00:00' AS logged_at FROM a" for n, e in _M]
        + [f"SELECT 'run-0001', 'param', '{n}', CAST(NULL AS DOUBLE), {e}, TIMESTAMP '2026-01-01 00:00:00' FROM a"
           for n, e in _P]),
    extra=_LAB + f""",
a AS (SELECT count(*) AS total, count_if(bert_label = 'positive') AS pos, count_if(bert_label = 'negative') AS neg,
             count_if(bert_label = 'neutral') AS neu, sum(bert_score) AS ssum, avg(rating) AS avg_rating,
             array_to_string(list_sort(list_distinct(list(language) FILTER (WHERE language IS NOT NULL))), ',') AS langs,
             array_to_string(list_sort(list_distinct(list(source) FILTER (WHERE source IS NOT NULL))), ',') AS srcs
      FROM lab)""")

INSIGHT = with_reviews(f"""
SELECT 'distribution' AS section, label AS item, CAST(n AS DOUBLE) AS n, {PCT('n', 'total')} AS value,
       row_number() OVER (ORDER BY n DESC, label ASC) AS rank
FROM (SELECT label, n, sum(n) OVER () AS total
      FROM (SELECT sentiment_label AS label, count(*) AS n FROM classified GROUP BY 1) g) t
WHERE label IS NOT NULL
UNION ALL
SELECT 'category_rating', sport_category, CAST(NULL AS DOUBLE), {R('m', 2)},
       row_number() OVER (ORDER BY m ASC NULLS LAST, sport_category ASC)
FROM (SELECT sport_category, avg(rating) AS m FROM classified WHERE sport_category IS NOT NULL GROUP BY 1) g
UNION ALL
SELECT * FROM (SELECT 'top_negative', sport_category, CAST(n AS DOUBLE), CAST(NULL AS DOUBLE),
       row_number() OVER (ORDER BY n DESC, sport_category ASC) AS rk
FROM (SELECT sport_category, count(*) AS n FROM classified
      WHERE sentiment_label = 'negative' AND sport_category IS NOT NULL GROUP BY 1) g) x WHERE rk <= 3
UNION ALL
SELECT 'lowest_scores', review_id, CAST(NULL AS DOUBLE), sentiment_score,
       row_number() OVER (ORDER BY sentiment_score ASC NULLS LAST, review_id ASC)
FROM (SELECT * FROM classified ORDER BY sentiment_score ASC NULLS LAST, review_id ASC LIMIT 3) l""", True)

STAR_REPORT = with_reviews(f"""
SELECT 'distribution' AS section, label AS item, CAST(n AS DOUBLE) AS n, {PCT('n', 'total')} AS value,
       row_number() OVER (ORDER BY n DESC, label ASC) AS rank
FROM (SELECT label, n, sum(n) OVER () AS total
      FROM (SELECT bert_label AS label, count(*) AS n FROM lab GROUP BY 1) g) t
UNION ALL
SELECT 'city_score', store_city, CAST(NULL AS DOUBLE), {R('m', 2)}, row_number() OVER (ORDER BY m ASC NULLS LAST, store_city ASC)
FROM (SELECT store_city, avg(bert_score) AS m FROM lab WHERE store_city IS NOT NULL GROUP BY 1) g
UNION ALL
SELECT 'lowest_scores', review_id, CAST(NULL AS DOUBLE), bert_score, row_number() OVER (ORDER BY bert_score ASC, review_id ASC)
FROM (SELECT * FROM lab ORDER BY bert_score ASC, review_id ASC LIMIT 5) l""", extra=_LAB)

UNKNOWN = with_reviews("SELECT s IS NOT NULL AS known FROM sc WHERE text IS NOT NULL", extra=_stars("reviews", "review_id"))
RUN_METRICS_APPEND = f"""SELECT kind, name, CASE WHEN name IN ('model_load_time_seconds', 'inference_time_seconds') THEN 1.0 ELSE value_num END AS value_num,
       value_str, 2 AS runs FROM ({RUN_METRICS}) r
UNION ALL
SELECT 'metric', name, CAST(v AS DOUBLE), CAST(NULL AS VARCHAR), 2
FROM (SELECT count(*) AS scored, count(*) FILTER (NOT known) AS failed FROM ({UNKNOWN}) t) a, LATERAL (VALUES ('scored_rows', scored), ('failed_rows', failed)) x(name, v)"""

SQL: dict[str, str] = {
    "lexicon_polarity": LEXICON,
    "lexicon_polarity_join": LEXICON,
    "enrich_reviews": ENRICH,
    "lexicon_large": ENRICH_BIG,
    "star_report": STAR_REPORT,
    "run_metrics_append": RUN_METRICS_APPEND,
    "star_sentiment": STAR,
    "cascade_classify": CASCADE,
    "zero_shot_fallback": ZERO_SHOT,
    "zero_shot_scores": ZERO_SHOT_SCORES,
    "run_metrics": RUN_METRICS,
    "insight_report": INSIGHT,
}
