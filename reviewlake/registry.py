"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (through the ``reviews`` adapter or
directly) so its work grows with the data.  The matching SQL oracle for
every key lives in ``reviewlake.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators import filters as FL
from reviewlake.operators import metrics as M
from reviewlake.operators.classify import with_keyword_category
from reviewlake.sources.tables import classified_reviews, read_table, reviews

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    # importing the modules that register more queries
    from reviewlake.plans import queries_io, queries_more, queries_text  # noqa: F401
    return dict(_REGISTRY)


# Dashboard filter used by the filtered queries (fixed parameters).
DASH = dict(languages=["en", "fr", "es"], sentiments=["positive", "neutral", "negative"],
            rating_range=(2.0, 4.5))


# -------------------------------------------------------------------- flagship
@register("rating_by_category")
def q_rating_by_category(spark, sf):
    return M.rating_by_category(classified_reviews(spark, sf))


# ------------------------------------------------------------- load checks
@register("verify_total")
def q_verify_total(spark, sf):
    return M.verify_total(reviews(spark, sf))


@register("verify_avg_rating")
def q_verify_avg_rating(spark, sf):
    return M.verify_avg_rating(reviews(spark, sf))


@register("verify_by_sentiment")
def q_verify_by_sentiment(spark, sf):
    return M.verify_by_sentiment(reviews(spark, sf))


@register("verify_by_city")
def q_verify_by_city(spark, sf):
    return M.verify_by_city(reviews(spark, sf))


# ----------------------------------------------------------------- KPIs etc.
@register("kpis")
def q_kpis(spark, sf):
    return M.kpis(reviews(spark, sf), FL.dashboard_predicate(**DASH))


@register("kpis_unfiltered")
def q_kpis_unfiltered(spark, sf):
    return M.kpis(reviews(spark, sf))


@register("label_distribution")
def q_label_distribution(spark, sf):
    return M.label_distribution(reviews(spark, sf), "sentiment_label", "all")


@register("sentiment_pie")
def q_sentiment_pie(spark, sf):
    return M.label_distribution(reviews(spark, sf), "sentiment_label", "non_null")


@register("category_distribution")
def q_category_distribution(spark, sf):
    return M.label_distribution(classified_reviews(spark, sf), "sport_category", "all")


@register("category_rating_bars")
def q_category_rating_bars(spark, sf):
    return M.category_rating_bars(classified_reviews(spark, sf))


@register("sentiment_by_city")
def q_sentiment_by_city(spark, sf):
    return M.sentiment_by_city(reviews(spark, sf))


@register("negatives_by_category")
def q_negatives_by_category(spark, sf):
    return M.negatives_by_category(classified_reviews(spark, sf))


@register("top3_negative_categories")
def q_top3_negative_categories(spark, sf):
    return M.top_negative_categories(classified_reviews(spark, sf), 3)


@register("rating_trend")
def q_rating_trend(spark, sf):
    return M.rating_trend(reviews(spark, sf))


@register("insight_worst_category")
def q_insight_worst_category(spark, sf):
    # a filtered view, so the "< 3.0" condition is exercised both ways
    return M.insight_worst_category(FL.dashboard_filter(classified_reviews(spark, sf), **DASH))


@register("insight_best_category")
def q_insight_best_category(spark, sf):
    return M.insight_best_category(classified_reviews(spark, sf))


@register("insight_negative_city")
def q_insight_negative_city(spark, sf):
    return M.insight_negative_city(reviews(spark, sf))


@register("insight_low_language")
def q_insight_low_language(spark, sf):
    return M.insight_low_language(reviews(spark, sf))


@register("score_by_city")
def q_score_by_city(spark, sf):
    return M.score_by_city(reviews(spark, sf), "sentiment_score")


@register("filter_options")
def q_filter_options(spark, sf):
    return M.filter_options(reviews(spark, sf))


@register("rating_bounds")
def q_rating_bounds(spark, sf):
    return M.rating_bounds(reviews(spark, sf))


@register("source_counts")
def q_source_counts(spark, sf):
    return M.source_counts(reviews(spark, sf), by_city=True)


# ------------------------------------------------------------------ filters
@register("dashboard_filter")
def q_dashboard_filter(spark, sf):
    return FL.dashboard_filter(reviews(spark, sf), **DASH).select(
        "review_id", "source", "language", "sentiment_label", "rating")


@register("label_subset")
def q_label_subset(spark, sf):
    return FL.label_equals(reviews(spark, sf), "sentiment_label", "negative").select(
        "review_id", "store_city", "sentiment_label")


@register("dated_reviews")
def q_dated_reviews(spark, sf):
    from reviewlake.functions.timefn import month
    return FL.not_null(reviews(spark, sf), "date").select("review_id", "date", month(F.col("date")).alias("month"))


@register("keyword_category")
def q_keyword_category(spark, sf):
    df = with_keyword_category(reviews(spark, sf), "text", "raw_category", fill=None)
    return df.select("review_id", "text", "raw_category",
                     F.coalesce("raw_category", F.lit("other")).alias("sport_category"))


@register("unclassified_rows")
def q_unclassified_rows(spark, sf):
    df = with_keyword_category(reviews(spark, sf), "text", "sport_category", fill=None)
    return FL.is_null(df, "sport_category").select("review_id", "text")


@register("classified_counts")
def q_classified_counts(spark, sf):
    df = with_keyword_category(reviews(spark, sf), "text", "sport_category", fill=None)
    return M.classified_counts(df)


@register("keyword_category_documents")
def q_keyword_category_documents(spark, sf):
    """Keyword cascade over the full text of every document, counted per category."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    d = with_keyword_category(d, "text", "sport_category", fill="other")
    return d.groupBy("sport_category").agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- explorer
@register("explorer_page_recent")
def q_explorer_page_recent(spark, sf):
    return M.explorer_page(reviews(spark, sf), "All", "Most Recent", page=2, per_page=20)


@register("explorer_page_low")
def q_explorer_page_low(spark, sf):
    return M.explorer_page(reviews(spark, sf), "negative", "Lowest Rating", page=1, per_page=50)


@register("explorer_page_high")
def q_explorer_page_high(spark, sf):
    return M.explorer_page(reviews(spark, sf), "positive", "Highest Rating", page=3, per_page=10)


@register("explorer_summary")
def q_explorer_summary(spark, sf):
    return M.explorer_summary(reviews(spark, sf), "negative", per_page=20)


@register("lowest_scores")
def q_lowest_scores(spark, sf):
    return M.lowest_scores(reviews(spark, sf), 5, "sentiment_score", 60)


@register("verify_by_city_sql")
def q_verify_by_city_sql(spark, sf):
    """The per-city check written as SQL text over a temp view."""
    return M.verify_sql(reviews(spark, sf))["by_city"]
