"""Registered text-analytics queries: polarity, model scoring, cascade,
run metrics and the insight report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.operators import metrics as M
from reviewlake.operators.cascade import enrich, fill_topics
from reviewlake.operators.polarity import with_polarity
from reviewlake.operators.text_models import StarModel, fit_stars, fit_topics, score_topics, star_labels
from reviewlake.plans.lexicons import big_lexicon
from reviewlake.registry import register
from reviewlake.session import scratch_path
from reviewlake.sources.tables import classified_reviews, read_table, reviews, stage

RUN_ID = "run-0001"
LOGGED_AT = "2026-01-01 00:00:00"
MODEL_NAME = "cumulative-bayes"


def _documents(spark, sf) -> DataFrame:
    return read_table(spark, sf, "documents").select("doc_id", "text")


def star_model(spark, sf) -> StarModel:
    """Fitted on every labelled document: toxic ones have one star (two if
    their quality is good), the others three or five by quality."""
    labels = read_table(spark, sf, "labels").select("doc_id", F.when(F.col("toxic") == 1, 1 + F.col("quality")).otherwise(
        3 + 2 * F.col("quality")).alias("stars"))
    return fit_stars(_documents(spark, sf).join(labels, "doc_id"))


def topic_rows(spark, sf):
    """Reviews with the keyword cascade's answer (found once, staged), and
    prototypes fitted on all of them."""
    from reviewlake.operators.classify import with_keyword_category
    rows = reviews(spark, sf).select("review_id", "text")
    rows = stage(with_keyword_category(rows, "text", "sport_category", fill=None), "topic-rows")
    return rows, fit_topics(rows)


@register("lexicon_polarity")
def q_lexicon_polarity(spark, sf):
    """Lexicon polarity of every document's full text (inline lexicon)."""
    return with_polarity(_documents(spark, sf), "text").select("doc_id", "sentiment_score", "sentiment_label")


@register("lexicon_polarity_join")
def q_lexicon_polarity_join(spark, sf):
    """Same result through the join plan (lexicon given as a table)."""
    lex = spark.createDataFrame([(w, float(p)) for w, p in C.DEFAULT_LEXICON.items()], "word string, polarity double")
    return with_polarity(_documents(spark, sf), "text", lex, key="doc_id").select(
        "doc_id", "sentiment_score", "sentiment_label")


@register("enrich_reviews")
def q_enrich_reviews(spark, sf):
    return enrich(reviews(spark, sf).drop("sentiment_label", "sentiment_score"), "text").select(
        "review_id", "sentiment_score", "sentiment_label", "sport_category")


@register("lexicon_large")
def q_lexicon_large(spark, sf):
    """Enrichment with a dict lexicon of more than a thousand words."""
    return enrich(reviews(spark, sf).drop("sentiment_label", "sentiment_score"), "text", big_lexicon()).select(
        "review_id", "sentiment_score", "sentiment_label", "sport_category")


@register("star_report")
def q_star_report(spark, sf):
    """The star model's report over scored reviews (scored once, staged)."""
    scored = star_labels(reviews(spark, sf), star_model(spark, sf), carry=["review_id", "store_city", "language"])
    return M.star_report(stage(scored.withColumn("text", F.lit("")), "scored"))


@register("run_metrics_append")
def q_run_metrics_append(spark, sf):
    """Two scoring runs append to one metrics table; measured timings show as
    1 when they are there."""
    from reviewlake.plans.jobs import scoring_run
    base = scratch_path(spark, "runs")
    df, model = reviews(spark, sf).select("review_id", "text", "rating", "language", "source"), star_model(spark, sf)
    for run in ("run-0001", "run-0002"):
        scoring_run(df, "text", model, f"{base}/{run}", f"{base}/metrics", run, MODEL_NAME)
    m = spark.read.parquet(f"{base}/metrics")
    timing = F.col("name").isin("model_load_time_seconds", "inference_time_seconds")
    value = F.when(timing, (F.col("value_num") >= 0).cast("double")).otherwise(F.col("value_num"))
    return m.groupBy("kind", "name", value.alias("value_num"), "value_str").agg(F.countDistinct("run_id").alias("runs"))


@register("star_sentiment")
def q_star_sentiment(spark, sf):
    """Star model over every document's whole text."""
    return star_labels(_documents(spark, sf), star_model(spark, sf), carry=["doc_id"])


@register("cascade_classify")
def q_cascade_classify(spark, sf):
    """Keywords, then the topic model on the unclassified rows, then "other"."""
    rows, model = topic_rows(spark, sf)
    return fill_topics(rows, model, "text", "sport_category", ["review_id"])


@register("zero_shot_fallback")
def q_zero_shot_fallback(spark, sf):
    """Only the model branch: rows the keywords missed, with the model's topic."""
    rows, model = topic_rows(spark, sf)
    return fill_topics(rows.where(F.col("sport_category").isNull()), model, "text", "sport_category", ["review_id"])


@register("zero_shot_scores")
def q_zero_shot_scores(spark, sf):
    """All ten scores of the rows that the keywords missed, best first."""
    rows, model = topic_rows(spark, sf)
    scored = score_topics(rows.where(F.col("sport_category").isNull()), model, F.col("text"), ["review_id"])
    return scored.select("review_id", F.posexplode("topic_scores").alias("place", "s")).select("review_id", "place", "s.label", "s.score")


@register("run_metrics")
def q_run_metrics(spark, sf):
    scored = star_labels(reviews(spark, sf), star_model(spark, sf), carry=["review_id", "rating", "language", "source"])
    return M.run_metrics(scored, RUN_ID, logged_at=F.to_timestamp(F.lit(LOGGED_AT)), model_name=MODEL_NAME)


@register("insight_report")
def q_insight_report(spark, sf):
    return M.insight_report(classified_reviews(spark, sf))
