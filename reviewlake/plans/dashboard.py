"""The dashboard's page as Spark work: one filtered frame, every panel.

``dashboard`` filters once and persists the few columns that the charts and
insights read (memory, spilling to disk), as a dozen panels share them.  The
explorer page reads its own rows with the wide text.  The caller releases
the cache with ``release`` when the page is done.  The unfiltered frame is
only scanned for the KPI row's full-set total, inside the same single
aggregation (no join).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from reviewlake.operators import metrics as M
from reviewlake.operators.filters import dashboard_predicate


PANEL_COLUMNS = ("review_id", "store_city", "rating", "language", "date", "sport_category", "sentiment_label", "sentiment_score")


def dashboard(df_full: DataFrame, sources=None, languages=None, sentiments=None, rating_range=None,
              explorer_sentiment: str = "All", explorer_sort: str = "Most Recent", page: int = 1,
              per_page: int = 20) -> dict[str, DataFrame]:
    pred = dashboard_predicate(sources, languages, sentiments, rating_range)
    rows = df_full.where(pred)
    df = rows.select(*[c for c in PANEL_COLUMNS if c in df_full.columns]).persist(StorageLevel.MEMORY_AND_DISK)
    return {
        "_filtered": df,
        "kpis": M.kpis(df_full, pred),
        "insight_worst_category": M.insight_worst_category(df),
        "insight_best_category": M.insight_best_category(df),
        "insight_negative_city": M.insight_negative_city(df),
        "insight_low_language": M.insight_low_language(df),
        "rating_by_category": M.rating_by_category(df),
        "sentiment_distribution": M.label_distribution(df, "sentiment_label", "non_null"),
        "sentiment_by_city": M.sentiment_by_city(df),
        "negatives_by_category": M.negatives_by_category(df),
        "rating_trend": M.rating_trend(df),
        "explorer_page": M.explorer_page(rows, explorer_sentiment, explorer_sort, page, per_page),
        "explorer_summary": M.explorer_summary(df, explorer_sentiment, per_page),
        "filter_options": M.filter_options(df_full),
        "rating_bounds": M.rating_bounds(df_full),
    }


def release(panels: dict[str, DataFrame]) -> None:
    panels["_filtered"].unpersist()


def load_data(spark, paths, multiline: bool = True) -> DataFrame:
    """The dashboard's data: the first review file that exists in ``paths``
    (priority order), model sentiment overriding lexicon sentiment where the
    file has it, dates parsed row by row (bad → null).  No file → empty frame."""
    from pyspark.sql import functions as F

    from reviewlake.functions.timefn import parse_ts
    from reviewlake.plans.jobs import load_reviews
    from reviewlake.schema import ENRICHED_REVIEW
    from reviewlake.sinks.files import first_available
    _, df = first_available(spark, paths, lambda s, p: load_reviews(s, p, "override", multiline), empty_schema=ENRICHED_REVIEW)
    return df.withColumn("date", parse_ts(F.col("date")))
