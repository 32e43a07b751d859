"""Row filters.  All are plain predicates, pushed into the scan by Catalyst
where the column comes straight from a parquet file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_length(df: DataFrame, col: str, n: int) -> DataFrame:
    """Keep rows whose text has at least ``n`` code points (null is dropped)."""
    return df.where(F.length(F.col(col)) >= n)


def dashboard_predicate(sources: Sequence[str] | None = None,
                        languages: Sequence[str] | None = None,
                        sentiments: Sequence[str] | None = None,
                        rating_range: tuple[float, float] | None = None) -> Column:
    """Conjunction of IN lists and an inclusive rating range.

    ``None`` means "no constraint on that column".  A given list drops
    rows whose value is null (as ``isin`` does), and the range drops null
    ratings: a null comparison is "not selected" both in ``where`` and in
    the conditional aggregates (``count_if`` / ``when``) that ``kpis`` uses.
    The terms are plain ``IN`` / range comparisons so the parquet reader
    receives them as pushed filters.
    """
    pred = F.lit(True)
    if sources is not None:
        pred = pred & F.col("source").isin(list(sources))
    if languages is not None:
        pred = pred & F.col("language").isin(list(languages))
    if sentiments is not None:
        pred = pred & F.col("sentiment_label").isin(list(sentiments))
    if rating_range is not None:
        lo, hi = rating_range
        pred = pred & F.col("rating").between(float(lo), float(hi))
    return pred


def dashboard_filter(df: DataFrame, **kw) -> DataFrame:
    return df.where(dashboard_predicate(**kw))


def label_equals(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """``df[df[col] == value]``; the value ``"All"`` (or None) bypasses."""
    if value is None or value == "All":
        return df
    return df.where(F.col(col) == F.lit(value))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def is_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def has_column(df: DataFrame, name: str) -> bool:
    """Plan-time column-presence test (no job)."""
    return name in df.columns
