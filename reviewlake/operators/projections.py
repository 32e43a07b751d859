"""Projections: derived columns, sentiment-column policy, storage layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.functions.numeric import length_category
from reviewlake.functions.text import preview
from reviewlake.functions.timefn import parse_ts


def with_text_features(df: DataFrame, text_col: str = "review_text") -> DataFrame:
    """``review_length``, ``review_text_lower``, ``length_category``."""
    t = F.col(text_col)
    return (df.withColumn("review_length", F.length(t))
              .withColumn("review_text_lower", F.lower(t))
              .withColumn("length_category", length_category(F.col("review_length"))))


def apply_sentiment_policy(df: DataFrame, policy: str = "fill") -> DataFrame:
    """Choose between lexicon sentiment and model sentiment columns.

    * ``fill``: model columns are copied into ``sentiment_label`` /
      ``sentiment_score`` only when those columns are absent;
    * ``override``: model columns, when present, always replace them.

    The decision is per column and made at plan time; missing sentiment
    columns are then added as typed nulls.
    """
    if policy not in ("fill", "override"):
        raise ValueError(f"unknown policy {policy!r}")
    pairs = [("bert_label", "sentiment_label", "string"), ("bert_score", "sentiment_score", "double")]
    for src, dst, _ in pairs:
        if src in df.columns and (policy == "override" or dst not in df.columns):
            df = df.withColumn(dst, F.col(src))
    return add_missing(df, {dst: t for _, dst, t in pairs})


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add each absent column as a typed null."""
    for name, dtype in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(dtype))
    return df


def to_stored(df: DataFrame, ingested_at=None) -> DataFrame:
    """Review rows → the keyed storage layout (13 columns + ingested_at).

    ``text`` → ``review_text``, ``date`` → ``review_date``; rating and score
    are cast to ``decimal(3,1)`` / ``decimal(5,3)`` with ``try_cast`` (an
    overflow gives null — see ``split_rejects`` to route such rows).
    """
    df = add_missing(df, {"source": "string", "store_id": "string", "store_name": "string",
                          "store_city": "string", "rating": "double", "text": "string",
                          "language": "string", "date": "string", "sport_category": "string",
                          "sentiment_label": "string", "sentiment_score": "double",
                          "collected_at": "string"})
    ts = F.current_timestamp() if ingested_at is None else ingested_at
    return df.select(
        F.col("review_id").cast("string"),
        F.col("source").cast("string"),
        F.col("store_id").cast("string"),
        F.col("store_name").cast("string"),
        F.col("store_city").cast("string"),
        F.col("rating").try_cast("decimal(3,1)").alias("rating"),
        F.col("text").cast("string").alias("review_text"),
        F.col("language").cast("string"),
        _as_ts(F.col("date")).alias("review_date"),
        F.col("sport_category").cast("string"),
        F.col("sentiment_label").cast("string"),
        F.col("sentiment_score").try_cast("decimal(5,3)").alias("sentiment_score"),
        _as_ts(F.col("collected_at")).alias("collected_at"),
        ts.cast("timestamp").alias("ingested_at"),
    )


def _as_ts(c):
    return parse_ts(c)


def unfit_numbers(df: DataFrame) -> Column:
    """Whether a row's rating or score does not fit the stored decimals."""
    score = F.col("sentiment_score") if "sentiment_score" in df.columns else F.lit(None)
    return ((F.col("rating").isNotNull() & F.col("rating").try_cast("decimal(3,1)").isNull())
            | (score.isNotNull() & score.try_cast("decimal(5,3)").isNull()))


def split_rejects(df: DataFrame, ingested_at=None) -> tuple[DataFrame, DataFrame]:
    """Store ``df`` and route rows whose numbers do not fit the stored
    decimals (overflow, non-numeric) to a reject frame instead of failing.

    One projection, no join: the flag compares the raw value with its
    ``try_cast``.  Returns ``(stored_rows, rejected_raw_rows)``.
    """
    flagged = df.withColumn("_reject", unfit_numbers(df))
    good = to_stored(flagged.where(~F.col("_reject")), ingested_at)
    rejects = flagged.where(F.col("_reject")).drop("_reject")
    return good, rejects


def explorer_display(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Explorer columns renamed for display, plus the sentiment colour."""
    colors = F.create_map(*[x for k, v in C.SENTIMENT_COLORS.items() for x in (F.lit(k), F.lit(v))])
    return df.select(
        *(keep or []),
        F.col("store_city").alias("Location"),
        F.col("language").alias("Lang"),
        F.col("rating").alias("Rating"),
        F.col("sentiment_label").alias("Sentiment"),
        F.col("text").alias("Review"),
        F.coalesce(colors[F.col("sentiment_label")], F.lit(C.COLOR_DEFAULT)).alias("sentiment_color"),
    )


def with_preview(df: DataFrame, text_col: str = "text", n: int = 60, out: str = "preview") -> DataFrame:
    return df.withColumn(out, preview(F.col(text_col), n))
