"""Schemas of the review data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# Canonical review record produced by every source normaliser.  ``date`` and
# ``collected_at`` stay text in flight (sources disagree on formats) and are
# parsed when stored.
REVIEW = StructType([
    StructField("review_id", StringType(), False),
    StructField("source", StringType(), True),
    StructField("store_id", StringType(), True),
    StructField("store_name", StringType(), True),
    StructField("store_city", StringType(), True),
    StructField("rating", DoubleType(), True),
    StructField("text", StringType(), True),
    StructField("language", StringType(), True),
    StructField("date", StringType(), True),
    StructField("sport_category", StringType(), True),
    StructField("collected_at", StringType(), True),
])

SENTIMENT_FIELDS = [
    StructField("sentiment_label", StringType(), True),
    StructField("sentiment_score", DoubleType(), True),
]
MODEL_FIELDS = [
    StructField("bert_label", StringType(), True),
    StructField("bert_score", DoubleType(), True),
]
ENRICHED_REVIEW = StructType(REVIEW.fields + SENTIMENT_FIELDS)

# Keyed review table (primary key review_id).
STORED_REVIEW = StructType([
    StructField("review_id", StringType(), False),
    StructField("source", StringType(), True),
    StructField("store_id", StringType(), True),
    StructField("store_name", StringType(), True),
    StructField("store_city", StringType(), True),
    StructField("rating", DecimalType(3, 1), True),
    StructField("review_text", StringType(), True),
    StructField("language", StringType(), True),
    StructField("review_date", TimestampType(), True),
    StructField("sport_category", StringType(), True),
    StructField("sentiment_label", StringType(), True),
    StructField("sentiment_score", DecimalType(5, 3), True),
    StructField("collected_at", TimestampType(), True),
    StructField("ingested_at", TimestampType(), True),
])
STORED_COLUMNS = [f.name for f in STORED_REVIEW.fields]

# Topic envelope (what a Kafka source yields / a Kafka sink takes).
TOPIC_RECORD = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])

# ---------------------------------------------------------------------------
# Raw payload schemas (landed as one JSON / HTML text per row).
# ---------------------------------------------------------------------------
_LABEL = StructType([StructField("label", StringType(), True)])
FEED_PAYLOAD = StructType([StructField("feed", StructType([
    StructField("entry", ArrayType(StructType([
        StructField("id", _LABEL, True),
        StructField("im:rating", _LABEL, True),
        StructField("title", _LABEL, True),
        StructField("content", _LABEL, True),
        StructField("updated", _LABEL, True),
    ])), True),
]), True)])

PLAY_REVIEW = StructType([
    StructField("reviewId", StringType(), True),
    StructField("score", StringType(), True),
    StructField("content", StringType(), True),
    StructField("at", StringType(), True),
])

LISTING_PAYLOAD = StructType([StructField("data", StructType([
    StructField("children", ArrayType(StructType([
        StructField("data", StructType([
            StructField("id", StringType(), True),
            StructField("selftext", StringType(), True),
            StructField("title", StringType(), True),
            StructField("score", StringType(), True),
            StructField("created_utc", StringType(), True),
        ]), True),
    ])), True),
]), True)])

# JSON-LD of pages is decoded in two steps, so that one odd item does not
# take its block with it: nested values stay JSON text until their item is
# decoded.
REVIEW_PAGE_LD = StructType([StructField("review", StringType(), True)])
REVIEW_ITEM = StructType([
    StructField("reviewRating", StringType(), True),
    StructField("description", StringType(), True),
    StructField("datePublished", StringType(), True),
    StructField("author", StringType(), True),
])
PRODUCT_PAGE_LD = StructType([
    StructField("@type", StringType(), True),
    StructField("itemListElement", StringType(), True),
])
PRODUCT_ITEM = StructType([
    StructField("url", StringType(), True),
    StructField("name", StringType(), True),
    StructField("item", StructType([
        StructField("review", StringType(), True),
        StructField("@id", StringType(), True),
        StructField("url", StringType(), True),
        StructField("sku", StringType(), True),
        StructField("name", StringType(), True),
    ]), True),
])
PRODUCT_REVIEW = StructType([
    StructField("reviewBody", StringType(), True),
    StructField("reviewRating", StringType(), True),
    StructField("datePublished", StringType(), True),
    StructField("author", StringType(), True),
])

# Run metrics in long form.
RUN_METRICS = StructType([
    StructField("run_id", StringType(), False),
    StructField("kind", StringType(), False),
    StructField("name", StringType(), False),
    StructField("value_num", DoubleType(), True),
    StructField("value_str", StringType(), True),
    StructField("logged_at", TimestampType(), True),
])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns in order; missing ones become typed nulls."""
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
