"""Topic cascade and enrichment chains.

``classify_cascade``: keywords first (native), then the model only on the
rows the keywords left unclassified, then ``"other"``.  It is one pass: rows
with a keyword hit send the model a null text, which is never scored, so the
input is read once and no union or join puts the rows together again.  The
model is a fitted ``TopicModel`` (Spark only) or a scorer factory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.operators.classify import with_keyword_category
from reviewlake.operators.model_scoring import Scorer, topic_of, with_model_answer
from reviewlake.operators.polarity import with_polarity
from reviewlake.operators.text_models import TopicModel, best_topic, score_topics


def classify_cascade(df: DataFrame, text_col: str = "text", out_col: str = "sport_category",
                     factory: Callable[[], Scorer] | None = None, use_model: bool = True,
                     carry: list[str] | None = None, topics: TopicModel | None = None) -> DataFrame:
    """``carry``: columns that pass through the model stage (default: all;
    with ``topics`` they must hold a unique key)."""
    k = with_keyword_category(df, text_col, out_col, fill=None)
    if not use_model or (factory is None and topics is None):
        return k.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(C.OTHER)))
    kept = [c for c in (carry or df.columns) if c != out_col]
    if topics is not None:
        return fill_topics(k, topics, text_col, out_col, kept)
    open_text = k.withColumn("_open", F.when(F.col(out_col).isNull(), F.col(text_col)))
    a = with_model_answer(open_text, "_open", factory, "__answer", carry=[*kept, out_col])
    return a.withColumn(out_col, F.coalesce(F.col(out_col), topic_of(F.col("__answer")))).drop("__answer")


def fill_topics(df: DataFrame, topics: TopicModel, text_col: str, out_col: str, carry: list[str]) -> DataFrame:
    """``carry`` and ``out_col``, a null one from the model's best topic."""
    open_text = F.when(F.col(out_col).isNull(), F.col(text_col))
    s = score_topics(df, topics, open_text, [*carry, out_col], "_scores")
    return s.select(*carry, F.coalesce(F.col(out_col), best_topic(F.col("_scores"))).alias(out_col))


ENRICHED = ("sentiment_label", "sentiment_score", "sport_category")


def enrich(df: DataFrame, text_col: str = "text", lexicon=None) -> DataFrame:
    """Polarity score + label, then keyword category (or ``"other"``)."""
    return (df.transform(lambda d: with_polarity(d, text_col, lexicon))
              .transform(lambda d: with_keyword_category(d, text_col, "sport_category", fill=C.OTHER)))
