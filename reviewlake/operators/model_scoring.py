"""Distributed model scoring with an injected scorer.

The scorer is built by a caller-supplied *factory* once per Python worker
process (not per batch, not per row) and is called on Arrow batches of
texts (``mapInPandas``).  Rows pass straight through the Python stage —
no shuffle and no join back — and everything after the model's raw
answer (parsing "4 stars", label / score mapping, fallbacks) is native
Spark.

A scorer is any callable ``list[str] -> list[str | None]``.  If it raises
on a batch, the batch is retried row by row; a row that still fails gets
``None`` (→ neutral / 0.0 for star models, ``"other"`` for topics) and is
counted.  A task in which the scorer fails on every one of at least
``BROKEN_ROWS`` rows fails the job: that model is broken, not its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from reviewlake import config as C
from reviewlake.functions.numeric import stars_label, stars_score
from reviewlake.functions.text import leading_int

Scorer = Callable[[list[str]], list]
_CACHE: dict[str, Scorer] = {}   # per Python worker process (workers are reused across tasks)
_IN = "__model_input"
_FAILED = "__model_failed"
BROKEN_ROWS = 20


def factory_id(factory: Callable[[], Scorer]) -> str:
    """Identity of a factory: a digest of its pickled form, which holds the
    values it closes over.  Two closures of one builder differ."""
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def _scorer(factory: Callable[[], Scorer], key: str) -> Scorer:
    s = _CACHE.get(key)
    if s is None:
        s = factory()
        _CACHE[key] = s
    return s


def _safe_call(scorer: Scorer, texts: list[str]) -> tuple[list, list[bool]]:
    """(answers, whether the scorer failed on the row)."""
    try:
        out = list(scorer(texts))
        if len(out) == len(texts):
            return out, [False] * len(texts)
    except Exception:  # noqa: BLE001 — failure is per row by contract
        pass
    res, failed = [], []
    for t in texts:
        try:
            res.append(scorer([t])[0])
            failed.append(False)
        except Exception:  # noqa: BLE001
            res.append(None)
            failed.append(True)
    return res, failed


def with_model_answer(df: DataFrame, text_col: str, factory: Callable[[], Scorer],
                      out_col: str = "model_answer", max_chars: int | None = None,
                      batch_rows: int = 256, carry: list[str] | None = None,
                      failures: Observation | None = None) -> DataFrame:
    """Add ``out_col``: the scorer's raw answer for ``text_col``.

    Whole texts are sent; ``max_chars`` cuts them for a model with an input
    limit.  Null texts are not sent (answer null).  ``carry`` lists the
    columns passed through the Python stage (default: all).  Catalyst cannot
    prune columns through it, so pass only what is needed downstream.
    ``failures`` observes ``scored`` and ``failed`` row counts."""
    from reviewlake.session import ship_package
    ship_package(df.sparkSession)
    kept = list(carry) if carry is not None else [c for c in df.columns if c != out_col]
    text = F.col(text_col) if max_chars is None else F.substring(F.col(text_col), 1, max_chars)
    src = df.select(*kept, text.alias(_IN))
    schema = StructType([df.schema[c] for c in kept] + [StructField(out_col, StringType(), True), StructField(_FAILED, BooleanType(), True)])
    key = factory_id(factory)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, scored, bad = _scorer(factory, key), 0, 0
        for pdf in batches:
            texts = pdf[_IN]
            ans: list = [None] * len(pdf)
            failed: list = [None] * len(pdf)
            idx = [i for i, t in enumerate(texts) if t is not None]
            for s in range(0, len(idx), batch_rows):
                chunk = idx[s:s + batch_rows]
                for i, a, f in zip(chunk, *_safe_call(scorer, [texts.iloc[i] for i in chunk])):
                    ans[i] = None if a is None else str(a)
                    failed[i] = f
                    bad += f
            scored += len(idx)
            out = pdf[kept].copy()
            out[out_col] = ans
            out[_FAILED] = pd.array(failed, dtype="boolean")
            yield out
        if bad == scored >= BROKEN_ROWS:
            raise RuntimeError(f"the scorer failed on all {scored} rows of a task")

    out = src.mapInPandas(run, schema=schema)
    if failures is not None:
        out = out.observe(failures, F.count(_FAILED).alias("scored"), F.count_if(F.col(_FAILED)).alias("failed"))
    return out.drop(_FAILED)


def star_sentiment(df: DataFrame, text_col: str, factory: Callable[[], Scorer],
                   label_col: str = "bert_label", score_col: str = "bert_score",
                   carry: list[str] | None = None, max_chars: int | None = None,
                   failures: Observation | None = None) -> DataFrame:
    """Star-model sentiment: answer "N stars" (N in 1..5) → label (>= 4
    positive, <= 2 negative, else neutral) and score (N-3)/2; no usable
    answer → neutral / 0.0."""
    a = with_model_answer(df, text_col, factory, "__answer", max_chars, carry=carry, failures=failures)
    stars = leading_int(F.col("__answer"))
    ok = stars.between(1, 5)
    return (a.withColumn(label_col, F.when(ok, stars_label(stars)).otherwise(F.lit("neutral")))
             .withColumn(score_col, F.when(ok, stars_score(stars)).otherwise(F.lit(0.0)))
             .drop("__answer"))


def topic_of(answer: Column, labels: list[str] | None = None) -> Column:
    """The answer if it is a candidate label, else ``"other"``."""
    return F.when(answer.isin(labels or C.ZERO_SHOT_LABELS), answer).otherwise(F.lit(C.OTHER))


def zero_shot_topic(df: DataFrame, text_col: str, factory: Callable[[], Scorer],
                    out_col: str = "sport_category", labels: list[str] | None = None,
                    carry: list[str] | None = None) -> DataFrame:
    """Top candidate label per row; an answer outside the candidates, or
    none, gives ``"other"``."""
    a = with_model_answer(df, text_col, factory, "__answer", carry=carry)
    return a.withColumn(out_col, topic_of(F.col("__answer"), labels)).drop("__answer")
