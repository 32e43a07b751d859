"""Text models that Spark fits: star sentiment and zero-shot topics.

A model is a table of integer weights per word.  Fitting is one aggregate
over (text, distinct word) rows; scoring joins the words of each text with
the table and sums.  Neither needs a Python worker, and as the weights are
integers, sums do not depend on the partitioning.

* Stars (``fit_stars``): cumulative naive Bayes.  For each threshold t a
  word weighs the log odds of texts above t stars against the others, each
  side's count smoothed by its share of all texts (so that a rare word of the
  larger side does not speak for the smaller one); words whose counts chance
  explains weigh nothing.  A text gets one star plus one for each threshold
  whose sum is positive.
* Topics (``fit_topics``): a prototype per candidate label, the tf-idf
  centroid of the texts that the keyword cascade gave the label.  A text
  scores the cosine with every prototype.

All words of a text are in one task, so sums collapse to a row per text
before the shuffle.  The word table is joined without a hint: Spark
broadcasts it below its own byte threshold, and beyond that a frequent word
is split by the skew join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.functions.numeric import round_half_up, stars_label, stars_score
from reviewlake.operators.polarity import tokens
from reviewlake.session import scratch_path

THRESHOLDS = (1, 2, 3, 4)
MIN_TEXTS = 2            # a word seen in fewer labelled texts has no weight
SURPRISE = 20.0          # chi-square (chance: one word in 100,000) that a word needs to weigh at a threshold
SHARE = 1000             # a prototype knows a word by its share of texts, in thousandths


@dataclass(frozen=True)
class StarModel:
    words: DataFrame                 # word, weights array<long>, one for each threshold
    bias: tuple[int, ...]


@dataclass(frozen=True)
class TopicModel:
    words: DataFrame                 # word, weights array<long>: idf^2, then idf * prototype for each label
    norms: tuple[int, ...]           # squared length of each prototype
    labels: tuple[str, ...]


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rounded(x: Column, scale: int) -> Column:
    return F.floor(F.lit(float(scale)) * x + F.lit(0.5)).cast("long")


def fit_stars(rows: DataFrame, text_col: str = "text", stars_col: str = "stars", min_texts: int = MIN_TEXTS,
              surprise: float = SURPRISE) -> StarModel:
    """Fit on all rows with a text and 1 to 5 stars.

    A threshold with no text on one side has no word weights; its bias alone
    keeps every text on the other side."""
    seen = rows.where(F.col(stars_col).between(1, 5) & F.col(text_col).isNotNull()) \
               .select(F.col(stars_col).cast("int").alias("s"), F.array_distinct(tokens(F.col(text_col))).alias("words"))
    n = dict(seen.groupBy("s").count().collect())                       # at most five rows
    above = [sum(c for s, c in n.items() if s > t) for t in THRESHOLDS]
    below = [sum(n.values()) - a for a in above]
    counts = seen.select("s", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("s") > t).alias(f"a{t}") for t in THRESHOLDS])

    def weight(t: int, hi: int, lo: int) -> Column:
        if not hi or not lo:
            return F.lit(0).cast("long")
        a, b, n = F.col(f"a{t}").cast("double"), (F.col("n") - F.col(f"a{t}")).cast("double"), float(hi + lo)
        odds = F.log(((a * F.lit(n) + F.lit(float(hi))) * F.lit(float(lo))) / ((b * F.lit(n) + F.lit(float(lo))) * F.lit(float(hi))))
        apart = a * F.lit(n) - (a + b) * F.lit(float(hi))
        sure = apart * apart > F.lit(surprise) * (a + b) * F.lit(float(hi)) * F.lit(float(lo))       # chi-square of the word
        return F.when(sure, _rounded(odds, 1000)).otherwise(F.lit(0).cast("long"))

    words = counts.where(F.col("n") >= min_texts).select("word", F.array(*[weight(*x) for x in zip(THRESHOLDS, above, below)]).alias("weights"))
    bias = [math.floor(1000 * math.log((a + 1) / (b + 1)) + 0.5) if a and b else (1 if a else -1) for a, b in zip(above, below)]
    return StarModel(_kept(words, "star-words"), tuple(bias))


def fit_topics(rows: DataFrame, text_col: str = "text", category_col: str = "sport_category", labels: list[str] | None = None) -> TopicModel:
    """Fit prototypes on all rows with a text; a category that is no candidate
    label counts for ``"other"``, a null one only for the word frequencies.

    Words in less than a thousandth of every label's texts are left out, so
    the table has at most ``SHARE`` times the mean number of distinct words
    of a text for each label, however large the corpus is."""
    labels = list(labels or C.ZERO_SHOT_LABELS)
    label = F.when(F.col(category_col).isin(labels), F.col(category_col)).when(F.col(category_col).isNotNull(), F.lit(C.OTHER))
    seen = rows.where(F.col(text_col).isNotNull()).select(label.alias("label"), F.array_distinct(tokens(F.col(text_col))).alias("words"))
    seen = _kept(seen, "topic-texts")                                   # the categories are found once
    n = dict(seen.groupBy("label").count().collect())                   # a row per label
    total = sum(n.values())
    counts = seen.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == c).alias(f"c{k}") for k, c in enumerate(labels)])
    share = [F.floor(F.col(f"c{k}") * SHARE / F.lit(max(n.get(c, 0), 1))).cast("long") for k, c in enumerate(labels)]
    known = counts.withColumn("shares", F.array(*share)).where(F.exists("shares", lambda x: x > 0)) \
                  .withColumn("idf", _rounded(F.log(F.lit(float(total)) / F.col("n").cast("double")), 100))
    square = F.col("idf") * F.col("idf")
    words = _kept(known.select("word", F.concat(F.array(square), F.transform("shares", lambda s: s * square)).alias("weights"),
                               F.transform("shares", lambda s: s * s * square).alias("squares")), "topic-words")
    norms = words.agg(*[F.coalesce(F.sum(F.col("squares")[k]), F.lit(0)) for k in range(len(labels))]).first()   # one row
    return TopicModel(words.drop("squares"), tuple(norms), tuple(labels))


def _summed(df: DataFrame, text: Column, carry: list[str], words: DataFrame, n: int) -> DataFrame:
    """``carry`` (with a unique key) and per row ``_known`` words and sums ``_s0`` ..."""
    each = df.select(*carry, F.explode_outer(F.array_distinct(tokens(text))).alias("_word"))
    j = each.join(words.withColumnRenamed("word", "_known_word"), F.col("_word") == F.col("_known_word"), "left")
    return j.groupBy(*carry).agg(F.count("_known_word").alias("_known"),
                                 *[F.coalesce(F.sum(F.col("weights")[k]), F.lit(0)).alias(f"_s{k}") for k in range(n)])


def score_stars(df: DataFrame, model: StarModel, text_col: str = "text", carry: list[str] | None = None,
                stars_col: str = "stars") -> DataFrame:
    """``carry`` (default: all but the text; it must hold a unique key) with
    ``stars_col``, 1 to 5; null where the text is null or has no known word."""
    carry = list(carry) if carry is not None else [c for c in df.columns if c not in (text_col, stars_col)]
    s = _summed(df, F.col(text_col), carry, model.words, len(THRESHOLDS))
    stars = F.lit(1)
    for k, b in enumerate(model.bias):
        stars = stars + (F.col(f"_s{k}") + F.lit(b) > 0).cast("int")
    return s.select(*carry, F.when(F.col("_known") > 0, stars).alias(stars_col))


def star_labels(df: DataFrame, model: StarModel, text_col: str = "text", carry: list[str] | None = None,
                label_col: str = "bert_label", score_col: str = "bert_score") -> DataFrame:
    """Label and score of the stars; no answer gives neutral and 0.0."""
    return star_labels_of(score_stars(df, model, text_col, carry, "_stars"), "_stars", label_col, score_col).drop("_stars")


def star_labels_of(df: DataFrame, stars_col: str, label_col: str = "bert_label", score_col: str = "bert_score") -> DataFrame:
    stars = F.col(stars_col)
    return df.withColumn(label_col, F.when(stars.isNotNull(), stars_label(stars)).otherwise(F.lit("neutral"))) \
             .withColumn(score_col, F.when(stars.isNotNull(), stars_score(stars)).otherwise(F.lit(0.0)))


def score_topics(df: DataFrame, model: TopicModel, text: Column, carry: list[str], scores_col: str = "topic_scores") -> DataFrame:
    """``carry`` (with a unique key) and all labels with their cosine, best
    first (ties: the earlier candidate); null without a known word."""
    s = _summed(df, text, carry, model.words, 1 + len(model.labels))
    scored = []
    for k, (label, norm) in enumerate(zip(model.labels, model.norms)):
        length = F.sqrt(F.col("_s0").cast("double")) * F.lit(math.sqrt(float(norm)))
        cosine = F.when(length > 0, round_half_up(F.col(f"_s{k + 1}").cast("double") / length, 6)).otherwise(F.lit(0.0))
        scored.append(F.struct((-cosine).alias("low"), F.lit(k).alias("k"), F.lit(label).alias("label"), cosine.alias("score")))
    ranked = F.transform(F.array_sort(F.array(*scored)), lambda x: F.struct(x["label"].alias("label"), x["score"].alias("score")))
    return s.select(*carry, F.when(F.col("_known") > 0, ranked).alias(scores_col))


def best_topic(scores: Column) -> Column:
    """The best label, or ``"other"`` without an answer or likeness."""
    return F.when(scores[0]["score"] > 0, scores[0]["label"]).otherwise(F.lit(C.OTHER))
