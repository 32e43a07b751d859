"""Lexicon polarity: mean word polarity per text → score (3 dp) and label.

Tokens are runs of letters of the lower-cased text.  The score is the mean
polarity over the tokens found in the lexicon (each occurrence counts); a
text with no lexicon token — or a null text — scores 0.0 / neutral.

A lexicon is given in one of two forms, and the form decides the plan:

* a ``dict`` of any size: its entries are nested map literals by first letters,
  looked up over the token array inside one projection — no shuffle, no
  join, no key column;
* a ``DataFrame`` (a lexicon that lives in a table): tokens are counted per
  text and word, joined with the lexicon on the word, summed per text and
  joined back by ``key``.  Counting first makes a frequent word one row per
  text.

Words that differ only in case are one word; its polarity is their mean.
Sums are exact (decimal), so the result does not depend on the order in
which partial sums are combined.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.functions.numeric import polarity_label, round_half_up

TOKEN_SPLIT = r"[^\p{L}]+"
_SUM_T = "decimal(20,6)"


def tokens(text: Column) -> Column:
    """Letter-run tokens of the lower-cased text (no empty tokens)."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != F.lit(""))


def _mean(total: Column, hits: Column) -> Column:
    """Unrounded mean polarity (0.0 without hits); the label is taken from it."""
    return F.when(hits > 0, total.cast("double") / hits.cast("double")).otherwise(F.lit(0.0))


def _finish(df: DataFrame, mean_col: str, score_col: str, label_col: str) -> DataFrame:
    return (df.withColumn(label_col, polarity_label(F.col(mean_col)))
              .withColumn(score_col, round_half_up(F.col(mean_col), 3))
              .drop(mean_col))


def _lookup(lexicon: dict[str, float]):
    """Token → polarity (null if absent).  A map literal is searched from its
    start, so the words are shelved by their first letter, then by their
    first two."""
    words: dict[str, list[Decimal]] = {}
    for w, p in lexicon.items():
        words.setdefault(w.lower(), []).append(Decimal(str(p)))
    shelves: dict[str, dict[str, list[Column]]] = {}
    for w, ps in words.items():
        shelves.setdefault(w[:1], {}).setdefault(w[:2], []).extend((F.lit(w), F.lit(str(sum(ps) / len(ps))).cast(_SUM_T)))
    if not shelves:
        return lambda t: F.lit(None).cast(_SUM_T)
    shelf = F.create_map(*[x for one, two in shelves.items() for x in (
        F.lit(one), F.create_map(*[y for k, pairs in two.items() for y in (F.lit(k), F.create_map(*pairs))]))])
    return lambda t: shelf[F.substring(t, 1, 1)][F.substring(t, 1, 2)][t]


def with_polarity(df: DataFrame, text_col: str = "text", lexicon: dict[str, float] | DataFrame | None = None,
                  key: str | None = None, score_col: str = "sentiment_score",
                  label_col: str = "sentiment_label") -> DataFrame:
    """Add ``score_col`` / ``label_col`` from the lexicon polarity of ``text_col``.

    ``key`` (a unique column) is required for a ``DataFrame`` lexicon.
    """
    lexicon = C.DEFAULT_LEXICON if lexicon is None else lexicon
    if isinstance(lexicon, dict):
        vals = F.filter(F.transform(tokens(F.col(text_col)), _lookup(lexicon)), lambda v: v.isNotNull())
        total = F.aggregate(F.col("_vals"), F.lit(0).cast(_SUM_T), lambda acc, v: (acc + v).cast(_SUM_T))
        # the hit list is projected once, then summed and counted
        d = df.withColumn("_vals", vals).withColumn("_mean", _mean(total, F.size("_vals"))).drop("_vals")
        return _finish(d, "_mean", score_col, label_col)
    if key is None:
        raise ValueError("a DataFrame lexicon needs a unique key column")
    lex = lexicon.groupBy(F.lower(F.col("word")).alias("_w")).agg(F.avg(F.col("polarity").cast(_SUM_T)).cast(_SUM_T).alias("_p"))
    toks = df.select(F.col(key).alias("_k"), F.explode(tokens(F.col(text_col))).alias("_w"))
    counted = toks.groupBy("_k", "_w").agg(F.count(F.lit(1)).alias("_c"))
    per = (counted.join(lex, "_w").groupBy("_k")
                  .agg(F.sum((F.col("_p") * F.col("_c")).cast(_SUM_T)).alias("_t"), F.sum("_c").alias("_n")))
    out = df.join(per, df[key] == per["_k"], "left")
    out = out.withColumn("_mean", _mean(F.coalesce(F.col("_t"), F.lit(0).cast(_SUM_T)),
                                        F.coalesce(F.col("_n"), F.lit(0))))
    return _finish(out, "_mean", score_col, label_col).drop("_k", "_t", "_n")
