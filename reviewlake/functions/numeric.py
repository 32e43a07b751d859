"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake import config as C


def round_half_up(col: Column, scale: int) -> Column:
    """Round half up on the decimal value (as SQL ``ROUND(x::numeric, n)``).

    The value goes through ``decimal(38,10)`` first so that 1.005 rounds to
    1.01 in every engine, independent of the binary representation.
    Returns double.
    """
    return F.round(col.cast("decimal(38,10)"), scale).cast("double")


def exact_mean(col: Column) -> Column:
    """Mean of the non-null values (aggregate): exact decimal sum over count,
    null for none.  Values are taken to six decimals."""
    return F.try_divide(F.sum(col.cast("decimal(20,6)")).cast("double"), F.count(col).cast("double"))


def clamp(col: Column, lo: float, hi: float) -> Column:
    """``max(lo, min(hi, x))``; null stays null."""
    return F.when(col.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), col)))


def ceil_div(a: Column, b: Column | int) -> Column:
    """Integer ``(a + b - 1) // b`` for non-negative a and positive b."""
    b = F.lit(b) if isinstance(b, int) else b
    return F.floor((a + b - F.lit(1)) / b).cast("long")


def pct(part: Column, total: Column, scale: int = 1) -> Column:
    """``round(part / total * 100, scale)``; 0 when total is 0 or null."""
    return F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        round_half_up(part.cast("double") / total.cast("double") * F.lit(100.0), scale))


def vote_to_rating(score: Column) -> Column:
    """Forum vote score → 1..5 rating."""
    expr = None
    for threshold, rating in C.VOTE_RATING_STEPS:
        expr = (F.when(score > threshold, F.lit(rating)) if expr is None
                else expr.when(score > threshold, F.lit(rating)))
    return expr.otherwise(F.lit(C.VOTE_RATING_FLOOR))


def polarity_label(score: Column) -> Column:
    """> 0.1 positive, < -0.1 negative, otherwise (incl. null) neutral."""
    return (F.when(score > C.POLARITY_POSITIVE_ABOVE, F.lit("positive"))
            .when(score < C.POLARITY_NEGATIVE_BELOW, F.lit("negative"))
            .otherwise(F.lit("neutral")))


def stars_label(stars: Column) -> Column:
    """1..5 stars → label: >= 4 positive, <= 2 negative, else neutral."""
    return (F.when(stars >= 4, F.lit("positive"))
            .when(stars <= 2, F.lit("negative"))
            .otherwise(F.lit("neutral")))


def stars_score(stars: Column) -> Column:
    """1..5 stars → score in [-1, 1]: (stars - 3) / 2, 3 decimals."""
    return round_half_up((stars.cast("double") - F.lit(3.0)) / F.lit(2.0), 3)


def rating_band(avg: Column) -> Column:
    """Mean rating → colour: < 2.5 red, < 3.5 amber, else (incl. null) green."""
    return (F.when(avg < C.BAND_RED_BELOW, F.lit(C.COLOR_RED))
            .when(avg < C.BAND_AMBER_BELOW, F.lit(C.COLOR_AMBER))
            .otherwise(F.lit(C.COLOR_GREEN)))


def length_category(length: Column) -> Column:
    """< 50 short, < 200 medium, else long (a null length gives long)."""
    return (F.when(length < C.LENGTH_SHORT_BELOW, F.lit("short"))
            .when(length < C.LENGTH_MEDIUM_BELOW, F.lit("medium"))
            .otherwise(F.lit("long")))
