"""Seeded synthetic reviews (one per input row).

Every random draw is a hash of (seed, draw number, row key) mapped to
[0, 1), so a row's review does not depend on partitioning, retries or
the order rows arrive in.  Templates, cities and weights are our own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.numeric import clamp, round_half_up
from reviewlake.functions.text import pick, zero_pad

# (text, base rating, category) — own wording.
TEMPLATES: list[tuple[str, float, str]] = [
    ("Great running shoes, light on long runs", 4.6, "running"),
    ("The sole wore out after two months of jogging", 2.1, "running"),
    ("Solid road bike for the price", 4.3, "cycling"),
    ("Brakes squeak on every ride", 2.0, "cycling"),
    ("Dumbbells arrived fast and feel sturdy", 4.5, "fitness"),
    ("The gym mat tore in a week", 1.8, "fitness"),
    ("Warm tent, survived a windy night", 4.7, "hiking"),
    ("Backpack strap snapped on the trail", 1.9, "hiking"),
    ("Goggles do not fog at all", 4.4, "swimming"),
    ("Swimsuit faded after a few pool sessions", 2.4, "swimming"),
    ("Good ball, keeps its shape", 4.1, "football"),
    ("Boots gave me blisters in the first match", 2.2, "football"),
    ("Yoga block is firm and grippy", 4.2, "yoga"),
    ("Paddle board leaks air slowly", 2.3, "water_sports"),
    ("Checkout in the app kept failing", 1.5, "app_delivery"),
    ("Delivery came a day early", 4.8, "app_delivery"),
    ("Staff helped me pick the right size", 4.9, "other"),
    ("Long queue at the tills", 2.5, "other"),
    ("Fair quality for the money", 3.4, "other"),
    ("Nothing special, does the job", 3.0, "other"),
]
CITIES: list[str] = ["Northport", "Eastvale", "Southbay", "Westfield", "Lakeside", "Hillcrest", "Riverton"]
LANGUAGE_WEIGHTS: list[tuple[str, float]] = [("pt", 0.4), ("es", 0.4), ("en", 0.2)]
MAX_DAYS_BACK = 180
JITTER = 0.3


def _u(seed: int, draw: int, key: Column) -> Column:
    """Deterministic uniform [0, 1) from (seed, draw, key): the first seven
    hex digits of an MD5, which any SQL engine can repeat."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(draw)), key.cast("string")))
    return F.conv(F.substring(h, 1, 7), 16, 10).cast("double") / F.lit(float(1 << 28))


def _pick(values: list, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return pick(arr, (F.floor(u * len(values))).cast("int") + 1)


def synthetic_reviews(rows: DataFrame, key: str, seed: int = 42, base_date: str = "2026-01-01 00:00:00",
                      prefix: str = "syn_") -> DataFrame:
    """One synthetic review per row of ``rows`` (identified by ``key``)."""
    k = F.col(key)
    t_idx = (F.floor(_u(seed, 1, k) * len(TEMPLATES))).cast("int")
    texts = F.array(*[F.lit(t) for t, _, _ in TEMPLATES])
    bases = F.array(*[F.lit(r) for _, r, _ in TEMPLATES])
    cats = F.array(*[F.lit(c) for _, _, c in TEMPLATES])
    city = _pick(CITIES, _u(seed, 2, k))
    u_lang = _u(seed, 3, k)
    lang, acc = None, 0.0
    for code, w in LANGUAGE_WEIGHTS:
        acc += w
        lang = F.when(u_lang < acc, F.lit(code)) if lang is None else lang.when(u_lang < acc, F.lit(code))
    lang = lang.otherwise(F.lit(LANGUAGE_WEIGHTS[-1][0]))
    days = F.floor(_u(seed, 4, k) * (MAX_DAYS_BACK + 1)).cast("int")
    jitter = (_u(seed, 5, k) * 2 - 1) * JITTER
    rating = round_half_up(clamp(pick(bases, t_idx + 1) + jitter, 1.0, 5.0), 1)
    base = F.to_timestamp(F.lit(base_date))
    return rows.select(
        F.concat(F.lit(prefix), zero_pad(k, 5)).alias("review_id"),
        F.lit("synthetic").alias("source"),
        F.concat(F.lit("store_"), F.lower(city)).alias("store_id"),
        F.concat(F.lit("Store "), city).alias("store_name"),
        city.alias("store_city"),
        rating.alias("rating"),
        pick(texts, t_idx + 1).alias("text"),
        lang.alias("language"),
        F.date_format(base - F.make_dt_interval(days), "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        pick(cats, t_idx + 1).alias("sport_category"),
        F.date_format(base, "yyyy-MM-dd'T'HH:mm:ss").alias("collected_at"),
    )
