"""Aggregates behind the dashboard, the insight reports and the load checks.

Conventions (decided once, here):

* "dashboard family" groupings drop null keys (as a pandas ``groupby``);
  "SQL family" (``verify_*``) keeps them (as ``GROUP BY``).
* ``*_count`` of a column counts non-null values; ``n`` / totals count rows.
* Every ordering ends with the grouping key, so ties are deterministic.
* Rounding is half-up on the decimal value (``round_half_up``).
* Shares over "all rows" are computed from the grouped frame (one row per
  key) with a key-less window — the window only ever sees the aggregated
  rows, never raw input.
* Every aggregate has a partial form on the map side, so a hot key costs
  one row per task in the shuffle.
* Means are an exact decimal sum over a count (``exact_mean``), so their last
  digit, and every rank built on them, is the same for any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.functions.numeric import exact_mean, pct, rating_band, round_half_up
from reviewlake.functions.text import bar, title_case
from reviewlake.functions.timefn import month


def _ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Add ``rank`` (1-based position in ``order``) to a small aggregated frame."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long")).orderBy("rank")


# --------------------------------------------------------------------------
# Load checks (SQL family: null groups kept)
# --------------------------------------------------------------------------
def verify_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def verify_avg_rating(df: DataFrame) -> DataFrame:
    return df.agg(round_half_up(exact_mean(F.col("rating")), 2).alias("avg_rating"))


def verify_by_sentiment(df: DataFrame) -> DataFrame:
    g = df.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    return _ranked(g, F.desc("n"), F.asc_nulls_first("sentiment_label"))


def verify_by_city(df: DataFrame) -> DataFrame:
    g = df.groupBy("store_city").agg(round_half_up(exact_mean(F.col("rating")), 2).alias("avg_rating"),
                                     F.count(F.lit(1)).alias("total"))
    return g.orderBy(F.asc_nulls_last("avg_rating"), F.asc_nulls_first("store_city"))


# --------------------------------------------------------------------------
# Dashboard KPIs (one pass, conditional aggregates, no join)
# --------------------------------------------------------------------------
def kpis(df_full: DataFrame, predicate: Column | None = None, target: float = C.RATING_TARGET) -> DataFrame:
    """KPI row of the filtered rows, plus the unfiltered total.

    Both totals come from one scan of ``df_full``: filtered figures are
    conditional aggregates under ``predicate``.
    """
    p = predicate if predicate is not None else F.lit(True)
    sel = lambda c: F.when(p, c)
    agg = df_full.agg(
        F.count_if(p).alias("total"),
        F.count(F.lit(1)).alias("full_total"),
        round_half_up(exact_mean(sel(F.col("rating"))), 2).alias("avg_rating"),
        F.count_if(p & (F.col("sentiment_label") == "positive")).alias("positive_count"),
        F.count_if(p & (F.col("sentiment_label") == "negative")).alias("negative_count"),
    )
    delta = round_half_up(F.col("avg_rating") - F.lit(target), 2)
    return agg.select(
        "total", "full_total", "avg_rating",
        pct(F.col("positive_count"), F.col("total"), 1).alias("pct_positive"),
        pct(F.col("negative_count"), F.col("total"), 1).alias("pct_negative"),
        "positive_count", "negative_count",
        delta.alias("delta_to_target"),
        F.when(delta >= 0, F.lit("good")).otherwise(F.lit("bad")).alias("delta_class"),
        F.when(delta >= 0, F.lit("↑")).otherwise(F.lit("↓")).alias("delta_arrow"),
    )


# --------------------------------------------------------------------------
# Distributions
# --------------------------------------------------------------------------
def label_distribution(df: DataFrame, col: str = "sentiment_label", denominator: str = "all") -> DataFrame:
    """Count and share (1 dp) per non-null label, most frequent first.

    ``denominator="all"`` divides by all rows (null labels included),
    ``"non_null"`` by labelled rows only (pie chart).
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # over the grouped rows only (one per label)
    if denominator == "all":
        total = F.sum("n").over(w)
    elif denominator == "non_null":
        total = F.sum(F.when(F.col(col).isNotNull(), F.col("n"))).over(w)
    else:
        raise ValueError(denominator)
    g = g.withColumn("total", total).where(F.col(col).isNotNull())
    g = g.select(F.col(col).alias("label"), "n",
                 pct(F.col("n"), F.col("total"), 1).alias("pct"))
    return _ranked(g, F.desc("n"), F.asc("label"))


def rating_by_category(df: DataFrame) -> DataFrame:
    """Mean rating (+ non-null count, 2-dp value, colour band) per category,
    lowest mean first — the flagship chart query."""
    g = (df.where(F.col("sport_category").isNotNull())
           .groupBy("sport_category")
           .agg(exact_mean(F.col("rating")).alias("avg_rating"), F.count("rating").alias("rating_count")))
    g = g.select("sport_category", "avg_rating", "rating_count",
                 round_half_up(F.col("avg_rating"), 2).alias("avg_rating_2dp"),
                 rating_band(F.col("avg_rating")).alias("band_color"))
    return _ranked(g, F.asc_nulls_last("avg_rating"), F.asc("sport_category"))


def category_rating_bars(df: DataFrame) -> DataFrame:
    """Mean rating per category ascending with a ``█ × int(2·mean)`` bar."""
    g = (df.where(F.col("sport_category").isNotNull())
           .groupBy("sport_category").agg(exact_mean(F.col("rating")).alias("avg_rating")))
    g = g.select("sport_category", round_half_up(F.col("avg_rating"), 2).alias("avg_rating"),
                 bar(F.floor(F.col("avg_rating") * 2)).alias("bar"),
                 F.col("avg_rating").alias("_m"))
    return _ranked(g, F.asc_nulls_last("_m"), F.asc("sport_category")).drop("_m")


def sentiment_by_city(df: DataFrame) -> DataFrame:
    """Count per (city, label) and its share of the city's labelled rows."""
    g = (df.where(F.col("store_city").isNotNull() & F.col("sentiment_label").isNotNull())
           .groupBy("store_city", "sentiment_label").agg(F.count(F.lit(1)).alias("n")))
    city_total = F.sum("n").over(Window.partitionBy("store_city"))
    return g.withColumn("pct", F.col("n").cast("double") / city_total.cast("double") * F.lit(100.0))


def negatives_by_category(df: DataFrame) -> DataFrame:
    """Negative reviews per category, most first (no negatives → no rows)."""
    g = (df.where((F.col("sentiment_label") == "negative") & F.col("sport_category").isNotNull())
           .groupBy("sport_category").agg(F.count(F.lit(1)).alias("n")))
    return _ranked(g, F.desc("n"), F.asc("sport_category"))


def top_negative_categories(df: DataFrame, k: int = 3) -> DataFrame:
    """First ``k`` of ``negatives_by_category`` (a top-k report)."""
    return negatives_by_category(df).where(F.col("rank") <= k)


def rating_trend(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Per ``YYYY-MM`` of dated rows: mean rating and non-null count, by month."""
    g = (df.where(F.col(date_col).isNotNull())
           .groupBy(month(F.col(date_col)).alias("month"))
           .agg(exact_mean(F.col("rating")).alias("avg_rating"), F.count("rating").alias("rating_count")))
    return g.orderBy("month")


# --------------------------------------------------------------------------
# Automated insights (each one row or none)
# --------------------------------------------------------------------------
def _category_means(df: DataFrame) -> DataFrame:
    return (df.where(F.col("sport_category").isNotNull())
              .groupBy("sport_category").agg(exact_mean(F.col("rating")).alias("m"))
              .where(F.col("m").isNotNull()))


def insight_worst_category(df: DataFrame, below: float = C.WORST_CATEGORY_BELOW) -> DataFrame:
    """Category with the lowest mean rating, reported only if its 2-dp mean < 3."""
    top = _category_means(df).orderBy(F.asc("m"), F.asc("sport_category")).limit(1)
    out = top.select("sport_category", title_case(F.col("sport_category")).alias("title"),
                     round_half_up(F.col("m"), 2).alias("value"))
    return out.where(F.col("value") < below)


def insight_best_category(df: DataFrame) -> DataFrame:
    top = _category_means(df).orderBy(F.desc("m"), F.asc("sport_category")).limit(1)
    return top.select("sport_category", title_case(F.col("sport_category")).alias("title"),
                      round_half_up(F.col("m"), 2).alias("value"))


def insight_negative_city(df: DataFrame) -> DataFrame:
    g = (df.where((F.col("sentiment_label") == "negative") & F.col("store_city").isNotNull())
           .groupBy("store_city").agg(F.count(F.lit(1)).alias("n")))
    return g.orderBy(F.desc("n"), F.asc("store_city")).limit(1)


def insight_low_language(df: DataFrame, score_col: str = "sentiment_score") -> DataFrame:
    """Language with the lowest mean score and its display name.

    Returns no rows when the score column is absent (plan-time check)."""
    if score_col not in df.columns:
        return df.sparkSession.createDataFrame([], "language string, language_name string, value double")
    names = F.create_map(*[x for k, v in C.LANGUAGE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    g = (df.where(F.col("language").isNotNull())
           .groupBy("language").agg(exact_mean(F.col(score_col)).alias("m"))
           .where(F.col("m").isNotNull()))
    top = g.orderBy(F.asc("m"), F.asc("language")).limit(1)
    return top.select("language", F.coalesce(names[F.col("language")], F.col("language")).alias("language_name"),
                      round_half_up(F.col("m"), 2).alias("value"))


def score_by_city(df: DataFrame, score_col: str = "bert_score") -> DataFrame:
    """Mean model score per city ascending, mood flag and ``int(|s|·10)`` bar."""
    g = (df.where(F.col("store_city").isNotNull())
           .groupBy("store_city").agg(exact_mean(F.col(score_col)).alias("m")))
    return g.select(
        "store_city",
        round_half_up(F.col("m"), 2).alias("avg_score"),
        (F.col("m") > 0).alias("is_positive"),
        bar(F.floor(F.abs(F.col("m")) * 10)).alias("bar"),
        F.col("m").alias("_m"),
    ).orderBy(F.asc_nulls_last("_m"), F.asc("store_city")).drop("_m")


# --------------------------------------------------------------------------
# Filter widgets, counters
# --------------------------------------------------------------------------
def filter_options(df: DataFrame, columns=("source", "language")) -> DataFrame:
    """Distinct non-null values per column, sorted: ``(column_name, value)``
    rows, from one pass over the input."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    u = df.select(*columns).selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, value)")
    return u.where("value IS NOT NULL").distinct().orderBy("column_name", "value")


def rating_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"))


def source_counts(df: DataFrame, by_city: bool = False) -> DataFrame:
    keys = ["source", "store_city"] if by_city else ["source"]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys)


def classified_counts(df: DataFrame, col: str = "sport_category") -> DataFrame:
    """Rows the keyword step classified vs left for the model."""
    return df.agg(F.count(col).alias("classified"),
                  F.count_if(F.col(col).isNull()).alias("unclassified"))


def run_metrics(df: DataFrame, run_id: str, label_col: str = "bert_label", score_col: str = "bert_score",
                load_seconds: float | None = None, inference_seconds: float | None = None,
                logged_at: Column | None = None, model_name: str | None = None,
                extra: dict[str, float] | None = None) -> DataFrame:
    """Run metrics of a scoring run in long form ``(run_id, kind, name, value_num, value_str, logged_at)``.

    One aggregate gives all metrics and parameters, then ``stack`` unpivots
    it, so the scored input is read once; percentages of an empty run are
    null, not an error.  Timings and ``extra`` metrics are measured by the
    caller.  Languages and sources are listed sorted (one value of the
    report; ``"unknown"`` when the column is absent, a plan-time check)."""
    lab = F.col(label_col)

    def listed(c):
        if c not in df.columns:
            return F.lit("unknown")
        return F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",")

    a = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(lab == "positive").alias("positive_count"),
        F.count_if(lab == "negative").alias("negative_count"),
        F.count_if(lab == "neutral").alias("neutral_count"),
        F.sum(F.col(score_col).cast("decimal(20,6)")).cast("double").alias("_score_sum"),
        (exact_mean(F.col("rating")) if "rating" in df.columns else F.lit(None).cast("double")).alias("_avg_rating"),
        listed("language").alias("languages"), listed("source").alias("sources"),
    )
    tot = F.col("total").cast("double")
    share = lambda c: F.when(tot > 0, round_half_up(F.col(c) / tot * 100, 2))
    metrics = {
        "total_reviews": tot,
        "positive_count": F.col("positive_count"), "negative_count": F.col("negative_count"), "neutral_count": F.col("neutral_count"),
        "positive_pct": share("positive_count"), "negative_pct": share("negative_count"), "neutral_pct": share("neutral_count"),
        "avg_sentiment_score": F.when(tot > 0, round_half_up(F.col("_score_sum") / tot, 4)),
        "avg_rating": round_half_up(F.col("_avg_rating"), 4),
        "model_load_time_seconds": F.lit(load_seconds), "inference_time_seconds": F.lit(inference_seconds),
        **{k: F.lit(v) for k, v in (extra or {}).items()},
    }
    params = {"model_name": F.lit(model_name), "total_reviews": F.col("total"), "languages": F.col("languages"), "sources": F.col("sources")}
    rows = [F.struct(F.lit("metric").alias("kind"), F.lit(n).alias("name"), c.cast("double").alias("value_num"),
                     F.lit(None).cast("string").alias("value_str")) for n, c in metrics.items()]
    rows += [F.struct(F.lit("param").alias("kind"), F.lit(n).alias("name"), F.lit(None).cast("double").alias("value_num"),
                      c.cast("string").alias("value_str")) for n, c in params.items()]
    ts = F.current_timestamp() if logged_at is None else logged_at
    return a.select(F.inline(F.array(*rows))).select(F.lit(run_id).alias("run_id"), "kind", "name", "value_num", "value_str",
                                                     ts.alias("logged_at"))


# --------------------------------------------------------------------------
# Review explorer and lowest scores
# --------------------------------------------------------------------------
SORTS = {
    "Most Recent": lambda: [F.col("date").desc_nulls_last()],
    "Lowest Rating": lambda: [F.col("rating").asc_nulls_last()],
    "Highest Rating": lambda: [F.col("rating").desc_nulls_last()],
}


def explorer_page(df: DataFrame, sentiment: str = "All", sort_by: str = "Most Recent",
                  page: int = 1, per_page: int = 20) -> DataFrame:
    """One page of the review explorer.

    Filter by label (``"All"`` bypasses), sort (nulls last in every mode,
    ``review_id`` breaks ties), then rows ``[(page-1)·per_page, page·per_page)``.
    Planned as ``TakeOrderedAndProject`` with an offset: each task keeps
    only its top ``page·per_page`` rows, nothing is fully sorted.  Output:
    ``pos`` (1-based position in the full ordering), ``review_id`` and the
    display columns with the sentiment colour.
    """
    from reviewlake.operators.filters import label_equals
    from reviewlake.operators.projections import explorer_display
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page must be >= 1")
    order = SORTS[sort_by]() + [F.col("review_id").asc()]
    start = (page - 1) * per_page
    top = label_equals(df, "sentiment_label", sentiment).orderBy(*order).offset(start).limit(per_page)
    # the window sees only the <= per_page rows of the page
    top = top.withColumn("pos", (F.row_number().over(Window.orderBy(*order)) + F.lit(start)).cast("long"))
    return explorer_display(top, keep=["pos", "review_id"]).orderBy("pos")


def explorer_page_after(df: DataFrame, after: tuple | None, sentiment: str = "All",
                        sort_by: str = "Lowest Rating", per_page: int = 20) -> DataFrame:
    """Keyset page: the ``per_page`` rows that follow ``after`` =
    ``(sort_value, review_id)`` of the previous page's last row (``None`` for
    the first page).  Unlike ``offset``, the cost does not grow with the page
    number: the predicate prunes everything before the key and each task
    keeps only ``per_page`` rows.  Same order as ``explorer_page`` (nulls
    last, ties by ``review_id``)."""
    from reviewlake.operators.filters import label_equals
    from reviewlake.operators.projections import explorer_display
    col, desc = {"Most Recent": ("date", True), "Lowest Rating": ("rating", False),
                 "Highest Rating": ("rating", True)}[sort_by]
    rows = label_equals(df, "sentiment_label", sentiment)
    if after is not None:
        v, rid = after
        c, r = F.col(col), F.col("review_id")
        if v is None:                                   # already in the null tail
            pred = c.isNull() & (r > F.lit(rid))
        else:
            beyond = (c < F.lit(v)) if desc else (c > F.lit(v))
            pred = c.isNull() | beyond | ((c == F.lit(v)) & (r > F.lit(rid)))
        rows = rows.where(pred)
    order = SORTS[sort_by]() + [F.col("review_id").asc()]
    top = rows.orderBy(*order).limit(per_page)
    top = top.withColumn("pos", F.row_number().over(Window.orderBy(*order)).cast("long"))
    return explorer_display(top, keep=["pos", "review_id", F.col(col).alias("sort_value")]).orderBy("pos")


def explorer_summary(df: DataFrame, sentiment: str = "All", per_page: int = 20) -> DataFrame:
    """Total matching rows and ``max(1, ceil(total / per_page))`` pages."""
    from reviewlake.operators.filters import label_equals
    a = label_equals(df, "sentiment_label", sentiment).agg(F.count(F.lit(1)).alias("total"))
    return a.select("total", F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(per_page))).cast("long").alias("total_pages"))


def lowest_scores(df: DataFrame, n: int = 3, score_col: str = "sentiment_score", preview_chars: int = 60) -> DataFrame:
    """The ``n`` rows with the smallest score (nulls only as filler), ties by id."""
    top = df.orderBy(F.col(score_col).asc_nulls_last(), F.col("review_id").asc()).limit(n)
    top = top.withColumn("pos", F.row_number().over(
        Window.orderBy(F.col(score_col).asc_nulls_last(), F.col("review_id").asc())).cast("long"))
    return top.select("pos", "review_id", "store_city", F.col(score_col).alias("score"),
                      F.concat(F.substring("text", 1, preview_chars), F.lit("...")).alias("preview"))


def _lowest_section(df: DataFrame, k: int, score_col: str) -> DataFrame:
    return lowest_scores(df, k, score_col).select(
        F.lit("lowest_scores").alias("section"), F.col("review_id").alias("item"),
        F.lit(None).cast("double").alias("n"), F.col("score").alias("value"), F.col("pos").alias("rank"))


def _ranked_sections(sums: DataFrame, order: dict[str, list[Column]]) -> DataFrame:
    """Rank each section's rows (a few per group key) by its own order."""
    out = None
    for name, by in order.items():
        part = sums.where(F.col("section") == name)
        part = part.withColumn("rank", F.row_number().over(Window.partitionBy("section").orderBy(*by)).cast("long"))
        out = part if out is None else out.unionByName(part)
    return out


def _section_sums(df: DataFrame, keys: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Per section and item: row count ``c``, value sum and value count, all
    sections from one pass.  ``keys``: section → (item, counts, value)."""
    rows = F.array(*[F.struct(F.lit(s).alias("section"), item.cast("string").alias("item"), counts.alias("hit"),
                              value.cast("decimal(20,6)").alias("v")) for s, (item, counts, value) in keys.items()])
    return df.select(F.inline(rows)).groupBy("section", "item").agg(
        F.count_if("hit").alias("c"), F.sum("v").cast("double").alias("_sum"), F.count("v").alias("_cnt"))


def insight_report(df: DataFrame, k: int = 3) -> DataFrame:
    """The printed insight report as one long frame
    ``(section, item, n, value, rank)`` (``n``, ``value`` double):

    * ``distribution``  label count and share of all rows;
    * ``category_rating`` mean rating per category (2 dp), lowest first;
    * ``top_negative``  the ``k`` categories with most negative reviews;
    * ``lowest_scores`` the ``k`` reviews with the smallest score.

    The first three share one pass and one aggregate over the input.
    """
    cat, label, yes, none = F.col("sport_category"), F.col("sentiment_label"), F.lit(True), F.lit(None)
    sums = _section_sums(df, {"distribution": (label, yes, none), "category_rating": (cat, yes, F.col("rating")),
                              "top_negative": (cat, F.coalesce(label == "negative", F.lit(False)), none)})
    mean = F.try_divide(F.col("_sum"), F.col("_cnt").cast("double"))
    total = F.sum("c").over(Window.partitionBy("section"))
    dist = F.col("section") == "distribution"
    sums = sums.withColumn("_total", total).where(F.col("item").isNotNull() & ((F.col("section") != "top_negative") | (F.col("c") > 0)))
    sums = sums.select("section", "item", "c", mean.alias("_m"),
                       F.when(F.col("section") != "category_rating", F.col("c").cast("double")).alias("n"),
                       F.when(dist, pct(F.col("c"), F.col("_total"), 1)).when(F.col("section") == "category_rating", round_half_up(mean, 2))
                        .alias("value"))
    ranked = _ranked_sections(sums, {"distribution": [F.desc("c"), F.asc("item")],
                                     "category_rating": [F.asc_nulls_last("_m"), F.asc("item")],
                                     "top_negative": [F.desc("c"), F.asc("item")]})
    ranked = ranked.where((F.col("section") != "top_negative") | (F.col("rank") <= k)).select("section", "item", "n", "value", "rank")
    return ranked.unionByName(_lowest_section(df, k, "sentiment_score"))


def star_report(df: DataFrame, k: int = 5, label_col: str = "bert_label", score_col: str = "bert_score") -> DataFrame:
    """The star model's printed report, in the form of ``insight_report``:

    * ``distribution`` label count and share of all rows;
    * ``city_score``   mean score per city (2 dp), lowest first;
    * ``lowest_scores`` the ``k`` reviews with the smallest score.
    """
    sums = _section_sums(df, {"distribution": (F.col(label_col), F.lit(True), F.lit(None)),
                              "city_score": (F.col("store_city"), F.lit(True), F.col(score_col))})
    mean = F.try_divide(F.col("_sum"), F.col("_cnt").cast("double"))
    dist = F.col("section") == "distribution"
    sums = sums.withColumn("_total", F.sum("c").over(Window.partitionBy("section"))).where("item IS NOT NULL")
    sums = sums.select("section", "item", "c", mean.alias("_m"), F.when(dist, F.col("c").cast("double")).alias("n"),
                       F.when(dist, pct(F.col("c"), F.col("_total"), 1)).otherwise(round_half_up(mean, 2)).alias("value"))
    ranked = _ranked_sections(sums, {"distribution": [F.desc("c"), F.asc("item")], "city_score": [F.asc_nulls_last("_m"), F.asc("item")]})
    return ranked.select("section", "item", "n", "value", "rank").unionByName(_lowest_section(df, k, score_col))


# --------------------------------------------------------------------------
# The load checks as SQL text over a temp view (same results as verify_*)
# --------------------------------------------------------------------------
VERIFY_SQL = {
    "total": "SELECT count(*) AS total FROM {v}",
    "avg_rating": "SELECT CAST(round(CAST(avg(rating) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_rating FROM {v}",
    "by_sentiment": "SELECT sentiment_label, count(*) AS n FROM {v} GROUP BY sentiment_label "
                    "ORDER BY n DESC, sentiment_label ASC NULLS FIRST",
    "by_city": "SELECT store_city, CAST(round(CAST(avg(rating) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_rating, "
               "count(*) AS total FROM {v} GROUP BY store_city ORDER BY avg_rating ASC NULLS LAST, store_city ASC NULLS FIRST",
}


def verify_sql(df: DataFrame, view: str | None = None) -> dict[str, DataFrame]:
    """The four check queries as SQL text over ``df`` (Catalyst plans them
    exactly like the DataFrame forms).  ``df`` is a temp view only while the
    queries are analysed, unless ``view`` names one to keep."""
    import uuid
    name = view or f"reviews_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    try:
        return {k: df.sparkSession.sql(q.format(v=name)) for k, q in VERIFY_SQL.items()}
    finally:
        if view is None:
            df.sparkSession.catalog.dropTempView(name)
