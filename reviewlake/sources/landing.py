"""Land raw payloads from table data (the inverse of the normalisers).

Each builder takes an optional ``base`` (the classified ``reviews`` rows)
so a job that lands several sources computes the adapter join once.  A base
stored bucketed by its column ``page`` is grouped into pages where it lies.

Collection over HTTP is not part of this library; payloads arrive as
files.  These builders produce the same payload shapes from the driver
tables so that the normalisers, the union/dedup and the collection job can
run — and be checked — on data that grows with the tables.  Every
grouping is bounded (a page holds at most ``PAGE_DOCS`` documents) so no
task ever assembles an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.jsonfn import encode
from reviewlake.functions.timefn import iso
from reviewlake.sources.tables import classified_reviews, read_table, reviews

FETCHED_AT = "2026-01-01 00:00:00"   # landing time stamped on derived payloads
PAGE_DOCS = 100                      # documents per landed page (bound)
LD_OPEN = '<script type="application/ld+json">'
LD_CLOSE = "</script>"


def _fetched_at():
    return F.to_timestamp(F.lit(FETCHED_AT))


def _rating(spoil: int | None):
    """The rating as payload text; with ``spoil`` every such document's is no number."""
    r = F.col("rating").cast("string")
    return r if spoil is None else F.when(F.col("doc_id") % spoil == 0, F.lit("n/a")).otherwise(r)


def _page(r: DataFrame):
    """The page a document lands on: a column of ``r``, or its id div ``PAGE_DOCS``."""
    return F.col("page") if "page" in r.columns else page_of(F.col("doc_id")).alias("page")


def page_of(doc_id):
    return (doc_id / PAGE_DOCS).cast("long")


def _label(c):
    return F.when(c.isNotNull(), F.struct(c.cast("string").alias("label")))


def play_payloads(spark: SparkSession, sf: str, base: DataFrame | None = None, spoil: int | None = None) -> DataFrame:
    """One JSON review per row; every 7th document lands a 9-character
    content (below the length bound)."""
    r = reviews(spark, sf) if base is None else base
    content = F.when(F.col("doc_id") % 7 == 0, F.substring("text", 1, 9)).otherwise(F.col("text"))
    body = F.struct(F.col("doc_id").cast("string").alias("reviewId"),
                    (F.floor("rating").cast("int") if spoil is None else _rating(spoil)).alias("score"),
                    content.alias("content"),
                    iso(F.col("date")).alias("at"))
    return r.select(encode(body).alias("payload"), F.col("language").alias("country"),
                    F.col("language").alias("lang"), F.col("store_city").alias("city"),
                    _fetched_at().alias("fetched_at"))


def feed_payloads(spark: SparkSession, sf: str, base: DataFrame | None = None, spoil: int | None = None) -> DataFrame:
    """Feed pages per (language, city, doc_id div PAGE_DOCS): an app-info
    entry first, then one entry per review (no rating object when the
    rating is null, no ``updated`` when the date is null)."""
    r = reviews(spark, sf) if base is None else base
    entry = F.struct(
        _label(F.col("review_id")).alias("id"),
        _label(_rating(spoil)).alias("im:rating"),
        _label(F.col("store_id")).alias("title"),
        _label(F.col("text")).alias("content"),
        _label(iso(F.col("date"))).alias("updated"),
    )
    header = F.struct(
        _label(F.lit("app")).alias("id"), F.lit(None).cast("struct<label:string>").alias("im:rating"),
        _label(F.lit("App information")).alias("title"), _label(F.lit("about")).alias("content"),
        F.lit(None).cast("struct<label:string>").alias("updated"))
    pages = (r.groupBy(F.col("language"), F.col("store_city"), _page(r))
              .agg(F.array_sort(F.collect_list(F.struct(F.col("doc_id").alias("k"), entry.alias("e")))).alias("es")))
    feed = F.struct(F.struct(F.concat(F.array(header), F.transform("es", lambda x: x["e"])).alias("entry")).alias("feed"))
    return pages.select(encode(feed).alias("payload"), F.col("language").alias("country"),
                        F.col("language").alias("lang"), F.col("store_city").alias("city"),
                        "page", _fetched_at().alias("fetched_at"))


POSTS_PER_PAGE = 100                 # turns of one conversation per listing page (bound)


def listing_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Forum listings from ``conversations``: one post per turn; a page holds
    at most ``POSTS_PER_PAGE`` turns of one conversation, so even a
    conversation with a huge share of all turns is split into bounded
    pages.  The role is the forum name."""
    c = read_table(spark, sf, "conversations")
    post = F.struct(F.struct(
        F.concat(F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("selftext"),
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")).alias("title"),
        ((F.col("turn") * 13) % 151 - 20).cast("long").alias("score"),
        (F.lit(1_700_000_000.0) + F.col("conv_id") * 3600.0 + F.col("turn") * 60.0).alias("created_utc"),
    ).alias("data"))
    pages = (c.groupBy("role", "conv_id", F.floor(F.col("turn") / POSTS_PER_PAGE).alias("page"))
              .agg(F.array_sort(F.collect_list(F.struct(F.col("turn"), post.alias("p")))).alias("ps")))
    body = F.struct(F.struct(F.transform("ps", lambda x: x["p"]).alias("children")).alias("data"))
    return pages.select(encode(body).alias("payload"), F.col("role").alias("subreddit"),
                        F.lit("en").alias("lang"), "page", _fetched_at().alias("fetched_at"))


def review_page_payloads(spark: SparkSession, sf: str, base: DataFrame | None = None, spoil: int | None = None) -> DataFrame:
    """HTML pages per (language, city, doc_id div PAGE_DOCS) holding one
    JSON-LD block with the reviews and one broken block."""
    r = reviews(spark, sf) if base is None else base
    item = F.struct(
        F.struct(_rating(spoil).alias("ratingValue")).alias("reviewRating"),
        F.col("text").alias("description"),
        iso(F.col("date")).alias("datePublished"),
        F.struct(F.concat(F.lit("user_"), F.col("doc_id").cast("string")).alias("name")).alias("author"),
    )
    pages = (r.groupBy("language", "store_city", _page(r))
              .agg(F.array_sort(F.collect_list(F.struct(F.col("doc_id").alias("k"), item.alias("v")))).alias("vs")))
    ld = encode(F.struct(F.transform("vs", lambda x: x["v"]).alias("review")))
    html = F.concat(F.lit("<html><head><title>Reviews</title>"), F.lit(LD_OPEN), ld, F.lit(LD_CLOSE),
                    F.lit(LD_OPEN), F.lit('{"review": [broken'), F.lit(LD_CLOSE),
                    F.lit("</head><body><p>page</p></body></html>"))
    return pages.select(html.alias("html"), F.col("language").alias("lang"),
                        F.col("store_city").alias("city"), "page", _fetched_at().alias("fetched_at"))


def product_page_payloads(spark: SparkSession, sf: str, base: DataFrame | None = None, spoil: int | None = None) -> DataFrame:
    """Category pages per (sport category, doc_id div PAGE_DOCS): an
    ``ItemList`` JSON-LD block of products (doc_id div 10) with their
    reviews, plus an unrelated ``Organization`` block."""
    r = classified_reviews(spark, sf) if base is None else base
    rv = F.struct(F.col("text").alias("reviewBody"),
                  F.struct(_rating(spoil).alias("ratingValue")).alias("reviewRating"),
                  iso(F.col("date")).alias("datePublished"))
    # the texts move once: a page's reviews are gathered, then dealt to its products
    pages = (r.groupBy("sport_category", _page(r))
              .agg(F.array_sort(F.collect_list(F.struct(F.col("doc_id").alias("k"), rv.alias("v")))).alias("vs")))

    def product(x):
        return (x["k"] / 10).cast("long")
    items = F.transform(F.array_distinct(F.transform("vs", product)), lambda p: F.struct(F.struct(
        F.transform(F.filter("vs", lambda x: product(x).eqNullSafe(p)), lambda x: x["v"]).alias("review")).alias("item")))
    ld = encode(F.struct(F.lit("ItemList").alias("@type"), items.alias("itemListElement")))
    html = F.concat(F.lit("<html><head>"), F.lit(LD_OPEN), F.lit('{"@type": "Organization", "name": "shop"}'),
                    F.lit(LD_CLOSE), F.lit(LD_OPEN), ld, F.lit(LD_CLOSE), F.lit("</head><body></body></html>"))
    return pages.select(html.alias("html"), F.col("sport_category").alias("sport"), F.lit("pt").alias("lang"),
                        F.lit("Online").alias("city"), "page", _fetched_at().alias("fetched_at"))
