"""Further registered queries: source normalisers, union / dedup, upsert,
storage projection, sentiment policy, text features."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.numeric import stars_label, stars_score
from reviewlake.operators.merge import UPDATE_SENTIMENT, UPDATE_TOUCH_ONLY, upsert
from reviewlake.operators.projections import apply_sentiment_policy, to_stored, with_text_features
from reviewlake.operators.setops import dedup_first, union_sources
from reviewlake.registry import register
from reviewlake.sources import landing as L
from reviewlake.sources import payloads as P
from reviewlake.sources.tables import classified_reviews, read_table, reviews, stage

TABLE_INGESTED_AT = "2026-01-01 00:00:00"
BATCH_INGESTED_AT = "2026-02-01 00:00:00"


# ------------------------------------------------------------ normalisers
@register("play_normalise")
def q_play_normalise(spark, sf):
    return P.normalise_play(L.play_payloads(spark, sf))


@register("feed_normalise")
def q_feed_normalise(spark, sf):
    return P.normalise_feed(L.feed_payloads(spark, sf))


@register("feed_page_stop")
def q_feed_page_stop(spark, sf):
    """The feed with empty and unreadable pages: what lies behind the first
    one of a country and city is rejected, and says so."""
    pages = L.feed_payloads(spark, sf)
    hole = F.when(F.col("page") % 4 == 1, F.lit('{"feed": {"entry": []}}')).when(F.col("page") % 7 == 6, F.lit("<html>busy"))
    out = P.flag_feed(pages.withColumn("payload", F.coalesce(hole, F.col("payload"))))
    return out.select("review_id", "store_id", "store_city", "rating", "text", "reject_reason")


@register("listing_normalise")
def q_listing_normalise(spark, sf):
    return P.normalise_listing(L.listing_payloads(spark, sf))


@register("jsonld_reviews")
def q_jsonld_reviews(spark, sf):
    return P.normalise_review_pages(L.review_page_payloads(spark, sf))


@register("jsonld_products")
def q_jsonld_products(spark, sf):
    return P.normalise_product_pages(L.product_page_payloads(spark, sf))


def normalised_sources(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The five sources in collection order (= dedup priority); what cannot
    be a review goes to a reject output.

    Four of them are landed from the reviews adapter; it is stored once as
    a table so its joins run once, not four times."""
    from reviewlake.plans.jobs import collect_sources
    from reviewlake.session import scratch_path
    with landed_sources(spark, sf) as landed:
        return collect_sources(spark, landed, scratch_path(spark, "rejects"))


@contextmanager
def landed_sources(spark: SparkSession, sf: str, spoil: int | None = None) -> Iterator[dict[str, DataFrame]]:
    """The five landed sources, while the table of their reviews exists.  It is
    bucketed by page, so no source moves the texts again for its pages."""
    from reviewlake.session import drop_scratch, scratch_path, shuffles_dropped
    from reviewlake.sinks.files import buckets_for, rows_and_bytes, save_bucketed
    name = f"reviews_base_{uuid.uuid4().hex[:10]}"
    rows, size = rows_and_bytes(read_table(spark, sf, "documents"))
    buckets = buckets_for(rows, size=size)
    base = classified_reviews(spark, sf).withColumn("page", L.page_of(F.col("doc_id")))
    path = scratch_path(spark, name)
    try:
        with shuffles_dropped(spark):
            save_bucketed(base, name, "page", buckets, path=path)
        base = spark.table(name)
        yield {"play": L.play_payloads(spark, sf, base, spoil), "feed": L.feed_payloads(spark, sf, base, spoil),
               "review_pages": L.review_page_payloads(spark, sf, base, spoil), "listing": L.listing_payloads(spark, sf),
               "product_pages": L.product_page_payloads(spark, sf, base, spoil)}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_scratch(spark, path)


@register("normalise_rejects")
def q_normalise_rejects(spark, sf):
    """Every 11th document's rating is no number: per source the items, what
    became a review, and what the reject output holds."""
    from reviewlake.plans.jobs import collect_sources
    from reviewlake.session import scratch_path
    path = scratch_path(spark, "rejects")
    with landed_sources(spark, sf, spoil=11) as landed:
        good = union_sources(collect_sources(spark, landed, path)).groupBy("source").agg(F.count(F.lit(1)).alias("good"))
    bad = spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("rejected"))
    out = good.join(bad, "source", "left").withColumn("rejected", F.coalesce("rejected", F.lit(0)).cast("long"))
    return out.withColumn("items", F.col("good") + F.col("rejected"))


@register("product_ids_long_text")
def q_product_ids_long_text(spark, sf):
    """Product ids over whole document texts: as many ids, and as many rows
    after dedup, as there are distinct contents."""
    d = read_table(spark, sf, "documents")
    base = d.select("doc_id", "text", F.col("source").alias("sport_category"), F.lit(4.0).alias("rating"),
                    F.lit(None).cast("timestamp").alias("date"))
    p = stage(P.normalise_product_pages(L.product_page_payloads(spark, sf, base)), "products")
    after = dedup_first(p, "review_id", ["date"]).agg(F.count(F.lit(1)).alias("rows_after"))
    counts = p.agg(F.count(F.lit(1)).alias("rows_in"), F.countDistinct("review_id").alias("ids"), F.countDistinct("store_id", "text").alias("contents"))
    return counts.join(after).select("rows_in", "ids", "contents", "rows_after")


@register("union_sources")
def q_union_sources(spark, sf):
    return union_sources(normalised_sources(spark, sf))


@register("dedup_products")
def q_dedup_products(spark, sf):
    """Product reviews of equal content share an id."""
    return dedup_first(P.normalise_product_pages(L.product_page_payloads(spark, sf)), "review_id", ["date"])


@register("collect_all_sources")
def q_collect_all_sources(spark, sf):
    """Union of the five sources, first occurrence per id (source order)."""
    u = union_sources(normalised_sources(spark, sf))
    return dedup_first(u, "review_id", ["source_priority", "date"]).drop("source_priority")


# ---------------------------------------------------------- storage, upsert
def stored_table(spark: SparkSession, sf: str) -> DataFrame:
    return to_stored(classified_reviews(spark, sf).drop("doc_id"),
                     ingested_at=F.to_timestamp(F.lit(TABLE_INGESTED_AT)))


def relabel_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch: relabelled documents (updates) + benchmark items (inserts),
    deduplicated by id before the merge."""
    lab = read_table(spark, sf, "labels")
    upd = lab.select(
        F.concat(F.lit("r_"), F.col("doc_id").cast("string")).alias("review_id"),
        F.lit("relabel").alias("source"),
        F.lit(None).cast("string").alias("store_id"),
        F.lit(None).cast("string").alias("store_city"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("language"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("string").alias("sport_category"),
        F.when(F.col("quality") == 1, F.lit("positive")).otherwise(F.lit("negative")).alias("sentiment_label"),
        (F.col("quality") - F.col("toxic")).cast("double").alias("sentiment_score"),
    )
    bench = read_table(spark, sf, "benchmark")
    ins = bench.select(
        F.concat(F.lit("b_"), F.col("item_id").cast("string")).alias("review_id"),
        F.lit("benchmark").alias("source"),
        F.lit("store_b").alias("store_id"),
        F.lit(None).cast("string").alias("store_city"),
        F.lit(3.0).alias("rating"),
        F.col("text"),
        F.lit("en").alias("language"),
        F.lit("2026-01-15T00:00:00").alias("date"),
        F.lit("other").alias("sport_category"),
        F.lit("neutral").alias("sentiment_label"),
        F.lit(0.0).alias("sentiment_score"),
    )
    batch = dedup_first(upd.unionByName(ins), "review_id", ["source"])
    return to_stored(batch, ingested_at=F.to_timestamp(F.lit(BATCH_INGESTED_AT)))


@register("upsert_sentiment")
def q_upsert_sentiment(spark, sf):
    return upsert(stored_table(spark, sf), stage(relabel_batch(spark, sf), "relabel-batch"), "review_id", UPDATE_SENTIMENT,
                  now=F.to_timestamp(F.lit(BATCH_INGESTED_AT)))


@register("upsert_touch")
def q_upsert_touch(spark, sf):
    return upsert(stored_table(spark, sf), stage(relabel_batch(spark, sf), "relabel-batch"), "review_id", UPDATE_TOUCH_ONLY,
                  now=F.to_timestamp(F.lit(BATCH_INGESTED_AT)))


@register("store_projection")
def q_store_projection(spark, sf):
    return stored_table(spark, sf)


@register("process_reviews")
def q_process_reviews(spark, sf):
    """The processing job over the stored layout with full document texts:
    length, lower-cased text and length band."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    t = d.select(F.concat(F.lit("r_"), F.col("doc_id").cast("string")).alias("review_id"),
                 F.col("text").alias("review_text"))
    return with_text_features(t, "review_text").drop("review_text")


# ------------------------------------------------------ sentiment policy
def _with_model_columns(df: DataFrame) -> DataFrame:
    """Star-model columns from a deterministic 1..5 star value per row."""
    stars = (F.col("doc_id") % 5 + 1).cast("int")
    return df.withColumn("bert_label", stars_label(stars)).withColumn("bert_score", stars_score(stars))


@register("sentiment_policy_override")
def q_sentiment_policy_override(spark, sf):
    df = apply_sentiment_policy(_with_model_columns(reviews(spark, sf)), "override")
    return df.select("review_id", "sentiment_label", "sentiment_score")


@register("sentiment_policy_fill")
def q_sentiment_policy_fill(spark, sf):
    # the label column exists (kept), the score column does not (filled)
    df = apply_sentiment_policy(_with_model_columns(reviews(spark, sf)).drop("sentiment_score"), "fill")
    return df.select("review_id", "sentiment_label", "sentiment_score")


@register("dedup_first")
def q_dedup_first(spark, sf):
    """Same dedup in its SQL ``QUALIFY`` form (window strategy)."""
    return dedup_first(P.normalise_product_pages(L.product_page_payloads(spark, sf)), "review_id", ["date"],
                       strategy="window")


@register("jsonld_extract")
def q_jsonld_extract(spark, sf):
    """Every JSON-LD block of every review page, and whether it parses."""
    from reviewlake.functions.html import script_blocks
    from reviewlake.functions.jsonfn import decode
    from reviewlake.schema import REVIEW_PAGE_LD
    pages = L.review_page_payloads(spark, sf)
    b = pages.select("lang", "city", "page", F.posexplode(script_blocks(F.col("html"))).alias("block", "body"))
    return b.select("lang", "city", "page", F.col("block").cast("long").alias("block"),
                    decode(F.col("body"), REVIEW_PAGE_LD, corrupt=True)["_corrupt_record"].isNull().alias("parsed"))


@register("pages_jsonld_reviews")
def q_pages_jsonld_reviews(spark, sf):
    """The review-page extractor over every raw web page of ``pages``, each
    with a block built from the page's own title and URL added."""
    p = read_table(spark, sf, "pages")
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    block = F.to_json(F.struct(F.array(F.struct(F.concat(title, F.lit(" "), F.col("url")).alias("description"),
                                                F.struct((F.col("page_id") % 5 + 1).cast("string").alias("ratingValue")).alias("reviewRating"),
                                                F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("author"))).alias("review")))
    p = p.withColumn("html", F.concat("html", F.lit(L.LD_OPEN), block, F.lit(L.LD_CLOSE)))
    p = p.select("html", F.regexp_extract("url", r"/([a-z]{2})/", 1).alias("lang"),
                 F.lit(None).cast("string").alias("city"), F.to_timestamp(F.lit(L.FETCHED_AT)).alias("fetched_at"))
    return P.normalise_review_pages(p, "html")


@register("pages_script_forms")
def q_pages_script_forms(spark, sf):
    """Script blocks of every raw web page of ``pages``, each behind a block
    written in one of ten ways that an HTML parser tells apart."""
    from reviewlake.functions.html import script_blocks
    body = F.concat(F.lit('{"page": '), F.col("page_id").cast("string"), F.lit(', "tag": "<!--"}'))
    forms = [('<script type="application/ld+json">', "</script>"), ("<script type=application/ld+json>", "</script>"),
             ('<script data-rule="a > b" type="application/ld+json">', "</script>"),
             ('<script type="application/ld+json">', "</script >"), ("<SCRIPT async TYPE = 'Application/LD+JSON'\n>", "</ScRiPt/>"),
             ('<script type="application&#47;ld&#43;json">', "</script>"),
             ('<!-- <script type="application/ld+json">', "</script> -->"), ("<i title='<script type=\"application/ld+json\">", "</script>'></i>"),
             ('<textarea><script type="application/ld+json">', "</script></textarea>"),
             ('<script data-type="application/ld+json">', "</script>")]
    wrapped = F.concat(*[F.when(F.col("page_id") % len(forms) == k, F.concat(F.lit(a), body, F.lit(b))).otherwise("") for k, (a, b) in enumerate(forms)])
    p = read_table(spark, sf, "pages").select("page_id", script_blocks(F.concat(wrapped, F.coalesce("html", F.lit("")))).alias("blocks"))
    return p.select("page_id", F.size("blocks").cast("long").alias("blocks"), F.get("blocks", F.lit(0)).alias("first_block"))


@register("upsert_bucketed")
def q_upsert_bucketed(spark, sf):
    """The upsert against a table stored bucketed by review_id: the table
    side is read pre-partitioned and only the batch is shuffled."""
    from reviewlake.session import scratch_path
    from reviewlake.sinks.files import buckets_for, rows_and_bytes, save_bucketed
    name = f"reviews_{uuid.uuid4().hex[:10]}"
    table = stage(stored_table(spark, sf), "stored")
    rows, size = rows_and_bytes(table)
    buckets = buckets_for(rows, size=size)
    save_bucketed(table, name, "review_id", buckets, path=scratch_path(spark, name))
    try:
        return stage(upsert(spark.table(name), stage(relabel_batch(spark, sf), "relabel-batch"), "review_id", UPDATE_SENTIMENT,
                            now=F.to_timestamp(F.lit(BATCH_INGESTED_AT)), buckets=buckets), "upserted")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@register("store_partitioned")
def q_store_partitioned(spark, sf):
    """Stored table written partitioned by source; the dashboard's source
    filter then prunes whole folders (``PartitionFilters``) before reading."""
    from reviewlake.operators.filters import dashboard_filter
    from reviewlake.operators.metrics import verify_by_sentiment
    from reviewlake.session import scratch_path
    from reviewlake.sinks.files import write_parquet
    path = scratch_path(spark, "stored_by_source")
    write_parquet(stored_table(spark, sf), path, partition_by=["source"])
    t = spark.read.parquet(path)
    return verify_by_sentiment(dashboard_filter(t, sources=PARTITION_SOURCES))


PARTITION_SOURCES = ["src1", "src3", "src5", "src7"]
