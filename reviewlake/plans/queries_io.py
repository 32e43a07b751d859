"""Registered queries: topic records, file round trips, streaming, jobs,
scalar functions and lookups.

Queries that write (round trips, streams, jobs) use a fresh folder under
the session's shared checkpoint folder for every run.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.functions import numeric as N
from reviewlake.functions import text as T
from reviewlake.functions import timefn as TM
from reviewlake.operators.filters import min_length
from reviewlake.plans import jobs
from reviewlake.plans.queries_more import (
    BATCH_INGESTED_AT, landed_sources, relabel_batch, stored_table,
)
from reviewlake.registry import register
from reviewlake.schema import REVIEW
from reviewlake.session import scratch_path, stored_bytes
from reviewlake.sinks import files as S
from reviewlake.sources import topic as TP
from reviewlake.sources.tables import read_table, reviews, stage
from reviewlake.streaming import ingest as ST

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Events published to a 3-partition topic keyed by user (envelope rows)."""
    ev = read_table(spark, sf, "events")
    enc = ev.select(F.col("user_id").cast("string").alias("key_src"), *EVENT_COLS)
    recs = TP.encode_records(enc, "key_src", EVENT_COLS, keep=("event_id", "ts"))
    return TP.envelope(recs, "reviews.raw", 3, F.col("key"), F.col("event_id"), F.col("ts"))


def _review_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Adapter rows in the canonical record layout (date as ISO text)."""
    r = reviews(spark, sf)
    return r.select("review_id", "source", "store_id",
                    F.concat(F.lit("Store "), F.col("store_id")).alias("store_name"),
                    "store_city", "rating", "text", "language", TM.iso(F.col("date")).alias("date"),
                    F.lit(C.OTHER).alias("sport_category"), F.lit(None).cast("string").alias("collected_at"))


# ------------------------------------------------------------------ topic
@register("topic_roundtrip")
def q_topic_roundtrip(spark, sf):
    """Publish encoding → envelope → decode: the events come back intact."""
    return TP.decode_records(_events_topic(spark, sf), EVENTS_SCHEMA)


@register("bounded_consume")
def q_bounded_consume(spark, sf):
    """The first 200 messages of the topic in log order."""
    return TP.decode_records(TP.bounded(_events_topic(spark, sf), 200), EVENTS_SCHEMA)


@register("props_decode")
def q_props_decode(spark, sf):
    """JSON text → struct field, malformed → null (never an exception)."""
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k int", {"mode": "PERMISSIVE"})["k"].alias("k"))


# ---------------------------------------------------------- file round trips
@register("json_roundtrip")
def q_json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    S.write_json(_review_rows(spark, sf), path)
    return S.read_json(spark, path, REVIEW)


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    S.write_csv(_review_rows(spark, sf), path)
    return S.read_csv(spark, path, REVIEW)


@register("first_available")
def q_first_available(spark, sf):
    """Priority list: two missing folders, then the written one."""
    path = scratch_path(spark, "avail")
    S.write_json(_review_rows(spark, sf), path)
    missing = [scratch_path(spark, "missing"), scratch_path(spark, "missing")]
    _, df = S.first_available(spark, missing + [path], lambda s, p: S.read_json(s, p, REVIEW))
    return df


# --------------------------------------------------------------- streaming
@register("stream_ingest")
def q_stream_ingest(spark, sf):
    """Topic files → stream (available-now) → decoded review files."""
    base = scratch_path(spark, "stream")
    _events_topic(spark, sf).write.parquet(f"{base}/topic")
    topic_schema = spark.read.parquet(f"{base}/topic").schema
    stream = ST.read_topic_stream(spark, "parquet", topic_schema, path=f"{base}/topic", max_per_trigger=2)
    q, _ = ST.ingest(stream, EVENTS_SCHEMA, f"{base}/sink", f"{base}/ckpt", f"{base}/rejects")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink").drop("batch")


@register("stream_rejects")
def q_stream_rejects(spark, sf):
    """Some values are cut short: they go to the reject output, the rest to
    the sink, and the counters know both."""
    base = scratch_path(spark, "stream")
    cut = F.when(F.col("offset") % 97 == 0, F.substring(F.col("value").cast("string"), 1, 9).cast("binary")).otherwise(F.col("value"))
    _events_topic(spark, sf).withColumn("value", cut).write.parquet(f"{base}/topic")
    stream = ST.read_topic_stream(spark, "parquet", spark.read.parquet(f"{base}/topic").schema, path=f"{base}/topic", max_per_trigger=1)
    q, got = ST.ingest(stream, EVENTS_SCHEMA, f"{base}/sink", f"{base}/ckpt", f"{base}/rejects")
    q.awaitTermination()
    n = spark.read.parquet(f"{base}/sink").agg(F.count(F.lit(1)).alias("good"))
    bad = spark.read.parquet(f"{base}/rejects").agg(F.count(F.lit(1)).alias("rejected"), F.max(F.length("_raw")).alias("raw_length"))
    return n.join(bad).select(F.lit(got.records).cast("long").alias("received"), F.lit(got.malformed).cast("long").alias("malformed"),
                              "good", "rejected", F.col("raw_length").cast("long").alias("raw_length"))


@register("stream_upsert")
def q_stream_upsert(spark, sf):
    """Two records per key arrive as a stream, in several micro-batches and
    over a restart; the table after them has the columns of the first
    insert and the sentiment of the latest record."""
    base = scratch_path(spark, "supsert")
    late = relabel_batch(spark, sf)
    early = late.withColumns({"sentiment_label": F.lit("early"), "sentiment_score": F.lit(-1).cast("decimal(5,3)"), "offset": F.lit(0).cast("long")})
    late = late.withColumns({"review_text": F.concat(F.lit("later "), F.col("review_text")), "offset": F.lit(1).cast("long")})
    log = early.unionByName(late).withColumns({"timestamp": F.to_timestamp(F.lit(BATCH_INGESTED_AT)), "partition": F.lit(0)})
    log.where("offset = 1").write.parquet(f"{base}/in")             # arrival order is not log order
    for part in (log.where("offset = 0"), None):
        schema = spark.read.parquet(f"{base}/in").schema
        stream = ST.read_topic_stream(spark, "parquet", schema, path=f"{base}/in", max_per_trigger=1)
        ST.stream_changes(stream, f"{base}/changes", f"{base}/ckpt").awaitTermination()
        if part is not None:
            part.write.mode("append").parquet(f"{base}/in")
    changes = spark.read.parquet(f"{base}/changes")
    return ST.current(stored_table(spark, sf), changes, now=F.to_timestamp(F.lit(BATCH_INGESTED_AT)))


# -------------------------------------------------------------------- jobs
@register("gates")
def q_gates(spark, sf):
    """Non-empty input gate over the stored table (fails on empty input)."""
    return jobs.require_nonempty(stored_table(spark, sf), "reviews")


@register("processing_job")
def q_processing_job(spark, sf):
    """The processing job end to end; returns the verified output rows."""
    path = scratch_path(spark, "processed")
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    stored = d.select(F.concat(F.lit("r_"), F.col("doc_id").cast("string")).alias("review_id"),
                      F.col("text").alias("review_text"))
    jobs.processing_job(spark, stored, path)
    return spark.read.parquet(path).select("review_id", "review_length", "length_category")


@register("weekly_batch_load")
def q_weekly_batch_load(spark, sf):
    """collect → sentiment + category → publish (topic files) → load (first
    load of the table)."""
    with landed_sources(spark, sf) as landed:
        return _first_load(spark, landed)


def _first_load(spark, landed: dict[str, DataFrame], load_path: str | None = None, slices: int = 1) -> DataFrame:
    return jobs.batch_load(spark, jobs.flag_sources(landed), ingested_at=F.to_timestamp(F.lit(BATCH_INGESTED_AT)),
                           topic_path=scratch_path(spark, "published"), reject_path=scratch_path(spark, "rejects"),
                           item_reject_path=scratch_path(spark, "item-rejects"), load_path=load_path, slices=slices)


@register("batch_load_incremental")
def q_batch_load_incremental(spark, sf):
    """A second weekly load into the table of the first: known reviews get
    the new sentiment, new ones are inserted.  Both loads land from one table
    of reviews, which goes once the second has read it; the first one's working
    table goes as its result is stored."""
    from reviewlake.sources import payloads as P
    slices = jobs.slices_for(stored_bytes(spark, f"{sf.rstrip('/')}/documents.parquet"))
    with ExitStack() as landing:
        landed = landing.enter_context(landed_sources(spark, sf))
        table = _first_load(spark, landed, scratch_path(spark, "loaded"), slices)
        again = P.normalise_play(landed["play"]).withColumn("text", F.concat(F.lit("Worst, useless. "), F.col("text")))
        fresh = again.withColumn("review_id", F.concat(F.lit("new_"), F.col("review_id")))
        return jobs.batch_load(spark, [again, fresh], table=table, ingested_at=F.to_timestamp(F.lit("2026-03-01 00:00:00")),
                               reject_path=scratch_path(spark, "rejects"), sources_read=landing.close)


def _load(spark, sf, columns: dict, policy: str) -> DataFrame:
    """A JSON review file with only these sentiment columns, loaded under a
    policy that decides by the columns of the file."""
    path = scratch_path(spark, "load")
    S.write_json(_review_rows(spark, sf).join(reviews(spark, sf).select("review_id", *[c.alias(n) for n, c in columns.items()]), "review_id"), path)
    return jobs.load_reviews(spark, path, policy).select("review_id", "sentiment_label", "sentiment_score")


@register("load_lexicon_only")
def q_load_lexicon_only(spark, sf):
    """A file without model columns keeps its sentiment under "override"."""
    return _load(spark, sf, {"sentiment_label": F.col("sentiment_label"), "sentiment_score": F.col("sentiment_score")}, "override")


@register("load_model_only")
def q_load_model_only(spark, sf):
    """A file with model columns only gets them as its sentiment under "fill"."""
    stars = (F.col("doc_id") % 5 + 1).cast("int")
    return _load(spark, sf, {"bert_label": N.stars_label(stars), "bert_score": N.stars_score(stars)}, "fill")


@register("explorer_page_after")
def q_explorer_page_after(spark, sf):
    """The second page by key: what follows the last row of the first."""
    from reviewlake.operators.metrics import explorer_page_after
    r = reviews(spark, sf)
    last = explorer_page_after(r, None, "positive", "Lowest Rating", 20).collect()[-1]      # a page of 20 rows
    return explorer_page_after(r, (last["sort_value"], last["review_id"]), "positive", "Lowest Rating", 20)


@register("dashboard_page")
def q_dashboard_page(spark, sf):
    """All panels of one filtered page, in long form."""
    from reviewlake.plans.dashboard import dashboard, release
    from reviewlake.registry import DASH
    from reviewlake.sources.tables import classified_reviews
    p = dashboard(classified_reviews(spark, sf), **DASH, explorer_sort="Lowest Rating", per_page=10)

    def long(panel, item, value):
        return p[panel].select(F.lit(panel).alias("panel"), F.col(item).cast("string").alias("item"), F.col(value).cast("double").alias("value"))
    parts = [long("kpis", "delta_class", "avg_rating"), long("insight_worst_category", "sport_category", "value"),
             long("insight_best_category", "sport_category", "value"), long("insight_negative_city", "store_city", "n"),
             long("rating_by_category", "sport_category", "avg_rating_2dp"), long("sentiment_distribution", "label", "pct"),
             long("negatives_by_category", "sport_category", "n"), long("rating_trend", "month", "rating_count"),
             long("explorer_page", "review_id", "pos"), long("explorer_summary", "total", "total_pages"),
             long("filter_options", "column_name", "value").groupBy("panel", "item").agg(F.count(F.lit(1)).cast("double").alias("value"))]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    out = stage(out, "page")
    release(p)
    return out


# ------------------------------------------------------- scalar functions
@register("string_functions")
def q_string_functions(spark, sf):
    r = reviews(spark, sf).withColumn("sport_category", F.lit("water_sports"))
    return r.select(
        "review_id",
        T.length_cp(F.col("text")).alias("n_chars"),
        F.lower("text").alias("lower"),
        T.prefix(F.col("text"), 12).alias("head"),
        T.preview(F.col("text"), 8).alias("preview"),
        T.strip_chars(F.concat(F.lit(". "), F.col("text"), F.lit(". .")), ". ").alias("stripped"),
        T.zero_pad(F.col("doc_id") % 1000, 5).alias("padded"),
        F.concat(F.lit("syn_"), T.zero_pad(F.col("doc_id"), 5)).alias("syn_id"),
        T.contains_any(F.lower("text"), ["bike", "swim", "gym"]).alias("has_sport_word"),
        T.title_case(F.concat(F.col("language"), F.lit("_"), F.col("sport_category"))).alias("title"),
        T.ljust(F.col("language"), 4).alias("lang_padded"),
        T.bar(F.floor(F.col("rating") * 2)).alias("bar"),
        # null for a null rating; double so the column has no nullable-int form
        T.leading_int(F.concat(F.floor("rating").cast("string"), F.lit(" stars"))).cast("double").alias("stars"),
        T.hash_id("tp_", F.col("text")).alias("hashed_id"),
    )


@register("numeric_functions")
def q_numeric_functions(spark, sf):
    r = reviews(spark, sf)
    x = F.col("sentiment_score") * F.lit(0.37) + F.col("doc_id") / F.lit(1000.0)
    return r.select(
        "review_id",
        N.round_half_up(x, 1).alias("r1"), N.round_half_up(x, 2).alias("r2"),
        N.round_half_up(x, 3).alias("r3"), N.round_half_up(x, 4).alias("r4"),
        N.clamp(F.col("rating") + (F.col("doc_id") % 7 - 3) * F.lit(0.3), 1.0, 5.0).alias("clamped"),
        F.abs(F.col("sentiment_score")).alias("abs_score"),
        N.ceil_div(F.col("doc_id"), 7).alias("pages"),
        N.pct(F.col("doc_id") % 13, F.col("doc_id") % 17, 1).alias("share"),
        F.col("rating").try_cast("decimal(3,1)").alias("rating_dec"),
        (F.col("rating") * 20).try_cast("decimal(3,1)").alias("overflow_is_null"),
    )


@register("default_values")
def q_default_values(spark, sf):
    r = reviews(spark, sf)
    return r.select("review_id",
                    F.coalesce(F.col("store_city"), F.lit("unknown")).alias("city"),
                    F.coalesce(F.col("rating"), F.lit(C.DEFAULT_RATING)).alias("rating"),
                    T.nullif_empty(F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("language"))).alias("lang"),
                    F.coalesce(T.nullif_empty(F.when(F.col("doc_id") % 2 == 0, F.lit("")).otherwise(F.col("text"))),
                               F.col("store_id")).alias("text_or_store"))


@register("time_functions")
def q_time_functions(spark, sf):
    """Epoch ↔ timestamp, ISO text with offsets → UTC, months, day shifts."""
    ev = read_table(spark, sf, "events")
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)
    with_offset = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return ev.select(
        "event_id",
        TM.epoch_to_ts(epoch).alias("from_epoch"),
        TM.parse_ts(with_offset).alias("utc_from_offset"),
        TM.parse_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("naive_fraction"),
        TM.parse_ts(F.concat(F.lit("garbage-"), F.col("event_type"))).alias("garbage"),
        TM.month(F.col("ts")).alias("month"),
        TM.days_before(F.col("ts").cast("timestamp"), F.col("user_id") % 180).alias("days_back"),
        TM.iso(F.col("ts")).alias("iso"),
    )


@register("forum_rating")
def q_forum_rating(spark, sf):
    """Vote score → 1..5 rating over the events' values (as scores)."""
    ev = read_table(spark, sf, "events")
    score = (F.col("value") * 10 - 100).cast("long")
    return ev.select("event_id", score.alias("score"), N.vote_to_rating(score).alias("rating"))


@register("label_lookup")
def q_label_lookup(spark, sf):
    """Code → display-name / colour lookups with a default."""
    r = reviews(spark, sf)
    names = F.create_map(*[x for k, v in C.LANGUAGE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    colors = F.create_map(*[x for k, v in C.SENTIMENT_COLORS.items() for x in (F.lit(k), F.lit(v))])
    return r.select("review_id",
                    F.coalesce(names[F.col("language")], F.col("language")).alias("language_name"),
                    F.coalesce(colors[F.col("sentiment_label")], F.lit(C.COLOR_DEFAULT)).alias("sentiment_color"))


@register("canonical_record")
def q_canonical_record(spark, sf):
    """Adapter rows built into the canonical record (category "other",
    rating as double, collection time from the landing)."""
    r = reviews(spark, sf)
    return r.select("review_id", "source", "store_id",
                    F.concat(F.lit("Store "), F.col("store_id")).alias("store_name"), "store_city",
                    F.col("rating").cast("string").try_cast("double").alias("rating"), "text", "language",
                    TM.iso(F.col("date")).alias("date"), F.lit(C.OTHER).alias("sport_category"),
                    F.lit("2026-01-01T00:00:00").alias("collected_at"))


@register("min_length_filter")
def q_min_length_filter(spark, sf):
    """Documents whose full text has at least 2000 characters."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return min_length(d, "text", 2000).select("doc_id", F.length("text").alias("n_chars"))


@register("synthetic_reviews")
def q_synthetic_reviews(spark, sf):
    """One seeded synthetic review per document."""
    from reviewlake.sources.synth import synthetic_reviews
    ids = read_table(spark, sf, "documents").select("doc_id")
    return synthetic_reviews(ids, "doc_id", seed=42, base_date="2026-01-01 00:00:00")


@register("store_rejects")
def q_store_rejects(spark, sf):
    """Rows whose value overflows the stored decimal go to a reject output
    (here: ratings on a 0–125 scale into ``decimal(3,1)``)."""
    from reviewlake.operators.projections import split_rejects
    r = reviews(spark, sf).withColumn("rating", F.col("rating") * F.lit(25.0))
    _, rejects = split_rejects(r.drop("doc_id"))
    return rejects.select("review_id", "rating")


@register("publish_counts")
def q_publish_counts(spark, sf):
    """Publish the events to a topic folder counting sent records during the
    write (``observe``), read the topic back and count received records."""
    from pyspark.sql import Observation
    path = scratch_path(spark, "topic")
    obs = Observation("published")
    enc = TP.encode_records(read_table(spark, sf, "events").withColumn("k", F.col("user_id").cast("string")), "k",
                            EVENT_COLS)
    TP.write_topic(enc.observe(obs, F.count(F.lit(1)).alias("n")), "reviews.raw", fmt="parquet", path=path)
    sent = obs.get["n"]
    received = TP.read_topic(spark, "parquet", path=path)
    return TP.decode_records(received, EVENTS_SCHEMA).agg(
        F.lit(sent).cast("long").alias("published"), F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("_malformed")).alias("failed"))


@register("label_lookup_table")
def q_label_lookup_table(spark, sf):
    """Language display names from a lookup table (joined without a hint)."""
    from reviewlake.operators.lookup import lookup_join
    names = spark.createDataFrame(list(C.LANGUAGE_NAMES.items()), "code string, name string")
    return lookup_join(reviews(spark, sf), names, "language", "code", "name", "language_name").select(
        "review_id", "language_name")
