"""Streams give the batch result, however they are cut."""

from pyspark.sql import functions as F

from reviewlake.registry import all_queries
from reviewlake.sources import topic as TP
from reviewlake.streaming import ingest as ST

SCHEMA = "review_id string, sentiment_label string, text string, ingested_at timestamp, timestamp timestamp, partition int, offset long"


def now():
    return F.to_timestamp(F.lit("2026-02-01 00:00:00"))


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def log(spark, records):
    """(id, label, text, offset) → change records."""
    return spark.createDataFrame([(i, l, t, None, None, 0, o) for i, l, t, o in records], SCHEMA) \
        .withColumn("timestamp", F.to_timestamp(F.lit("2026-01-05 00:00:00")))


def test_stream_ingest_equals_batch(spark, sf):
    q = all_queries()
    assert rows(q["stream_ingest"](spark, sf)) == rows(q["topic_roundtrip"](spark, sf).drop("_malformed"))


def test_stream_upsert_equals_batch_upsert(spark, sf):
    q = all_queries()
    assert rows(q["stream_upsert"](spark, sf)) == rows(q["upsert_sentiment"](spark, sf))


def apply_stream(spark, tmp_path, name, parts):
    base = str(tmp_path / name)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = ST.read_topic_stream(spark, "parquet", part.schema, path=f"{base}/in", max_per_trigger=1)
        ST.stream_changes(stream, f"{base}/changes", f"{base}/ckpt").awaitTermination()
    return spark.read.parquet(f"{base}/changes")


def test_latest_record_wins_in_any_batches_and_after_a_restart(spark, tmp_path):
    table = log(spark, [("a", "neutral", "stored", 0)]).drop("timestamp", "partition", "offset")
    records = [("a", "negative", "x", 1), ("a", "positive", "y", 2), ("n", "negative", "first", 3), ("n", "positive", "last", 4), (None, "lost", "no key", 5)]
    want = {"a": ("positive", "stored"), "n": ("positive", "first")}
    one = [log(spark, records)]
    many = [log(spark, [r]) for r in (records[3], records[0], records[4], records[2], records[1])]      # arrival is not log order
    for name, parts in (("one", one), ("many", many)):
        got = ST.current(table, apply_stream(spark, tmp_path, name, parts), update_cols=("sentiment_label",), now=now()).collect()
        assert {r.review_id: (r.sentiment_label, r.text) for r in got} == want
    empty = ST.current(None, log(spark, records), update_cols=("sentiment_label",), now=now())
    assert empty.columns == table.columns
    assert {r.review_id: r.sentiment_label for r in empty.collect()} == {"a": "positive", "n": "positive"}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "c")
    calls = []

    class Writer:
        def foreachBatch(self, fn):
            calls.append(fn)
            return self

        def option(self, *a):
            return self

        def trigger(self, **k):
            return self

        def start(self):
            return None

    class Stream:
        writeStream = Writer()
    ST.stream_changes(Stream(), out, "unused")
    batch = log(spark, [("a", "positive", "x", 1)])
    calls[0](batch, 7)
    calls[0](batch, 7)                       # the same micro-batch again, after a failure
    assert spark.read.parquet(out).count() == 1


def test_received_count_is_exact_beyond_a_hundred_batches(spark, tmp_path):
    base, n = str(tmp_path), 130
    enc = TP.encode_records(spark.range(2 * n).select(F.col("id").alias("k")), "k").repartition(n)
    enc.write.parquet(f"{base}/topic")
    bad = spark.createDataFrame([(b"k", b"{cut")], "key binary, value binary")
    bad.write.mode("append").parquet(f"{base}/topic")
    stream = ST.read_topic_stream(spark, "parquet", enc.schema, path=f"{base}/topic", max_per_trigger=1)
    q, got = ST.ingest(stream, "k long", f"{base}/sink", f"{base}/ckpt", f"{base}/rejects")
    q.awaitTermination()
    assert len(got.batches) > 100 and got.records == 2 * n + 1 and got.malformed == 1
    assert spark.read.parquet(f"{base}/sink").count() == 2 * n
    assert [r["_raw"] for r in spark.read.parquet(f"{base}/rejects").collect()] == ["{cut"]


def test_compact_writes_the_table_after_the_changes(spark, tmp_path):
    table = log(spark, [("a", "neutral", "stored", 0)]).drop("timestamp", "partition", "offset")
    ST.compact(table, log(spark, [("a", "positive", "x", 1)]), str(tmp_path / "base"), update_cols=("sentiment_label",), now=now())
    assert [(r.review_id, r.sentiment_label) for r in spark.read.parquet(str(tmp_path / "base")).collect()] == [("a", "positive")]


def test_compact_replaces_the_base_it_reads(spark, tmp_path):
    path = str(tmp_path / "base")
    log(spark, [("a", "neutral", "old", 0), ("b", "neutral", "kept", 0)]).drop("timestamp", "partition", "offset").write.parquet(path)
    ST.compact(spark.read.parquet(path), log(spark, [("a", "positive", "x", 1)]), path, update_cols=("sentiment_label",), now=now())
    spark.catalog.refreshByPath(path)
    assert {(r.review_id, r.sentiment_label) for r in spark.read.parquet(path).collect()} == {("a", "positive"), ("b", "neutral")}
