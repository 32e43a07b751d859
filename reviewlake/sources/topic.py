"""Topic (message log) records: encode rows for publishing, decode them
back, and bounded batch reads.

Encoding and decoding are pure column transforms, so they work the same
on a Kafka source/sink, on a file holding the envelope, or in a stream.
The Kafka connector jar is not bundled here; pass ``fmt="kafka"`` and the
usual ``kafka.*`` options where it is on the classpath.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlake.functions.jsonfn import decode, encode
from reviewlake.functions.text import nullif_empty

# Producer settings of the publishing job: every replica acknowledges,
# three retries, gzip batches.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.compression.type": "gzip"}


def encode_records(df: DataFrame, key_col: str | None = "store_id", value_cols: list[str] | None = None,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows → ``(key binary, value binary)`` (+ ``keep`` columns, e.g. to
    build the envelope without parsing the value back).

    Key: UTF-8 of ``key_col`` (null when empty or absent).  Value: UTF-8 JSON
    of the row (or of ``value_cols``) with null fields kept and non-ASCII
    characters unescaped."""
    cols = value_cols or df.columns
    key = (F.lit(None).cast("binary") if key_col is None
           else nullif_empty(F.col(key_col).cast("string")).cast("binary"))
    return df.select(key.alias("key"), encode(F.struct(*[F.col(c) for c in cols])).cast("binary").alias("value"),
                     *[F.col(c) for c in keep])


def decode_records(df: DataFrame, schema: StructType | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``value`` JSON → the fields of ``schema`` (+ ``key`` as text and any
    ``keep`` envelope columns).  A malformed value gives null fields and
    ``_malformed = true`` instead of failing the read."""
    v = decode(F.col("value").cast("string"), schema, corrupt=True)
    out = df.select(*[F.col(k) for k in keep], F.col("key").cast("string").alias("key"), v.alias("_v"))
    fields = [f for f in out.schema["_v"].dataType.fieldNames() if f != "_corrupt_record"]
    return out.select(*keep, "key", *[F.col("_v")[f].alias(f) for f in fields],
                      F.col("_v")["_corrupt_record"].isNotNull().alias("_malformed"))


def read_topic(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
               path: str | None = None) -> DataFrame:
    """Batch read of a whole topic from the earliest offset."""
    opts = {"startingOffsets": "earliest"} if fmt == "kafka" else {}
    opts.update(options or {})
    r = spark.read.format(fmt).options(**opts)
    return r.load(path) if path else r.load()


def bounded_options(topic: str, starts: dict[int, int], ends: dict[int, int], max_messages: int) -> dict[str, str]:
    """Kafka read options for ``bounded``: from the position ``starts`` of each
    partition (as the consumer group or an earlier run left it) at most
    ``max_messages`` records, and none beyond its present end ``ends``.  The
    first ``max_messages`` in log order lie in them, so no more is read."""
    ends = {p: min(ends[p], at + max_messages) for p, at in starts.items()}
    return {"subscribe": topic, "startingOffsets": json.dumps({topic: {str(p): o for p, o in starts.items()}}),
            "endingOffsets": json.dumps({topic: {str(p): o for p, o in ends.items()}})}


def bounded(df: DataFrame, max_messages: int, order: list[Column] | None = None) -> DataFrame:
    """First ``max_messages`` records in log order (timestamp, partition,
    offset): a top-k, each task keeps only its first ``max_messages``."""
    order = order or [F.col("timestamp"), F.col("partition"), F.col("offset")]
    return df.orderBy(*order).limit(max_messages)


def write_topic(df: DataFrame, topic: str, fmt: str = "kafka", options: dict | None = None,
                path: str | None = None) -> None:
    """Publish encoded records (``key``, ``value``)."""
    w = df.write.format(fmt)
    if fmt == "kafka":
        w = w.option("topic", topic).options(**PRODUCER_OPTIONS)
    w = w.options(**(options or {}))
    if path:
        w.mode("append").save(path)
    else:
        w.save()


def envelope(df: DataFrame, topic: str, partitions: int, partition_key: Column, offset: Column,
             timestamp: Column) -> DataFrame:
    """Wrap encoded records in the topic envelope columns (for file-backed
    topics): partition = hash of the key modulo ``partitions``."""
    return df.select("key", "value", F.lit(topic).alias("topic"),
                     F.pmod(F.hash(partition_key), F.lit(partitions)).cast("int").alias("partition"),
                     offset.cast("long").alias("offset"), timestamp.alias("timestamp"))
