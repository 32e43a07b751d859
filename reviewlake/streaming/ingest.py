"""Structured Streaming: topic → review files, and stream → keyed table.

Both write each micro-batch to a folder named by its batch id, overwriting
it: a batch that is replayed after a failure replaces itself.

* ``ingest``: read the topic from the earliest offset (the checkpoint holds
  the position from then on — it replaces a consumer group's committed
  offsets, and is only advanced after a batch is written), decode, and write
  good records to the sink and malformed ones to the reject output; with
  ``available_now`` it stops at the end of the data.
* ``stream_changes`` appends a keyed stream's records as they are;
  ``current`` is the table after them: per key the columns of an insert come
  from its earliest record in log order and the update columns from its
  latest, whatever the micro-batches were.  ``compact`` writes that as a new
  base.  Where the catalog has row-level operations, ``merge_into`` does the
  same in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlake.operators.merge import UPDATE_SENTIMENT, upsert
from reviewlake.sources.tables import stage
from reviewlake.sources.topic import decode_records

LOG_ORDER = ("timestamp", "partition", "offset")


def read_topic_stream(spark: SparkSession, fmt: str, schema: StructType | None = None,
                      options: dict | None = None, path: str | None = None,
                      max_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        r = r.option("startingOffsets", "earliest")
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
    elif max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    if schema is not None:
        r = r.schema(schema)
    r = r.options(**(options or {}))
    return r.load(path) if path else r.load()


def _start(stream: DataFrame, write, checkpoint: str, available_now: bool):
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


class Received:
    """Records per batch id, as observed while they were written."""

    def __init__(self):
        self.batches: dict[int, tuple[int, int]] = {}

    @property
    def records(self) -> int:
        return sum(n for n, _ in self.batches.values())

    @property
    def malformed(self) -> int:
        return sum(m for _, m in self.batches.values())


def ingest(stream: DataFrame, value_schema: StructType | str, sink_path: str, checkpoint: str, reject_path: str,
           available_now: bool = True, keep: tuple[str, ...] = ()):
    """Decode the envelope; good records go to ``sink_path``, malformed ones
    (key and raw value) to ``reject_path``.  Returns the started query and
    its ``Received`` counters."""
    counts = Received()

    def write(batch: DataFrame, batch_id: int) -> None:
        obs = Observation()
        decoded = decode_records(batch.withColumn("_raw", F.col("value").cast("string")), value_schema, keep=(*keep, "_raw")) \
            .observe(obs, F.count(F.lit(1)).alias("n"), F.count_if(F.col("_malformed")).alias("bad")) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            decoded.where(~F.col("_malformed")).drop("_raw", "_malformed").write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")
            decoded.where(F.col("_malformed")).select(*keep, "key", "_raw").write.mode("overwrite").parquet(f"{reject_path}/batch={batch_id}")
            counts.batches[batch_id] = (obs.get["n"], obs.get["bad"])
        finally:
            decoded.unpersist()

    return _start(stream, write, checkpoint, available_now), counts


def stream_changes(stream: DataFrame, changes_path: str, checkpoint: str, available_now: bool = True):
    """Append the stream's records, one folder per micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes_path}/batch={batch_id}")

    return _start(stream, write, checkpoint, available_now)


def fold(changes: DataFrame, key: str = "review_id", update_cols: Sequence[str] = UPDATE_SENTIMENT,
         order: Sequence[str] = LOG_ORDER) -> DataFrame:
    """One row per key: what applying its records one by one would insert
    and then update.  Records equal in ``order`` are ordered by content."""
    cols = [c for c in changes.columns if c != key]
    at = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in cols])
    first, last = F.min(at).alias("_first"), F.max(at).alias("_last")
    g = changes.where(F.col(key).isNotNull()).groupBy(key).agg(first, last)
    return g.select(key, *[F.col("_last" if c in update_cols else "_first")[c].alias(c) for c in cols])


def current(base: DataFrame | None, changes: DataFrame, key: str = "review_id",
            update_cols: Sequence[str] = UPDATE_SENTIMENT, order: Sequence[str] = LOG_ORDER,
            now: Column | None = None, stamp_col: str = "ingested_at") -> DataFrame:
    """The keyed table after all ``changes`` (null keys are left out)."""
    batch = fold(changes, key, update_cols, order)
    if base is None:
        stamp = F.current_timestamp() if now is None else now
        kept = batch.drop(*LOG_ORDER, "batch")
        return kept.withColumn(stamp_col, stamp.cast("timestamp")) if stamp_col in kept.columns else kept
    return upsert(base, stage(batch, "folded-changes"), key, update_cols, now, stamp_col)


def compact(base: DataFrame | None, changes: DataFrame, path: str, **kw) -> None:
    """Write the table after ``changes`` as a new base at ``path``, which may
    be the folder of the old one: the result is written beside it first, and
    a run that dies while replacing it leaves that copy in the shared folder."""
    stage(current(base, changes, **kw), "compacted").write.mode("overwrite").parquet(path)
