"""Keyed upsert of a batch into the review table (``INSERT … ON CONFLICT``).

Semantics, per key of the union of both sides:

* only in the table → the stored row, unchanged;
* only in the batch → the batch row (an insert), stamped ``ingested_at``;
* in both → the stored row with ``update_cols`` taken from the batch (an
  incoming null overwrites, as SQL does) and a new ``ingested_at``.

The batch must hold each key once and no null key (``dedup_first`` first —
one SQL statement cannot touch a row twice either); the call fails if not.

Plan: table LEFT JOIN batch gives the stored rows, batch LEFT ANTI table the
inserts.  Unlike a full outer join, AQE can split a skewed partition of
either, and a table that is stored bucketed by the key is not shuffled.
The key check and both joins read the batch: pass one that is stored (see
``sources.tables.stage``) where computing it is dear, as the jobs do.

``strategy="touched"`` is for wide rows of stored frames.  Which keys of the
batch the table holds is found on the keys alone; of the table only rows whose
key may be among them (see ``keybits``) are shuffled, the others stay where
they are, and of the batch only the few rows that the keys' bitmaps cannot tell.
With ``slice_col`` the touched rows are joined and stored slice by slice, so
their shuffle takes the room of one slice on disk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.operators.keybits import bits_for, key_bits, with_may_hold

UPDATE_SENTIMENT = ("sentiment_label", "sentiment_score")   # variant A
UPDATE_TOUCH_ONLY: tuple[str, ...] = ()                     # variant B


def check_keys(batch: DataFrame, key: str) -> None:
    """Raise if a key of the batch is null or repeated; reads the key column only."""
    fault = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col(key).isNull() | (F.col("_n") > 1)).select(key).first()
    if fault is not None:
        raise ValueError(f"null {key} in the batch" if fault[0] is None else f"repeated {key} in the batch: {fault[0]}")


def upsert(table: DataFrame, batch: DataFrame, key: str = "review_id",
           update_cols: Sequence[str] = UPDATE_SENTIMENT, now: Column | None = None,
           stamp_col: str = "ingested_at", buckets: int | None = None, strategy: str = "join",
           slice_col: str | None = None) -> DataFrame:
    """Return the table after the upsert (a new DataFrame; the table is not written).

    ``buckets``: the bucket count of a table bucketed by ``key``; the batch
    is then dealt into as many partitions and the rows of the table stay where
    they are (the anti join moves its key column only).
    ``strategy``: ``join``, or ``touched`` (see above), which reads table and
    batch several times and is not for a bucketed table.
    ``slice_col``: a column by whose few values the table is stored in folders
    (see ``sources.tables.SLICE``); no column of the result.  For ``touched`` only."""
    if strategy not in ("join", "touched") or (strategy == "touched" and buckets) or (strategy == "join" and slice_col):
        raise ValueError(strategy)
    now = F.current_timestamp() if now is None else now
    cols, types = [c for c in table.columns if c != slice_col], {f.name: f.dataType for f in table.schema.fields}
    check_keys(batch, key)
    s = batch
    if buckets:
        s = s.repartition(buckets, key)
    s = s.select(*[(F.col(c) if c in s.columns else F.lit(None)).cast(types[c]).alias(c) for c in cols])
    stamp = now.cast(types[stamp_col]) if stamp_col in types else None
    changes = s.select(F.col(key).alias("_k"), F.lit(True).alias("_hit"),
                       *[F.col(c).alias(f"_s_{c}") for c in update_cols if c in types and c not in (key, stamp_col)])
    touched, rest, known, unsure = table, None, None, s
    if strategy == "touched":
        changes, touched, rest, known, unsure = _touched(table, s, changes, key)
    hit = F.col("_hit").isNotNull()

    def stored(c: str) -> Column:
        if c == stamp_col:
            return F.when(hit, stamp).otherwise(F.col(c)).alias(c)
        if f"_s_{c}" in changes.columns:
            return F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    def updated(rows: DataFrame) -> DataFrame:
        return rows.join(changes, rows[key] == F.col("_k"), "left").select(*[stored(c) for c in cols])

    inserts = unsure.join(table.select(F.col(key).alias("_t")), F.col(key) == F.col("_t"), "left_anti")
    if known is not None:
        inserts = known.unionByName(inserts)
    if stamp is not None:
        inserts = inserts.withColumn(stamp_col, stamp)
    out = (_by_slice(touched, slice_col, updated) if slice_col else updated(touched)).unionByName(inserts.select(*cols))
    return out if rest is None else rest.select(*cols).unionByName(out)


def _by_slice(df: DataFrame, slice_col: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``change`` of ``df``, stored for one value of ``slice_col`` after the other."""
    from reviewlake.session import scratch_path, shuffles_dropped
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "updated")
    slices = sorted(r[0] for r in df.select(slice_col).distinct().collect())
    if not slices:
        return change(df)
    with shuffles_dropped(spark):
        for k in slices:
            change(df.where(F.col(slice_col) == k)).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _touched(table: DataFrame, batch: DataFrame, changes: DataFrame, key: str) -> tuple[DataFrame, ...]:
    """``changes`` of rows that the table holds, the rows of the table that
    may be touched and those that are not, the rows of the batch that the
    table surely lacks and those still to be looked up."""
    from reviewlake.sources.tables import stage
    held = table.select(F.col(key).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    # keys, flags and new values only; four readers
    marks = stage(changes.join(held, F.col("_k") == F.col("_t"), "left").withColumn("_held", F.col("_t").isNotNull()).drop("_t"), "changes")
    bits = bits_for(marks.count())
    found, missing = marks.where("_held"), marks.where("not _held")
    found_bits, missing_bits = key_bits(found, "_k", bits), key_bits(missing, "_k", bits)
    t = with_may_hold(table, key, found_bits, bits, "_may")
    b = with_may_hold(batch, key, found_bits, bits, "_may")
    unsure = with_may_hold(b.where("_may").drop("_may"), key, missing_bits, bits, "_may").where("_may").drop("_may")
    return found.drop("_held"), t.where("_may").drop("_may"), t.where("not _may").drop("_may"), b.where("not _may").drop("_may"), unsure


@contextmanager
def known_once(keys: DataFrame, table: DataFrame, key: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function that flags rows of a batch with the keys ``keys``, for
    what is written inside.  The flag is true only where the batch holds the
    key once and the table holds it too: of such a row ``upsert`` reads the
    key and ``update_cols``.  It may be false there as well (see ``keybits``)."""
    from reviewlake.session import drop_scratch, scratch_path, shuffles_dropped
    spark, path = keys.sparkSession, scratch_path(keys.sparkSession, "keys")
    held = table.select(F.col(key).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    counted = keys.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    marks = counted.join(held, F.col("_k") == F.col("_t"), "left").select("_k", ((F.col("_n") == 1) & F.col("_t").isNotNull()).alias("_known"))
    try:
        with shuffles_dropped(spark):
            marks.write.option("compression", "zstd").parquet(path)
        marks = spark.read.parquet(path)
        bits = bits_for(marks.count())
        known, others = (key_bits(marks.where(c), "_k", bits) for c in ("_known", "not _known"))

        def flagged(df: DataFrame, out: str) -> DataFrame:
            d = with_may_hold(with_may_hold(df, key, known, bits, "_known"), key, others, bits, "_other")
            return d.withColumn(out, F.col("_known") & ~F.col("_other")).drop(*{"_known", "_other"} - {out})
        yield flagged
    finally:
        drop_scratch(spark, path)


def merge_into(batch: DataFrame, table_name: str, key: str = "review_id",
               update_cols: Sequence[str] = UPDATE_SENTIMENT, stamp_col: str = "ingested_at") -> None:
    """The same upsert as an in-place ``MERGE`` on a catalog table that
    supports row-level operations (Delta / Iceberg style catalogs).

    At large table sizes this is the preferred path: only the files holding
    matched keys are rewritten, instead of a new snapshot of the whole
    table.  Not exercised here (no such catalog ships with this install).
    """
    s = batch.alias("s")
    cond = F.expr(f"{table_name}.{key} = s.{key}")
    sets = {c: F.col(f"s.{c}") for c in update_cols}
    sets[stamp_col] = F.current_timestamp()
    inserts = {c: F.col(f"s.{c}") for c in batch.columns if c != stamp_col}
    inserts[stamp_col] = F.current_timestamp()
    (s.mergeInto(table_name, cond)
      .whenMatched().update(sets)
      .whenNotMatched().insert(inserts)
      .merge())
