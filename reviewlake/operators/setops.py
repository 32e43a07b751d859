"""Union of sources and first-occurrence dedup by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


KEY_SLOTS = 1 << 20


def union_sources(frames: Sequence[DataFrame], priority_col: str = "source_priority") -> DataFrame:
    """Union all, in the given order; each row gets its source's 1-based priority.

    Columns are matched by name; a column missing from one source is null
    there.  A narrow operation (no shuffle).
    """
    out = None
    for i, df in enumerate(frames, start=1):
        df = df.withColumn(priority_col, F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def dedup_first(df: DataFrame, key: str, order: Sequence[str | Column], strategy: str = "aggregate") -> DataFrame:
    """Keep one row per ``key``: the first by ``order`` (then by every other
    column, so the survivor is deterministic even for ties).

    * ``aggregate`` (default): ``groupBy(key).agg(min(struct(order…, row…)))``.
      The partial aggregate runs map-side, so a hot key (say a third of all
      rows) collapses to one row per task before the shuffle.
    * ``window``: ``row_number() over (partition by key order by …) = 1``,
      the SQL ``QUALIFY`` form; it sorts every row of a key in one task, so
      use it only when keys are known not to be skewed.
    * ``repeated``: for wide rows whose keys mostly occur once.  The keys are
      counted first; only rows that share a slot (key hash modulo
      ``KEY_SLOTS``) with a repeated key are aggregated, the others stay where
      they are.  ``df`` is read three times: pass one that is stored.
    """
    if strategy == "repeated":
        slot = F.pmod(F.xxhash64(key), F.lit(KEY_SLOTS))
        shared = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                    .select(slot.alias("_slot")).distinct())
        shared = F.broadcast(shared)             # KEY_SLOTS numbers at most
        on = slot == F.col("_slot")
        return df.join(shared, on, "left_anti").unionByName(dedup_first(df.join(shared, on, "left_semi"), key, order))
    cols = [c for c in df.columns if c != key]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if strategy == "window":
        # nulls first: the same total order as the struct comparison below
        w = Window.partitionBy(key).orderBy(*[c.asc_nulls_first() for c in order_cols],
                                            *[F.col(c).asc_nulls_first() for c in cols])
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    if strategy != "aggregate":
        raise ValueError(strategy)
    ordk = [o.alias(f"_o{i}") for i, o in enumerate(order_cols)]
    packed = F.struct(*ordk, F.struct(*[F.col(c) for c in cols]).alias("_row"))
    g = df.groupBy(key).agg(F.min(packed).alias("_m"))
    return g.select(key, *[F.col("_m._row")[c].alias(c) for c in cols]).select(df.columns)
