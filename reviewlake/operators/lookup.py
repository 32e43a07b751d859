"""Code → value lookups with a default (``dict.get(key, default)``).

Small fixed maps are inlined as map literals (see ``metrics`` /
``projections``).  A caller-supplied lookup *table* is joined without a
hint: Spark broadcasts it below its byte threshold and shuffles it beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str, out: str,
                default: Column | None = None) -> DataFrame:
    """Left-join ``table[value]`` onto ``df`` by key; missing → ``default``
    (the key itself when no default is given).  ``table`` must hold each key
    once (duplicates would multiply rows, as any join does)."""
    t = table.select(F.col(table_key).alias("_lk"), F.col(value).alias("_lv"))
    j = df.join(t, df[key] == t["_lk"], "left")
    fallback = F.col(key).cast("string") if default is None else default
    return j.withColumn(out, F.coalesce(F.col("_lv"), fallback)).drop("_lk", "_lv")
