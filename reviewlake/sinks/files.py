"""File and JDBC sinks, first-available reader, typed table creation.

All writers produce many part files (one per task); nothing is coalesced
to one file or passed through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines, UTF-8, null fields kept (``"x": null``)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json_present(spark: SparkSession, path: str, schema: StructType, optional: Sequence[str],
                      multiline: bool = False) -> DataFrame:
    """``read_json`` without those ``optional`` columns that no record of the
    file has: column presence is then a property of the file (one pass over
    its records infers it)."""
    found = set(spark.read.option("multiLine", multiline).option("primitivesAsString", "true").json(path).columns)
    fields = [f for f in schema.fields if f.name not in optional or f.name in found]
    return read_json(spark, path, StructType(fields), multiline)


def read_json(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """JSON Lines (splittable), or one JSON array per file with ``multiline``."""
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE").json(path)


# Any text survives a round trip: all values are quoted, a quote is doubled,
# line breaks and outer white space are kept, and null differs from empty.
CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "nullValue": "\\N",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row, UTF-8 (BI export).  No byte-order mark."""
    df.write.mode(mode).options(**CSV_OPTIONS, quoteAll="true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def first_available(spark: SparkSession, paths: Sequence[str], reader,
                    empty_schema: StructType | None = None) -> tuple[str | None, DataFrame | None]:
    """Read the first path that exists (``reader(spark, path)``), trying
    them in priority order.  Existence is checked when the read is planned,
    so no job runs for the missing paths; a path that exists but cannot be
    read is an error.  Returns ``(path, df)``; when none
    exists ``(None, empty frame of empty_schema)`` or ``(None, None)``."""
    for p in paths:
        try:
            df = reader(spark, p)
            df.schema  # forces the file listing
            return p, df
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return None, (spark.createDataFrame([], empty_schema) if empty_schema is not None else None)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "overwrite",
               batchsize: int = 10_000) -> None:
    """JDBC write; overwrite truncates instead of dropping the table."""
    (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
       .option("truncate", "true").option("batchsize", batchsize).options(**properties).save())


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8) -> DataFrame:
    """JDBC read, in ``num_partitions`` parallel range queries when a numeric
    ``partition_column`` and its bounds are given (one query otherwise)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def create_table_if_absent(spark: SparkSession, name: str, schema: StructType, location: str | None = None,
                           partition_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` from a schema."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part}{loc}")


ROWS_PER_BUCKET = 1_000_000
BYTES_PER_BUCKET = 32_000_000


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET, size: int = 0) -> int:
    """Bucket count of a table with so many rows and bytes: both are bounded per bucket."""
    return max(1, -(-rows // rows_per_bucket), -(-size // BYTES_PER_BUCKET))


def rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    """Row count, and bytes of the rows (texts by their UTF-8 length, 8 for any other column)."""
    size = F.lit(0)
    for f in df.schema.fields:
        size = size + (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if isinstance(f.dataType, (StringType, BinaryType)) else F.lit(8))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("size")).first()
    return r["n"], r["size"]


def save_bucketed(df: DataFrame, table_name: str, key: str, buckets: int, path: str | None = None,
                  mode: str = "overwrite") -> None:
    """Store ``df`` as a parquet table bucketed (and sorted) by ``key``.

    Joins and aggregations on ``key`` against this table need no shuffle
    of the table side — the keyed upsert then moves only the batch.  Rows
    are hash-partitioned into ``buckets`` first so each bucket is one file
    per write instead of one per task.
    """
    w = (df.repartition(buckets, key).write.mode(mode).format("parquet").option("compression", "zstd")
           .bucketBy(buckets, key).sortBy(key))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table_name)
