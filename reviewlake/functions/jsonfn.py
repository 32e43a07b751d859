"""JSON and embedded-document column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

# Timestamps travel at full microsecond precision (the JSON default keeps
# milliseconds only); zoned timestamps carry their offset.
TS_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode(col: Column) -> Column:
    """Struct → JSON text keeping null fields (``json.dumps`` keeps them)."""
    return F.to_json(col, {"ignoreNullFields": "false", **TS_OPTIONS})


CORRUPT = "_corrupt_record"


def decode(col: Column, schema: DataType | str, corrupt: bool = False) -> Column:
    """JSON text → struct; malformed input never raises.

    Malformed input gives a struct of null fields.  With ``corrupt=True``
    the struct gets one more field, ``_corrupt_record``, holding the raw
    text of malformed input (null when it parsed) — the reliable flag."""
    if not corrupt:
        return F.from_json(col, schema, {"mode": "PERMISSIVE", **TS_OPTIONS})
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    schema = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    return F.from_json(col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **TS_OPTIONS})


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, however many
    predicates and columns read it: a plain projection is copied into each
    of them, a generator's output is not."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))
