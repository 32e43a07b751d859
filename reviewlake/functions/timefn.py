"""Time column functions.  Session time zone is UTC (see ``session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts(col: Column) -> Column:
    """ISO-8601 text → timestamp, each row parsed on its own.

    Offsets are honoured and normalised to UTC; naive values are read as
    UTC; fractional seconds are optional; anything unparseable is null."""
    return col.cast("string").try_cast("timestamp")


def epoch_to_ts(col: Column) -> Column:
    """Epoch seconds (may be fractional) → UTC timestamp, to the nearest microsecond."""
    return F.timestamp_micros(F.round(col.cast("double") * F.lit(1_000_000.0)).cast("long"))


def month(col: Column) -> Column:
    """``YYYY-MM`` of a timestamp."""
    return F.date_format(col, "yyyy-MM")


def days_before(ts: Column, days: Column) -> Column:
    """``ts - days`` (whole days)."""
    return ts - F.make_dt_interval(days.cast("int"))


def iso(ts: Column) -> Column:
    """Timestamp → ISO text without zone, exactly like ``datetime.isoformat()``:
    microseconds are printed only when they are not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
