"""Time helpers. Cursors travel as microseconds: JSON would cut them to milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for zoned (session zone UTC) and zone-less timestamps."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))


def truncate_millis(ts: Column) -> Column:
    return F.date_trunc("MILLISECOND", ts)


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def age_seconds(now_micros: Column, ts: Column) -> Column:
    """Seconds from ``ts`` to now, never negative, one decimal."""
    age = (now_micros - micros(ts)) / F.lit(MICROS_PER_SECOND)
    return F.round(F.greatest(F.lit(0.0), age), 1)
