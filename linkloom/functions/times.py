"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for integer arithmetic."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def format_time(ts: Column, padded: bool = True) -> Column:
    """``d/M/yyyy HH:mm:ss``, or with an unpadded time part."""
    return F.date_format(ts, "d/M/yyyy HH:mm:ss" if padded else "d/M/yyyy H:m:s")
