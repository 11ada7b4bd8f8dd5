"""Minute buckets and the newest-first time key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest long, from which the time key counts down, and the
# text pattern of a minute bucket.
LONG_MAX = 2**63 - 1
BUCKET_PATTERN = "yyyyMMddHHmm"


def bucket_millis(bucket: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds of a ``yyyyMMddHHmm`` bucket in ``zone``; NULL if it is not one.

    The digits become a timestamp text with its own zone mark, so neither the
    session zone nor a formatter is involved. Kept to one level: a filter on a time
    key is pushed below the steps that make it, and copies all they refer to.
    """
    spans = [(1, 4), (5, 2), (7, 2), (9, 2), (11, 2)]
    year, month, day, hour, minute = (F.substring(bucket, *span) for span in spans)
    dash, colon = F.lit("-"), F.lit(":")
    iso = F.concat(year, dash, month, dash, day, F.lit("T"), hour, colon, minute, F.lit(":00Z"))
    wall = F.when(F.length(bucket) == len(BUCKET_PATTERN), iso).try_cast("timestamp")
    return F.unix_millis(wall if zone == "UTC" else F.to_utc_timestamp(wall, zone))


def reverse_time(millis: Column) -> Column:
    """Key that sorts the newest time first in ascending order.

    NULL for times before 1970, whose key would not fit a long.
    """
    return F.try_subtract(F.lit(LONG_MAX), millis)


def from_reverse_time(rtime: Column) -> Column:
    """The timestamp a reverse-time key stands for."""
    return F.timestamp_millis(F.lit(LONG_MAX) - rtime)
