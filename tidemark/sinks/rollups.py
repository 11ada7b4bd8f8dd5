"""A stored rollup that follows its keyed table: only windows that changed dates reach are redone.

Windows lie by the date they begin on, those that reach into the next date apart. A changed
date touches its own windows, and of the date before only those that reach into it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import LONG_MAX
from tidemark.operators.rollup import MINUTE, rollup
from tidemark.schemas import SERIES_KEY

CELL = ["window_date", "spans"]
_DAY = timedelta(days=1)


def _laid(windows: DataFrame) -> DataFrame:
    """Add the date that a window begins on, and 1 if it reaches into the next, else 0."""
    begins = F.to_date("window_start")
    last = F.to_date(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND"))
    return windows.withColumns({"window_date": begins, "spans": (begins != last).cast("int")})


def _write(windows: DataFrame, path: str) -> None:
    _laid(windows).hint("rebalance", *CELL).write.mode("errorifexists").partitionBy(*CELL).parquet(path)


def write_rollup(rows: DataFrame, path: str, key: Sequence[str] = SERIES_KEY, length_minutes: int = 5, slide_minutes: int = 1) -> None:
    """The rollup of a whole keyed table, as the base that later layers are laid on."""
    _write(rollup(rows, key, length_minutes, slide_minutes), path)


def _midnight(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp() * 1000)


def _needed(dates: Sequence[date], length: int) -> Column:
    """The rows that windows of these dates hold: the dates, and a window's length beside them.

    Dates are partitions, so others are not opened. The bounds of all of them on the sorted
    time key reach the scan: of the first and the last neighbour only the row groups at the
    border are read.
    """
    changed = sorted(set(dates))
    keep = F.col("event_date").isin(changed)
    for day in changed:
        before, after = day - _DAY, day + _DAY
        if before not in changed:
            keep |= (F.col("event_date") == F.lit(before)) & (F.col("RTIME") <= LONG_MAX - (_midnight(day) - length))
        if after not in changed:
            keep |= (F.col("event_date") == F.lit(after)) & (F.col("RTIME") > LONG_MAX - (_midnight(after) + length))
    near = sorted({d + n * _DAY for d in changed for n in (-1, 0, 1)})
    first, last = _midnight(changed[0]) - length, _midnight(changed[-1] + _DAY) + length
    return F.col("event_date").isin(near) & keep & F.col("RTIME").between(LONG_MAX - last, LONG_MAX - first)


def refresh_rollup(
    rows: DataFrame, dates: Sequence[date], target: str, key: Sequence[str] = SERIES_KEY, length_minutes: int = 5, slide_minutes: int = 1
) -> None:
    """Write to ``target`` the windows that rows of these dates reach, from the table as it is now.

    ``rows`` is the keyed table with its ``event_date``; ``dates`` are those that changed, late
    rows' dates included. :func:`read_rollup` lays the result over what was there.
    """
    if not length_minutes * MINUTE <= 24 * 60 * MINUTE:
        raise ValueError("a window reaches into the next date at most")
    changed = sorted(set(dates))
    some = rows.where(_needed(changed, length_minutes * MINUTE)) if changed else rows.limit(0)
    windows = _laid(rollup(some.drop("event_date"), key, length_minutes, slide_minutes))
    own = F.col("window_date").isin(changed) | (F.col("window_date").isin([d - _DAY for d in changed]) & (F.col("spans") == 1))
    _write(windows.where(own if changed else F.lit(False)).drop(*CELL), target)


def changed_dates(log: DataFrame) -> list[date]:
    """The dates that a log of changes has rows of: as many as it has folders."""
    return [r.event_date for r in log.select("event_date").distinct().collect()]


def read_rollup(spark: SparkSession, base: str, *layers: str) -> DataFrame:
    """The windows, each date (and each date's windows into the next) as its newest layer has it."""
    schema = spark.read.parquet(base).schema
    parts, taken = [], set()
    for path in reversed((base, *layers)):
        windows = spark.read.schema(schema).parquet(path)
        kept = windows
        for day, spans in sorted(taken):
            kept = kept.where(~((F.col("window_date") == F.lit(day)) & (F.col("spans") == F.lit(spans))))
        parts.append(kept)
        if path != base:
            taken |= {(r.window_date, r.spans) for r in windows.select(*CELL).distinct().collect()}
    return reduce(DataFrame.unionByName, parts).drop(*CELL)
