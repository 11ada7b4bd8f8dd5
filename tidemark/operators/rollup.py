"""Sliding windows over metric rows, and their rollup.

Counts, sums, minima and maxima merge, so rows are aggregated before they move.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cell
from tidemark.functions.time import LONG_MAX, from_reverse_time
from tidemark.schemas import SERIES_KEY

# The window a rollup covers and the step between windows.
LENGTH = "5 minutes"
SLIDE = "1 minute"
MINUTE = 60_000
# Windows whose starts fall in one hour are finished together by one task.
BLOCK_MINUTES = 60


def event_time() -> Column:
    """Event time of a metric row, for windows and watermarks."""
    return from_reverse_time(F.col("RTIME"))


def sliding_window_rows(
    rows: DataFrame, ts: Column | None = None, length: str = LENGTH, slide: str = SLIDE
) -> DataFrame:
    """Every row once per window that contains it, with a ``window`` column.

    Narrow, for batch and stream. ``ts`` defaults to the event time; give the
    arrival time to window by arrival.
    """
    return rows.withColumn("window", F.window(event_time() if ts is None else ts, length, slide))


PARTS = ["count", "sum", "min", "max"]


def merged(cell_path: str = "") -> list[Column]:
    """Aggregates that merge the parts of METRIC, plain or inside ``cell_path``."""
    at = f"{cell_path}." if cell_path else ""
    return [
        F.sum(f"{at}count").alias("count"),
        F.sum(f"{at}sum").alias("sum"),
        F.min(f"{at}min").alias("min"),
        F.max(f"{at}max").alias("max"),
    ]


def measures(rows: DataFrame) -> DataFrame:
    """Rows that hold a measured value; datasource rows hold text and do not merge."""
    return rows.where(F.col("METRIC.items").isNull() & F.col("METRIC").isNotNull())


def pane_millis(length_minutes: int, slide_minutes: int) -> int:
    """The longest span that no window cuts."""
    return gcd(length_minutes, slide_minutes) * MINUTE


def as_cell(df: DataFrame) -> DataFrame:
    """``count sum min max`` back into one METRIC column."""
    none = F.lit(None).cast("string")
    return df.withColumn("METRIC", cell.metric(*[F.col(p) for p in PARTS], none)).drop(*PARTS)


def rollup(
    rows: DataFrame,
    key: Sequence[str] = SERIES_KEY,
    length_minutes: int = 5,
    slide_minutes: int = 1,
    block_minutes: int = BLOCK_MINUTES,
) -> DataFrame:
    """METRIC of each series merged over sliding event-time windows.

    Gives ``key, window_start, window_end, METRIC``; windows start at multiples of
    the slide since 1970. Three steps, for batch input:

    1. Merge rows per (series, pane), where a pane is the longest span that no
       window cuts. Partial aggregation before this shuffle shrinks hot series.
    2. Bring the panes of a series and block of window starts together. Only panes
       near a block border are copied, not every pane once per window.
    3. Give each pane to its windows and merge again. The rows of a window are all
       in the task already, so this needs no shuffle, and a task's share of one
       series is bounded by the panes of a block.
    """
    if length_minutes < slide_minutes or slide_minutes < 1:
        raise ValueError("a window must be at least as long as its slide, and the slide a minute")
    pane = pane_millis(length_minutes, slide_minutes)
    length, slide = length_minutes * MINUTE, slide_minutes * MINUTE
    block = max(block_minutes, length_minutes) // slide_minutes * slide

    millis = F.lit(LONG_MAX) - F.col("RTIME")
    panes = (
        measures(rows)
        .select(*key, (millis - F.pmod(millis, F.lit(pane))).alias("_pane"), "METRIC")
        .groupBy(*key, "_pane")
        .agg(*merged("METRIC"))
    )
    newest = F.col("_pane") - F.pmod(F.col("_pane"), F.lit(slide))
    # Starts at or before the pane whose window still reaches it.
    oldest = newest - slide * F.floor((newest + length - F.col("_pane") - 1) / slide)
    first_block, last_block = (start - F.pmod(start, F.lit(block)) for start in (oldest, newest))
    placed = panes.withColumn(
        "_block", F.explode(F.array_distinct(F.array(first_block, last_block)))
    ).repartition(*key, "_block")
    low = F.greatest(oldest, F.col("_block"))
    high = F.least(newest, F.col("_block") + (block - slide))
    starts = F.explode(F.sequence(low, high, F.lit(slide))).alias("_start")
    windows = placed.select(*key, "_block", starts, *PARTS)
    done = windows.groupBy(*key, "_block", "_start").agg(*merged())
    return as_cell(done).select(
        *key,
        F.timestamp_millis("_start").alias("window_start"),
        F.timestamp_millis(F.col("_start") + length).alias("window_end"),
        "METRIC",
    )


def stream_rollup(
    rows: DataFrame,
    key: Sequence[str] = SERIES_KEY,
    delay: str = "10 minutes",
    length: str = LENGTH,
    slide: str = SLIDE,
    ts: Column | None = None,
) -> DataFrame:
    """The same rollup as one streaming aggregate, closed by a watermark.

    One aggregate keeps one state store. It runs on batch input too, where the
    watermark has no effect; :func:`rollup` moves less there.
    """
    timed = measures(rows).withColumn("_ts", event_time() if ts is None else ts)
    grouped = timed.withWatermark("_ts", delay).groupBy(F.window("_ts", length, slide), *key)
    done = as_cell(grouped.agg(*merged("METRIC")))
    return done.select(
        *key,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "METRIC",
    )
