"""A keyed metric table without a database.

Rows are appended to a log together with the records set aside, in one write. The
current table is the log's last row per key. Compaction writes it to a new folder;
no folder is written while it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import from_reverse_time
from tidemark.operators.upsert import latest_per_key

ROW, BAD = "row", "bad"
PARTITIONS = ["outcome", "event_date"]
SCHEMA = "_schema"


def log_layout(rows: DataFrame) -> DataFrame:
    """Add the log's partition columns: outcome, and the date of the row."""
    outcome = F.lit(ROW)
    if "reason" in rows.columns:
        outcome = F.when(F.col("reason").isNull(), outcome).otherwise(F.lit(BAD))
    date = F.to_date(from_reverse_time(F.col("RTIME")))
    return rows.withColumns({"outcome": outcome, "event_date": F.when(outcome == ROW, date)})


def declare(rows: DataFrame, path: str) -> None:
    """Note the log's schema beside its files, so that a log without rows can be read.

    Readers of the folder skip names that begin with an underscore.
    """
    note_schema(log_layout(rows), path)


def note_schema(rows: DataFrame, path: str) -> None:
    """Write a table without rows beside the files, unless there is one."""
    rows.sparkSession.createDataFrame([], rows.schema).write.mode("ignore").parquet(f"{path}/{SCHEMA}")


def write_log(rows: DataFrame, path: str, mode: str = "append", even: bool = True) -> None:
    """Write rows as files of even size per date, newest rows first in each file.

    The rebalance splits a date that holds most rows and joins small ones, and the
    order lets a reader of recent times skip row groups. ``even=False`` leaves out
    this shuffle, for input whose tasks each hold few dates already.
    """
    laid = log_layout(rows)
    if even:
        laid = laid.hint("rebalance", *PARTITIONS)
    ordered = laid.sortWithinPartitions(*PARTITIONS, "RTIME")
    ordered.write.mode(mode).partitionBy(*PARTITIONS).parquet(path)
    declare(rows, path)


def read_log(spark: SparkSession, *paths: str, outcome: str = ROW) -> DataFrame:
    """The log's rows, or its quarantine with ``outcome=BAD``.

    Each path is read by its declared schema. Spark reads partitioned folders without a
    common root only one by one, so there is a scan for each.
    """
    unused = ["outcome", "reason", "raw"] if outcome == ROW else ["outcome"]
    parts = []
    for path in paths:
        declared = spark.read.parquet(f"{path}/{SCHEMA}").schema
        part = spark.read.schema(declared).parquet(path).where(F.col("outcome") == outcome)
        parts.append(part.drop(*unused))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def current(log: DataFrame, order: Sequence[str], dates: Sequence[str] | None = None) -> DataFrame:
    """The keyed table: the last row written per key.

    A key fixes its date, so ``dates`` restricts the work to the partitions of those
    days without changing any row in them.
    """
    if dates is not None:
        log = log.where(F.col("event_date").cast("string").isin(list(dates)))
    return latest_per_key(log, order)


def compact(
    spark: SparkSession,
    sources: Sequence[str],
    target: str,
    order: Sequence[str],
    dates: Sequence[str] | None = None,
) -> None:
    """Write the keyed table of logs and earlier compactions to a new folder."""
    write_log(current(read_log(spark, *sources), order, dates), target, mode="errorifexists")


def compact_changed(
    spark: SparkSession, base: str, logs: Sequence[str], target: str, order: Sequence[str]
) -> None:
    """Write to ``target`` the keyed table of those dates that the logs have rows of.

    The dates come from the logs' folders. Of ``base`` only these dates are read; with
    :func:`read_layers` both make the whole table.
    """
    dates = dates_of(read_log(spark, *logs))
    rows = read_log(spark, base, *logs)
    write_log(current(rows, order, dates), target, mode="errorifexists", even=bool(dates))


def read_layers(
    spark: SparkSession, base: str, *layers: str, read: Callable[[SparkSession, str], DataFrame] = read_log
) -> DataFrame:
    """A keyed table of a base and later layers: each date as its newest layer has it."""
    newest, taken, parts = list(reversed((base, *layers))), set(), []
    for path in newest:
        rows = read(spark, path)
        parts.append(rows.where(~F.col("event_date").cast("string").isin(sorted(taken))) if taken else rows)
        if path != base:
            taken |= set(dates_of(rows))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def dates_of(rows: DataFrame) -> list[str]:
    """The dates a log holds: as many as it has folders."""
    return [str(r.event_date) for r in rows.select("event_date").distinct().collect()]


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete logs that a compaction has replaced, in whatever store they lie."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
