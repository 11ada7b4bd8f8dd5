"""Streaming queries: rows to a log, rollups, and per-batch output.

Every query takes a checkpoint folder that all executors share. Rows go through the
same functions as in batch.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.dictionary import Dictionaries
from tidemark.operators.enrich import as_rows
from tidemark.operators.flatten import good
from tidemark.operators.flatten import quarantine as set_aside
from tidemark.operators.rollup import LENGTH, SLIDE, sliding_window_rows, stream_rollup
from tidemark.operators.rowjson import from_row_json, to_row_json
from tidemark.operators.upsert import latest_per_key
from tidemark.plans.rows import Options, metric_rows, quarantine, tagged_rows
from tidemark.schemas import ROW_KEY, SERIES_KEY
from tidemark.session import new_dir
from tidemark.sinks.stores import KEYED_FORMAT, peek, stored_rows, write_rows
from tidemark.sinks.table import PARTITIONS, SCHEMA, declare, log_layout, note_schema, remove, write_log
from tidemark.streaming.state import SHARDS, newest_windows, newest_writes, open_rollup

# Fixed value: the time between micro-batches when none is given.
INTERVAL = "500 seconds"


# Name of the counts of rows kept, dropped and set aside in a query's progress.
FATES = "fates"
# Files of one outcome and date that a micro-batch writes at most.
FILES_PER_DATE = 4


def timed(writer: DataStreamWriter, interval: str | None = INTERVAL) -> DataStreamWriter:
    """Run every ``interval``; with None, take in what is there and stop."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def _to_files(df: DataFrame, path: str, checkpoint: str, interval: str | None) -> DataStreamWriter:
    note_schema(df, path)
    writer = df.writeStream.format("parquet").outputMode("append")
    return timed(writer.option("path", path).option("checkpointLocation", checkpoint), interval)


def start_rows(
    messages: DataFrame,
    dictionaries: Dictionaries,
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    options: Options = Options(),
    files: int = FILES_PER_DATE,
) -> StreamingQuery:
    """Append rows and quarantine to the log, once each, from one read of the source.

    Rows of an outcome and date are dealt by ``dealt``, so that no task writes a file for
    every date and a date with most rows is shared by as many tasks as the batch allows.
    """
    laid = log_layout(tagged_rows(messages, dictionaries, options, FATES))
    declare(laid.drop(*PARTITIONS), path)
    return _to_files(dealt(laid, files), path, checkpoint, interval).partitionBy(*PARTITIONS).start()


def dealt(laid: DataFrame, files: int = FILES_PER_DATE) -> DataFrame:
    """Rows moved so that those of an outcome and date come together, in ``files`` parts of
    each task that read them: the parts of a date grow with the batch, and none holds more
    than the rows of that date that one task read.
    """
    part = F.pmod(F.xxhash64(*ROW_KEY, F.col("raw")), F.lit(files))
    keyed = laid.withColumn("_part", part).withColumn("_read", F.spark_partition_id())
    return keyed.repartition(*PARTITIONS, "_part", "_read").drop("_part", "_read")


def start_quarantine(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    options: Options = Options(),
) -> StreamingQuery:
    """Append the records set aside, for jobs whose output has no place for them."""
    return _to_files(quarantine(messages, options), path, checkpoint, interval).start()


def start_row_json(
    messages: DataFrame,
    dictionaries: Dictionaries,
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    options: Options = Options(),
) -> StreamingQuery:
    """Append the rows as JSON texts (without METRIC)."""
    texts = to_row_json(metric_rows(messages, dictionaries, options, FATES))
    return _to_files(texts, path, checkpoint, interval).start()


def start_window_rows(
    messages: DataFrame,
    dictionaries: Dictionaries,
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    options: Options = Options(),
    length: str = LENGTH,
    slide: str = SLIDE,
) -> StreamingQuery:
    """Append each row once per sliding window that contains it; keeps no state."""
    rows = metric_rows(messages, dictionaries, options, FATES)
    windows = sliding_window_rows(rows, length=length, slide=slide)
    return _to_files(windows, path, checkpoint, interval).start()


def start_rollup(
    messages: DataFrame,
    dictionaries: Dictionaries,
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    options: Options = Options(datasources=False),
    key: list[str] | None = None,
    delay: str = "10 minutes",
    length: str = LENGTH,
    slide: str = SLIDE,
) -> StreamingQuery:
    """Append each sliding window's rollup once the watermark has passed its end.

    Rows behind the watermark are dropped; the query's progress counts them as
    ``numRowsDroppedByWatermark``.
    """
    rows = as_rows(metric_rows(messages, dictionaries, options, FATES))
    windows = stream_rollup(rows, key or SERIES_KEY, delay, length, slide)
    return _to_files(windows, path, checkpoint, interval).start()


def start_open_rollup(
    messages: DataFrame,
    dictionaries: Dictionaries,
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    options: Options = Options(datasources=False),
    key: list[str] | None = None,
    delay: str = "10 minutes",
    length_minutes: int = 5,
    slide_minutes: int = 1,
    shards: int = SHARDS,
) -> StreamingQuery:
    """Append every window that a batch has changed, with its version, open windows included.

    :func:`read_windows` gives the windows as they stand. The series of an hour are dealt over
    ``shards``: many for batches of a few busy minutes, few for the history of a small log.
    """
    rows = as_rows(metric_rows(messages, dictionaries, options, FATES))
    updates = open_rollup(rows, key or SERIES_KEY, delay, length_minutes, slide_minutes, shards=shards)
    return _to_files(updates, path, checkpoint, interval).start()


def read_windows(spark: SparkSession, path: str, key: list[str] | None = None) -> DataFrame:
    """Each window once, as the last of its updates under ``path`` has it."""
    return newest_windows(spark.read.parquet(path), key or SERIES_KEY)


def start_newest_writes(
    rows: DataFrame,
    order: list[str],
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    keep: str = "1 day",
    shards: int = SHARDS,
) -> StreamingQuery:
    """Append the rows of a stream that no row before them, in any batch, supersedes."""
    return _to_files(newest_writes(rows, order, keep=keep, shards=shards), path, checkpoint, interval).start()


def start_store(
    messages: DataFrame,
    dictionaries: Dictionaries,
    order: list[str],
    checkpoint: str,
    interval: str | None = INTERVAL,
    options: Options = Options(),
    keep: str = "1 day",
    fmt: str = KEYED_FORMAT,
    mode: str = "overwrite",
    **settings: str,
) -> StreamingQuery:
    """Upsert the rows of a stream into a keyed store, where the last write holds over all batches.

    What :func:`store_writer` orders within a batch is ordered over batches here, by state.
    """
    rows = newest_writes(metric_rows(messages, dictionaries, options, FATES), order, keep=keep)
    return start_batches(rows, put_rows(fmt, mode, **settings), checkpoint, interval)


def put_rows(fmt: str = KEYED_FORMAT, mode: str = "overwrite", **settings: str) -> Callable[[DataFrame, int], None]:
    """What a per-batch query does with rows that are to be stored as they come."""

    def write(rows: DataFrame, batch_id: int) -> None:
        write_rows(stored_rows(rows), fmt, mode, **settings)

    return write


def note_fates(batch_id: int, fates: dict) -> None:
    """Log what became of a batch's records."""
    logging.getLogger(__name__).info("batch %s: %s", batch_id, ", ".join(f"{n} {fate}" for fate, n in fates.items()))


def batch_writer(
    dictionaries: Dictionaries | Callable[[], Dictionaries],
    path: str,
    options: Options = Options(),
    show: int = 0,
    counted: Callable[[int, dict], None] = note_fates,
) -> Callable[[DataFrame, int], None]:
    """What a per-batch query does with the messages of one micro-batch.

    A batch owns the folder ``batch_id=<n>`` of the log, so running it again after a
    failure replaces its rows. Given a function, dictionaries are read anew for each
    batch. ``show`` prints the first rows, from what was written. ``counted`` gets the
    batch's number and its rows kept, dropped and set aside, counted as they were written.
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        now = dictionaries() if callable(dictionaries) else dictionaries
        target = f"{path}/batch_id={batch_id}"
        spark, fates, entries = messages.sparkSession, Observation(FATES), new_dir(messages.sparkSession, "entries")
        rows = tagged_rows(messages, now, options, fates, entries)
        declare(rows, path)
        write_log(rows, target, mode="overwrite")
        remove(spark, entries)
        counted(batch_id, fates.get)
        if show:
            peek(spark.read.parquet(target), show).show(show, False)

    return write


def store_writer(
    dictionaries: Dictionaries | Callable[[], Dictionaries],
    order: list[str],
    options: Options = Options(),
    as_json: bool = False,
    fmt: str = KEYED_FORMAT,
    mode: str = "overwrite",
    show: int = 0,
    bad: str | None = None,
    counted: Callable[[int, dict], None] = note_fates,
    **settings: str,
) -> Callable[[DataFrame, int], None]:
    """What a per-batch query does to upsert a micro-batch into a keyed store.

    The store takes rows in any order, so only the last of each key is sent. With
    ``as_json`` rows pass through JSON texts and the declared schema, without METRIC. The
    batch is read once: rows and records set aside are held in the shared folder, from where
    the former go to the store and the latter to the folder ``batch_id=<n>`` of ``bad``. So
    both agree whatever fails on the way. ``counted`` gets the batch's number, its rows kept,
    dropped and set aside, and those whose JSON text could not be read back (``corrupt``).
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        now = dictionaries() if callable(dictionaries) else dictionaries
        spark, fates, corrupt = messages.sparkSession, Observation(FATES), Observation("corrupt")
        entries, held = new_dir(spark, "entries"), new_dir(spark, "batch")
        tagged = tagged_rows(messages, now, options, fates, entries)
        tagged.write.parquet(held)
        both = spark.read.schema(tagged.schema).parquet(held)
        if bad:
            set_aside(both).drop("MID", "ENV", "APP").write.mode("overwrite").parquet(f"{bad}/batch_id={batch_id}")
        rows = latest_per_key(good(both), order)
        if as_json:
            typed = from_row_json(to_row_json(rows)).observe(corrupt, F.count_if(F.col("corrupt").isNotNull()).alias("corrupt"))
            rows = typed.where(F.col("corrupt").isNull())
        if show:
            peek(good(both), show).show(show, False)
        write_rows(stored_rows(rows), fmt, mode, **settings)
        counted(batch_id, fates.get | (corrupt.get if as_json else {"corrupt": 0}))
        remove(spark, entries, held)

    return write


def written_rows(spark: SparkSession, path: str) -> DataFrame:
    """What a query of this module appends to ``path``, as a stream: each batch's files once they are committed."""
    return spark.readStream.schema(spark.read.parquet(f"{path}/{SCHEMA}").schema).parquet(path)


def show_rows(n: int) -> Callable[[DataFrame, int], None]:
    """What a per-batch query does to print the first rows; it reads no more than they take."""

    def write(rows: DataFrame, batch_id: int) -> None:
        peek(rows, n).show(n, False)

    return write


def start_peek(spark: SparkSession, path: str, n: int, checkpoint: str, interval: str | None = INTERVAL) -> StreamingQuery:
    """Print the first rows of what another query appends to ``path``, without reading its messages again."""
    return start_batches(written_rows(spark, path), show_rows(n), checkpoint, interval)


def start_batches(
    messages: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Hand each micro-batch of messages to ``write``."""
    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return timed(writer, interval).start()
