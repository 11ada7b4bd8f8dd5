"""A keyed metric table in buckets of its key: changes move to the base, and the base stays.

Rows lie by date and, within a date, by a hash of their key in a fixed number of buckets.
A merge shuffles the changes into the same buckets and reads the base as it lies, so its
cost follows the changes and the dates they touch. As elsewhere, a merge writes a new
folder and never the one it reads.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import latest_per_key
from tidemark.schemas import ROW_KEY
from tidemark.sinks.table import SCHEMA, dates_of, log_layout, read_layers, read_log

KEY_HASH, DATE, COUNT = "key_hash", "event_date", "buckets"


def _keyed(rows: DataFrame, buckets: int) -> DataFrame:
    """Add the column that buckets go by; it keeps their number, and is never null."""
    return rows.withColumn(KEY_HASH, F.xxhash64(*ROW_KEY).alias(KEY_HASH, metadata={COUNT: buckets}))


def write_buckets(rows: DataFrame, path: str, buckets: int, lies: bool = False) -> None:
    """Write rows to a new folder, one file per date and bucket.

    Choose ``buckets`` so that one holds some hundred MB of an ordinary date. ``lies``: the
    rows are in their buckets already and are not shuffled.
    """
    spark, name = rows.sparkSession, f"tidemark_{uuid.uuid4().hex}"
    laid = _keyed(log_layout(rows).drop("outcome"), buckets)
    if not lies:
        laid = laid.repartition(buckets, KEY_HASH)
    writer = laid.write.format("parquet").mode("errorifexists").partitionBy(DATE)
    # Spark writes buckets only by way of a table; without it the files stay.
    writer.bucketBy(buckets, KEY_HASH).sortBy(KEY_HASH).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    spark.createDataFrame([], laid.schema).write.parquet(f"{path}/{SCHEMA}")


def bucket_count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/{SCHEMA}").schema[KEY_HASH].metadata[COUNT]


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a folder of buckets, known to Spark to lie so.

    The folder becomes an external table of the session's catalog, with its own name.
    """
    schema = spark.read.parquet(f"{path}/{SCHEMA}").schema
    name = f"tidemark_{hashlib.sha256(path.encode()).hexdigest()[:32]}"
    if not spark.catalog.tableExists(name):
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet PARTITIONED BY ({DATE}) "
            f"CLUSTERED BY ({KEY_HASH}) SORTED BY ({KEY_HASH}) INTO {bucket_count(spark, path)} BUCKETS LOCATION '{place}'"
        )
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def merged(held: DataFrame, changes: DataFrame, order: Sequence[str], buckets: int) -> DataFrame:
    """The last row per key of a table in buckets and of changes, in the same buckets.

    Changes shrink to one row per key first, so a key that fills them is one row of its
    bucket. Equal hashes meet in a bucket, and the whole key tells them apart.
    """
    newest = _keyed(latest_per_key(changes, order), buckets).repartition(buckets, KEY_HASH)
    both = held.unionByName(newest, allowMissingColumns=True)
    return latest_per_key(both, order, [KEY_HASH, *ROW_KEY])


def merge_changes(
    spark: SparkSession, bases: Sequence[str], logs: Sequence[str], target: str, order: Sequence[str]
) -> None:
    """Write to ``target`` the keyed table of those dates that the logs have rows of.

    ``bases`` are a first folder of buckets and earlier merges into it, oldest first. Of them
    only the changed dates are read, each from its newest folder, and nothing is shuffled.
    """
    counts = {bucket_count(spark, path) for path in bases}
    if len(counts) > 1:
        raise ValueError(f"the folders have different numbers of buckets: {sorted(counts)}")
    changes, buckets = read_log(spark, *logs), counts.pop()
    changed = F.col(DATE).cast("string").isin(dates_of(changes))
    held = read_table(spark, *bases).where(changed)
    write_buckets(merged(held, changes, order, buckets), target, buckets, lies=True)


def read_table(spark: SparkSession, *folders: str) -> DataFrame:
    """A keyed table of buckets and of the merges into it, oldest first."""
    return read_layers(spark, *folders, read=read_buckets)
