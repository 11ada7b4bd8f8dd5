"""Message logs: Kafka topics and folders of files, as batch or as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a job listens to when it is told nothing else.
BROKERS = "localhost:9092"
TOPIC = "Default"
GROUP = "Default-Handler"

# Columns of a Kafka message that say where it stood: the order of writes.
KAFKA_ORDER = ["ingest_time", "partition", "offset", "event_pos"]


def kafka_options(
    brokers: str = BROKERS,
    topic: str = TOPIC,
    group: str | None = GROUP,
    starting: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``max_offsets`` bounds a micro-batch. ``min_partitions`` splits the offset range
    of a topic partition over several tasks, for a topic with one hot partition.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_messages(spark: SparkSession, **settings: object) -> DataFrame:
    """Stream of ``value`` texts with their place in the topic (needs the connector)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**settings)).load()
    return _kafka_columns(raw)


def kafka_backlog(spark: SparkSession, **settings: object) -> DataFrame:
    """What a topic holds now, as a batch (needs the connector)."""
    options = kafka_options(**{"starting": "earliest", **settings})
    return _kafka_columns(spark.read.format("kafka").options(**options).load())


def _kafka_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        F.col("timestamp").alias("ingest_time"),
    )


def file_messages(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Stream of the message files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
