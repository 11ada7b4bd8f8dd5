"""Session settings and the shared folder that jobs write into."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DIR: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the library relies on; all can be changed at run time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Payloads are large next to ordinary columns: bound what one Arrow batch holds.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    # Of a key that comes twice in an object the last counts, in variants as elsewhere.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # Window state grows with series, so it is kept on disk and not on the heap.
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # A batch then uploads its changes and not a snapshot of the whole state.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    A machine-local folder is used only where Spark itself runs on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIR:
        _LOCAL_DIR[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_DIR[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
