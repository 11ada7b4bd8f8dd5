"""Rows written to stores that Spark reaches through a connector, and a peek."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cell
from tidemark.operators.upsert import latest_per_key
from tidemark.schemas import ROW_KEY

# The keyed store's connector and where its coordinator answers.
KEYED_FORMAT = "org.apache.phoenix.spark"
QUORUM, PORT, ROOT = "localhost", "2181", "/hbase-unsecure"


def keyed_options(
    table: str, quorum: str = QUORUM, port: str = PORT, root: str = ROOT
) -> dict[str, str]:
    """Options that name a table of the keyed store."""
    return {"table": table, "zkUrl": f"{quorum}:{port}:{root}"}


def stored_rows(rows: DataFrame, binary: bool = True) -> DataFrame:
    """The row columns with METRIC as one stored cell, for stores without structs."""
    cells = [cell.store(F.col("METRIC"), binary).alias("METRIC")] if "METRIC" in rows.columns else []
    return rows.select(*ROW_KEY, *cells)


def write_rows(
    rows: DataFrame, fmt: str = KEYED_FORMAT, mode: str = "overwrite", **options: str
) -> None:
    """Write a frame through a data source.

    The keyed store's connector takes ``overwrite`` to mean upsert and accepts no
    other mode; for files and databases choose the mode that is meant.
    """
    rows.write.format(fmt).mode(mode).options(**options).save()


def stage_options(
    url: str, stage: str, batch: int = 10_000, connections: int = 16, **options: str
) -> dict[str, str]:
    """Options of a staging table's writer: rows go in by batches, over so many connections at most."""
    return {
        "url": url, "dbtable": stage, "batchsize": str(batch), "numPartitions": str(connections), **options
    }


def write_jdbc_stage(rows: DataFrame, order: list[str], url: str, stage: str, **options) -> None:
    """Append the last row per key to a staging table of a database.

    The database then merges the staging table into its own.
    """
    kept = stored_rows(latest_per_key(rows, order))
    write_rows(kept, "jdbc", "append", **stage_options(url, stage, **options))


def peek(rows: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows, of an order if one is given so that the answer is fixed."""
    return (rows.orderBy(*order) if order else rows).limit(n)
