"""Where dictionaries are read from.

Read errors are not caught: a job without its dictionaries would drop every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the table that names the metrics, and the query run against it.
METRIC_TABLE = "METRICSMETA"


def metric_query(table: str = METRIC_TABLE) -> str:
    """The subquery that leaves removing repeats to the database."""
    return f"(SELECT DISTINCT ID, NAME FROM {table}) m"


def metric_ids_from_jdbc(
    spark: SparkSession, url: str, table: str = METRIC_TABLE, **options: str
) -> DataFrame:
    """(ID, NAME) rows of the metric table."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=metric_query(table), **options)
    return reader.load().select(F.col("ID").cast("int").alias("ID"), "NAME")


def metric_ids_from_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(ID, NAME) rows from files; repeats are removed by the dictionary step."""
    return spark.read.format(fmt).load(path).select(F.col("ID").cast("int").alias("ID"), "NAME")


def hierarchy_from_files(
    spark: SparkSession, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """(rowkey, qualifier) rows of the hierarchy table, one row per column: an export in
    files, or whatever a connector's format reads from ``path``."""
    return spark.read.format(fmt).options(**options).load(path).select("rowkey", "qualifier")
