"""The metric and host dictionaries."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import clean, filled
from tidemark.operators.lookup import HOT_SHARE, Dictionary, hot_keys, measured

# Row keys of the hierarchy table, built from these words.
ENVIRONMENTS = "environment"
APPLICATIONS = "appname"
HOSTS = "hosts"

# Names of hot ids that are split; more of them do not share an id in practice.
MOST_HOT_NAMES = 1_000

# Schemas of the stored dictionaries.
METRICS = "NAME string, MID int"
PLACES = "host string, env string, app string"
# The same with the time from which (and before which) a row holds, in epoch milliseconds.
METRIC_VERSIONS = "NAME string, MID int, since long"
PLACE_VERSIONS = "host string, env string, app string, since long, until long"


@dataclass(frozen=True)
class Dictionaries:
    """name -> MID, and host -> (env, app)."""

    metrics: Dictionary
    hosts: Dictionary


def metric_dictionary(meta: DataFrame) -> DataFrame:
    """``NAME, MID`` with one id per name, from raw (ID, NAME) rows.

    Repeats collapse; of conflicting ids the smallest is kept.
    """
    pairs = meta.where(F.col("NAME").isNotNull())
    return pairs.groupBy("NAME").agg(F.min("ID").cast("int").alias("MID"))


def metric_conflicts(meta: DataFrame) -> DataFrame:
    """Names that raw (ID, NAME) rows give more than one id, with the id kept."""
    pairs = meta.select("ID", "NAME").distinct().where(F.col("NAME").isNotNull())
    found = pairs.groupBy("NAME").agg(
        F.count("ID").alias("ids"), F.min("ID").cast("int").alias("MID")
    )
    return found.where(F.col("ids") > 1)


def read_row(table: DataFrame, rowkey: str) -> DataFrame:
    """Qualifiers of one row of the hierarchy table; the filter reaches its scan."""
    return table.where(F.col("rowkey") == rowkey).select("qualifier").distinct()


def read_rows(table: DataFrame, keys: DataFrame, key: str = "rowkey") -> DataFrame:
    """Qualifiers of many rows: the table joined to a frame of keys.

    All columns of ``keys`` are carried along, so nothing has to be read back out
    of the text of a key. The join's form is left to the plan, which sees the sizes as it
    runs; each hop of a walk is then computed once.
    """
    found = table.select(F.col("rowkey").alias("_row"), "qualifier")
    match = keys.withColumnRenamed(key, "_key")
    return found.join(match, F.col("_row") == F.col("_key")).drop("_row", "_key")


def _places(table: DataFrame) -> DataFrame:
    """``host, env, app`` rows, walking env -> applications -> hosts; hosts may repeat."""
    found = table.where(F.col("rowkey") == ENVIRONMENTS).select(clean(F.col("qualifier")).alias("env"))
    envs = found.where(filled(F.col("env"))).distinct()
    app_keys = envs.select("env", F.concat("env", F.lit(f".{APPLICATIONS}")).alias("key"))
    apps = (
        read_rows(table, app_keys, "key")
        .select("env", F.col("qualifier").alias("app"))
        .where(filled(clean(F.col("app"))))
        .distinct()
    )
    host_keys = apps.select(
        "env", "app", F.concat("env", F.lit("."), "app", F.lit(f".{HOSTS}")).alias("key")
    )
    return read_rows(table, host_keys, "key").select(
        clean(F.col("qualifier")).alias("host"), "env", clean(F.col("app")).alias("app")
    )


def host_hierarchy(table: DataFrame) -> DataFrame:
    """Distinct ``host, env, app`` rows, walking env -> applications -> hosts."""
    return _places(table).distinct()


def host_dictionary(table: DataFrame) -> DataFrame:
    """``host, env, app`` with one row per host: the smallest (env, app) pair."""
    places = _places(table).groupBy("host").agg(F.min(F.struct("env", "app")).alias("place"))
    return places.select("host", "place.env", "place.app")


def host_conflicts(table: DataFrame) -> DataFrame:
    """Hosts the hierarchy places more than once."""
    places = host_hierarchy(table).groupBy("host").agg(F.count("*").alias("places"))
    return places.where(F.col("places") > 1)


def store(metrics: DataFrame, hosts: DataFrame, folder: str) -> None:
    """Resolve both dictionaries once into tables under ``folder``.

    Jobs then join the stored tables and do not walk the hierarchy again.
    """
    metrics.write.parquet(f"{folder}/metrics")
    hosts.write.parquet(f"{folder}/hosts")


def load(spark: SparkSession, folder: str) -> Dictionaries:
    """The stored dictionaries, measured.

    An empty metric dictionary is refused: with it every row would be dropped without
    notice.
    """
    names = measured(spark.read.schema(METRICS).parquet(f"{folder}/metrics"), "NAME")
    if names.count == 0:
        raise ValueError("the metric dictionary is empty")
    return Dictionaries(names, measured(spark.read.schema(PLACES).parquet(f"{folder}/hosts"), "host"))


def resolve(meta: DataFrame, hierarchy: DataFrame, folder: str) -> Dictionaries:
    """Dictionaries from raw (ID, NAME) and (rowkey, qualifier) rows, stored and measured."""
    store(metric_dictionary(meta), host_dictionary(hierarchy), folder)
    return load(meta.sparkSession, folder)


def metric_versions(meta: DataFrame) -> DataFrame:
    """``NAME, MID, since`` with one id per name and start, from raw (ID, NAME, since) rows.

    Of conflicting ids of one start the smallest is kept, as in a dictionary without times.
    """
    pairs = meta.where(F.col("NAME").isNotNull() & F.col("since").isNotNull())
    return pairs.groupBy("NAME", "since").agg(F.min("ID").cast("int").alias("MID")).select("NAME", "MID", "since")


def place_versions(places: DataFrame) -> DataFrame:
    """``host, env, app, since, until`` with one place per host and start: the smallest (env, app)."""
    named = places.select(clean(F.col("host")).alias("host"), clean(F.col("env")).alias("env"), clean(F.col("app")).alias("app"), "since", "until")
    whole = named.where(filled(F.col("host")) & F.col("since").isNotNull())
    first = whole.groupBy("host", "since").agg(F.min(F.struct("env", "app", "until")).alias("place"))
    return first.select("host", "place.env", "place.app", "since", "place.until")


def resolve_versions(meta: DataFrame, places: DataFrame, folder: str) -> Dictionaries:
    """Dictionaries that change in time, stored and measured; rows take what holds at their time."""
    store(metric_versions(meta), place_versions(places), folder)
    spark = meta.sparkSession
    names = measured(spark.read.schema(METRIC_VERSIONS).parquet(f"{folder}/metrics"), "NAME")
    if names.count == 0:
        raise ValueError("the metric dictionary is empty")
    return Dictionaries(names, measured(spark.read.schema(PLACE_VERSIONS).parquet(f"{folder}/hosts"), "host"))


def with_hot_keys(found: Dictionaries, log: DataFrame, share: float = HOT_SHARE) -> Dictionaries:
    """Dictionaries that know the hosts and names which hold most rows of a log, as of past batches.

    Streams split the rows of these keys where a dictionary is joined by shuffle.
    """
    ids = hot_keys(log, "MID", share)
    names = found.metrics.rows.where(F.col("MID").isin(*ids)).select("NAME").distinct() if ids else None
    hot = tuple(sorted(r.NAME for r in names.limit(MOST_HOT_NAMES).collect())) if names is not None else ()
    return Dictionaries(replace(found.metrics, hot=hot), replace(found.hosts, hot=hot_keys(log, "HOST", share)))
