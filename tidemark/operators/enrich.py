"""Metric entries to metric rows: ids, places, and the row filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.text import clean, filled
from tidemark.functions.time import LONG_MAX
from tidemark.operators.dictionary import Dictionaries
from tidemark.operators.lookup import Dictionary, lookup
from tidemark.schemas import ROW, ROW_KEY, STRING

# What becomes of an entry; a record set aside has its reason instead.
KEPT, UNKNOWN_NAME, NO_PLACE = "kept", "unknown_name", "no_place"


def bucket_time() -> Column:
    """An entry's time in epoch milliseconds, at which a dictionary that changes is read."""
    return F.lit(LONG_MAX) - F.col("RTIME")


def known_metrics(entries: DataFrame, metrics: Dictionary) -> DataFrame:
    """Add ``MID``; entries whose name the dictionary lacks (at their time) are dropped."""
    return lookup(entries, metrics, "name", "inner", bucket_time())


def unknown_metrics(entries: DataFrame, metrics: Dictionary) -> DataFrame:
    """How many entries carry each name that the dictionary lacks."""
    named = entries.groupBy("name").agg(F.count("*").alias("entries"))
    return lookup(named, metrics, "name", "left_anti")


def placed(entries: DataFrame, hosts: Dictionary) -> DataFrame:
    """Add ``ENV`` and ``APP``: the entry's own, else its host's.

    Of a host that moves, the place at the entry's time counts. Only a missing value is looked up. A blank one is present, so it stays blank. Entries
    that lack neither do not take part in a shuffled join.
    """
    lacking = F.col("environment").isNull() | F.col("appname").isNull()
    if hosts.small:
        found = lookup(entries, hosts, "host", "left", bucket_time())
    else:
        whole = entries.where(~lacking)
        found = lookup(entries.where(lacking), hosts, "host", "left", bucket_time()).unionByName(whole, allowMissingColumns=True)
    return found.select(
        *entries.columns,
        clean(F.coalesce("environment", "env")).alias("ENV"),
        clean(F.coalesce("appname", "app")).alias("APP"),
    )


def judged(
    entries: DataFrame,
    dictionaries: Dictionaries,
    default_env: str | None = None,
    require_place: bool = True,
) -> DataFrame:
    """Every entry with its ids, its place and its ``fate``; nothing is dropped.

    A fate is kept, the cause for which the row will be dropped, or the reason for which
    the record was set aside. ``default_env`` fills a missing environment first.
    """
    bad = F.col("reason").isNotNull() if "reason" in entries.columns else F.lit(False)
    rows = placed(lookup(entries, dictionaries.metrics, "name", "left", bucket_time()), dictionaries.hosts)
    if default_env is not None:
        rows = rows.withColumn("ENV", F.coalesce("ENV", F.lit(default_env)))
    fate = F.when(bad, F.col("reason") if "reason" in entries.columns else F.lit(None).cast("string"))
    fate = fate.when(F.col("MID").isNull(), F.lit(UNKNOWN_NAME))
    if require_place:
        complete = filled(F.col("ENV")) & filled(F.col("host"))
        fate = fate.when(~F.coalesce(complete, F.lit(False)), F.lit(NO_PLACE))
    return rows.withColumn("fate", fate.otherwise(F.lit(KEPT)))


def observed(rows: DataFrame, name: str | Observation = "fates") -> DataFrame:
    """Count the fates while the rows go by, in batch or in each micro-batch of a stream."""
    counts = [F.count_if(F.col("fate") == f).alias(f) for f in (KEPT, UNKNOWN_NAME, NO_PLACE)]
    aside = F.count_if(~F.col("fate").isin(KEPT, UNKNOWN_NAME, NO_PLACE)).alias("set_aside")
    return rows.observe(name, *counts, aside)


def enrich(
    entries: DataFrame,
    dictionaries: Dictionaries,
    default_env: str | None = None,
    require_place: bool = True,
    observe: str | Observation | None = None,
) -> DataFrame:
    """Metric rows from entries; quarantined entries pass through unchanged.

    ``require_place`` drops rows without environment or host. ``default_env`` fills
    a missing environment first. ``observe`` names counts of what is kept and dropped.
    Every column besides the row's own is carried.
    """
    rows = judged(entries, dictionaries, default_env, require_place)
    if observe:
        rows = observed(rows, observe)
    rows = rows.where(~F.col("fate").isin(UNKNOWN_NAME, NO_PLACE))
    rest = [c for c in entries.columns if c not in _CONSUMED]
    own = {"HOST": F.col("host"), "INSTANCE": F.col("instance")}
    return rows.select(*[own.get(c, F.col(c)).alias(c) for c in [*ROW_KEY, "METRIC"]], *rest)


# Columns of an entry that no row keeps.
READ_ONLY = ("name", "host", "instance", "environment", "appname", "rowkey")
_CONSUMED = {
    "name", "host", "instance", "environment", "appname", "RTIME", "METRIC", "rowkey"
}


def as_rows(rows: DataFrame) -> DataFrame:
    """Exactly the declared row schema, with its non-null columns.

    A row that lacks one of them has no place in the table: the job fails there, rather
    than drop it unseen. Jobs that keep rows without a place do not use this schema.
    """
    typed = []
    for field in ROW.fields:
        column = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            missing = F.raise_error(F.lit(f"a row without {field.name}")).cast(field.dataType)
            # The literal only tells the schema that no NULL is left.
            never = F.lit("") if field.dataType == STRING else F.lit(0).cast(field.dataType)
            column = F.coalesce(F.when(column.isNull(), missing).otherwise(column), never)
        typed.append(column.alias(field.name))
    return rows.select(*typed)
