"""Dictionaries that change in time: each row takes the version that holds at its own time.

A version holds from ``since`` (epoch milliseconds, included) until the next version of its
key, or until its own ``until`` (excluded) where it has one. Of versions that begin together
the smallest counts. Two ways give the same rows: versions gathered per key, for an equi-join
that streams can do too, and a sorted sweep for batch, whose tasks hold a few rows at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SINCE, UNTIL = "since", "until"
# A sweep's task holds the rows of a key, an hour, and one of some parts of them.
BLOCK = 3_600_000
SALTS = 16


def values_of(versions: DataFrame, key: str) -> list[str]:
    return [c for c in versions.columns if c not in (key, SINCE, UNTIL)]


def _held(versions: DataFrame, key: str) -> Column:
    until = F.col(UNTIL) if UNTIL in versions.columns else F.lit(None)
    return F.struct(until.cast("long").alias(UNTIL), *values_of(versions, key))


def one_per_start(versions: DataFrame, key: str) -> DataFrame:
    """``key, since`` and the values as ``_held``, without versions that lack key or start."""
    whole = versions.where(F.col(key).isNotNull() & F.col(SINCE).isNotNull())
    return whole.groupBy(key, F.col(SINCE).cast("long").alias(SINCE)).agg(F.min(_held(versions, key)).alias("_held"))


def gathered(versions: DataFrame, key: str) -> DataFrame:
    """One row per key: its versions in order of time, as ``_versions``."""
    starts = one_per_start(versions, key)
    return starts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(SINCE, "_held"))).alias("_versions"))


def picked(at: Column) -> Column:
    """Of ``_versions`` what holds at a time, NULL if nothing does."""
    before = F.filter("_versions", lambda v: v[SINCE] <= at)
    return F.try_element_at(before, F.lit(-1))["_held"]


def _valid(held: Column, at: Column) -> Column:
    """A version, or NULL behind its end."""
    return F.when(held[UNTIL].isNull() | (at < held[UNTIL]), held)


def spread(rows: DataFrame, values: Sequence[str], at: Column, how: str) -> DataFrame:
    """The columns of ``_held`` in its place; an inner join drops rows without a version."""
    found = rows.withColumn("_held", _valid(F.col("_held"), at))
    if how == "inner":
        found = found.where(F.col("_held").isNotNull())
    return found.select(*[c for c in rows.columns if c != "_held"], *(F.col(f"_held.{v}").alias(v) for v in values))


def swept(rows: DataFrame, versions: DataFrame, key: str, by: str, at: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """The same by sorting rows and versions together, for large dictionaries in batch.

    Rows of ``rows[key]`` are dealt by key, hour and salt, so neither a key that holds a third
    of all rows nor one with many versions meets in one task. A version goes to the parts of
    its own hour; what held before is found by a small sweep over the hours of each key, and
    opens each part. Both joins are on equal keys.
    """
    starts = one_per_start(versions, by).withColumnRenamed(by, "_key")
    block = lambda c: F.floor(c / BLOCK)
    own = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    placed = rows.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), at.alias("_at"))
    placed = placed.withColumns({"_block": block(F.col("_at")), "_salt": F.pmod(F.xxhash64(*(F.col(f"_row.{c}") for c in own)), F.lit(salts))})
    # A row without key or time has no version; each stands alone, so that they do not meet.
    loose = F.col("_key").isNull() | F.col("_at").isNull()
    parts = placed.where(~loose).select("_key", "_block", "_salt").distinct()
    hours = parts.select("_key", "_block").distinct()
    none = F.lit(None).cast(starts.schema["_held"].dataType)
    marks = starts.select("_key", F.col(SINCE).alias("_at"), F.lit(0).alias("_kind"), "_held").unionByName(
        hours.select("_key", (F.col("_block") * BLOCK).alias("_at"), F.lit(1).alias("_kind"), none.alias("_held"))
    )
    upto = Window.partitionBy("_key").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    opening = marks.withColumn("_held", F.last("_held", ignorenulls=True).over(upto)).where("_kind = 1 AND _held IS NOT NULL")
    first = opening.select("_key", block(F.col("_at")).alias("_block"), (F.col("_at") - 1).alias("_at"), "_held")
    inside = starts.select("_key", block(F.col(SINCE)).alias("_block"), F.col(SINCE).alias("_at"), "_held")
    given = parts.join(first.unionByName(inside), ["_key", "_block"])
    row = F.lit(None).cast(placed.schema["_row"].dataType)
    events = given.select("_key", "_block", "_salt", "_at", F.lit(0).alias("_kind"), "_held", row.alias("_row")).unionByName(
        placed.where(~loose).select("_key", "_block", "_salt", "_at", F.lit(1).alias("_kind"), none.alias("_held"), "_row")
    )
    sweep = Window.partitionBy("_key", "_block", "_salt").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    done = events.withColumn("_held", F.last("_held", ignorenulls=True).over(sweep)).where("_kind = 1").select("_row.*", "_held", "_at")
    if how != "inner":
        done = done.unionByName(placed.where(loose).select("_row.*", none.alias("_held"), "_at"))
    values = [n for n in starts.schema["_held"].dataType.names if n != UNTIL]
    return spread(done, values, F.col("_at"), how).drop("_at")
