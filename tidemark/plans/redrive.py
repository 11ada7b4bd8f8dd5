"""Records set aside, taken in once a repaired form of their messages can be read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dictionary import Dictionaries
from tidemark.plans.rows import Options, tagged_rows
from tidemark.schemas import ROW_KEY
from tidemark.session import new_dir
from tidemark.sinks.table import BAD, read_log, write_log

MESSAGE = ("message_id",)


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equal in all columns, nulls included."""
    match = F.lit(True)
    for name in names:
        match = match & left[name].eqNullSafe(right[name])
    return match


def _known(rows: DataFrame, message: Sequence[str]) -> DataFrame:
    """What tells a row or a record set aside from others of its message, under names of its own."""
    none = F.lit(None).cast("string")
    reason = F.col("reason") if "reason" in rows.columns else none
    raw = F.sha2(F.col("raw").cast("binary"), 256) if "raw" in rows.columns else none
    return rows.select(*message, "event_pos", *ROW_KEY, reason.alias("_reason"), raw.alias("_raw"))


def redriven(
    aside: DataFrame,
    taken: DataFrame,
    repaired: DataFrame,
    dictionaries: Dictionaries,
    options: Options = Options(),
    message: Sequence[str] = MESSAGE,
) -> DataFrame:
    """Rows, and records still set aside, that ``repaired`` messages add to a log.

    ``aside`` and ``taken`` are the log's quarantine and rows, ``message`` the columns by which
    a message is known; ``repaired`` may hold others as well, which are left alone. Reading
    again with other ``options`` is a repair too. A repaired message keeps the places of its
    events: a row that was taken in from the same place under the same key does not come again,
    and neither does a record that fails as it did, so driving twice adds nothing.

    The messages' names are stored first. If they are few, Spark sends them to the log's rows,
    and only rows of these messages are shuffled; a row's payload and texts are not.
    """
    spark, path = repaired.sparkSession, new_dir(repaired.sparkSession, "set-aside")
    aside.select(*message).distinct().write.parquet(path)
    names = spark.read.parquet(path)
    again = repaired.join(names, _same(repaired, names, message), "left_semi")
    read = tagged_rows(again, dictionaries, options)
    own = taken.join(names, _same(taken, names, message), "left_semi")
    known = _known(own, message).unionByName(_known(aside, message))
    identity = [*message, "event_pos", *ROW_KEY, "_reason", "_raw"]
    keyed = read.withColumns({"_reason": F.col("reason"), "_raw": F.sha2(F.col("raw").cast("binary"), 256)})
    return keyed.join(known, _same(keyed, known, identity), "left_anti").drop("_reason", "_raw")


def take_in(
    spark: SparkSession,
    logs: Sequence[str],
    target: str,
    repaired: DataFrame,
    dictionaries: Dictionaries,
    options: Options = Options(),
    message: Sequence[str] = MESSAGE,
) -> None:
    """Write what repaired messages add to the logs to a new one beside them.

    The logs' quarantine stays as it is: it is the record of what was repaired.
    """
    aside, taken = read_log(spark, *logs, outcome=BAD), read_log(spark, *logs)
    # The outcome is the log's own column; the reason tells one record set aside from another.
    write_log(redriven(aside, taken, repaired, dictionaries, options, message), target, mode="errorifexists")
