"""Messages to metric rows, as one narrow job: decode, flatten, enrich, filter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators import decode, enrich, flatten
from tidemark.operators.dictionary import Dictionaries
from tidemark.session import new_dir


@dataclass(frozen=True)
class Options:
    """How messages are read and which rows are kept."""

    codec: str = "gzip"
    zone: str = "UTC"
    env_key: str = "environment"
    app_key: str = "appname"
    metrics: bool = True
    datasources: bool = True
    default_env: str | None = None
    require_place: bool = True
    # Fields of an event to carry along, such as its identifier, with their types.
    carry: tuple[tuple[str, str], ...] = ()
    # Column that takes all fields of an event outside the wire schema, as one variant.
    extra: str | None = None


# Rows are kept without a place; give ``default_env`` for a default environment.
KEEP_ALL = Options(require_place=False)


def events(messages: DataFrame, options: Options = Options()) -> DataFrame:
    decoded = decode.decode_payload(messages, options.codec)
    return flatten.explode_events(
        decoded, options.metrics, options.datasources, options.env_key, options.app_key, options.carry, options.extra
    )


def entries(messages: DataFrame, options: Options = Options()) -> DataFrame:
    """Metric entries, and a row with a reason for each record set aside."""
    return flatten.unpivot_metrics(events(messages, options), options.zone)


def metric_rows(
    messages: DataFrame,
    dictionaries: Dictionaries,
    options: Options = Options(),
    observe: str | None = None,
) -> DataFrame:
    """The metric rows of messages: ``MID RTIME ENV APP HOST INSTANCE METRIC`` first.

    Columns of the message, ``event_pos`` and carried fields follow; they order writes.
    ``observe`` names counts of what is kept, dropped and set aside.
    """
    if observe:
        return flatten.good(tagged_rows(messages, dictionaries, options, observe))
    read = flatten.good(entries(messages, options))
    return enrich.enrich(read, dictionaries, options.default_env, options.require_place)


def tagged_rows(
    messages: DataFrame,
    dictionaries: Dictionaries,
    options: Options = Options(),
    observe: str | Observation | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Metric rows and the records set aside together, for a single write.

    With small dictionaries this is one pass. If one is large, entries are stored once:
    those set aside, with their texts, then stay out of the shuffles. A stream cannot be
    stored on the way; there they only pass by the joins as well. ``folder`` is where the
    entries go; whoever gives one can delete it once the rows are written.
    """
    read = entries(messages, options)
    if messages.isStreaming or (dictionaries.metrics.small and dictionaries.hosts.small):
        return enrich.enrich(read, dictionaries, options.default_env, options.require_place, observe)
    spark, path = messages.sparkSession, folder or new_dir(messages.sparkSession, "entries")
    read.write.parquet(path)
    held = spark.read.schema(read.schema).parquet(path)
    bad = held.where(F.col("reason").isNotNull())
    rows = enrich.enrich(flatten.good(held), dictionaries, options.default_env, options.require_place, observe)
    return rows.unionByName(bad.drop(*enrich.READ_ONLY), allowMissingColumns=True)


def fates(messages: DataFrame, dictionaries: Dictionaries, options: Options = Options()) -> DataFrame:
    """Every record of the messages with its ``fate``: kept, dropped or set aside, and why."""
    return enrich.judged(entries(messages, options), dictionaries, options.default_env, options.require_place)


def quarantine(messages: DataFrame, options: Options = Options()) -> DataFrame:
    """Only the records set aside."""
    return flatten.quarantine(entries(messages, options))
