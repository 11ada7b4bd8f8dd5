"""The registered queries: each takes (spark, folder of the tables).

All of them work on every event. Times come out as epoch milliseconds and METRIC
as plain columns, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cell, time
from tidemark.operators import decode, dictionary, enrich, flatten, rollup, rowjson, upsert
from tidemark.operators.dictionary import Dictionaries
from tidemark.plans import redrive
from tidemark.plans import rows as jobs
from tidemark.schemas import METRIC, ROW_KEY, SERIES_KEY
from tidemark.session import new_dir, prepare
from tidemark.sinks import buckets, rollups, stores, table
from tidemark.sources import fixtures
from tidemark.sources.messages import file_messages
from tidemark.streaming import jobs as streams

# The derived events carry their identifier, so that results can be compared row by row.
WIRE = jobs.Options(carry=(("event_id", "bigint"),))
ORDINARY = replace(WIRE, datasources=False)
DATASOURCES = replace(WIRE, metrics=False)
PEEK_ROWS = 20


@cache
def dictionaries(spark: SparkSession, sf: str) -> Dictionaries:
    """Resolved once per session, as a job does when it starts."""
    return dictionary.resolve(
        fixtures.table(spark, sf, "metric_ids"),
        fixtures.table(spark, sf, "hierarchy"),
        new_dir(spark, "dictionaries"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.table(spark, sf, "messages")


def flat_cell(source: str | Column = "METRIC", *parts: str) -> list[Column]:
    """METRIC as ``metric_*`` columns; the sum is rounded since its order may vary."""
    held = F.col(source) if isinstance(source, str) else source
    out = []
    for part in parts or METRIC.names:
        value = F.round(held[part], 4) if part == "sum" else held[part]
        out.append(value.alias(f"metric_{part}"))
    return out


def row_columns(*rest: str) -> list[Column | str]:
    return ["event_id", *ROW_KEY, *flat_cell("METRIC", *rest)]


MEASURES = ("count", "sum", "min", "max")


def millis(ts: str) -> Column:
    return F.unix_millis(ts).alias(f"{ts}_ms")


# Decode and flatten


def decode_payload(spark: SparkSession, sf: str) -> DataFrame:
    """The whole text of every message, laid out value by value."""
    decoded = decode.decode_payload(messages(spark, sf))
    wire = (
        "array<struct<event_id:bigint,environment:string,appname:string,"
        "metrics:map<string,map<string,struct<host:string,instance:string,count:bigint,sum:double>>>,"
        "datasources:map<string,struct<pool:array<struct<k:bigint>>,queue:array<struct<n:bigint>>>>>>"
    )
    event = decoded.select("message_id", F.explode_outer(F.from_json("text", wire)).alias("e"))
    bucket = event.select("message_id", "e", F.explode_outer("e.metrics").alias("rowkey", "named"))
    metric = bucket.select("message_id", "e", "rowkey", F.explode_outer("named").alias("name", "m"))
    held = metric.select("*", F.explode_outer("e.datasources").alias("_key", "lists"))
    pooled = held.select("*", F.explode_outer("lists.pool").alias("pool"))
    queued = pooled.select("*", F.explode_outer("lists.queue").alias("queue"))
    return queued.select(
        "message_id",
        "e.event_id",
        "e.environment",
        "e.appname",
        "rowkey",
        "name",
        "m.host",
        "m.instance",
        F.col("m.count").alias("n"),
        F.col("m.sum").alias("value"),
        F.col("pool.k").alias("pool_k"),
        F.col("queue.n").alias("queue_n"),
    )


def explode_events(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.events(messages(spark, sf), WIRE).select(
        "message_id",
        "event_id",
        "environment",
        "appname",
        F.size("metrics").alias("metric_buckets"),
        F.size("datasources").alias("datasource_buckets"),
    )


def unpivot_metrics(spark: SparkSession, sf: str) -> DataFrame:
    entries = flatten.good(jobs.entries(messages(spark, sf), ORDINARY))
    return entries.select(
        "event_id", "rowkey", "name", "host", "instance", *flat_cell("METRIC", *MEASURES)
    )


def reverse_time(spark: SparkSession, sf: str) -> DataFrame:
    bucket = fixtures.attributes(fixtures.events(spark, sf)).select("event_id", "bucket")
    return bucket.withColumn("RTIME", time.reverse_time(time.bucket_millis(F.col("bucket"))))


# Dictionaries


def metric_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    raw = fixtures.derive_metric_ids(fixtures.events(spark, sf))
    return dictionary.metric_dictionary(raw)


def metric_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    raw = fixtures.derive_metric_ids(fixtures.events(spark, sf))
    return dictionary.metric_conflicts(raw)


def hierarchy_row(spark: SparkSession, sf: str) -> DataFrame:
    kv = fixtures.derive_hierarchy(fixtures.events(spark, sf))
    return dictionary.read_row(kv, dictionary.ENVIRONMENTS)


def hierarchy_rows(spark: SparkSession, sf: str) -> DataFrame:
    kv = fixtures.derive_hierarchy(fixtures.events(spark, sf))
    keys = kv.where(F.col("rowkey") == dictionary.ENVIRONMENTS).select(
        F.trim("qualifier").alias("env"),
        F.concat(F.trim("qualifier"), F.lit(".appname")).alias("key"),
    )
    return dictionary.read_rows(kv, keys, "key").select("env", F.col("qualifier").alias("app"))


def host_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.host_dictionary(fixtures.table(spark, sf, "hierarchy"))


# Enrichment


def known_metrics(spark: SparkSession, sf: str) -> DataFrame:
    entries = flatten.good(jobs.entries(messages(spark, sf), WIRE))
    named = enrich.known_metrics(entries, dictionaries(spark, sf).metrics)
    return named.select("event_id", "name", "MID")


def unknown_metrics(spark: SparkSession, sf: str) -> DataFrame:
    entries = flatten.good(jobs.entries(messages(spark, sf), ORDINARY))
    return enrich.unknown_metrics(entries, dictionaries(spark, sf).metrics)


def host_lookup(spark: SparkSession, sf: str) -> DataFrame:
    entries = flatten.good(jobs.entries(messages(spark, sf), ORDINARY))
    found = enrich.placed(entries, dictionaries(spark, sf).hosts)
    return found.select("event_id", "host", "ENV", "APP")


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY)
    return rows.select(*row_columns(*MEASURES))


def metric_rows_large_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows with both dictionaries treated as too large to broadcast."""
    found = dictionaries(spark, sf)
    large = Dictionaries(replace(found.metrics, small=False), replace(found.hosts, small=False))
    rows = jobs.metric_rows(messages(spark, sf), large, ORDINARY)
    return rows.select(*row_columns(*MEASURES))


@cache
def changing_dictionaries(spark: SparkSession, sf: str) -> Dictionaries:
    """Ids and places with the times from which they hold."""
    return dictionary.resolve_versions(
        fixtures.table(spark, sf, "metric_versions"),
        fixtures.table(spark, sf, "place_versions"),
        new_dir(spark, "dictionaries"),
    )


def metric_rows_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with the id and the place that held at their own time."""
    rows = jobs.metric_rows(messages(spark, sf), changing_dictionaries(spark, sf), ORDINARY)
    return rows.select(*row_columns(*MEASURES))


def metric_rows_as_of_large_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a sorted sweep, as for dictionaries too large to broadcast."""
    found = changing_dictionaries(spark, sf)
    large = Dictionaries(replace(found.metrics, small=False), replace(found.hosts, small=False))
    rows = jobs.metric_rows(messages(spark, sf), large, ORDINARY)
    return rows.select(*row_columns(*MEASURES))


def metric_rows_default_env(spark: SparkSession, sf: str) -> DataFrame:
    options = replace(jobs.KEEP_ALL, datasources=False, carry=WIRE.carry, default_env="unplaced")
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), options)
    return rows.select(*row_columns(*MEASURES))


def datasource_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), DATASOURCES)
    return rows.select(*row_columns("items"))


def all_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _all_rows(spark, sf).select(*row_columns())


def _all_rows(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), WIRE)


def union_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinary and datasource rows from two reads, put together by name."""
    both = [
        jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), part)
        for part in (ORDINARY, DATASOURCES)
    ]
    return both[0].unionByName(both[1]).select(*row_columns())


# Records set aside


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = jobs.quarantine(fixtures.table(spark, sf, "damaged"))
    return bad.select("message_id", "unit", "reason")


def recovered_entries(spark: SparkSession, sf: str) -> DataFrame:
    kept = flatten.good(jobs.entries(fixtures.table(spark, sf, "damaged"), WIRE))
    return kept.select("message_id", "event_id", "rowkey", "name")


def drop_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of every record: kept, dropped for which cause, or set aside."""
    found = jobs.fates(fixtures.table(spark, sf, "damaged"), dictionaries(spark, sf), WIRE)
    return found.groupBy("fate").agg(F.count("*").alias("records"))


def redriven_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Repaired messages taken in twice over: what was set aside comes once, as if it had been good."""
    found, repaired = dictionaries(spark, sf), fixtures.table(spark, sf, "repaired")
    logs = [new_dir(spark, "log") for _ in range(3)]
    table.write_log(jobs.tagged_rows(fixtures.table(spark, sf, "damaged"), found, WIRE), logs[0])
    for n in (1, 2):
        redrive.take_in(spark, logs[:n], logs[n], repaired, found, WIRE)
    return table.read_log(spark, *logs).select(*row_columns())


# Fields nobody declared


def unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields outside the wire schema, through the log and typed where they are read."""
    path = new_dir(spark, "log")
    sent = fixtures.table(spark, sf, "extended")
    table.write_log(jobs.tagged_rows(sent, dictionaries(spark, sf), replace(ORDINARY, extra="extra")), path)
    held = lambda place, kind: F.variant_get("extra", place, kind)
    return table.read_log(spark, path).select(
        "event_id",
        *ROW_KEY,
        held("$.trace.user", "bigint").alias("trace_user"),
        held("$.trace.tags[1]", "string").alias("trace_host"),
        F.to_json(held("$.trace.tags", "array<string>")).alias("trace_tags"),
    )


# Stored forms


def row_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY)
    return rowjson.to_row_json(rows).select("event_id", "value")


def json_typed_rows(spark: SparkSession, sf: str) -> DataFrame:
    texts = row_json(spark, sf)
    typed = rowjson.from_row_json(texts).where(F.col("corrupt").isNull())
    return typed.select("event_id", *ROW_KEY)


def stored_metric_decode(spark: SparkSession, sf: str) -> DataFrame:
    stored = _all_rows(spark, sf).select(
        "event_id", "MID", cell.store(F.col("METRIC"), binary=True).alias("METRIC")
    )
    loaded = stored.select("event_id", "MID", cell.load(F.col("METRIC"), binary=True).alias("M"))
    return loaded.select("event_id", "MID", *flat_cell("M"), cell.average(F.col("M")).alias("average"))


def row_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Rows under the declared schema, as a keyed store gets them."""
    return enrich.as_rows(_all_rows(spark, sf)).select(*ROW_KEY, *flat_cell())


# Keyed table


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY)
    sent = fixtures.derive_replayed(rows)
    return upsert.latest_per_key(sent, ["seq"]).select(*ROW_KEY, "seq", *flat_cell("METRIC", *MEASURES))


def compacted_log(spark: SparkSession, sf: str) -> DataFrame:
    """Write the log twice, as after a failed batch, compact it, and read the table."""
    first, again, kept = (new_dir(spark, name) for name in ("log", "log", "table"))
    tagged = jobs.tagged_rows(messages(spark, sf), dictionaries(spark, sf), WIRE)
    table.write_log(tagged, first)
    table.write_log(table.read_log(spark, first).drop("event_date"), again)
    table.compact(spark, [first, again], kept, ["event_id"])
    rows = table.read_log(spark, kept)
    return rows.select(*ROW_KEY, "event_id", *flat_cell())


def compacted_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed table, and a later log with corrected purchases: only its dates are redone."""
    log, base, later, changed = (new_dir(spark, name) for name in ("log", "base", "log", "changed"))
    rows = _all_rows(spark, sf)
    table.write_log(rows.withColumn("seq", F.col("event_id")), log)
    table.compact(spark, [log], base, ["seq"])
    sent = fixtures.derive_replayed(rows).where(F.col("seq") != F.col("event_id"))
    table.write_log(sent, later)
    table.compact_changed(spark, base, [later], changed, ["seq"])
    kept = table.read_layers(spark, base, changed)
    return kept.select(*ROW_KEY, "event_id", *flat_cell("METRIC", "sum", "items"))


def merged_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same, twice over, with the table in buckets that the corrections are brought to."""
    base, once, twice = (new_dir(spark, name) for name in ("base", "changed", "changed"))
    early, late = new_dir(spark, "log"), new_dir(spark, "log")
    rows = _all_rows(spark, sf)
    first = upsert.latest_per_key(rows.withColumn("seq", F.col("event_id")), ["seq"])
    buckets.write_buckets(first, base, 4)
    sent = fixtures.derive_replayed(rows).where(F.col("seq") != F.col("event_id"))
    table.write_log(sent.where("event_id % 2 = 0"), early)
    table.write_log(sent, late)
    buckets.merge_changes(spark, [base], [early], once, ["seq"])
    buckets.merge_changes(spark, [base, once], [late, early], twice, ["seq"])
    kept = buckets.read_table(spark, base, once, twice)
    return kept.select(*ROW_KEY, "event_id", *flat_cell("METRIC", "sum", "items"))


def store_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One batch of messages upserted into a store, here a folder of files, and read back."""
    path = new_dir(spark, "store")
    write = streams.store_writer(dictionaries(spark, sf), ["event_id"], WIRE, fmt="parquet", path=path)
    write(messages(spark, sf), 0)
    held = spark.read.parquet(path).withColumn("METRIC", cell.load(F.col("METRIC"), binary=True))
    return held.select(*ROW_KEY, *flat_cell())


def batch_peek(spark: SparkSession, sf: str) -> DataFrame:
    order = ["RTIME", "MID", "ENV", "HOST", "INSTANCE", "event_id"]
    return stores.peek(metric_rows(spark, sf), PEEK_ROWS, order)


# Windows


def sliding_window_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY)
    return _window_rows(rollup.sliding_window_rows(rows))


def _window_rows(windows: DataFrame) -> DataFrame:
    bounds = windows.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    )
    return bounds.select(millis("window_start"), millis("window_end"), *row_columns(*MEASURES))


def _windows(rolled: DataFrame, key: list[str]) -> DataFrame:
    return rolled.select(
        millis("window_start"), millis("window_end"), *key, *flat_cell("METRIC", *MEASURES)
    )


def rollup_5m(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY)
    return _windows(rollup.rollup(rows), SERIES_KEY)


def rollup_5m_by_env(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY)
    return _windows(rollup.rollup(rows, ["MID", "ENV"]), ["MID", "ENV"])


def refreshed_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A stored rollup after corrected purchases: only windows of their dates are redone."""
    log, base, later, changed = (new_dir(spark, name) for name in ("log", "base", "log", "changed"))
    windows, redone = new_dir(spark, "windows"), new_dir(spark, "windows")
    rows = jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY)
    table.write_log(rows.withColumn("seq", F.col("event_id")), log)
    table.compact(spark, [log], base, ["seq"])
    rollups.write_rollup(table.read_log(spark, base), windows)
    sent = fixtures.derive_replayed(rows).where(F.col("seq") != F.col("event_id"))
    table.write_log(sent, later)
    table.compact_changed(spark, base, [later], changed, ["seq"])
    now = table.read_layers(spark, base, changed)
    rollups.refresh_rollup(now, rollups.changed_dates(table.read_log(spark, later)), redone)
    return _windows(rollups.read_rollup(spark, windows, redone), SERIES_KEY)


# Streams: what is there is taken in, through files and a checkpoint in the shared folder


def _message_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = fixtures.table_path(spark, sf, "messages")
    return file_messages(spark, path, fixtures.MESSAGES)


def stream_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_dir(spark, "stream-rows"), new_dir(spark, "checkpoint")
    streams.start_rows(
        _message_stream(spark, sf), dictionaries(spark, sf), path, checkpoint, None, ORDINARY
    ).awaitTermination()
    return table.read_log(spark, path).select(*row_columns(*MEASURES))


def stream_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A stream against large dictionaries, with the keys split that a first stream found hot."""
    found = dictionaries(spark, sf)
    large = Dictionaries(replace(found.metrics, small=False), replace(found.hosts, small=False))
    past = _all_rows(spark, sf)
    path, checkpoint = new_dir(spark, "stream-rows"), new_dir(spark, "checkpoint")
    streams.start_rows(
        _message_stream(spark, sf), dictionary.with_hot_keys(large, past), path, checkpoint, None, ORDINARY
    ).awaitTermination()
    return table.read_log(spark, path).select(*row_columns(*MEASURES))


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_dir(spark, "stream-rows"), new_dir(spark, "checkpoint")
    damaged = fixtures.table_path(spark, sf, "damaged")
    streams.start_rows(
        file_messages(spark, damaged, fixtures.MESSAGES),
        dictionaries(spark, sf),
        path,
        checkpoint,
        None,
        WIRE,
    ).awaitTermination()
    return table.read_log(spark, path, outcome=table.BAD).select("message_id", "reason")


def stream_row_json(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_dir(spark, "stream-json"), new_dir(spark, "checkpoint")
    streams.start_row_json(
        _message_stream(spark, sf), dictionaries(spark, sf), path, checkpoint, None, ORDINARY
    ).awaitTermination()
    typed = rowjson.from_row_json(spark.read.parquet(path)).where(F.col("corrupt").isNull())
    return typed.select("event_id", *ROW_KEY)


def stream_window_rows(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_dir(spark, "stream-windows"), new_dir(spark, "checkpoint")
    streams.start_window_rows(
        _message_stream(spark, sf), dictionaries(spark, sf), path, checkpoint, None, ORDINARY
    ).awaitTermination()
    return _window_rows(spark.read.parquet(path))


def stream_rollup_5m(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_dir(spark, "stream-rollup"), new_dir(spark, "checkpoint")
    streams.start_rollup(
        _message_stream(spark, sf), dictionaries(spark, sf), path, checkpoint, None, ORDINARY
    ).awaitTermination()
    return _windows(spark.read.parquet(path), SERIES_KEY)


def stream_open_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """All windows of a stream, those included that no watermark has closed yet."""
    path, checkpoint = new_dir(spark, "stream-windows"), new_dir(spark, "checkpoint")
    streams.start_open_rollup(
        _message_stream(spark, sf), dictionaries(spark, sf), path, checkpoint, None, ORDINARY, shards=1
    ).awaitTermination()
    return _windows(streams.read_windows(spark, path), SERIES_KEY)


def stream_upserts(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections in a first batch and what they correct in a second: the store keeps the former.

    The store is what the last row put in for each key leaves.
    """
    sent, path, checkpoint = (new_dir(spark, name) for name in ("sent", "stream-writes", "checkpoint"))
    rows = fixtures.derive_replayed(jobs.metric_rows(messages(spark, sf), dictionaries(spark, sf), ORDINARY))
    columns = [*ROW_KEY, "METRIC", "seq"]
    for later in (True, False):
        part = rows.where((F.col("seq") != F.col("event_id")) == later).select(*columns)
        part.write.mode("append").parquet(f"{sent}/part={int(not later)}")
        source = file_messages(spark, f"{sent}/part=*", part.schema)
        streams.start_newest_writes(source, ["seq"], path, checkpoint, None, "3650 days").awaitTermination()
    put = spark.read.parquet(path).withColumn("_put", F.col("version"))
    return upsert.latest_per_key(put, ["_put"], tie=None).select(*ROW_KEY, "seq", *flat_cell("METRIC", *MEASURES))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    decode_payload,
    explode_events,
    unpivot_metrics,
    reverse_time,
    metric_dictionary,
    metric_conflicts,
    hierarchy_row,
    hierarchy_rows,
    host_hierarchy,
    known_metrics,
    unknown_metrics,
    host_lookup,
    metric_rows,
    metric_rows_large_dictionary,
    metric_rows_as_of,
    metric_rows_as_of_large_dictionary,
    metric_rows_default_env,
    datasource_rows,
    all_rows,
    union_rows,
    quarantine,
    recovered_entries,
    drop_counts,
    redriven_rows,
    unknown_fields,
    row_json,
    json_typed_rows,
    stored_metric_decode,
    row_schema,
    upsert_latest,
    compacted_log,
    compacted_dates,
    merged_buckets,
    store_rows,
    batch_peek,
    sliding_window_rows,
    rollup_5m,
    rollup_5m_by_env,
    refreshed_rollup,
    stream_metric_rows,
    stream_hot_keys,
    stream_quarantine,
    stream_row_json,
    stream_window_rows,
    stream_rollup_5m,
    stream_open_rollup,
    stream_upserts,
]


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name, each with the session settings the library needs."""

    def ready(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf: query(prepare(spark), sf.rstrip("/"))

    return {query.__name__: ready(query) for query in QUERIES}
