"""Messages and dictionaries derived by Spark from the ``events`` table.

The tables hold no metric messages, so jobs and tests get theirs from here.
Nothing is sampled: every event becomes one JSON event, and the dictionaries
come from a pass over all events.
"""

from __future__ import annotations

import base64
import gzip
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import new_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the derived inputs (FIXTURES.md).
MESSAGE_EVENTS = 10
METRIC_IDS = {"error": 1, "click": 2, "purchase": 3, "signup": 4, "dsmetrics": 5}
APPS = ["cart", "web", "api"]

MESSAGES = T.StructType(
    [T.StructField("message_id", T.LongType()), T.StructField("value", T.StringType())]
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def attributes(ev: DataFrame) -> DataFrame:
    """The wire attributes of each event."""
    user, event = F.col("user_id"), F.col("event_id")
    mode = F.pmod(event, F.lit(5))
    return ev.select(
        event,
        F.expr(f"event_id div {MESSAGE_EVENTS}").alias("message_id"),
        F.date_format("ts", "yyyyMMddHHmm").alias("bucket"),
        F.concat(F.lit("h"), F.pmod(user, F.lit(7))).alias("host"),
        F.concat(F.lit("i"), F.pmod(event, F.lit(3))).alias("instance"),
        F.when(mode < 2, F.lit(None).cast("string"))
        .when(mode == 2, F.lit(""))
        .when(F.pmod(user, F.lit(2)) == 0, F.lit("qa"))
        .otherwise(F.lit("prod"))
        .alias("environment"),
        F.when(F.pmod(event, F.lit(4)) != 0, F.lit("shop")).alias("appname"),
        F.col("event_type").alias("name"),
        "value",
        "user_id",
        F.from_json("props", "struct<k:bigint>").alias("props"),
    )


def event_json(rowkey: Column | None = None) -> Column:
    """JSON text of one event, from the columns of :func:`attributes`."""
    key = F.concat_ws("|", "bucket", "host", "instance") if rowkey is None else rowkey
    value = F.col("value")
    cell = F.struct(
        "host",
        "instance",
        F.lit(1).cast("long").alias("count"),
        value.alias("sum"),
        value.alias("min"),
        value.alias("max"),
    )
    queue = F.array(F.struct(F.col("user_id").alias("n")))
    pools = F.struct(F.array("props").alias("pool"), queue.alias("queue"))
    return F.to_json(
        F.struct(
            "event_id",
            "environment",
            "appname",
            F.create_map(key, F.create_map(F.col("name"), cell)).alias("metrics"),
            F.create_map(key, pools).alias("datasources"),
        )
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The events of each message become one compressed JSON array."""
    for batch in batches:
        texts = ["[" + ",".join(held) + "]" for held in batch.column(1).to_pylist()]
        values = [base64.b64encode(gzip.compress(t.encode(), 6, mtime=0)) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values, pa.binary()).cast(pa.string())], MESSAGES.names
        )


def pack_messages(texts: DataFrame) -> DataFrame:
    """(message_id, event_id, event text) to (message_id, payload).

    A message holds its events in the order of their ids, whatever splits and order the
    input has; ten consecutive ids make a message, so a group is small.
    """
    held = F.array_sort(F.collect_list(F.struct("event_id", "text")))
    grouped = texts.groupBy("message_id").agg(held.alias("held"))
    return grouped.select("message_id", F.col("held.text").alias("texts")).mapInArrow(_pack, MESSAGES)


def derive_messages(ev: DataFrame) -> DataFrame:
    return pack_messages(attributes(ev).select("message_id", "event_id", event_json().alias("text")))


def derive_metric_ids(ev: DataFrame) -> DataFrame:
    """Raw (ID, NAME) rows, one or more per event: mostly repeats, some conflicts."""
    ids = F.create_map(*[F.lit(x) for pair in METRIC_IDS.items() for x in pair])
    kind = F.col("event_type")
    named = F.array(
        F.struct(ids[kind].alias("ID"), kind.alias("NAME")),
        F.struct(F.lit(METRIC_IDS["dsmetrics"]).alias("ID"), F.lit("dsmetrics").alias("NAME")),
        F.struct(F.when(kind == "error", F.lit(9)).alias("ID"), kind.alias("NAME")),
    )
    return ev.select(F.inline(named)).where(F.col("ID").isNotNull())


def derive_hierarchy(ev: DataFrame) -> DataFrame:
    """Key-value rows env -> applications -> hosts, taken from the hosts seen."""
    k = F.pmod(F.col("user_id"), F.lit(7)).cast("int")
    even = F.pmod(k, F.lit(2)) == 0
    env = F.when(even, F.lit("qa")).otherwise(F.lit("prod"))
    app = F.element_at(F.array(*[F.lit(a) for a in APPS]), (F.floor(k / 2) + 1).cast("int"))
    pairs = [
        (F.lit("environment"), F.when(even, F.lit("qa")).otherwise(F.lit(" prod "))),
        (F.lit("environment"), F.lit(" ")),
        (F.concat(env, F.lit(".appname")), app),
        (F.concat(env, F.lit("."), app, F.lit(".hosts")), F.concat(F.lit("h"), k)),
        (F.lit("prod.appname"), F.lit("a.b")),
        (F.lit("prod.a.b.hosts"), F.lit("h9")),
    ]
    rows = F.array(*[F.struct(r.alias("rowkey"), q.alias("qualifier")) for r, q in pairs])
    # h6 stays out of the hierarchy, as a host nobody registered.
    return ev.where(k < 6).select(F.inline(rows)).distinct()


DAY = 86_400_000


def _days(ev: DataFrame) -> DataFrame:
    """Every day with events, as a number and with its events' columns."""
    return ev.withColumn("day", F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / DAY))


def derive_metric_versions(ev: DataFrame) -> DataFrame:
    """Raw (ID, NAME, since) rows: names get another id every second day, from its start on."""
    ids = F.create_map(*[F.lit(x) for pair in METRIC_IDS.items() for x in pair])
    base = F.array(
        F.struct(ids[F.col("event_type")].alias("ID"), F.col("event_type").alias("NAME")),
        F.struct(F.lit(METRIC_IDS["dsmetrics"]).alias("ID"), F.lit("dsmetrics").alias("NAME")),
    )
    rows = _days(ev).where(F.col("day") % 2 == 0).select("day", F.inline(base)).where(F.col("ID").isNotNull())
    number = F.col("ID") + 10 * F.col("day") % 30
    return rows.select(number.cast("int").alias("ID"), "NAME", (F.col("day") * DAY).alias("since")).distinct()


def derive_place_versions(ev: DataFrame) -> DataFrame:
    """(host, env, app, since, until) rows: hosts move every third day; h2 is gone a day later."""
    k = F.pmod(F.col("user_id"), F.lit(7)).cast("int")
    turn = k + F.col("day").cast("int")
    since = F.col("day") * DAY + k * 3_600_000
    rows = _days(ev).where((F.pmod(F.col("day"), F.lit(3)) == 0) & (k < 6))
    return rows.select(
        F.concat(F.lit("h"), k).alias("host"),
        F.when(F.pmod(turn, F.lit(2)) == 0, F.lit("qa")).otherwise(F.lit(" prod ")).alias("env"),
        F.element_at(F.array(*[F.lit(a) for a in APPS]), F.pmod(turn, F.lit(3)).cast("int") + 1).alias("app"),
        since.alias("since"),
        F.when(k == 2, since + DAY).alias("until"),
    ).distinct()


def derive_damaged(ev: DataFrame) -> DataFrame:
    """One message per event, fifteen of sixteen spoilt or unusual in some way.

    Which way goes by ``event_id % 16``; every event is used.
    """
    mode = F.pmod(F.col("event_id"), F.lit(16))
    bad_key = (
        F.when(mode == 6, F.concat(F.lit("|"), "host", F.lit("|"), "instance"))
        .when(mode == 7, F.concat_ws("|", "bucket", "host"))
        .when(
            mode == 8,
            F.concat_ws(
                "|",
                F.concat(F.substring("bucket", 1, 4), F.lit("13"), F.substring("bucket", 7, 6)),
                "host",
                "instance",
            ),
        )
        .otherwise(F.concat_ws("|", "bucket", "host", "instance"))
    )
    whole = event_json(bad_key)
    stub = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"metrics":'))
    null_metric = F.concat(stub, F.lit('{"202401010000|h1|i0":{"click":null}}}'))
    piece = (
        F.when(mode == 4, F.lit('{"a":'))
        .when(mode == 5, F.concat(F.lit("null,"), whole))
        .when(mode == 9, F.concat(stub, F.lit("[1]},"), whole))
        .when(mode == 10, null_metric)
        # The message's own brackets stand around these.
        .when(mode == 12, F.concat(whole, F.lit("]["), whole))
        .when(mode == 13, F.concat(whole, F.lit("]} junk [")))
        .when(mode == 14, F.concat(whole, F.lit('],"events":['), whole))
        .when(mode == 15, F.regexp_replace(whole, '"pool":\\[', '"pool":["text",'))
        .otherwise(whole)
    )
    pieces = attributes(ev).select(
        F.col("event_id").alias("message_id"), "event_id", piece.alias("text")
    )
    how = F.pmod(F.col("message_id"), F.lit(16))
    value = (
        F.when(how == 0, F.lit(None).cast("string"))
        .when(how == 1, F.lit("%%%"))
        .when(how == 2, F.lit("not base64!"))
        .when(how == 3, F.base64(F.encode(F.lit("not compressed"), "UTF-8")))
        .otherwise(F.col("value"))
    )
    return pack_messages(pieces).select("message_id", value.alias("value"))


def derive_repaired(ev: DataFrame) -> DataFrame:
    """The messages of :func:`derive_damaged` as their sender meant them, each event in its place."""
    mode = F.pmod(F.col("event_id"), F.lit(16))
    whole = event_json()
    empty = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit("},"))
    piece = F.when(mode == 5, F.concat(F.lit("null,"), whole)).when(mode == 9, F.concat(empty, whole)).otherwise(whole)
    return pack_messages(attributes(ev).select(F.col("event_id").alias("message_id"), "event_id", piece.alias("text")))


def derive_extended(ev: DataFrame) -> DataFrame:
    """The messages with a field in each event that the wire schema does not know."""
    trace = F.struct(F.struct(F.col("user_id").alias("user"), F.array("name", "host").alias("tags")).alias("trace"))
    whole = event_json()
    text = F.concat(F.substr(whole, F.lit(1), F.length(whole) - 1), F.lit(","), F.substr(F.to_json(trace), F.lit(2)))
    return pack_messages(attributes(ev).select("message_id", "event_id", text.alias("text")))


def derive_replayed(rows: DataFrame) -> DataFrame:
    """All rows with ``seq``, and a corrected copy of the purchases sent later."""
    cell = F.col("METRIC")
    more = F.struct(
        cell["count"].alias("count"),
        *[(cell[c] + 1).alias(c) for c in ("sum", "min", "max")],
        cell["items"].alias("items"),
    )
    first = F.struct(cell.alias("METRIC"), F.col("event_id").alias("seq"))
    later = F.struct(more.alias("METRIC"), (F.col("event_id") + 1_000_000).alias("seq"))
    purchase = F.col("MID") == METRIC_IDS["purchase"]
    sent = F.when(purchase, F.array(first, later)).otherwise(F.array(first))
    rest = [c for c in rows.columns if c != "METRIC"]
    return rows.select(*rest, F.inline(sent))


DERIVED = {
    "messages": derive_messages,
    "damaged": derive_damaged,
    "repaired": derive_repaired,
    "extended": derive_extended,
    # The job's dictionaries are read from their distinct rows.
    "metric_ids": lambda ev: derive_metric_ids(ev).distinct(),
    "hierarchy": derive_hierarchy,
    "metric_versions": derive_metric_versions,
    "place_versions": derive_place_versions,
}


_PATHS: dict[tuple[str, str, str], str] = {}


def table_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a derived table lies, written once per application into the shared folder.

    Reading jobs then start from stored messages, as they would in use, and a lost
    executor costs one file and not the derivation.
    """
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _PATHS:
        path = new_dir(spark, name)
        DERIVED[name](events(spark, sf_dir)).write.parquet(path)
        _PATHS[slot] = path
    return _PATHS[slot]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, sf_dir, name))
