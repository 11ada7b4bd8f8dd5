"""Message text -> events -> buckets -> one entry per metric.

One narrow pass: each message is parsed once and both kinds of metric come out
of the same pass. A record that cannot be read keeps its place in the output
with a ``reason``, so one write can hold the good rows and the quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cell, rowkey, time, whole
from tidemark.functions import text as texts
from tidemark.schemas import CORRUPT, STRING, WIRE_METRIC, wire_event

# Reasons a record is set aside, by the unit that failed.
BAD_PAYLOAD = "bad_payload"  # message: not base64, damaged or missing
BAD_JSON = "bad_json"  # message: not a JSON array
BAD_EVENT = "bad_event"  # event: not an object of the wire schema
BAD_ROWKEY = "bad_rowkey"  # bucket: no time prefix, or too few parts
BAD_TIME = "bad_time"  # bucket: the prefix is no valid minute
BAD_METRIC = "bad_metric"  # metric: no value under its name
BAD_ITEM = "bad_item"  # datasource bucket: an item that is no object
TOO_LARGE = "too_large"  # message: longer than a text can be

# Fixed value: the dictionary name all datasource rows are stored under.
DATASOURCE_NAME = "dsmetrics"


_VALUES = T.MapType(STRING, WIRE_METRIC)
_LISTS = T.MapType(STRING, T.ArrayType(STRING))
_BUCKETS = T.ArrayType(
    T.StructType(
        [
            T.StructField("rowkey", STRING),
            T.StructField("values", _VALUES),
            T.StructField("lists", _LISTS),
        ]
    )
)


def _last_of_each(held: Column) -> Column:
    """Entries of a map read from JSON. Of a key that comes twice the last counts."""
    keys = F.map_keys(held)
    behind = lambda e, i: F.size(keys) - F.array_position(F.reverse(keys), e["key"]) == i
    entries = F.map_entries(held)
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(F.filter(entries, behind))


def _unknown(event: Column, known: Sequence[str]) -> Column:
    """The fields of an event's text outside the wire schema, as a variant object."""
    held = F.from_json(event, T.MapType(STRING, T.VariantType()))
    names = [*known, "metrics", "datasources"]
    return F.to_variant_object(F.map_from_entries(F.filter(_last_of_each(held), lambda e: ~e["key"].isin(names))))


def explode_events(
    decoded: DataFrame,
    metrics: bool = True,
    datasources: bool = True,
    env_key: str = "environment",
    app_key: str = "appname",
    carry: Sequence[tuple[str, str]] = (),
    extra: str | None = None,
) -> DataFrame:
    """One row per event of each decoded message; null array elements are skipped.

    Adds ``event_pos``, ``event``, ``reason`` and ``raw`` in place of ``text`` and
    ``rejected``. An unreadable message or event stays as one row with a reason. A message
    is one array and nothing else: two arrays, also of two compressed members, or text
    after the array make it unreadable, and it is kept whole. ``carry`` names fields of
    an event to take along, with their types. ``extra`` names a column for all its fields
    outside the wire schema, as one variant; each event is then parsed from its own text.
    """
    ids = [c for c in decoded.columns if c not in ("text", "rejected", "too_large")]
    schema = wire_event(metrics, datasources, env_key, app_key, carry)
    size = [F.col("too_large")] if "too_large" in decoded.columns else []
    text = F.col("text")
    message = decoded.select(*ids, "text", "rejected", *size, whole.parse(text, T.ArrayType(schema)).alias("_message"))
    # One event that does not fit must not cost its neighbours: just the messages that hold
    # one are split, and parsed event by event.
    fine = F.lit(False) if extra else whole.fits(F.col("_message"), text, array=True)
    again = F.when(~fine, whole.parse(text, T.ArrayType(STRING)))
    message = message.select("*", fine.alias("_fine"), again.alias("_split"))
    pieces = whole.value(F.col("_split"))
    apart = F.transform(pieces, lambda piece: F.from_json(piece, schema))
    if extra:
        apart = F.transform(pieces, lambda piece: F.struct(F.from_json(piece, schema).alias("_event"), _unknown(piece, schema.names).alias("_extra")))
    split = F.when(whole.fits(F.col("_split"), text, array=True), apart)
    events = split if extra else F.when(F.col("_fine"), whole.value(F.col("_message"))).otherwise(split)
    listed = message.select(*ids, "text", "rejected", *size, events.alias("_events"))
    unread = F.lit(BAD_PAYLOAD)
    if size:
        unread = F.when(F.col("too_large"), F.lit(TOO_LARGE)).otherwise(unread)
    reason = F.when(F.col("text").isNull(), unread).when(F.col("_events").isNull(), F.lit(BAD_JSON))
    raw = F.when(F.col("_events").isNull(), F.coalesce("rejected", "text"))
    # The outer form keeps unreadable messages. It also keeps Spark from adding a
    # filter below that would parse every message a second time.
    exploded = listed.select(*ids, reason.alias("_bad"), raw.alias("_raw"), "_events").select(
        *ids, "_bad", "_raw", F.posexplode_outer("_events").alias("event_pos", "_event")
    )
    more = []
    if extra:
        # A struct stands around each event here.
        held = F.col("_event")["_extra"].alias(extra)
        exploded, more = exploded.select(*ids, "_bad", "_raw", "event_pos", F.col("_event")["_event"].alias("_event"), held), [extra]
    broken = F.col("_event")[CORRUPT]
    fields = [F.col("_event")[name].alias(name) for name, _ in carry]
    fields += [F.col("_event")[env_key].alias("environment")]
    fields += [F.col("_event")[app_key].alias("appname")]
    fields += [
        F.col("_event")[part].alias(part)
        for part, on in (("metrics", metrics), ("datasources", datasources))
        if on
    ]
    return exploded.where(F.col("_event").isNotNull() | F.col("_bad").isNotNull()).select(
        *ids,
        "event_pos",
        *fields,
        *more,
        F.coalesce("_bad", F.when(broken.isNotNull(), F.lit(BAD_EVENT))).alias("reason"),
        F.coalesce("_raw", broken).alias("raw"),
    )


def collect_items(collection: Column) -> Column:
    """All datasource metrics of a bucket as one JSON array text, in sorted order.

    Items are JSON objects, written as Spark reads their text: numbers keep their value,
    not always their spelling. The sort makes the text independent of the order of the map. It stays inside
    one event, whose lists came in one message.
    """
    return F.concat(F.lit("["), F.array_join(F.sort_array(_items(collection)), ","), F.lit("]"))


def _items(collection: Column) -> Column:
    lists = F.transform(_last_of_each(collection), lambda e: e["value"])
    return F.flatten(F.filter(lists, lambda items: items.isNotNull()))


def items_are_objects(collection: Column) -> Column:
    """Whether every item of a datasource bucket is a JSON object."""
    return F.forall(_items(collection), lambda item: F.coalesce(F.json_object_keys(item).isNotNull(), F.lit(False)))


def unpivot_metrics(events: DataFrame, zone: str = "UTC") -> DataFrame:
    """One row per (bucket, metric name), and one per datasource bucket.

    Adds ``rowkey name host instance RTIME METRIC``. Empty or missing maps
    give no rows. A bucket or metric that cannot be read keeps one row with a
    reason.
    """
    has_metrics, has_datasources = ("metrics" in events.columns), ("datasources" in events.columns)
    ids = [c for c in events.columns if c not in ("metrics", "datasources", "reason", "raw")]
    readable = F.col("reason").isNull()

    # Both kinds of bucket as one list: (rowkey, values of a metric bucket, lists of a
    # datasource bucket), so that a single pass over the message yields both.
    arms = []
    if has_metrics:
        arms.append(
            F.transform(
                _last_of_each(F.col("metrics")),
                lambda e: F.struct(
                    e["key"].alias("rowkey"),
                    e["value"].alias("values"),
                    F.lit(None).cast(_LISTS).alias("lists"),
                ),
            )
        )
    if has_datasources:
        arms.append(
            F.transform(
                _last_of_each(F.col("datasources")),
                lambda e: F.struct(
                    e["key"].alias("rowkey"),
                    F.lit(None).cast(_VALUES).alias("values"),
                    e["value"].alias("lists"),
                ),
            )
        )
    filled = [F.coalesce(arm, F.array().cast(_BUCKETS)) for arm in arms]
    buckets = F.when(readable, F.concat(*filled) if len(filled) > 1 else filled[0])

    bucketed = events.select(*ids, "reason", "raw", F.explode_outer(buckets).alias("_bucket"))
    filled_bucket = (F.size("_bucket.values") > 0) | (F.size("_bucket.lists") > 0)
    listed = bucketed.where(F.col("reason").isNotNull() | filled_bucket).select(
        *ids,
        "reason",
        "raw",
        F.col("_bucket.rowkey").alias("rowkey"),
        F.col("_bucket.values").alias("_values"),
        collect_items(F.col("_bucket.lists")).alias("_items"),
        items_are_objects(F.col("_bucket.lists")).alias("_objects"),
        F.when(F.col("_bucket.lists").isNotNull(), rowkey.parts(F.col("_bucket.rowkey"))).alias(
            "_parts"
        ),
    )
    # The place of a datasource bucket is in its key; a short key does not say it.
    short = F.coalesce(F.size("_parts") < 3, F.lit(False))
    prefix = F.when(~short, rowkey.time_prefix(F.col("rowkey")))
    keyed = listed.withColumn("_prefix", prefix).withColumn(
        "RTIME", time.reverse_time(time.bucket_millis(F.col("_prefix"), zone))
    )
    reason = F.coalesce(
        "reason",
        F.when(F.col("_prefix").isNull(), F.lit(BAD_ROWKEY)).when(
            F.col("RTIME").isNull(), F.lit(BAD_TIME)
        ).when(~F.col("_objects"), F.lit(BAD_ITEM)),
    )
    checked = keyed.withColumn("reason", reason).select(
        *ids,
        "reason",
        F.when(F.col("reason").isNotNull(), F.coalesce("raw", "rowkey")).alias("raw"),
        "rowkey",
        "RTIME",
        "_items",
        "_parts",
        F.when(F.col("reason").isNull(), F.col("_values")).alias("_values"),
    )
    entries = checked.select(
        *ids,
        "reason",
        "raw",
        "rowkey",
        "RTIME",
        "_items",
        "_parts",
        F.inline_outer(_last_of_each(F.col("_values"))).alias("name", "_value"),
    )
    ordinary = F.col("_items").isNull()
    lost = F.col("reason").isNull() & ordinary & F.col("_value").isNull()
    value = F.col("_value")

    def place(field: str, part: int) -> Column:
        return texts.clean(F.when(ordinary, value[field]).otherwise(F.get("_parts", part)))

    return entries.select(
        *ids,
        "rowkey",
        F.when(ordinary, F.col("name")).otherwise(F.lit(DATASOURCE_NAME)).alias("name"),
        place("host", 1).alias("host"),
        place("instance", 2).alias("instance"),
        "RTIME",
        cell.metric(
            value["count"], value["sum"], value["min"], value["max"], F.col("_items")
        ).alias("METRIC"),
        F.when(lost, F.lit(BAD_METRIC)).otherwise(F.col("reason")).alias("reason"),
        F.when(lost, F.concat_ws("|", "rowkey", "name")).otherwise(F.col("raw")).alias("raw"),
    )


def good(entries: DataFrame) -> DataFrame:
    """Entries that could be read."""
    return entries.where(F.col("reason").isNull()).drop("reason", "raw")


def quarantine(entries: DataFrame) -> DataFrame:
    """Records set aside, one row per failing message, event, bucket or metric."""
    unit = (
        F.when(F.col("reason").isin(BAD_PAYLOAD, BAD_JSON, TOO_LARGE), F.lit("message"))
        .when(F.col("reason") == BAD_EVENT, F.lit("event"))
        .when(F.col("reason") == BAD_METRIC, F.lit("metric"))
        .otherwise(F.lit("bucket"))
    )
    kept = ["rowkey", "name", "host", "instance", "RTIME", "METRIC", "environment", "appname"]
    return entries.where(F.col("reason").isNotNull()).drop(*kept).withColumn("unit", unit)
