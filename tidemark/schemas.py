"""Every schema the library declares, in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# Types a carried field can have. Text fits every value.
KINDS = {"string": STRING, "bigint": LONG, "int": INT, "double": DOUBLE}

# One measured value, as it arrives on the wire.
WIRE_METRIC = T.StructType(
    [
        T.StructField("host", STRING),
        T.StructField("instance", STRING),
        T.StructField("count", LONG),
        T.StructField("sum", DOUBLE),
        T.StructField("min", DOUBLE),
        T.StructField("max", DOUBLE),
    ]
)

# The stored METRIC cell. Ordinary rows fill count..max, datasource rows items.
METRIC = T.StructType(
    [
        T.StructField("count", LONG),
        T.StructField("sum", DOUBLE),
        T.StructField("min", DOUBLE),
        T.StructField("max", DOUBLE),
        T.StructField("items", STRING),
    ]
)

# The six key columns of a metric row; the key is what an upsert replaces by.
ROW_KEY = ["MID", "RTIME", "ENV", "APP", "HOST", "INSTANCE"]
# A series is a key without its time.
SERIES_KEY = ["MID", "ENV", "APP", "HOST", "INSTANCE"]

ROW_JSON = T.StructType(
    [
        T.StructField("MID", INT, False),
        T.StructField("RTIME", LONG, False),
        T.StructField("ENV", STRING, False),
        T.StructField("APP", STRING),
        T.StructField("HOST", STRING, False),
        T.StructField("INSTANCE", STRING),
    ]
)

ROW = T.StructType(ROW_JSON.fields + [T.StructField("METRIC", METRIC)])

METRIC_DICTIONARY = T.StructType([T.StructField("ID", INT), T.StructField("NAME", STRING)])
HIERARCHY = T.StructType([T.StructField("rowkey", STRING), T.StructField("qualifier", STRING)])

# Column that takes the text of an event which does not fit the wire schema.
CORRUPT = "_corrupt_record"


def wire_event(
    metrics: bool = True,
    datasources: bool = True,
    env_key: str = "environment",
    app_key: str = "appname",
    carry: Sequence[tuple[str, str]] = (),
) -> T.StructType:
    """Schema of one JSON event, holding only the parts a job will read.

    Leaving out a part keeps the JSON parser from building its maps: columns
    are not pruned through the explodes that follow, so the schema says it. A carried
    field whose value is not of its type makes the event unreadable.
    """
    fields = [
        *(T.StructField(name, KINDS[kind]) for name, kind in carry),
        T.StructField(env_key, STRING),
        T.StructField(app_key, STRING),
    ]
    if metrics:
        fields.append(
            T.StructField("metrics", T.MapType(STRING, T.MapType(STRING, WIRE_METRIC)))
        )
    if datasources:
        fields.append(
            T.StructField(
                "datasources", T.MapType(STRING, T.MapType(STRING, T.ArrayType(STRING)))
            )
        )
    fields.append(T.StructField(CORRUPT, STRING))
    return T.StructType(fields)
