import base64
import gzip
import json
from datetime import datetime, timezone

from tidemark.functions.time import LONG_MAX
from tidemark.operators.dictionary import Dictionaries
from tidemark.operators.lookup import measured
from tidemark.plans.rows import Options


WIRE = Options(carry=(("event_id", "bigint"),))


def payload(obj) -> str:
    text = obj if isinstance(obj, str) else json.dumps(obj)
    return base64.b64encode(gzip.compress(text.encode())).decode()


def messages(spark, *objs):
    rows = [(i, payload(o)) for i, o in enumerate(objs)]
    return spark.createDataFrame(rows, "message_id bigint, value string")


def value(host="h1", instance="i0", count=1, total=2.0, low=2.0, high=2.0):
    return {
        "host": host,
        "instance": instance,
        "count": count,
        "sum": total,
        "min": low,
        "max": high,
    }


def event(event_id=1, metrics=None, datasources=None, **rest):
    out = {"event_id": event_id, **rest}
    if metrics is not None:
        out["metrics"] = metrics
    if datasources is not None:
        out["datasources"] = datasources
    return out


def reverse(bucket: str) -> int:
    at = datetime.strptime(bucket, "%Y%m%d%H%M").replace(tzinfo=timezone.utc)
    return LONG_MAX - int(at.timestamp() * 1000)


def dictionaries(spark, names=None, hosts=None) -> Dictionaries:
    names = names or [("click", 2), ("error", 1), ("dsmetrics", 5)]
    hosts = hosts or [("h1", "prod", "cart"), ("h2", "qa", "web")]
    return Dictionaries(
        measured(spark.createDataFrame(names, "NAME string, MID int"), "NAME"),
        measured(spark.createDataFrame(hosts, "host string, env string, app string"), "host"),
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
