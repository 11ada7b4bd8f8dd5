"""Repaired messages, fields nobody declared, and one read per batch."""

from collections import Counter

from pyspark.sql import functions as F

from tidemark.plans import queries, redrive
from tidemark.plans import rows as jobs
from tidemark.schemas import ROW_KEY
from tidemark.session import new_dir
from tidemark.sinks import table
from tidemark.sources import fixtures
from tidemark.sources import messages as logs
from tidemark.streaming import jobs as streams

from .helpers import WIRE, dictionaries, event, payload, plan, value

KEY = "202401010500|h1|i0"


def click(n, name="click", **rest):
    return event(n, {KEY: {name: value(total=float(n))}}, **rest)


def sent(spark, *rows):
    return spark.createDataFrame([(i, payload(o)) for i, o in rows], "message_id bigint, value string")


def written(spark, frame):
    path = new_dir(spark, "log")
    table.write_log(frame, path)
    return path


def ids(frame):
    return sorted((r.message_id is None, r.message_id or 0, r.event_id, r.event_pos) for r in frame.collect())


def test_only_what_was_set_aside_comes_in_and_once(spark):
    found = dictionaries(spark)
    first = sent(spark, (1, [5, click(11)]), (2, "["), (3, [click(31)]), (None, [click(41), 7]), (4, "{"))
    log = written(spark, jobs.tagged_rows(first, found, WIRE))
    assert table.read_log(spark, log).count() == 3 and table.read_log(spark, log, outcome=table.BAD).count() == 4
    # 3 was read, so what is sent under its name is left alone; 4 is still as it was.
    again = sent(spark, (1, [click(10), click(11)]), (2, [click(20), click(20)]), (3, [click(32)]), (None, [click(41), click(42)]), (4, "{"))
    second = new_dir(spark, "log")
    redrive.take_in(spark, [log], second, again, found, WIRE)
    new = table.read_log(spark, second)
    assert ids(new) == [(False, 1, 10, 0), (False, 2, 20, 0), (False, 2, 20, 1), (True, 0, 42, 1)]
    assert table.read_log(spark, second, outcome=table.BAD).count() == 0
    third = new_dir(spark, "log")
    redrive.take_in(spark, [log, second], third, again, found, WIRE)
    assert table.read_log(spark, third).count() == table.read_log(spark, third, outcome=table.BAD).count() == 0


def test_a_repair_that_fails_in_another_way_is_set_aside(spark):
    found = dictionaries(spark)
    log = written(spark, jobs.tagged_rows(sent(spark, (1, "[")), found, WIRE))
    more = written(spark, redrive.redriven(
        table.read_log(spark, log, outcome=table.BAD), table.read_log(spark, log), sent(spark, (1, [click(1), 5])), found, WIRE
    ))
    assert [r.reason for r in table.read_log(spark, more, outcome=table.BAD).collect()] == ["bad_event"]
    assert table.read_log(spark, more).count() == 1


def test_reading_again_with_other_options_is_a_repair(spark):
    """Messages of another codec, without a change of the messages."""
    found = dictionaries(spark)
    plainly = spark.createDataFrame([(1, '[{"event_id":1,"metrics":{"%s":{"click":{"host":"h1","count":1}}}}]' % KEY)], "message_id bigint, value string")
    log = written(spark, jobs.tagged_rows(plainly, found, WIRE))
    options = jobs.Options(codec="plain", carry=WIRE.carry)
    rows = redrive.redriven(table.read_log(spark, log, outcome=table.BAD), table.read_log(spark, log), plainly, found, options)
    assert [(r.MID, r.HOST, r.reason) for r in rows.collect()] == [(2, "h1", None)]


def test_an_empty_quarantine_drives_nothing(spark):
    found = dictionaries(spark)
    log = written(spark, jobs.tagged_rows(sent(spark, (1, [click(1)])), found, WIRE))
    rows = redrive.redriven(table.read_log(spark, log, outcome=table.BAD), table.read_log(spark, log), sent(spark, (1, [click(1), click(2)])), found, WIRE)
    assert rows.count() == 0


def test_rows_of_other_messages_are_not_shuffled(spark, sf):
    found = queries.dictionaries(spark, sf)
    log = written(spark, jobs.tagged_rows(fixtures.table(spark, sf, "damaged"), found, WIRE))
    frame = redrive.redriven(table.read_log(spark, log, outcome=table.BAD), table.read_log(spark, log), fixtures.table(spark, sf, "repaired"), found, WIRE)
    assert plan(frame).count("BroadcastHashJoin") >= 2 and "NestedLoop" not in plan(frame) and "Cartesian" not in plan(frame)


def test_unknown_fields_survive(spark):
    options = jobs.Options(carry=WIRE.carry, extra="extra")
    odd = '[%s,{"event_id":2,"metrics":{"%s":{"click":{"host":"h1","count":1}}},"deep":{"a":1,"a":2},"note":"x","note":"5","none":null}]'
    texts = [odd % ("null", KEY), [click(1, trace={"user": 7, "tags": ["a", 2.5]}), 5, click(3)], "["]
    messages = sent(spark, *enumerate(texts))
    both = jobs.tagged_rows(messages, dictionaries(spark), options)
    assert Counter(r.reason for r in both.collect()) == {None: 3, "bad_event": 1, "bad_json": 1}
    rows = table.read_log(spark, written(spark, both))
    got = {r.event_id: (r.user, r.tag, r.note, r.deep, r.text) for r in rows.select(
        "event_id", F.variant_get("extra", "$.trace.user", "bigint").alias("user"), F.variant_get("extra", "$.trace.tags[1]", "double").alias("tag"),
        F.variant_get("extra", "$.note", "string").alias("note"), F.variant_get("extra", "$.deep.a", "int").alias("deep"), F.to_json("extra").alias("text"),
    ).collect()}
    assert got[1][:4] == (7, 2.5, None, None) and got[2][:4] == (None, None, "5", 2) and got[3][4] == "{}"
    assert '"none":null' in got[2][4]
    # The rows are those that are read without the column.
    plain = jobs.metric_rows(messages, dictionaries(spark), WIRE).select("message_id", "event_pos", *ROW_KEY, "METRIC")
    assert sorted(map(str, rows.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_unknown_fields_of_a_stream(spark, sf):
    path = new_dir(spark, "rows")
    source = logs.file_messages(spark, fixtures.table_path(spark, sf, "extended"), fixtures.MESSAGES)
    options = jobs.Options(carry=WIRE.carry, extra="extra")
    streams.start_rows(source, queries.dictionaries(spark, sf), path, new_dir(spark, "checkpoint"), None, options).awaitTermination()
    rows = table.read_log(spark, path)
    assert rows.count() > 0 and rows.where(F.variant_get("extra", "$.trace.user", "bigint").isNull()).count() == 0


def test_batches_count_every_record(spark, sf):
    found, path, seen = queries.dictionaries(spark, sf), new_dir(spark, "log"), {}
    damaged = fixtures.table(spark, sf, "damaged")
    streams.batch_writer(found, path, WIRE, counted=seen.__setitem__)(damaged, 3)
    want = Counter({r.fate: r.n for r in jobs.fates(damaged, found, WIRE).groupBy("fate").agg(F.count("*").alias("n")).collect()})
    aside = sum(n for fate, n in want.items() if fate not in ("kept", "unknown_name", "no_place"))
    assert seen == {3: {"kept": want["kept"], "unknown_name": want["unknown_name"], "no_place": want["no_place"], "set_aside": aside}}


def test_a_store_batch_is_read_once(spark, sf):
    """Rows to the store, records set aside to their folder, and counts, from one read of the messages."""
    found, seen = queries.dictionaries(spark, sf), {}
    store, bad = new_dir(spark, "store"), new_dir(spark, "bad")
    reads = spark.sparkContext.accumulator(0)
    once = F.udf(lambda v: reads.add(1) or v)
    damaged = fixtures.table(spark, sf, "damaged")
    counted = damaged.withColumn("value", once("value"))
    write = streams.store_writer(found, ["event_id"], WIRE, as_json=True, fmt="parquet", path=store, bad=bad, show=2, counted=seen.__setitem__)
    write(counted, 1)
    assert reads.value == damaged.count()
    write(damaged, 1)  # again after a failure
    aside = spark.read.parquet(bad)
    assert sorted((r.message_id, r.unit, r.reason) for r in aside.collect()) == sorted((r.message_id, r.unit, r.reason) for r in jobs.quarantine(damaged).collect())
    assert seen[1]["set_aside"] == aside.count() and seen[1]["corrupt"] == 0 and seen[1]["kept"] == jobs.metric_rows(damaged, found, WIRE).count()
    assert not {"MID", "HOST", "METRIC"} & set(aside.columns)
