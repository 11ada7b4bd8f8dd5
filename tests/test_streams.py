"""Streams give what batch gives, over several micro-batches."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import job, queries, rows as jobs
from tidemark.schemas import ROW_KEY
from tidemark.session import new_dir
from tidemark.sinks import table
from tidemark.sources import fixtures, messages as logs
from tidemark.streaming import jobs as streams, state


@pytest.fixture(scope="module")
def files(spark, sf):
    """The message log in time order, one file per part of the time."""
    path = new_dir(spark, "files")
    fixtures.table(spark, sf, "messages").coalesce(1).sort("message_id").write.option(
        "maxRecordsPerFile", 30
    ).parquet(path)
    return path


def held(rows):
    return sorted(repr(tuple(r)) for r in rows.collect())


def test_rows_over_many_batches(spark, sf, files):
    found = queries.dictionaries(spark, sf)
    path, checkpoint = new_dir(spark, "rows"), new_dir(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        source = logs.file_messages(spark, files, fixtures.MESSAGES, max_files=1)
        query = streams.start_rows(source, found, path, checkpoint, None)
        query.awaitTermination()
    got = table.read_log(spark, path).drop("event_date")
    want = jobs.metric_rows(spark.read.parquet(files), found)
    assert held(got.select(*want.columns)) == held(want)


def test_rollup_over_many_batches(spark, sf, files):
    found = queries.dictionaries(spark, sf)
    path, checkpoint = new_dir(spark, "rollup"), new_dir(spark, "checkpoint")
    source = logs.file_messages(spark, files, fixtures.MESSAGES, max_files=1)
    # A watermark wider than the disorder between files, so that no row is late.
    query = streams.start_rollup(source, found, path, checkpoint, None, delay="10 days")
    query.awaitTermination()
    got = spark.read.parquet(path)
    batch = queries.rollup.rollup(
        jobs.metric_rows(spark.read.parquet(files), found, queries.ORDINARY)
    )
    newest = jobs.metric_rows(spark.read.parquet(files), found, queries.ORDINARY).agg(
        F.max(queries.rollup.event_time())
    ).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 10 DAYS"))
    parts = [*queries.SERIES_KEY, "window_start", "window_end", *queries.flat_cell()]
    assert held(got.select(*parts)) == held(closed.select(*parts))
    assert got.count() > 0


def test_a_batch_owns_its_folder(spark, sf, files):
    found, path = queries.dictionaries(spark, sf), new_dir(spark, "batches")
    asked = []

    def fresh():
        asked.append(1)
        return found

    write = streams.batch_writer(fresh, path)
    log = spark.read.parquet(files)
    parts = log.where("message_id < 40"), log.where("message_id >= 40")
    for batch_id, part in enumerate(parts):
        write(part, batch_id)
    once = held(table.read_log(spark, path))
    write(parts[1], 1)  # run again after a failure
    assert held(table.read_log(spark, path)) == once
    assert len(once) == jobs.metric_rows(log, found).count() and len(asked) == 3


@pytest.mark.parametrize("as_json", [False, True])
def test_a_store_gets_the_last_row_of_each_key(spark, sf, files, as_json):
    found, path = queries.dictionaries(spark, sf), new_dir(spark, "store")
    log = spark.read.parquet(files)
    write = streams.store_writer(
        found, ["event_id"], queries.WIRE, as_json=as_json, fmt="parquet", mode="append", path=path
    )
    write(log.union(log), 0)  # every message twice
    stored = spark.read.parquet(path)
    assert stored.columns == (ROW_KEY if as_json else [*ROW_KEY, "METRIC"])
    keys = jobs.metric_rows(log, found).select(*ROW_KEY).distinct()
    assert held(stored.select(*ROW_KEY)) == held(keys)


def test_files_per_date_are_bounded(spark, sf, files):
    found = queries.dictionaries(spark, sf)
    path, checkpoint = new_dir(spark, "rows"), new_dir(spark, "checkpoint")
    source = logs.file_messages(spark, files, fixtures.MESSAGES, max_files=1)
    query = streams.start_rows(source, found, path, checkpoint, None, files=2)
    query.awaitTermination()
    batches = len(query.recentProgress)
    seen = query.recentProgress[0].observedMetrics["fates"]
    assert seen.kept > 0 and seen.unknown_name > 0
    made = table.read_log(spark, path).select("event_date", F.input_file_name().alias("file")).distinct()
    assert made.groupBy("event_date").count().agg(F.max("count")).first()[0] <= 2 * batches


def test_a_query_runs_at_its_interval(spark, sf, files):
    asked = []

    class Writer:
        def trigger(self, **how):
            asked.append(how)

    streams.timed(Writer()), streams.timed(Writer(), "7 seconds"), streams.timed(Writer(), None)
    assert asked == [{"processingTime": "500 seconds"}, {"processingTime": "7 seconds"}, {"availableNow": True}]
    # Two ticks and more: one file for each, so four batches.
    found, path = queries.dictionaries(spark, sf), new_dir(spark, "rows")
    source = logs.file_messages(spark, files, fixtures.MESSAGES, max_files=1)
    query = streams.start_rows(source, found, path, new_dir(spark, "checkpoint"), "1 second")
    query.processAllAvailable()
    query.stop()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4


def test_dictionaries_of_past_batches_are_removed(spark, sf):
    given = ["batches", "--path", "p", "--checkpoint", "c", "--metric-ids", fixtures.table_path(spark, sf, "metric_ids"), "--hierarchy", fixtures.table_path(spark, sf, "hierarchy")]
    fresh = job._fresh(spark, job.parser().parse_args(given))
    first, second = fresh(), fresh()
    assert second.metrics.rows.count() == 5
    with pytest.raises(Exception):
        first.metrics.rows.count()


def test_an_empty_log_can_be_read(spark, sf, files):
    found, path = queries.dictionaries(spark, sf), new_dir(spark, "rows")
    none = spark.read.parquet(files).where("false")
    table.write_log(jobs.tagged_rows(none, found), path)
    assert table.read_log(spark, path).count() == 0
    bad = spark.createDataFrame([(1, "%%%")], none.schema)
    table.write_log(jobs.tagged_rows(bad, found), path)
    assert table.read_log(spark, path).count() == 0
    assert dict(table.read_log(spark, path, outcome=table.BAD).dtypes)["event_date"] == "date"
    table.remove(spark, path)


def test_records_set_aside_go_to_their_own_folder(spark, sf):
    path = new_dir(spark, "bad")
    damaged = fixtures.table_path(spark, sf, "damaged")
    source = logs.file_messages(spark, damaged, fixtures.MESSAGES)
    streams.start_quarantine(source, path, new_dir(spark, "checkpoint"), None).awaitTermination()
    assert spark.read.parquet(path).count() == jobs.quarantine(spark.read.parquet(damaged)).count()


def test_command_line_of_the_store(spark, sf, monkeypatch):
    given = ["store", "--checkpoint", "c", "--hierarchy", "h", "--metric-ids", "m", "--files", fixtures.table_path(spark, sf, "messages"),
             "--order", "event_id", "--carry", "event_id:bigint", "--format", "parquet", "--option", "path=/x", "--as-json", "--default-env", "e"]
    taken = {}
    monkeypatch.setattr(job.jobs, "store_writer", lambda *a, **k: taken.update(args=a, options=k))
    monkeypatch.setattr(job.jobs, "start_batches", lambda *a: taken.update(started=a))
    job.start(spark, job.parser().parse_args(given))
    _, order, options, as_json, fmt, mode, show = taken["args"]
    assert (order, as_json, fmt, mode, show) == (["event_id"], True, "parquet", "overwrite", 0)
    assert options.carry == (("event_id", "bigint"),) and options.default_env == "e" and taken["options"] == {"path": "/x"}
    for wrong in (["store", *given[1:-8]], ["rows", *given[1:7]]):
        with pytest.raises(SystemExit):
            job.start(spark, job.parser().parse_args([w for w in wrong if w not in ("--order", "event_id")]))


def test_a_peek_reads_what_was_written_and_not_the_messages(spark, sf, files, capsys):
    found, path = queries.dictionaries(spark, sf), new_dir(spark, "json")
    source = logs.file_messages(spark, files, fixtures.MESSAGES, max_files=1)
    streams.start_row_json(source, found, path, new_dir(spark, "checkpoint"), None).awaitTermination()
    peeked = streams.written_rows(spark, path)
    query = peeked.writeStream.format("memory").queryName("peeked").option("checkpointLocation", new_dir(spark, "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert held(spark.table("peeked")) == held(spark.read.parquet(path)) and spark.table("peeked").count() > 3
    streams.show_rows(3)(spark.read.parquet(path), 0)
    assert capsys.readouterr().out.count('{"MID"') == 3


def test_command_line_of_a_peek(spark, sf, monkeypatch):
    path, taken = new_dir(spark, "job"), []
    given = ["rows", "--show", "3", "--path", path, "--checkpoint", new_dir(spark, "checkpoint"), "--interval", "once",
             "--files", fixtures.table_path(spark, sf, "messages"), "--metric-ids", fixtures.table_path(spark, sf, "metric_ids"),
             "--hierarchy", fixtures.table_path(spark, sf, "hierarchy")]
    monkeypatch.setattr(job.jobs, "start_batches", lambda rows, write, *rest: taken.append((rows, rest)))
    job.start(spark, job.parser().parse_args(given))
    ((rows, (checkpoint, interval)),) = taken
    assert rows.isStreaming and checkpoint == f"{given[6]}-show" and interval is None
    assert set(spark.read.parquet(path).columns) == set(rows.columns)


def test_kafka_options():
    assert logs.kafka_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "Default",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "kafka.group.id": "Default-Handler",
    }
    more = logs.kafka_options("a:1,b:2", "t", None, "earliest", 1000, 64)
    assert more["maxOffsetsPerTrigger"] == "1000" and more["minPartitions"] == "64"
    assert "kafka.group.id" not in more


def test_command_line_of_a_store_over_batches(spark, sf, monkeypatch):
    given = ["store", "--checkpoint", "c", "--hierarchy", fixtures.table_path(spark, sf, "hierarchy"), "--metric-ids", fixtures.table_path(spark, sf, "metric_ids"),
             "--files", fixtures.table_path(spark, sf, "messages"), "--order", "event_id", "--carry", "event_id:bigint", "--option", "table=t", "--keep", "2 days"]
    taken = {}
    monkeypatch.setattr(job.jobs, "start_store", lambda *a, **k: taken.update(args=a, options=k))
    job.start(spark, job.parser().parse_args(given))
    assert taken["args"][2] == ["event_id"] and taken["args"][6] == "2 days" and taken["options"] == {"table": "t"}
    with pytest.raises(SystemExit):
        job.start(spark, job.parser().parse_args([*given, "--as-json"]))


@pytest.mark.parametrize("mode", ["rows", "keep-all", "json", "windows", "rollup", "open-rollup"])
def test_command_line(spark, sf, mode):
    path = new_dir(spark, "job")
    given = {
        "path": path,
        "checkpoint": new_dir(spark, "checkpoint"),
        "interval": "once",
        "files": fixtures.table_path(spark, sf, "messages"),
        "metric-ids": fixtures.table_path(spark, sf, "metric_ids"),
        "hierarchy": fixtures.table_path(spark, sf, "hierarchy"),
    }
    argv = [mode, *(x for k, v in given.items() for x in (f"--{k}", v))]
    job.start(spark, job.parser().parse_args(argv)).awaitTermination()
    assert spark.read.parquet(path).count() > 0


def test_stream_upserts_splits_a_block_of_time_over_shards(spark, sf, monkeypatch):
    """A block's keys are spread over shards, so that no state holds all rows of an hour."""
    given, start = [], streams.start_newest_writes

    def spy(*args, **settings):
        given.append(settings.get("shards", state.SHARDS))
        return start(*args, **settings)

    monkeypatch.setattr(streams, "start_newest_writes", spy)
    assert queries.stream_upserts(spark, sf).count() > 0
    assert given and min(given) > 1


def test_dealt_spreads_a_large_date_with_the_batch(spark):
    """One outcome and date read by many tasks is shared by more than ``files`` tasks."""
    rows = spark.range(0, 4000, 1, 16).select(
        F.lit("good").alias("outcome"),
        F.lit("2024-01-01").cast("date").alias("event_date"),
        *[F.col("id").cast("string").alias(c) for c in ROW_KEY],
        F.col("id").cast("string").alias("raw"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        out = streams.dealt(rows, files=2).withColumn("task", F.spark_partition_id())
        sizes = [r["n"] for r in out.groupBy("task").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == 4000
    assert len(sizes) > 4 and max(sizes) < 4000 // 4
