"""State of streams: windows that are open, last writes over batches, and what ends them."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rollup, upsert
from tidemark.plans import queries, rows as jobs
from tidemark.schemas import ROW, ROW_KEY, SERIES_KEY
from tidemark.session import new_dir
from tidemark.sources import fixtures, messages as logs
from tidemark.streaming import jobs as streams, state

from .helpers import reverse

START = "202401010000"


def held(rows):
    return sorted(repr(tuple(r)) for r in rows.collect())


def row(minute, seq=0, host="h", app="a", instance="i", mid=1, count=1, total=1.0, low=1.0, high=1.0, items=None):
    at = reverse(START) - minute * 60_000
    return (mid, at, "e", app, host, instance, (count, total, low, high, items), seq)


SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ROW.fields) + ", seq long"


class Feed:
    """A stream of rows, run once for each batch put in."""

    def __init__(self, spark, start):
        self.spark, self.start = spark, start
        self.source, self.path, self.checkpoint = (new_dir(spark, n) for n in ("source", "out", "checkpoint"))

    def put(self, *rows):
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(self.source)
        return self.run()

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).parquet(self.source)
        query = streams._to_files(self.start(stream), self.path, self.checkpoint, None).start()
        query.awaitTermination()
        return query

    def out(self):
        return self.spark.read.parquet(self.path)


@pytest.fixture(scope="module")
def files(spark, sf):
    path = new_dir(spark, "files")
    fixtures.table(spark, sf, "messages").coalesce(1).sort("message_id").write.option("maxRecordsPerFile", 40).parquet(path)
    return path


def test_open_windows_over_many_batches(spark, sf, files):
    found = queries.dictionaries(spark, sf)
    path, checkpoint = new_dir(spark, "windows"), new_dir(spark, "checkpoint")
    source = logs.file_messages(spark, files, fixtures.MESSAGES, max_files=1)
    query = streams.start_open_rollup(source, found, path, checkpoint, None, queries.ORDINARY, delay="10 days", shards=2)
    query.awaitTermination()
    assert len(query.recentProgress) > 1
    want = rollup.rollup(jobs.metric_rows(spark.read.parquet(files), found, queries.ORDINARY))
    parts = [*SERIES_KEY, "window_start", "window_end", *queries.flat_cell()]
    assert held(streams.read_windows(spark, path).select(*parts)) == held(want.select(*parts))


def windows(feed, key=SERIES_KEY):
    parts = [*key, F.unix_millis("window_start"), *queries.flat_cell()]
    return held(state.newest_windows(feed.out(), key).select(*parts))


def plain(spark, rows, key=SERIES_KEY, **more):
    done = rollup.rollup(spark.createDataFrame(rows, SCHEMA), key, **more)
    return held(done.select(*key, F.unix_millis("window_start"), *queries.flat_cell()))


def test_a_window_comes_again_when_it_changes(spark):
    feed = Feed(spark, lambda s: state.open_rollup(s, delay="1 hour", shards=2))
    first = [row(0), row(58, total=2.0, low=2.0, high=2.0), row(61), row(3, app=None, instance=None)]
    first += [row(4, count=None, total=None, low=None, high=None), row(5, items="[1]")]
    feed.put(*first)
    assert windows(feed) == plain(spark, first)
    updates = feed.out().count()
    more = [row(59, total=-1.0, low=-1.0, high=-1.0), row(3, app=None, instance=None, count=4)]
    feed.put(*more)
    assert windows(feed) == plain(spark, first + more)
    # Only changed windows came out again: five for each of the two rows.
    assert feed.out().count() == updates + 10
    assert feed.out().groupBy(*SERIES_KEY, "window_start", "version").count().where("count > 1").count() == 0


@pytest.mark.parametrize("length, slide, block", [(5, 1, 5), (10, 4, 12), (3, 3, 60), (7, 2, 9)])
def test_windows_of_any_shape(spark, length, slide, block):
    shape = {"length_minutes": length, "slide_minutes": slide, "block_minutes": block}
    feed = Feed(spark, lambda s: state.open_rollup(s, ["MID"], "1 day", shards=1, **shape))
    parts = [[row(m * 3 + k, total=float(m)) for m in range(12)] for k in (0, 1)]
    for part in parts:
        feed.put(*part)
    assert windows(feed, ["MID"]) == plain(spark, parts[0] + parts[1], ["MID"], **shape)


def test_a_batch_that_runs_again_changes_nothing(spark):
    feed = Feed(spark, lambda s: state.open_rollup(s, delay="1 day", shards=1))
    feed.put(row(0))
    feed.put(row(1, total=5.0))
    before = held(feed.out())
    # The second batch's commit is lost, as after a crash behind its output.
    os.remove(f"{feed.checkpoint}/commits/1")
    for crc in (f"{feed.checkpoint}/commits/.1.crc",):
        if os.path.exists(crc):
            os.remove(crc)
    feed.run()
    assert held(feed.out()) == before
    feed.put(row(2))
    assert windows(feed) == plain(spark, [row(0), row(1, total=5.0), row(2)])


def test_state_ends_behind_the_watermark(spark):
    feed = Feed(spark, lambda s: state.open_rollup(s, delay="10 minutes", shards=1))
    feed.put(*(row(m) for m in range(0, 180, 7)))
    query = feed.put(row(60 * 24))
    last = query.recentProgress[-1].stateOperators[0]
    assert last.numRowsTotal <= 2
    late = feed.put(row(1, total=9.0))
    # Once for each block that its windows begin in.
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in late.recentProgress if p.stateOperators) == 2
    assert windows(feed) == plain(spark, [*(row(m) for m in range(0, 180, 7)), row(60 * 24)])


def test_a_hot_key_moves_as_a_few_rows(spark):
    rows = spark.range(200_000).select(
        F.lit(1).alias("MID"), (F.lit(reverse(START)) - F.pmod("id", F.lit(120)) * 60_000).alias("RTIME"), F.lit("e").alias("ENV"), F.lit("a").alias("APP"),
        F.lit("h").alias("HOST"), F.lit("i").alias("INSTANCE"), F.expr("named_struct('count', 1L, 'sum', 1D, 'min', 1D, 'max', 1D, 'items', cast(null as string))").alias("METRIC"), F.col("id").alias("seq"),
    )
    moved = []
    original = state._stateful
    try:
        state._stateful = lambda packed, *rest: moved.append(packed) or original(packed, *rest)
        state.open_rollup(rows, shards=4)
        state.newest_writes(rows, ["seq"], shards=4)
    finally:
        state._stateful = original
    tasks = rows.rdd.getNumPartitions()
    # A task holds 100,000 rows at most, in three blocks; a series has one shard, its writes four.
    assert moved[0].count() <= 2 * tasks * 3 and moved[1].count() <= 2 * tasks * 3 * 4
    assert moved[0].agg(F.max(F.length("_held"))).first()[0] < 20_000


def stored(feed):
    """What a store holds that takes the rows as they come."""
    put = feed.out().withColumn("_put", F.col("version"))
    return upsert.latest_per_key(put, ["_put"], tie=None).select(*ROW_KEY, "seq", "METRIC")


def test_an_older_record_of_a_later_batch_is_refused(spark):
    feed = Feed(spark, lambda s: state.newest_writes(s, ["seq"], keep="1 day", shards=2))
    batches = [
        [row(0, 5, total=5.0), row(0, 3, total=3.0), row(1, 1, app=None, instance=None)],
        [row(0, 4, total=4.0), row(1, 2, total=2.0, app=None, instance=None), row(2, None)],
        [row(0, 5, total=5.0), row(2, 1), row(0, 5, total=4.0), row(1, 2, total=7.0, app=None, instance=None)],
        [row(0, 6, count=None, items="x")],
    ]
    for batch in batches:
        feed.put(*batch)
    sent = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    assert held(stored(feed)) == held(upsert.latest_per_key(sent, ["seq"]).select(*ROW_KEY, "seq", "METRIC"))
    # 0: seq 5, then 6. 1: seq 1, 2, then the larger value. 2: without a position, then 1. Nothing twice.
    assert feed.out().count() == 7
    with pytest.raises(ValueError):
        state.newest_writes(sent, ["seq"], ["MID"])


def test_writes_behind_the_kept_time_cannot_overwrite(spark):
    feed = Feed(spark, lambda s: state.newest_writes(s, ["seq"], keep="30 minutes", shards=1))
    feed.put(row(0, 5), row(600, 1))
    feed.put(row(601, 1))  # the watermark moves on
    late = feed.put(row(0, 4), row(0, 9), row(602, 1))
    assert feed.out().where("HOST = 'h'").count() == 4
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in late.recentProgress if p.stateOperators) == 1


def test_rows_are_put_into_the_store_as_they_come(spark):
    path = new_dir(spark, "store")
    write = streams.put_rows("parquet", "append", path=path)
    write(spark.createDataFrame([row(0, 1), row(1, 2)], SCHEMA), 0)
    kept = spark.read.parquet(path)
    assert kept.columns == [*ROW_KEY, "METRIC"] and kept.count() == 2


