"""Dictionaries that change in time, and hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, dictionary, lookup
from tidemark.operators.dictionary import Dictionaries
from tidemark.operators.lookup import Dictionary, hot_keys, measured
from tidemark.plans import queries, rows as jobs
from tidemark.session import new_dir
from tidemark.sinks import table
from tidemark.sources import fixtures
from tidemark.streaming import jobs as streams

from .helpers import plan

HOUR = asof.BLOCK
VERSIONS = "k string, v int, w string, since long, until long"
WAYS = ["gathered", "merged", "swept"]


def joined(spark, rows, versions, how, way):
    frame = spark.createDataFrame(rows, "id long, key string, at long, m map<string,int>")
    given = spark.createDataFrame(versions, VERSIONS)
    if way == "swept":
        return asof.swept(frame, given, "key", "k", F.col("at"), how, salts=3)
    # By shuffle a stream takes the way of a small dictionary, here called for itself.
    found = Dictionary(given, "k", len(versions), True)
    if way == "merged":
        match = asof.gathered(given, "k").withColumnRenamed("k", "_key")
        both = lookup._matched(frame, match, "key", how, ("a",)).withColumn("_held", asof.picked(F.col("at"))).drop("_versions")
        return asof.spread(both, ["v", "w"], F.col("at"), how)
    return lookup.lookup(frame, found, "key", how, F.col("at"))


def plain(rows, versions, how):
    best = {}
    for k, v, w, since, until in versions:
        if k is None or since is None:
            continue
        low = lambda x: (x is not None, x if x is not None else 0)
        now = (low(until), low(v), (w is not None, w or ""))
        if (k, since) not in best or now < best[k, since][0]:
            best[k, since] = now, (until, v, w)
    out = []
    for i, key, at, _ in rows:
        held = [] if key is None or at is None else [(s, b[1]) for (k, s), b in best.items() if k == key and s <= at]
        until, v, w = max(held)[1] if held else (None, None, None)
        found = bool(held) and (until is None or at < until)
        if found or how == "left":
            out.append((i, key, at, *((v, w) if found else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("how", ["inner", "left"])
def test_versions_against_a_plain_search(spark, way, how):
    rng = random.Random(4)
    versions = [(rng.choice("abc"), i, rng.choice(["x", None]), rng.randrange(0, 9 * HOUR, HOUR // 4), rng.choice([None, None, 5 * HOUR])) for i in range(60)]
    versions += [("a", None, "n", 2 * HOUR, None), (None, 1, "x", 0, None), ("d", 1, "x", None, None), ("e", 7, "late", 20 * HOUR, None), ("a", 3, "x", -HOUR, None)]
    rows = [(i, rng.choice(["a", "a", "b", "c", "d", "e", None]), rng.choice([rng.randrange(-2 * HOUR, 12 * HOUR), HOUR * rng.randrange(9)]), {"x": i}) for i in range(300)]
    rows += [(900, "a", None, None), (901, "a", HOUR, None), (901, "a", HOUR, None)]
    got = [(r.id, r.key, r.at, r.v, r.w) for r in joined(spark, rows, versions, how, way).collect()]
    assert sorted(got, key=repr) == plain(rows, versions, how)


@pytest.mark.parametrize("way", WAYS)
def test_no_versions_and_no_rows(spark, way):
    rows = [(1, "a", 5, None)]
    assert [tuple(r) for r in joined(spark, rows, [], "left", way).drop("m").collect()] == [(1, "a", 5, None, None)]
    assert joined(spark, rows, [], "inner", way).count() == 0
    assert joined(spark, [], [("a", 1, "x", 0, None)], "left", way).count() == 0


def test_neither_way_compares_every_row_with_every_version(spark, sf):
    found = queries.changing_dictionaries(spark, sf)
    large = Dictionaries(*(Dictionary(d.rows, d.key, d.count, False) for d in (found.metrics, found.hosts)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for given in (found, large):
            text = plan(jobs.metric_rows(queries.messages(spark, sf), given, queries.ORDINARY))
            assert "NestedLoop" not in text and "Cartesian" not in text
        assert "BroadcastHashJoin" in plan(jobs.metric_rows(queries.messages(spark, sf), found, queries.ORDINARY))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_key_of_a_sweep_meets_in_no_task(spark):
    """A third of 60,000 rows have one key, in ten hours; each part is an hour and a salt."""
    rows = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"), (F.col("id") * 600).alias("at"))
    versions = spark.createDataFrame([("hot", n, "x", n * HOUR // 2, None) for n in range(30)], VERSIONS)
    held = asof.swept(rows, versions, "key", "k", F.col("at"), "left")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = held.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("v").alias("found")).agg(F.max("n"), F.sum("found")).first()
        assert sizes[0] < 60_000 / 20 and sizes[1] == 20_000
        assert held.where("key = 'hot' AND v IS NULL").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_what_a_changing_dictionary_asks_for(spark):
    found = measured(spark.createDataFrame([("a", 1, "x", 0, None)], VERSIONS), "k")
    rows = spark.createDataFrame([(1, "a")], "id long, key string")
    assert found.changes
    for how, at in (("left", None), ("left_anti", F.lit(1))):
        with pytest.raises(ValueError):
            lookup.lookup(rows, found, "key", how, at)


def test_raw_versions_are_resolved(spark):
    meta = spark.createDataFrame([(2, "click", 0), (1, "click", 0), (5, "click", 10), (1, None, 0), (1, "x", None)], "ID int, NAME string, since long")
    places = spark.createDataFrame([(" h1 ", "qa", "b", 0, None), ("h1", "prod", " a ", 0, 9), ("", "qa", "b", 0, None), (None, "qa", "b", 0, None)], "host string, env string, app string, since long, until long")
    found = dictionary.resolve_versions(meta, places, new_dir(spark, "dictionaries"))
    assert sorted(tuple(r) for r in found.metrics.rows.collect()) == [("click", 1, 0), ("click", 5, 10)]
    assert [tuple(r) for r in found.hosts.rows.collect()] == [("h1", "prod", "a", 0, 9)]
    with pytest.raises(ValueError):
        dictionary.resolve_versions(meta.limit(0), places, new_dir(spark, "dictionaries"))


@pytest.mark.parametrize("small", [True, False])
def test_streams_take_versions_too(spark, sf, small):
    found = queries.changing_dictionaries(spark, sf)
    given = Dictionaries(*(Dictionary(d.rows, d.key, d.count, small, ("h1", "click")) for d in (found.metrics, found.hosts)))
    path = new_dir(spark, "rows")
    streams.start_rows(queries._message_stream(spark, sf), given, path, new_dir(spark, "checkpoint"), None, queries.ORDINARY).awaitTermination()
    got = table.read_log(spark, path).select("event_id", "MID", "ENV", "APP")
    want = jobs.metric_rows(queries.messages(spark, sf), found, queries.ORDINARY).select("event_id", "MID", "ENV", "APP")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_rows_of_a_hot_key_are_split(spark):
    """One key holds a third of the rows; without adaptive plans it still meets in no task."""
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("key"))
    entries = rows.select(F.col("key").alias("k")).distinct().withColumn("v", F.length("k"))
    assert hot_keys(rows, "key") == ("hot",)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        largest = {}
        for hot in ((), ("hot",)):
            done = lookup.lookup(rows, Dictionary(entries, "k", 901, False, hot), "key", "left")
            assert done.columns == ["id", "key", "v"] and "SortMergeJoin" in plan(done)
            sizes = done.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("v").alias("found")).collect()
            assert sum(r.n for r in sizes) == sum(r.found for r in sizes) == 30_000
            largest[hot] = max(r.n for r in sizes)
        assert largest[()] >= 10_000 and largest[("hot",)] < 30_000 / 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_keys_come_from_a_log(spark, sf):
    log = queries._all_rows(spark, sf)
    found = dictionary.with_hot_keys(queries.dictionaries(spark, sf), log, 0.15)
    ids = {r.MID for r in log.groupBy("MID").count().where(f"count > {0.15 * log.count()}").collect()}
    names = {r.NAME for r in found.metrics.rows.collect() if r.MID in ids}
    assert set(found.metrics.hot) == names and set(found.hosts.hot) <= {f"h{k}" for k in range(7)} and found.hosts.hot
    assert hot_keys(log.limit(0), "HOST") == ()
    assert fixtures.DAY == 24 * HOUR
