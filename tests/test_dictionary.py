from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dictionary
from tidemark.operators.lookup import lookup, measured
from tidemark.session import new_dir
from tests.helpers import plan


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "rowkey string, qualifier string")


def places(frame):
    return sorted(tuple(r) for r in frame.collect())


WALK = [
    ("environment", "qa"), ("environment", " prod "), ("environment", "  "),
    ("qa.appname", "web"), ("prod.appname", "a.b"), ("prod.appname", " "),
    ("qa.web.hosts", "h2"), ("prod.a.b.hosts", "h9"), ("dev.x.hosts", "h7"),
]


def test_metric_dictionary_keeps_the_smallest_id(spark):
    rows = [(1, "error"), (1, "error"), (9, "error"), (2, "click"), (3, None)]
    meta = spark.createDataFrame(rows, "ID int, NAME string")
    assert places(dictionary.metric_dictionary(meta)) == [("click", 2), ("error", 1)]
    assert places(dictionary.metric_conflicts(meta)) == [("error", 2, 1)]


def test_hierarchy_walk_with_blank_and_dotted_names(spark):
    assert places(dictionary.host_dictionary(table(spark, *WALK))) == [
        ("h2", "qa", "web"), ("h9", "prod", "a.b")
    ]


def test_a_host_in_two_places_gets_the_smallest(spark):
    kv = table(spark, *WALK, ("prod.a.b.hosts", "h2"), ("qa.web.hosts", "h2"))
    assert places(dictionary.host_dictionary(kv))[0] == ("h2", "prod", "a.b")
    assert places(dictionary.host_conflicts(kv)) == [("h2", 2)]


def test_the_point_read_reaches_the_scan(spark):
    path = new_dir(spark, "kv")
    table(spark, *WALK).write.parquet(path)
    read = dictionary.read_row(spark.read.parquet(path), "environment")
    assert "EqualTo(rowkey,environment)" in plan(read)


def test_an_empty_metric_dictionary_is_refused(spark):
    none = spark.createDataFrame([], "ID int, NAME string")
    with pytest.raises(ValueError):
        dictionary.resolve(none, table(spark, *WALK), new_dir(spark, "dictionaries"))
    one = spark.createDataFrame([(2, "click")], "ID int, NAME string")
    nowhere = spark.createDataFrame([], "rowkey string, qualifier string")
    found = dictionary.resolve(one, nowhere, new_dir(spark, "dictionaries"))
    assert found.metrics.count == 1 and found.metrics.small and found.hosts.count == 0


def test_a_missing_dictionary_fails_the_job(spark):
    from pyspark.errors import AnalysisException

    from tidemark.sources import metadata

    with pytest.raises(AnalysisException):
        metadata.metric_ids_from_files(spark, new_dir(spark, "absent"))


def test_broadcast_only_within_the_measured_bound(spark):
    frame = spark.range(100).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 50).alias("v"))
    assert measured(frame, "k").small
    assert not measured(frame, "k", max_rows=99).small
    assert not measured(frame, "k", max_bytes=5000).small
    rows = spark.range(10).select(F.col("id").cast("string").alias("name"))
    assert "BroadcastHashJoin" in plan(lookup(rows, measured(frame, "k"), "name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(lookup(rows, measured(frame, "k", max_rows=1), "name"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_a_large_dictionary_gives_the_same_rows(spark, how):
    # One key holds a third of the rows, some have none, some are not in the dictionary.
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("name"),
        "id",
        F.struct("id", F.lit(None).cast("string").alias("t")).alias("nested"),
    )
    pairs = [("hot", 1)] + [(f"k{i}", i) for i in range(40)]
    small = measured(spark.createDataFrame(pairs, "NAME string, MID int"), "NAME")
    want = places(lookup(rows, small, "name", how).select("id"))
    large = lookup(rows, replace(small, small=False), "name", how)
    assert places(large.select("id")) == want
    assert large.columns == lookup(rows, small, "name", how).columns
    assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)


def test_a_hot_key_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    name = F.when(F.col("id") % 1000 == 999, "cold").otherwise("hot").alias("name")
    rows = spark.range(0, 40000, 1, 16).select(name, "id")
    pairs = spark.createDataFrame([("hot", 1), ("cold", 2)], "NAME string, MID int")
    large = replace(measured(pairs, "NAME"), small=False)
    for key, setting in settings.items():
        spark.conf.set(key, setting)
    try:
        joined = lookup(rows, large, "name", "left")
        assert joined.where("MID = 1").count() == 39960
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_resolving_takes_few_jobs(spark, sf):
    from tidemark.operators import dictionary
    from tidemark.session import new_dir
    from tidemark.sources import fixtures

    raw = [fixtures.table(spark, sf, name) for name in ("metric_ids", "hierarchy")]
    spark.sparkContext.setJobGroup("resolve", "")
    try:
        dictionary.resolve(*raw, new_dir(spark, "dictionaries"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("resolve")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    print(len(jobs))
    assert len(jobs) < 25
