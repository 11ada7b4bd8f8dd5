"""Upsert, log, compaction, row JSON, and what stores get."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cell
from tidemark.operators import rowjson
from tidemark.operators.upsert import latest_per_key
from tidemark.plans import rows as jobs
from tidemark.schemas import ROW, ROW_KEY
from tidemark.session import new_dir
from tidemark.sinks import stores, table
from tests.helpers import WIRE, dictionaries, event, messages, plan, reverse, value

R = reverse("202401010000")


WRITTEN = T.StructType([*ROW.fields, T.StructField("seq", T.LongType())])


def written(spark, *rows):
    """Rows (MID, APP, seq, sum) under one time, environment and host."""
    made = [
        (m, R, "qa", app, "h1", None, (1, total, total, total, None), seq)
        for m, app, seq, total in rows
    ]
    return spark.createDataFrame(made, WRITTEN)


def held(frame):
    return sorted(((r.MID, r.APP, r.seq, r.METRIC["sum"]) for r in frame.collect()), key=repr)


def test_the_last_write_wins_per_key_and_null_is_a_key(spark):
    rows = [(1, "a", 1, 1.0), (1, "a", 3, 3.0), (1, "a", 2, 2.0), (1, None, 1, 5.0), (1, None, 2, 6.0),
            (2, "a", 1, 9.0), (1, "b", None, 7.0), (1, "b", 0, 8.0)]
    want = [(1, "a", 3, 3.0), (1, "b", 0, 8.0), (1, None, 2, 6.0), (2, "a", 1, 9.0)]
    assert held(latest_per_key(written(spark, *rows), ["seq"])) == sorted(want, key=repr)


def test_equal_positions_are_decided_by_value(spark):
    rows = [(1, "a", 1, float(v)) for v in range(40)]
    for order in (rows, rows[::-1]):
        assert held(latest_per_key(written(spark, *order).repartition(4), ["seq"])) == [(1, "a", 1, 39.0)]


def test_a_hot_key_shrinks_before_the_shuffle(spark):
    frame = latest_per_key(written(spark, *[(1, "a", i, 1.0) for i in range(50)]), ["seq"])
    text = plan(frame)
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def sent(spark, total, bad=False):
    key = "202401010000|h1|i0"
    array = [event(7, metrics={key: {"click": value(total=total)}}), event(8, metrics={"202401020000|h2|i0": {"error": value("h2")}})]
    return jobs.tagged_rows(messages(spark, array, *(["["] if bad else [])), dictionaries(spark), WIRE)


def test_log_holds_rows_and_quarantine_and_prunes_by_date(spark):
    path = new_dir(spark, "log")
    table.write_log(sent(spark, 2.0, bad=True), path)
    log = table.read_log(spark, path)
    assert sorted(str(r.event_date) for r in log.collect()) == ["2024-01-01", "2024-01-02"]
    assert [r.reason for r in table.read_log(spark, path, outcome=table.BAD).collect()] == ["bad_json"]
    day = table.current(log, ["event_id"], dates=["2024-01-02"])
    assert day.count() == 1
    filters = [line for line in plan(day).split("PartitionFilters: [")[1:]]
    assert filters and all("outcome" in f.split("]")[0] and "event_date" in f.split("]")[0] for f in filters)


def test_only_changed_dates_are_compacted(spark):
    log, base, later, changed = (new_dir(spark, "t") for _ in range(4))
    table.write_log(sent(spark, 2.0), log)
    table.compact(spark, [log], base, ["event_id"])
    table.write_log(sent(spark, 5.0).where("MID = 2").withColumn("event_id", F.col("event_id") + 10), later)
    table.compact_changed(spark, base, [later], changed, ["event_id"])
    rows = table.read_layers(spark, base, changed)
    assert sorted((r.MID, r.METRIC["sum"]) for r in rows.collect()) == [(1, 2.0), (2, 5.0)]
    assert [str(r.event_date) for r in table.read_log(spark, changed).collect()] == ["2024-01-01"]


def test_writing_a_batch_again_leaves_the_table_as_it_was(spark):
    first, again, one, two = (new_dir(spark, "t") for _ in range(4))
    table.write_log(sent(spark, 2.0), first)
    table.write_log(sent(spark, 2.0), again)
    table.compact(spark, [first], one, ["event_id", "event_pos"])
    table.compact(spark, [one, again, first], two, ["event_id", "event_pos"])
    rows = [sorted(map(repr, table.read_log(spark, p).select(*ROW_KEY, "METRIC").collect())) for p in (one, two)]
    assert rows[0] == rows[1] and len(rows[0]) == 2
    with pytest.raises(AnalysisException):
        table.compact(spark, [first], one, ["event_id"])


def test_typed_rows_from_texts(spark):
    rows = [(i, R - i * 60_000, f"env{i}", None if i % 2 else f"app{i}", f"host{i}", f"i{i}") for i in range(1, 4)]
    fine = [json.dumps(dict(zip(reversed(ROW_KEY), reversed(row)))) for row in rows]
    unquoted = fine[0].replace('"MID"', '"METRIC": <cell 01ab>, "MID"')
    lacking = '{"MID":1,"RTIME":2,"ENV":"e"}'
    wrong = [unquoted, lacking, "", fine[0] + fine[1], fine[0] + " junk", f'{fine[0]}],"x":[{fine[1]}', f"[{fine[0]}]", '{"MID":"x"}']
    texts = [*fine, *wrong, None]
    typed = rowjson.from_row_json(spark.createDataFrame([(t,) for t in texts], "value string"))
    good = typed.where(F.col("corrupt").isNull()).collect()
    assert sorted(tuple(r[c] for c in ROW_KEY) for r in good) == sorted(rows)
    corrupt = sorted(r.corrupt for r in typed.where("corrupt IS NOT NULL").collect())
    assert corrupt == sorted([*wrong, ""])


def test_a_cell_is_one_object(spark):
    texts = ['{"count":1}', '{"count":1}{"count":2}', '{"count":1} junk', '{"count":1}],"x":[{}', "[]", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.m and r.m["count"] for r in frame.select(cell.load(F.col("t")).alias("m")).collect()] == [1, *[None] * 6]


def test_row_json_writes_nulls(spark):
    text = rowjson.to_row_json(written(spark, (1, None, 1, 1.0))).first().value
    assert text == '{"MID":1,"RTIME":%d,"ENV":"qa","APP":null,"HOST":"h1","INSTANCE":null}' % R


def test_what_stores_get(spark):
    assert stores.keyed_options("M") == {"table": "M", "zkUrl": "localhost:2181:/hbase-unsecure"}
    rows = written(spark, (1, "a", 1, 1.5))
    stored = stores.stored_rows(rows)
    assert stored.columns == [*ROW_KEY, "METRIC"] and dict(stored.dtypes)["METRIC"] == "binary"
    path = new_dir(spark, "store")
    stores.write_rows(stored, "parquet", "append", path=path)
    back = spark.read.parquet(path).select(cell.load(F.col("METRIC"), binary=True).alias("m")).first().m
    assert back["sum"] == 1.5 and back["count"] == 1
    keys = rowjson.from_row_json(rowjson.to_row_json(rows)).drop("corrupt")
    assert stores.stored_rows(keys.drop("seq")).columns == ROW_KEY


def test_a_staging_table_gets_the_last_row_of_each_key(spark, monkeypatch):
    sent = {}
    monkeypatch.setattr(stores, "write_rows", lambda rows, fmt, mode, **o: sent.update(rows=rows, fmt=fmt, mode=mode, **o))
    rows = written(spark, (1, "a", 1, 1.0), (1, "a", 2, 2.0), (2, "a", 1, 3.0))
    stores.write_jdbc_stage(rows, ["seq"], "jdbc:x", "stage", connections=3, user="u")
    got = sent.pop("rows")
    assert sent == {"fmt": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "stage", "batchsize": "10000", "numPartitions": "3", "user": "u"}
    assert got.columns == [*ROW_KEY, "METRIC"] and got.count() == 2


def test_peek(spark):
    rows = written(spark, *[(i, "a", i, 1.0) for i in range(30)])
    assert stores.peek(rows).count() == 10
    assert [r.MID for r in stores.peek(rows, 3, ["MID"]).collect()] == [0, 1, 2]


def test_a_date_with_most_rows_is_written_by_many_tasks(spark):
    rows = spark.range(20000).select(
        F.lit(1).alias("MID"),
        F.lit(R).alias("RTIME"),
        *[F.concat(F.lit(k), F.col("id")).alias(k) for k in ("ENV", "APP", "HOST", "INSTANCE")],
        F.struct(F.xxhash64("id").alias("count")).alias("METRIC"),
    )
    path = new_dir(spark, "log")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        table.write_log(rows.repartition(16), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files > 3 and table.read_log(spark, path).count() == 20000
