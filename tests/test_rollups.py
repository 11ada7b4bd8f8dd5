"""A stored rollup follows its table, and reads no more of it than what changed."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rollup
from tidemark.plans import queries
from tidemark.schemas import SERIES_KEY
from tidemark.session import new_dir
from tidemark.sinks import rollups, table
from tidemark.sources import fixtures


def held(windows):
    return sorted(repr(tuple(r)) for r in windows.select(*SERIES_KEY, "window_start", "window_end", *queries.flat_cell()).collect())


@pytest.fixture(scope="module")
def base(spark, sf):
    """A keyed table of all dates, and its rollup."""
    log, kept, windows = (new_dir(spark, n) for n in ("log", "base", "windows"))
    rows = queries._all_rows(spark, sf).withColumn("seq", F.col("event_id"))
    table.write_log(rows, log)
    table.compact(spark, [log], kept, ["seq"])
    rollups.write_rollup(table.read_log(spark, kept), windows)
    return rows, kept, windows


def follow(spark, base, rows):
    """The rollup after a change, a full one for comparison, and the part that was redone."""
    _, kept, windows = base
    later, changed, part = (new_dir(spark, n) for n in ("log", "changed", "windows"))
    table.write_log(rows, later)
    table.compact_changed(spark, kept, [later], changed, ["seq"])
    now = table.read_layers(spark, kept, changed)
    rollups.refresh_rollup(now, rollups.changed_dates(table.read_log(spark, later)), part)
    return held(rollups.read_rollup(spark, windows, part)), held(rollup.rollup(now)), part


def test_corrections_of_some_dates(spark, base):
    """Rows of three dates, two of them neighbours, get other values; all windows come out right."""
    rows = base[0].withColumn("event_date", F.to_date(rollup.event_time()))
    some = rows.where(F.col("event_date").isin(date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 20))).drop("event_date")
    sent = fixtures.derive_replayed(some.drop("seq")).where("seq <> event_id")
    got, want, redone = follow(spark, base, sent)
    assert got == want
    cells = {(r.window_date, r.spans) for r in spark.read.parquet(redone).select(*rollups.CELL).distinct().collect()}
    days = {date(2024, 1, d) for d in (5, 6, 20)}
    assert {d for d, spans in cells if not spans} <= days
    assert {d for d, spans in cells if spans} <= days | {date(2024, 1, 4), date(2024, 1, 19)}


def test_late_rows_at_the_border_of_a_date(spark, base):
    """New rows in the first and the last minutes of a date reach windows of both dates."""
    rows, kept, _ = base
    day = 1_704_844_800_000  # 2024-01-10
    late = rows.limit(1).crossJoin(spark.createDataFrame([(t,) for t in (day, day + 60_000, day + 86_400_000 - 60_000, day + 43_200_000)], "t long"))
    late = late.withColumns({"RTIME": F.lit(2**63 - 1) - F.col("t"), "seq": F.lit(10**9), "METRIC": F.expr("named_struct('count', 1L, 'sum', 7D, 'min', 7D, 'max', 7D, 'items', cast(null as string))")}).drop("t")
    got, want, redone = follow(spark, base, late)
    assert got == want
    spans = spark.read.parquet(redone).where("spans = 1").select("window_date").distinct().collect()
    assert {r.window_date for r in spans} >= {date(2024, 1, 9), date(2024, 1, 10)}


def test_other_dates_are_not_read(spark, base):
    _, kept, _ = base
    rows = table.read_log(spark, kept)
    some = rows.where(rollups._needed([date(2024, 1, 10)], 5 * 60_000))
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "RTIME" in text.split("PushedFilters")[1].split("]")[0]
    dates = {r.event_date for r in some.select("event_date").distinct().collect()}
    assert date(2024, 1, 10) in dates and dates <= {date(2024, 1, d) for d in (9, 10, 11)}
    pruned = text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "event_date" in pruned and " IN (" in pruned


def test_nothing_changed(spark, base):
    _, kept, windows = base
    part = new_dir(spark, "windows")
    rollups.refresh_rollup(table.read_log(spark, kept), [], part)
    assert held(rollups.read_rollup(spark, windows, part)) == held(rollup.rollup(table.read_log(spark, kept)))
    with pytest.raises(ValueError):
        rollups.refresh_rollup(table.read_log(spark, kept), [date(2024, 1, 1)], part, length_minutes=2000)
