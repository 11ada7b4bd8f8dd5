"""Changes merged into a table in buckets that is not moved."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.schemas import ROW_KEY
from tidemark.session import new_dir
from tidemark.sinks import buckets, table
from tests.helpers import plan, reverse
from tests.test_keyed import WRITTEN

FIRST, SECOND, THIRD = (reverse(f"2024010{d}0000") for d in (1, 2, 3))


def rows_of(spark, *rows):
    """Rows (time, MID, APP, seq, sum)."""
    return spark.createDataFrame([(m, at, "qa", app, "h1", None, (1, s, s, s, None), seq) for at, m, app, seq, s in rows], WRITTEN)


def log_of(spark, *rows):
    path = new_dir(spark, "log")
    table.write_log(rows_of(spark, *rows), path)
    return path


def held(frame):
    return sorted(((r.RTIME, r.MID, r.APP, r.seq, r.METRIC["sum"]) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def base(spark):
    path = new_dir(spark, "base")
    rows = [(at, m, app, 1, 1.0) for at in (FIRST, SECOND) for m in range(50) for app in ("a", "", None)]
    buckets.write_buckets(rows_of(spark, *rows).repartition(3), path, 8)
    return path


def test_a_file_per_date_and_bucket(spark, base):
    files = [f for f in os.listdir(f"{base}/event_date=2024-01-01") if f.endswith(".parquet")]
    assert len(files) <= 8 and len({f.rsplit("_", 1)[1] for f in files}) == len(files)
    assert buckets.bucket_count(spark, base) == 8 and buckets.read_buckets(spark, base).count() == 300
    with pytest.raises(AnalysisException):
        buckets.write_buckets(rows_of(spark, (FIRST, 1, "a", 1, 1.0)), base, 8)


def test_the_base_is_not_moved(spark, base):
    changes = table.read_log(spark, log_of(spark, (FIRST, 1, "a", 2, 9.0)))
    day = buckets.read_buckets(spark, base).where("event_date = '2024-01-01'")
    text = plan(buckets.merged(day, changes, ["seq"], 8))
    above = text[: text.index("Bucketed: true")]
    assert "Exchange" not in above and "Union" in above and "Exchange" in text[len(above) :]
    assert "event_date=2024-01-02" not in text


def test_the_last_write_wins_and_other_dates_stay(spark, base):
    log = log_of(
        spark,
        (FIRST, 1, "a", 2, 9.0), (FIRST, 1, "a", 3, 8.0), (FIRST, 1, "", 0, 7.0), (FIRST, 1, None, 2, 6.0),
        (FIRST, 99, "new", 1, 5.0), (THIRD, 1, "a", 1, 4.0),
    )
    once = new_dir(spark, "merged")
    buckets.merge_changes(spark, [base], [log], once, ["seq"])
    assert sorted(table.dates_of(buckets.read_buckets(spark, once))) == ["2024-01-01", "2024-01-03"]
    now = buckets.read_table(spark, base, once)
    want = {(at, m, app): (1, 1.0) for at in (FIRST, SECOND) for m in range(50) for app in ("a", "", None)}
    want |= {(FIRST, 1, "a"): (3, 8.0), (FIRST, 1, None): (2, 6.0), (FIRST, 99, "new"): (1, 5.0), (THIRD, 1, "a"): (1, 4.0)}
    assert held(now) == sorted(((*k, *v) for k, v in want.items()), key=repr)
    # A merge into both folders, with a log that was merged before and a later write.
    late = log_of(spark, (FIRST, 1, "a", 4, 3.0), (SECOND, 2, "a", 0, 2.0))
    twice = new_dir(spark, "merged")
    buckets.merge_changes(spark, [base, once], [late, log], twice, ["seq"])
    assert held(buckets.read_table(spark, base, once, twice)) == sorted(((*k, *v) for k, v in (want | {(FIRST, 1, "a"): (4, 3.0)}).items()), key=repr)


def test_a_hot_key_is_one_row_of_its_bucket(spark, base):
    log = log_of(spark, *[(FIRST, 3, "a", i, float(i)) for i in range(500)])
    target = new_dir(spark, "merged")
    buckets.merge_changes(spark, [base], [log], target, ["seq"])
    got = buckets.read_buckets(spark, target)
    assert got.count() == 150 and got.where("MID = 3 AND APP = 'a'").first().seq == 499
    text = plan(buckets.merged(buckets.read_buckets(spark, base), table.read_log(spark, log), ["seq"], 8))
    assert text.rindex("WindowGroupLimit") > text.rindex("Exchange hashpartitioning")


def test_no_changes_and_no_rows(spark, base):
    nothing, target, empty = log_of(spark), new_dir(spark, "merged"), new_dir(spark, "base")
    buckets.merge_changes(spark, [base], [nothing], target, ["seq"])
    assert buckets.read_table(spark, base, target).count() == 300
    buckets.write_buckets(rows_of(spark), empty, 4)
    assert buckets.read_buckets(spark, empty).count() == 0
    filled = new_dir(spark, "merged")
    buckets.merge_changes(spark, [empty], [log_of(spark, (FIRST, 1, None, 1, 1.0))], filled, ["seq"])
    assert held(buckets.read_table(spark, empty, filled)) == [(FIRST, 1, None, 1, 1.0)]
    with pytest.raises(ValueError):
        buckets.merge_changes(spark, [base, empty], [nothing], new_dir(spark, "merged"), ["seq"])


def test_a_column_that_only_changes_have(spark, base):
    log = new_dir(spark, "log")
    table.write_log(rows_of(spark, (FIRST, 1, "a", 2, 9.0)).withColumn("note", F.lit("x")), log)
    target = new_dir(spark, "merged")
    buckets.merge_changes(spark, [base], [log], target, ["seq"])
    rows = buckets.read_table(spark, base, target)
    assert rows.where("note = 'x'").count() == 1 and rows.select(*ROW_KEY).distinct().count() == 300
