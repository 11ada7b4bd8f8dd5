from pyspark.sql import functions as F

from tidemark.functions import cell, rowkey, text, time
from tests.helpers import reverse


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


def rtime(spark, bucket, zone="UTC"):
    return one(spark, time.reverse_time(time.bucket_millis(F.col("b"), zone)), b=bucket)


def test_reverse_time_known_values(spark):
    assert rtime(spark, "201703031912") == 9223370548286455807
    assert rtime(spark, "201703031922") == 9223370548285855807
    assert rtime(spark, "201703031412", "America/New_York") == 9223370548286455807


def test_reverse_time_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rtime(spark, "202402292359") == reverse("202402292359")
        assert rtime(spark, "201703031412", "America/New_York") == 9223370548286455807
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_what_is_no_bucket(spark):
    for bad in ["202413010000", "202402300000", "202401012400", "202401010060", "2024010100",
                "2024010100001", "20240101000x", "+20240101000", "20240101 000", "", None,
                "196912312359"]:
        assert rtime(spark, bad) is None, bad


def test_time_key_sorts_newest_first_and_reads_back(spark):
    assert rtime(spark, "202401010001") < rtime(spark, "202401010000")
    row = spark.range(1).select(F.lit(reverse("202401010001")).alias("RTIME"))
    millis = row.select(F.unix_millis(time.from_reverse_time(F.col("RTIME"))).alias("x")).first().x
    assert millis == 1704067260000


def test_rowkey_parts_drop_trailing_empty_ones(spark):
    cases = {"t|h|i": 3, "t|h|": 2, "t|h||": 2, "t|h||x": 4, "t||i": 3, "t": 1, "|h|i": 3}
    for key, size in cases.items():
        assert one(spark, F.size(rowkey.parts(F.col("k"))), k=key) == size, key


def test_time_prefix(spark):
    assert one(spark, rowkey.time_prefix(F.col("k")), k="t|h|i") == "t"
    for key in ["|h|i", "nobar", "", None]:
        assert one(spark, rowkey.time_prefix(F.col("k")), k=key) is None


def test_clean_and_filled(spark):
    assert one(spark, text.clean(F.col("t")), t=" \t a b\r\n") == "a b"
    assert one(spark, text.clean(F.col("t")), t=None) is None
    assert [one(spark, text.filled(F.col("t")), t=t) for t in ("a", "", None)] == [True, False, False]


def test_cell_round_trip(spark):
    frame = spark.sql("SELECT 1 n UNION ALL SELECT 2")
    built = frame.select(
        cell.metric(F.lit(3), F.lit(4.5), F.lit(1.0), F.lit(2.5), F.lit('[{"k":"a\\"b"}]')).alias("m")
    )
    for binary in (False, True):
        loaded = built.select("m", cell.load(cell.store(F.col("m"), binary), binary).alias("back"))
        assert all(r.m == r.back for r in loaded.collect())
    assert built.select(cell.average(F.col("m")).alias("a")).first().a == 1.5


def test_cell_that_holds_something_else(spark):
    for stored in ["garbage", "[1]", '{"count":"x"}', None]:
        assert one(spark, cell.load(F.col("s")), s=stored) is None, stored
