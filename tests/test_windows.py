"""Sliding windows and rollups against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.functions.time import LONG_MAX
from tidemark.operators import rollup
from tidemark.schemas import ROW
from tests.helpers import plan, reverse

MINUTE = 60_000
BASE = LONG_MAX - reverse("202401012355")


@pytest.fixture(scope="module")
def data(spark):
    """Rows over two hours; one series holds half of them, some have no app."""
    rng = random.Random(5)
    rows = []
    for _ in range(1500):
        hot = rng.random() < 0.5
        series = (1, "qa", "cart", "h1", "i0") if hot else (
            rng.randint(1, 3), "prod", rng.choice(["web", None]), f"h{rng.randint(1, 3)}", "i1"
        )
        at = BASE + rng.randint(0, 130) * MINUTE
        v = float(rng.randint(0, 50))
        rows.append((series[0], LONG_MAX - at, *series[1:], (rng.randint(1, 4), v, v, v + 1, None)))
    rows.append((5, LONG_MAX - BASE, "qa", "cart", "h1", "i0", (None, None, None, None, "[]")))
    return rows, spark.createDataFrame(rows, ROW).repartition(4)


def brute(rows, length, slide, pick):
    out = defaultdict(list)
    for mid, rtime, env, app, host, inst, m in rows:
        if m[4] is not None:
            continue
        at = LONG_MAX - rtime
        start = at - at % (slide * MINUTE)
        while start > at - length * MINUTE:
            out[(pick(mid, env, app, host, inst), start)].append(m)
            start -= slide * MINUTE
    return {
        k: (sum(m[0] for m in ms), sum(m[1] for m in ms), min(m[2] for m in ms), max(m[3] for m in ms))
        for k, ms in out.items()
    }


def found(frame, key):
    rows = frame.withColumn("at", F.unix_millis("window_start")).withColumn(
        "span", F.unix_millis("window_end") - F.col("at")
    )
    out = {}
    for r in rows.collect():
        m = r.METRIC
        out[(tuple(r[k] for k in key), r.at)] = (m["count"], m["sum"], m["min"], m["max"])
        spans = r.span
    return out, spans


@pytest.mark.parametrize("length,slide,block", [(5, 1, 60), (5, 1, 1), (7, 3, 60), (10, 5, 30), (90, 1, 60), (4, 4, 60)])
def test_rollup(data, length, slide, block):
    rows, frame = data
    key = ["MID", "ENV", "APP", "HOST", "INSTANCE"]
    got, span = found(rollup.rollup(frame, key, length, slide, block), key)
    assert got == brute(rows, length, slide, lambda *s: s)
    assert span == length * MINUTE


def test_rollup_by_fewer_keys(data):
    rows, frame = data
    got, _ = found(rollup.rollup(frame, ["MID", "ENV"]), ["MID", "ENV"])
    assert got == brute(rows, 5, 1, lambda mid, env, *_: (mid, env))


def test_the_streaming_form_agrees(data):
    rows, frame = data
    key = ["MID", "ENV", "APP", "HOST", "INSTANCE"]
    got, _ = found(rollup.stream_rollup(frame), key)
    assert got == brute(rows, 5, 1, lambda *s: s)


def test_windows_shorter_than_their_slide_are_refused(data):
    with pytest.raises(ValueError):
        rollup.rollup(data[1], length_minutes=1, slide_minutes=5)


def test_window_rows_are_every_row_once_per_window(data):
    rows, frame = data
    windows = rollup.sliding_window_rows(frame)
    assert windows.count() == 5 * len(rows)
    assert "Exchange hashpartitioning" not in plan(windows)


def test_windows_by_arrival(data):
    _, frame = data
    arrived = frame.withColumn("ingest_time", F.timestamp_millis(F.lit(BASE + 30_000)))
    starts = rollup.sliding_window_rows(arrived, F.col("ingest_time")).select("window.start").distinct()
    assert starts.count() == 5


def test_rollup_moves_rows_twice_and_merges_first(data):
    text = plan(rollup.rollup(data[1]))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.index("partial_sum") > 0 and "SortAggregate" not in text
