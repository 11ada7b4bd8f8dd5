"""State of streams by blocks of time: windows that are still open, and last writes over batches.

State is kept per block of event time and shard of the key, as one Arrow table, so a batch is
merged into it with vectorised steps and no call per key. A task merges its own rows before
they move, so a key that holds a third of them reaches its block as a few. The state of a
block ends once the watermark has passed all that could change it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.time import LONG_MAX
from tidemark.operators.rollup import MINUTE, PARTS, as_cell, measures, pane_millis
from tidemark.schemas import ROW_KEY, SERIES_KEY

SHARDS = 64
BLOCK_MINUTES = 60
# Rows that a task merges at a time before they move.
HELD_ROWS = 100_000

VERSION = "version"
_PACKED = "_block long, _shard int, _ts timestamp, _held binary"
_GIVEN = "version long, _held binary"
_STATE = "version long, _held binary"

Merge = Callable[[pa.Table], pa.Table]


def _to_bytes(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return out.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def _packed(rows: DataFrame, merge: Merge, delay: str) -> DataFrame:
    """Rows with ``_block``, ``_shard`` and ``_millis`` as one table per task, block and shard.

    A packed row's event time is its newest row's, so late rows ride along with others and
    count while their block is open.
    """
    schema = to_arrow_schema(StructType.fromDDL(_PACKED))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            table = merge(pa.Table.from_batches(held)).sort_by([("_block", "ascending"), ("_shard", "ascending")])
            block, shard = table["_block"].to_numpy(), table["_shard"].to_numpy()
            heads = np.nonzero(np.append(True, (block[1:] != block[:-1]) | (shard[1:] != shard[:-1])))[0]
            parts = [table.slice(i, j - i) for i, j in zip(heads, np.append(heads[1:], table.num_rows))]
            newest = pa.array([pc.max(p["_millis"]).as_py() * 1000 for p in parts], schema.field("_ts").type)
            data = [_to_bytes(p.drop_columns(["_block", "_shard", "_millis"])) for p in parts]
            return pa.RecordBatch.from_arrays([pa.array(block[heads]), pa.array(shard[heads]), newest, pa.array(data, pa.binary())], schema=schema)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= HELD_ROWS:
                yield done()
                held = []
        if held:
            yield done()

    return rows.mapInArrow(pack, _PACKED).withWatermark("_ts", delay)


def _stateful(packed: DataFrame, step: Callable[[int, pa.Table | None, list[pa.Table]], tuple[pa.Table, pa.Table]], ends_after: int) -> DataFrame:
    """``step`` takes a block, its state and what is new, and gives the state and what goes out.

    What goes out carries a version that grows with each batch that touches the block. It is
    part of the state, so a batch that runs again after a failure gives the same versions.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        version, held = state.get if state.exists else (0, None)
        new = [_from_bytes(data) for frame in frames for data in frame["_held"]]
        kept, out = step(int(key[0]), None if held is None else _from_bytes(held), new)
        state.update((version + 1, _to_bytes(kept)))
        # The last row of the block comes before this; the watermark has not passed it yet.
        state.setTimeoutTimestamp(max(int(key[0]) + ends_after, state.getCurrentWatermarkMs() + 1))
        if out.num_rows:
            yield pd.DataFrame({"version": [version + 1], "_held": [_to_bytes(out)]})

    grouped = packed.groupBy("_block", "_shard")
    return grouped.applyInPandasWithState(run, _GIVEN, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _unpacked(given: DataFrame, schema: StructType) -> DataFrame:
    out = StructType([*schema.fields, StructField(VERSION, LongType())])
    names = to_arrow_schema(out)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for version, data in zip(batch.column("version").to_pylist(), batch.column("_held").to_pylist()):
                table = _from_bytes(data)
                table = table.append_column(VERSION, pa.array([version] * table.num_rows, pa.int64()))
                yield from table.select(names.names).cast(names).to_batches()

    return given.mapInArrow(unpack, out)


def open_rollup(
    rows: DataFrame,
    key: Sequence[str] = SERIES_KEY,
    delay: str = "10 minutes",
    length_minutes: int = 5,
    slide_minutes: int = 1,
    block_minutes: int = BLOCK_MINUTES,
    shards: int = SHARDS,
) -> DataFrame:
    """The sliding rollup of a stream, each window again whenever a batch has changed it.

    Gives ``key, window_start, window_end, METRIC, version``, open windows included; the row
    of the highest version holds what has come so far (:func:`newest_windows`). Rows of a
    block whose windows the watermark has closed are dropped; the query's progress counts
    them, as often as tasks and blocks hold some.
    """
    if length_minutes < slide_minutes or slide_minutes < 1:
        raise ValueError("a window must be at least as long as its slide, and the slide a minute")
    key = list(key)
    pane, length, slide = pane_millis(length_minutes, slide_minutes), length_minutes * MINUTE, slide_minutes * MINUTE
    block = max(block_minutes, length_minutes) // slide_minutes * slide

    millis = F.lit(LONG_MAX) - F.col("RTIME")
    parts = measures(rows).select(
        *key, (millis - F.pmod(millis, F.lit(pane))).alias("_pane"), millis.alias("_millis"), *(F.col(f"METRIC.{p}").alias(p) for p in PARTS)
    )
    newest = F.col("_pane") - F.pmod(F.col("_pane"), F.lit(slide))
    oldest = newest - slide * F.floor((newest + length - F.col("_pane") - 1) / slide)
    first, last = (start - F.pmod(start, F.lit(block)) for start in (oldest, newest))
    placed = parts.select("*", F.explode(F.array_distinct(F.array(first, last))).alias("_block"))
    dealt = placed.withColumn("_shard", F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int"))

    def merged(table: pa.Table, by: list[str], *more: str) -> pa.Table:
        wanted = [("count", "sum"), ("sum", "sum"), ("min", "min"), ("max", "max"), *((m, "max") for m in more)]
        found = table.group_by(by, use_threads=False).aggregate(wanted)
        return found.rename_columns([c.rsplit("_", 1)[0] if c not in by else c for c in found.column_names])

    def step(at: int, held: pa.Table | None, new: list[pa.Table]) -> tuple[pa.Table, pa.Table]:
        mark = lambda t, n: t.append_column("_new", pa.array(np.full(t.num_rows, n, np.int8)))
        panes = merged(pa.concat_tables([mark(t, 1) for t in new] + ([] if held is None else [mark(held, 0)])), [*key, "_pane"], "_new")
        begin = panes["_pane"].to_numpy()
        high = begin - begin % slide
        low = np.maximum(high - slide * ((high + length - begin - 1) // slide), at)
        high = np.minimum(high, at + block - slide)
        many = (high - low) // slide + 1
        which = np.repeat(np.arange(len(begin)), many)
        among = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        windows = panes.take(pa.array(which)).append_column("_start", pa.array(low[which] + among * slide))
        done = merged(windows, [*key, "_start"], "_new")
        return panes.drop_columns(["_new"]), done.filter(pc.equal(done["_new"], 1)).drop_columns(["_new"])

    packed = _packed(dealt, lambda t: merged(t, [*key, "_pane", "_block", "_shard"], "_millis"), delay)
    given = _stateful(packed, step, block + length)
    fields = [*(f for f in rows.select(*key).schema.fields), StructField("_start", LongType()), *parts.select(*PARTS).schema.fields]
    done = as_cell(_unpacked(given, StructType([StructField(f.name, f.dataType) for f in fields])))
    return done.select(
        *key,
        F.timestamp_millis("_start").alias("window_start"),
        F.timestamp_millis(F.col("_start") + length).alias("window_end"),
        "METRIC",
        VERSION,
    )


def newest_windows(updates: DataFrame, key: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Each window as its last update has it; merged in the tasks before it moves."""
    newest = F.max_by("METRIC", VERSION).alias("METRIC")
    return updates.groupBy(*key, "window_start", "window_end").agg(newest)


def newest_writes(
    rows: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = ROW_KEY,
    keep: str = "1 day",
    block_minutes: int = BLOCK_MINUTES,
    shards: int = SHARDS,
    tie: Sequence[str] = ("METRIC",),
) -> DataFrame:
    """The rows of a stream that are newer, by ``order``, than all that came before for their key.

    A store that these rows are put into, batch after batch, holds the last write of each key:
    an older record in a later batch does not come out. Equal positions are decided by the
    ``tie`` columns and a repeated row comes out once, as in the batch upsert; nulls come
    last. The highest position of each key is kept for ``keep`` of event time behind the
    newest row; rows behind that are dropped, and counted by task, so that they cannot
    overwrite either. ``version`` is added.
    """
    key, order = list(key), list(order)
    if "RTIME" not in key:
        raise ValueError("the key must hold RTIME, by which its state ends")
    positions = [*order]
    flat = []
    for name in tie:
        field = rows.schema[name]
        inner = field.dataType.names if isinstance(field.dataType, StructType) else None
        flat += [(f"_tie_{name}_{n}", F.col(f"{name}.{n}")) for n in inner] if inner else [(f"_tie_{name}", F.col(name))]
    positions += [n for n, _ in flat]
    millis, block = F.lit(LONG_MAX) - F.col("RTIME"), block_minutes * MINUTE
    dealt = rows.select(
        "*", *(c.alias(n) for n, c in flat), millis.alias("_millis"), (millis - F.pmod(millis, F.lit(block))).alias("_block"),
        F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int").alias("_shard"),
    )

    def first_of_each(table: pa.Table, *last: tuple[str, str]) -> pa.Table:
        order = pc.sort_indices(table, [*((p, "descending") for p in positions), *last], null_placement="at_end")
        table = table.take(order).append_column("_i", pa.array(np.arange(table.num_rows)))
        return table.take(table.group_by(key, use_threads=False).aggregate([("_i", "min")])["_i_min"]).drop_columns(["_i"])

    def step(_: int, held: pa.Table | None, new: list[pa.Table]) -> tuple[pa.Table, pa.Table]:
        given = first_of_each(pa.concat_tables(new))
        own = given.select([*dict.fromkeys([*key, *positions])])
        both = own.append_column("_at", pa.array(np.arange(own.num_rows)))
        if held is not None:
            both = pa.concat_tables([both, held.append_column("_at", pa.array(np.full(held.num_rows, -1)))])
        # Of equal positions the one that is there already stays.
        won = first_of_each(both, ("_at", "ascending"))
        taken = won["_at"].to_numpy()
        return won.drop_columns(["_at"]), given.take(pa.array(np.sort(taken[taken >= 0])))

    given = _stateful(_packed(dealt, first_of_each, keep), step, block)
    return _unpacked(given, StructType([StructField(f.name, f.dataType) for f in rows.schema.fields]))
