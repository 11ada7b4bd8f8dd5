"""The METRIC cell: build it, store it, read it back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import whole
from tidemark.schemas import METRIC


def metric(count: Column, total: Column, low: Column, high: Column, items: Column) -> Column:
    """METRIC struct from its five parts."""
    return F.struct(
        count.cast("long").alias("count"),
        total.cast("double").alias("sum"),
        low.cast("double").alias("min"),
        high.cast("double").alias("max"),
        items.cast("string").alias("items"),
    )


def store(cell: Column, binary: bool = False) -> Column:
    """METRIC struct as a JSON text or binary cell of a stored table."""
    text = F.when(cell.isNotNull(), F.to_json(cell))
    return F.encode(text, "UTF-8") if binary else text


def load(stored: Column, binary: bool = False) -> Column:
    """METRIC struct from a stored cell; NULL where the cell does not hold one."""
    text = F.decode(stored, "UTF-8") if binary else stored
    parsed = whole.parse(text, METRIC)
    return F.when(whole.fits(parsed, text), whole.value(parsed))


def average(cell: Column) -> Column:
    """Mean of a cell, computed on read since means do not merge."""
    return F.when(cell["count"] > 0, cell["sum"] / cell["count"])
