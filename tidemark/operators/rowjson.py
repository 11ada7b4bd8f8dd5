"""Metric rows as JSON texts, and back by the declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import whole
from tidemark.schemas import ROW_JSON, ROW_KEY


def to_row_json(rows: DataFrame) -> DataFrame:
    """The six key columns of each row as one JSON text ``value``; nulls are written."""
    text = F.to_json(F.struct(*ROW_KEY), {"ignoreNullFields": "false"})
    rest = [c for c in rows.columns if c not in (*ROW_KEY, "METRIC")]
    return rows.select(text.alias("value"), *rest)


def from_row_json(texts: DataFrame, value: str = "value") -> DataFrame:
    """Typed rows from JSON texts by the declared schema.

    Adds ``corrupt``: the text of a record that does not fit (not one JSON object, a wrong
    type, or a key column missing), whose row columns are then not to be used.
    """
    rest = [c for c in texts.columns if c != value]
    parsed = texts.select(*rest, value, whole.parse(F.col(value), ROW_JSON).alias("_read"))
    row = whole.value(F.col("_read"))
    lacking = [row[f.name].isNull() for f in ROW_JSON.fields if not f.nullable]
    misfit = row.isNull() | ~whole.fits(F.col("_read"), F.col(value))
    for lack in lacking:
        misfit = misfit | lack
    text = F.coalesce(F.col(value), F.lit(""))
    return parsed.select(*rest, *[row[c].alias(c) for c in ROW_KEY], F.when(misfit, text).alias("corrupt"))
