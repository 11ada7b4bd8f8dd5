"""Last write wins per row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import ROW_KEY


def latest_per_key(
    rows: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = ROW_KEY,
    tie: str | None = "METRIC",
) -> DataFrame:
    """The row of each key that was written last by the ``order`` columns.

    Equal positions are decided by the value, so a rerun keeps the same row. Spark
    keeps one row per key in each task before the shuffle (a window group limit),
    so a key that holds a third of all rows reaches its task as a handful.
    """
    newest = [F.col(c).desc_nulls_last() for c in [*order, *([tie] if tie else [])]]
    ranked = rows.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*newest))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")
