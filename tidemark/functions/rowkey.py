"""Parts of a ``bucket|host|instance`` row key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_prefix(rowkey: Column) -> Column:
    """Text before the first bar; NULL without a bar or with nothing before it."""
    return F.when(F.instr(rowkey, "|") > 1, F.substring_index(rowkey, "|", 1))


def parts(rowkey: Column) -> Column:
    """All parts, with trailing empty ones left out (``a|h|`` has two)."""
    return F.split(F.rtrim(rowkey, F.lit("|")), r"\|")
