"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"


def clean(text: Column) -> Column:
    """Text without leading and trailing blanks; NULL stays NULL."""
    return F.trim(text, F.lit(BLANKS))


def filled(text: Column) -> Column:
    """True where there is text; a NULL counts as empty."""
    return F.coalesce(text != "", F.lit(False))
