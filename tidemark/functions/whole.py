"""Reading a JSON text whole: what follows the first value makes it unreadable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CORRUPT, LONG, STRING

_VALUE, _END = "_whole", "_end"
# Only with this can a text close the wrapper's array and go on as part of its object.
_BREAKS_OUT = {True: r"\][ \t\r\n]*\][ \t\r\n]*,", False: r"\}[ \t\r\n]*\][ \t\r\n]*,"}


def _wrapped(text: Column) -> Column:
    mark = F.xxhash64(text).cast("string")
    return F.concat(F.lit(f'{{"{_VALUE}":['), text, F.lit(f'],"{_END}":'), mark, F.lit("}"))


def parse(text: Column, kind: T.DataType) -> Column:
    """Parse a text as one array or object of the given type, for :func:`value` and :func:`fits`.

    Spark stops after the first value of a text and reports what does not fit only for
    objects. So the value is read inside an array inside an object, and a mark that depends
    on the text follows: it is found only if the text was read to its end.
    """
    fields = [
        T.StructField(_VALUE, T.ArrayType(kind)),
        T.StructField(_END, LONG),
        T.StructField(CORRUPT, STRING),
    ]
    return F.from_json(_wrapped(text), T.StructType(fields))


def value(parsed: Column) -> Column:
    return F.get(parsed[_VALUE], 0)


def fits(parsed: Column, text: Column, array: bool = False) -> Column:
    """Whether the text is one value of the type asked for, with nothing before or after it.

    ``array`` says whether an array or an object was asked for.
    """
    honest = F.json_object_keys(_wrapped(text)) == F.array(F.lit(_VALUE), F.lit(_END))
    kept = F.when(text.rlike(_BREAKS_OUT[array]), F.coalesce(honest, F.lit(False))).otherwise(True)
    ended = F.coalesce((parsed[_END] == F.xxhash64(text)) & (F.size(parsed[_VALUE]) == 1), F.lit(False))
    return ended & parsed[CORRUPT].isNull() & kept
