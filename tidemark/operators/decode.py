"""Payload decoding: base64 and compressed text to plain text.

Spark has no inflate function, so this one step runs in Python, a whole Arrow
batch at a time. It is narrow: no shuffle, and every message is independent.
"""

from __future__ import annotations

import binascii
import sys
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the functions below inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# zlib window arguments of the two container formats.
WINDOW_BITS = {"gzip": 31, "zlib": 15}
# An Arrow batch leaves the worker once its text passes this size, so a batch of
# strongly compressed payloads does not have to fit in memory at once.
FLUSH_BYTES = 16 << 20
# The largest text one Spark string cell can hold; a longer one is rejected whole.
CELL_LIMIT = (1 << 31) - (1 << 16)


class TooLarge(ValueError):
    """A payload whose text no Spark string cell can hold."""


def inflate(payload: bytes, bits: int, limit: int = CELL_LIMIT) -> bytes | None:
    """All members of a compressed payload; None if it is damaged or cut short."""
    texts, left = [], limit
    try:
        while payload:
            member = zlib.decompressobj(bits)
            texts.append(member.decompress(payload, left))
            left -= len(texts[-1])
            if member.unconsumed_tail or left <= 0 and (not member.eof or member.unused_data):
                raise TooLarge
            if not member.eof:
                return None
            payload = member.unused_data
    except zlib.error:
        return None
    return b"".join(texts) if texts else None


def unbase64(text: str) -> bytes | None:
    """Bytes of strict base64, with or without line breaks; None if it is not."""
    try:
        raw = text.encode("ascii")
        try:
            return binascii.a2b_base64(raw, strict_mode=True)
        except binascii.Error:
            return binascii.a2b_base64(b"".join(raw.split()), strict_mode=True)
    except ValueError:
        return None


def _reader(bits: int) -> Callable[[str | None], bytes | None]:
    def read(value: str | None) -> bytes | None:
        raw = unbase64(value) if value else None
        text = inflate(raw, bits) if raw else None
        if text is not None:
            try:
                text.decode("utf-8")
            except UnicodeDecodeError:
                return None
        return text

    return read


def _batches(bits: int, source: str, names: list[str]) -> Callable:
    read = _reader(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(source))
            texts: list[bytes | None] = []
            rejected: list[str | None] = []
            large: list[bool] = []
            start = size = 0

            def flush() -> pa.RecordBatch:
                rows = batch.slice(start, len(texts))
                columns = [rows.column(rows.schema.get_field_index(n)) for n in names]
                columns += [
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(rejected, pa.string()),
                    pa.array(large, pa.bool_()),
                ]
                return pa.RecordBatch.from_arrays(columns, [*names, "text", "rejected", "too_large"])

            for i in range(batch.num_rows):
                value = values[i].as_py()
                text, over = None, False
                try:
                    text = read(value)
                except TooLarge:
                    over = True
                grow = len(text or b"") + (len(value or "") if text is None else 0)
                if texts and size + grow > FLUSH_BYTES:
                    yield flush()
                    start, size, texts, rejected, large = i, 0, [], [], []
                texts.append(text)
                rejected.append(value if text is None else None)
                large.append(over)
                size += grow
            if texts:
                yield flush()

    return run


def decode_payload(messages: DataFrame, codec: str = "gzip", source: str = "value") -> DataFrame:
    """Replace the payload column by ``text``, ``rejected`` and ``too_large``.

    ``text`` is the decoded message, NULL if the payload is missing or damaged;
    ``rejected`` then holds the payload as it came, and ``too_large`` says whether its text
    would be longer than a cell can hold. All other columns pass through.
    ``codec``: ``gzip`` or ``zlib`` inside base64, ``none`` for base64 alone,
    ``plain`` for text that is not encoded.
    """
    names = [c for c in messages.columns if c != source]
    payload = F.col(source).cast("string")
    if codec == "plain":
        return _with_text(messages, names, payload, source)
    if codec == "none":
        raw = F.try_to_binary(payload, F.lit("base64")).cast("string")
        text = F.when(payload != "", F.try_validate_utf8(raw))
        return _with_text(messages, names, text, source)
    if codec not in WINDOW_BITS:
        raise ValueError(f"codec {codec!r} is none of gzip, zlib, none, plain")
    schema = T.StructType(
        [messages.schema[n] for n in names]
        + [T.StructField("text", T.StringType()), T.StructField("rejected", T.StringType())]
        + [T.StructField("too_large", T.BooleanType())]
    )
    wire = messages.select(*names, payload.alias(source))
    return wire.mapInArrow(_batches(WINDOW_BITS[codec], source, names), schema)


def _with_text(messages: DataFrame, names: list[str], text: Column, source: str) -> DataFrame:
    return messages.select(*names, text.alias("text"), F.col(source).alias("_payload")).select(
        *names,
        "text",
        F.when(F.col("text").isNull(), F.col("_payload").cast("string")).alias("rejected"),
        F.lit(False).alias("too_large"),
    )
