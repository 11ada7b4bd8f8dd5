"""What the operators share: tables, stored intermediates, words."""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_dir, prepare

#: White space is ASCII only, in patterns as in ``bytes.split()``.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ready(spark: SparkSession) -> SparkSession:
    """Session settings. Python workers on this machine find the package where the driver has."""
    prepare(spark)
    # Texts have any length: an Arrow batch is also cut by its bytes.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends, lost executors cost nothing."""
    path = new_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


#: Rows of one or two numbers that are small enough to send to every task.
SMALL_ROWS = 1_000_000


def sent_if_small(held: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """A stored table of a few numbers per row, to be broadcast if its count allows."""
    return F.broadcast(held) if held.count() <= most else held


def is_empty(df: DataFrame) -> bool:
    return not df.limit(1).collect()


class PieceCache:
    """Encodings of short pieces, found by piece; a batch is put together with numpy.

    ``encode`` takes a list of pieces and gives for each the bytes of 32-bit integers, in rows
    of ``width``. The memory is bounded: a full cache forgets its younger half, as what comes
    often comes early.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], width: int = 1, limit: int = 500_000):
        self.encode, self.width, self.limit = encode, width, limit
        self.place: dict[str, int] = {}
        self.chars = 0
        self.flat = np.empty((1024, width), np.int32)
        self.ends = np.zeros(1024, np.int64)

    def _forget(self) -> None:
        self.place = dict(islice(self.place.items(), self.limit // 2))
        if self.chars > 64 * self.limit:
            self.place = {}
        self.chars = sum(map(len, self.place))

    def _learn(self, new: list[str]) -> None:
        rows = self.encode(new)
        at, used = len(self.place), int(self.ends[len(self.place)])
        lengths = np.fromiter(map(len, rows), np.int64, len(rows)) // (4 * self.width)
        while at + len(new) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while used + lengths.sum() > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[used : used + lengths.sum()] = np.frombuffer(b"".join(rows), np.int32).reshape(-1, self.width)
        self.ends[at + 1 : at + 1 + len(new)] = used + np.cumsum(lengths)
        self.place.update(zip(new, range(at, at + len(new))))
        self.chars += sum(map(len, new))

    def places(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the rows of each piece start, and how many there are."""
        if len(self.place) > self.limit or self.chars > 64 * self.limit:
            self._forget()
        at = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.nonzero(at < 0)[0]
        if len(missing):
            unknown = [pieces[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(unknown)))
            at[missing] = np.fromiter(map(self.place.__getitem__, unknown), np.int64, len(unknown))
        return self.ends[at], self.ends[at + 1] - self.ends[at]

    def rows(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """All rows in a line: each one's place is a step on, or a jump to the next piece."""
        filled = lengths > 0
        starts, counts = starts[filled], lengths[filled]
        steps = np.ones(int(counts.sum()), np.int64)
        if len(steps):
            steps[0] = starts[0]
            steps[np.cumsum(counts)[:-1]] = starts[1:] - starts[:-1] - counts[:-1] + 1
        return self.flat[np.cumsum(steps)]

    def gather(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        starts, lengths = self.places(pieces)
        return self.rows(starts, lengths), lengths


def gather_words(cache: PieceCache, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the ASCII-separated words of all texts, and how many rows each text has."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = split.flatten().dictionary_encode()
    distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    at, lengths = cache.places(distinct)
    if "" in distinct:  # what lies between white space and the end of a text
        lengths[distinct.index("")] = 0
    which = words.indices.to_numpy(zero_copy_only=False)
    rows = cache.rows(at[which], lengths[which])
    upto = np.concatenate([[0], np.cumsum(lengths[which])])[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])]
    return rows, np.diff(upto)


def texts_of(batch) -> list[str]:
    return ["" if t is None or t != t else t for t in batch]
