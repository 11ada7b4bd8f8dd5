"""Joining rows to a dictionary.

A dictionary is broadcast only after its size has been measured. One that is
larger is joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import asof

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


# Parts that the rows of a hot key are dealt over, and the share of rows that makes a key hot.
HOT_PARTS = 32
HOT_SHARE = 0.01


@dataclass(frozen=True)
class Dictionary:
    """A table with one row per key, its row count, and whether it was found small.

    A table with a ``since`` column has a row per version of a key, see ``asof``. ``hot`` are
    keys that many rows have, as found in the past.
    """

    rows: DataFrame
    key: str
    count: int
    small: bool
    hot: tuple = ()

    @property
    def changes(self) -> bool:
        return asof.SINCE in self.rows.columns


def measured(
    df: DataFrame, key: str, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> Dictionary:
    """Measure a table against the broadcast bound, with one aggregate over it."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns),
        start=F.lit(16 * len(df.columns)),
    )
    count, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return Dictionary(df, key, count, count <= max_rows and size <= max_bytes)


def hot_keys(past: DataFrame, key: str, share: float = HOT_SHARE) -> tuple:
    """The keys that hold more than ``share`` of the rows of a table, such as a log so far.

    They are 1 / ``share`` at most, whatever the table's size; counts are merged in its tasks.
    """
    total = past.count()
    counts = past.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return tuple(sorted(r[key] for r in counts.where(F.col("_n") > share * total).collect()))


def _matched(rows: DataFrame, match: DataFrame, key: str, how: str, hot: Sequence) -> DataFrame:
    """Sort-merge join of ``rows[key]`` to ``match._key``, with the rows of hot keys split.

    A row of a hot key goes to one of ``HOT_PARTS`` by its hash, where a copy of the key's one
    entry waits for it; other rows and entries are moved once.
    """
    if not hot:
        return rows.join(match.hint("merge"), rows[key] == match["_key"], how).drop("_key")
    plain = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    part = F.pmod(F.xxhash64(*plain), F.lit(HOT_PARTS)).cast("int")
    dealt = rows.withColumn("_part", F.when(F.col(key).isin(*hot), part).otherwise(F.lit(0)))
    parts = F.when(F.col("_key").isin(*hot), F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    copies = match.withColumn("_copy", F.explode(parts))
    both = (dealt[key] == copies["_key"]) & (dealt["_part"] == copies["_copy"])
    return dealt.join(copies.hint("merge"), both, how).drop("_key", "_part", "_copy")


def lookup(rows: DataFrame, dictionary: Dictionary, key: str, how: str = "inner", at: Column | None = None) -> DataFrame:
    """Join ``rows`` to a dictionary on ``rows[key] = dictionary.key``.

    The dictionary's key column is dropped; its other columns are added. With a small
    dictionary the join is narrow. Otherwise it is a sort-merge join of both sides, each
    moved once. A key held by a third of the rows is one row of the dictionary: in batch the
    adaptive skew join cuts its rows over several tasks; in a stream, which has no adaptive
    plan, keys known as hot are split (:func:`hot_keys`).

    Of a dictionary that changes in time a row takes the version that holds at ``at``, in
    epoch milliseconds; the versions' own times do not come along.
    """
    if not dictionary.changes:
        match = dictionary.rows.withColumnRenamed(dictionary.key, "_key")
        if dictionary.small:
            return rows.join(F.broadcast(match), rows[key] == match["_key"], how).drop("_key")
        return _matched(rows, match, key, how, dictionary.hot)
    if at is None or how not in ("inner", "left"):
        raise ValueError("a dictionary that changes needs a time, and an inner or a left join")
    if not dictionary.small and not rows.isStreaming:
        return asof.swept(rows, dictionary.rows, key, dictionary.key, at, how)
    match = asof.gathered(dictionary.rows, dictionary.key).withColumnRenamed(dictionary.key, "_key")
    if dictionary.small:
        found = rows.join(F.broadcast(match), rows[key] == match["_key"], how).drop("_key")
    else:
        found = _matched(rows, match, key, how, dictionary.hot)
    held = found.withColumn("_held", asof.picked(at)).drop("_versions")
    return asof.spread(held, asof.values_of(dictionary.rows, dictionary.key), at, how)
