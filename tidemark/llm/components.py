"""Connected components of a table of links, in rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import is_empty, stored

JUMPS = 3


def components(links: DataFrame) -> DataFrame:
    """``id`` and the smallest id it reaches, for every id in the links (columns a and b).

    In each round a node hooks to its smallest neighbour, a few jumps shorten the chains,
    and the links move to the roots; loops and repeats go. The links shrink by a factor
    each round, and nothing but "is there any left" comes to the driver.
    """
    left = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found: DataFrame | None = None
    while not is_empty(left):
        both = left.select(F.col("a").alias("id"), F.col("b").alias("near")).unionByName(left.select(F.col("b").alias("id"), F.col("a").alias("near")))
        hooks = both.groupBy("id").agg(F.min("near").alias("near")).select("id", F.least("id", "near").alias("root"))
        for _ in range(JUMPS):
            hooks = _through(stored(hooks, "hooks"))
        hooks = stored(hooks, "hooks")
        found = hooks if found is None else stored(_onwards(found, hooks), "components")
        a, b = hooks.toDF("__a", "__ra"), hooks.toDF("__b", "__rb")
        moved = left.join(a, F.col("a") == F.col("__a")).join(b, F.col("b") == F.col("__b")).where("__ra <> __rb")
        left = stored(moved.select(F.least("__ra", "__rb").alias("a"), F.greatest("__ra", "__rb").alias("b")).distinct(), "links")
    if found is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.withColumnRenamed("root", "component")


def _through(hooks: DataFrame) -> DataFrame:
    return _onwards(hooks, hooks)


def _onwards(found: DataFrame, hooks: DataFrame) -> DataFrame:
    onward = hooks.toDF("__from", "__to")
    return found.join(onward, F.col("root") == F.col("__from"), "left").select("id", F.coalesce("__to", "root").alias("root"))
