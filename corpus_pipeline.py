"""A training corpus from raw documents: five stages, each an operator of tidemark.llm.

Every stage works on all that the one before has kept. The first three drop documents,
the fourth repeats, drops and orders them, the last one encodes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact, forest, mixing, pieces, rules
from tidemark.llm.common import ready, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the outlier test reject."""
    ready(spark)
    return rules.passed(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    ready(spark)
    return exact.unique(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words to a shingle, similarity 0.8."""
    ready(spark)
    return forest.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in training order."""
    ready(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every row of the mix, as digests."""
    ready(spark)
    return pieces.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix),
    ("pieces", encode),
]

#: SQL cannot encode pieces; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
