"""Exact dedup: sorted digest runs, merged up a tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, is_empty, stored, table, text_or_empty

FAN_IN = 8


def digest_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its run, a short digest to sort by, and what verifies it.

    A run is what one task reads, in the order of the digest. A null text counts as empty.
    """
    text = F.regexp_replace(text_or_empty(), f"{SPACE}+", " ")
    return (
        docs.select("doc_id", text.alias("__text"))
        .select(
            "doc_id",
            F.spark_partition_id().cast("long").alias("run"),
            F.xxhash64("__text").alias("digest"),
            F.sha2("__text", 256).alias("text_sha256"),
            F.octet_length("__text").cast("long").alias("n_bytes"),
        )
        .sortWithinPartitions("digest", "text_sha256", "doc_id")
    )


def tree_merge(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Digest, smallest doc_id and number of rows of every text.

    In each round the runs whose numbers share all but the lowest place, counted in base
    ``fan_in``, meet in the first of them. Rows merge only if short digest, SHA-256 and
    length all agree. A merge is an aggregate by run and digest: tasks first merge what
    they hold, so a text that fills a third of the rows moves as one row per run, and no
    run is ever held by one task. Null identifiers count but never win.
    """
    key = ["digest", "text_sha256", "n_bytes"]
    last = runs.agg(F.max("run")).first()[0] or 0
    merged = runs.select("run", *key, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    span = 1
    while True:
        span *= fan_in
        merged = merged.groupBy((F.col("run") - F.col("run") % span).alias("run"), *key).agg(
            F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        )
        if span > last:
            return merged.drop("run")


def groups(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows that repeat an identifier together with its text are all marked kept; ``unique``
    leaves one. An identifier is only null where no row of the text has one.
    """
    runs = stored(digest_runs(docs), "digest-runs")
    key = ["digest", "text_sha256", "n_bytes"]
    return runs.join(tree_merge(runs, fan_in), key).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def unique(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The documents with one row for each text, all columns as they were.

    Of rows that repeat an identifier with its text, the one whose JSON has the least SHA-256
    stays, so that reruns agree on the other columns.
    """
    runs = stored(digest_runs(docs), "digest-runs")
    kept = tree_merge(runs, fan_in).select(F.col("keep_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    text = F.regexp_replace(text_or_empty(), f"{SPACE}+", " ")
    rows = docs.select(F.struct("*").alias("__row"), F.sha2(text, 256).alias("__of"))
    firsts = rows.join(kept, (F.col("__of") == F.col("__sha")) & F.col("__row.doc_id").eqNullSafe(F.col("__id")), "left_semi")
    if not is_empty(runs.groupBy("text_sha256", "doc_id").count().where("count > 1")):
        # A task keeps one row per text before the shuffle.
        firsts = firsts.groupBy("__of").agg(F.min_by("__row", F.sha2(F.to_json("__row"), 256)).alias("__row"))
    return firsts.select("__row.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), h AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM t)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256)
"""
