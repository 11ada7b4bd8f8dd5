"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stored, table, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Per weight, the speed at the start, the middle and the end of training, of mean one:
#: heavy sources come early, light ones late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
#: Hex digits of the order key that make up a bucket of the running sum.
BUCKET_DIGITS = 3


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the order key. The order depends on doc_id alone."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), key.alias("__key"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source its size, rank, weight and target.

    Weights repeat over the sources by code point, null last. A target stops at ``most``
    times its source; what lies above is dealt again by weight. Sorted by size over weight,
    the sources that stop come first, so the level of the others follows from running sums
    over the sources (one row each).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    found = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("__all", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("__level", (F.col("__all") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("__fits", F.col("__level") * F.col("weight") <= most * F.col("source_size"))
        .withColumn("__level", F.min(F.when(F.col("__fits"), F.struct(F.col("source_size") / F.col("weight"), "rank", "__level"))).over(everything)["__level"])
    )
    cap = (most * F.col("source_size")).cast("double")
    target = F.least(cap, F.coalesce(F.col("__level") * F.col("weight"), cap))
    return found.select("source", "source_size", "rank", target.alias("target"))


def place_in_time(share: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """The time from 0 to 1 by which a source has given this share of its words.

    A schedule is linear between its knots, so the demand it adds up to is a parabola on
    each piece, whose inverse is known.
    """
    picked = None
    for k, speeds in enumerate(schedules):
        step, done, pieces = 1 / (len(speeds) - 1), 0.0, []
        whole = sum((a + b) / 2 * step for a, b in zip(speeds, speeds[1:]))
        for i, (a, b) in enumerate(zip(speeds, speeds[1:])):
            slope, left = (b - a) / step, share * whole - done
            inside = left / a if slope == 0 else (F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * slope * left)) - a) / slope
            done += (a + b) / 2 * step
            pieces.append((done / whole, i * step + inside))
        time = pieces[-1][1]
        for end, at in reversed(pieces[:-1]):
            time = F.when(share < end, at).otherwise(time)
        match = rank % len(schedules) == k
        picked = F.when(match, time) if picked is None else picked.when(match, time)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), picked))


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, schedules=SCHEDULES) -> DataFrame:
    """Per row of ``docs``: size, its source's size and target, copies and their positions.

    Whole passes over a source come first; the rest of the target goes to the documents
    that come first in the order of their key, up to the one whose middle reaches it. The
    running sum has two levels (buckets of a source, rows of a bucket), so a source with a
    third of all rows is spread over its buckets. Empty texts have size 0. Null sources
    are one source. Rows that repeat an identifier follow each other and count each.
    """
    rows = stored(sized(docs), "sizes").withColumn("__bucket", F.substring("__key", 1, BUCKET_DIGITS))
    goals = targets(rows, weights, share, most)
    earlier = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        rows.groupBy("source", "__bucket")
        .agg(F.sum("size").alias("__in"))
        .withColumn("__before", F.coalesce(F.sum("__in").over(earlier), F.lit(0)))
        .join(goals.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
        .select(F.col("source").alias("__s"), F.col("__bucket").alias("__b"), "__before", "source_size", "rank", "target")
    )
    inside = Window.partitionBy("source", "__bucket").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("__passes") * F.col("source_size")
    extra = F.col("__at") + F.col("size") / 2 < rest
    copy = F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda k: place_in_time((k * F.col("source_size") + F.col("__at") + F.col("size") / 2) / F.col("target"), F.col("rank"), schedules),
    )
    return (
        rows.withColumn("__run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(buckets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
        .withColumn("__at", F.col("__before") + F.col("__run"))
        .withColumn("__passes", passes)
        .withColumn("copies", (F.col("__passes") + F.when(extra, 1).otherwise(0)).cast("int"))
        .withColumn("positions", F.when((F.col("copies") > 0) & (F.col("target") > 0), copy).otherwise(F.array().cast("array<double>")))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "positions")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order, each as often as it is taken, columns as they were.

    Rows are range-sorted by position. Documents of no words are taken with their source's
    whole passes. Rows that repeat an identifier within a source share one decision.
    """
    taken = (
        plan(docs, **options)
        .groupBy("doc_id", "source")
        .agg(F.max_by("positions", F.size("positions")).alias("__positions"))
        .select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.explode("__positions").alias("__position"))
    )
    rows = docs.select(F.struct("*").alias("__row"))
    same = F.col("__row.doc_id").eqNullSafe(F.col("__id")) & F.col("__row.source").eqNullSafe(F.col("__source"))
    return rows.join(taken, same).repartitionByRange(F.col("__position"), F.col("__id")).sortWithinPartitions("__position", "__id").select("__row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan in training order; no document has more than two copies, so these are its positions."""
    rows = plan(table(spark, sf_dir, "documents"))
    first, last = (F.round(F.try_element_at("positions", F.lit(k)), 6).alias(n) for k, n in ((1, "first_position"), (-1, "last_position")))
    placed = rows.select("doc_id", "size", "source_size", "target", "taken", first, last)
    return placed.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


def _position_sql(copy: str) -> str:
    """The inverse of each schedule's demand, as :func:`place_in_time` has it, for SQL."""
    share, picked = f"(({copy} * source_size + pos + size / 2.0) / target)", []
    for k, speeds in enumerate(SCHEDULES):
        step, done, pieces = 1 / (len(speeds) - 1), 0.0, []
        whole = sum((a + b) / 2 * step for a, b in zip(speeds, speeds[1:]))
        for i, (a, b) in enumerate(zip(speeds, speeds[1:])):
            slope, left = (b - a) / step, f"({share} * {whole}::DOUBLE - {done}::DOUBLE)"
            inside = f"{left} / {a}::DOUBLE" if slope == 0 else f"(sqrt(greatest(0, {a * a}::DOUBLE + {2 * slope}::DOUBLE * {left})) - {a}::DOUBLE) / {slope}::DOUBLE"
            done += (a + b) / 2 * step
            pieces.append(f"WHEN {share} < {done / whole}::DOUBLE OR {i} = {len(speeds) - 2} THEN {i * step}::DOUBLE + {inside}")
        picked.append(f"WHEN rank % {len(SCHEDULES)} = {k} THEN CASE {' '.join(pieces)} END")
    return f"CASE WHEN copies > 0 AND target > 0 THEN round(least(1, greatest(0, CASE {' '.join(picked)} END)), 6) END"


OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
            - (2 * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE)
            / (sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM s
), f AS (SELECT level FROM l WHERE level * weight <= 2 * source_size ORDER BY source_size::DOUBLE / weight, rank LIMIT 1),
g AS (SELECT source, source_size, rank, least((2 * source_size)::DOUBLE, coalesce((SELECT level FROM f) * weight, (2 * source_size)::DOUBLE)) AS target FROM l),
c AS (
  SELECT d.*, g.source_size, g.target, g.rank,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS pos,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), e AS (SELECT *, passes + CASE WHEN pos + size / 2.0 < target - passes * source_size THEN 1 ELSE 0 END AS copies FROM c)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken,
       {_position_sql("0")} AS first_position, {_position_sql("(copies - 1)")} AS last_position
FROM e
"""
