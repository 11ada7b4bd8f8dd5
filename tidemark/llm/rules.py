"""Quality rules: text statistics, and outliers from a robust estimate per language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, text_or_empty

SYMBOLS = b"#*$%&|<>"
STATISTICS = "doc_id long, __h long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long"
#: Share of a group that its estimate rests on, and steps of concentration.
SUPPORT, STEPS = 0.75, 3
#: Groups of fewer rows are judged by their language's estimate, or by that of the whole table.
LEAST_ROWS = 300
#: A clean row is farther out than the limit once in so many.
ONCE_IN = 1e12
#: Transformed statistics, and the spread below which a difference does not count.
VECTOR = ("mean_length", "symbols", "dup_lines", "repeats", "upper")
FLOORS = (0.25, 0.15, 0.1, 0.1, 0.1)
#: Vectors are held as whole numbers of this fraction: sums do not depend on their order.
SCALE = 1024
#: Distances are compared in steps of this fraction, up to a bound far beyond any limit.
FINE, FARTHEST = 64, 1000


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that the text has twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, window, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice, marked = counts[window] > 1, np.zeros(len(words), bool)
    for k in range(3):
        marked[k : k + len(twice)] |= twice
    return int(marked.sum())


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    joined = b"".join(words)
    letters = joined.decode()
    return (
        len(words),
        len(letters),
        sum(text.count(s) for s in (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS)))),
        len(lines) - len(set(lines)),
        repeated_words(words),
        sum(map(str.isupper, letters)) if not letters.islower() else 0,
    )


def statistics(docs: DataFrame) -> DataFrame:
    """The statistics of every row; a null text has no words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [measure(t.encode()) for t in batch.pop("text")]
            made = pd.DataFrame(found, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"])
            yield pd.concat([batch.reset_index(drop=True).astype({"doc_id": "Int64"}), made], axis=1)

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("__h"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text.alias("text"))
    return rows.mapInPandas(run, STATISTICS)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed() -> list[Column]:
    """The vector of a row, in whole numbers of 1 / SCALE."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    parts = (
        F.log(1 + F.col("word_chars") / words) * 4,
        F.log(1 + 10 * F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / words) * 2,
        F.sqrt(F.col("n_repeat_words") / words),
        F.sqrt(F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))),
    )
    return [F.round(p * SCALE).cast("long").alias(f"v{i}") for i, p in enumerate(parts)]


def _chi2(x: float, p: float) -> float:
    """Distribution function of chi-square, by the series of the incomplete gamma function."""
    a, x = p / 2, x / 2
    term = total = 1 / a
    for n in range(1, 2000):
        term *= x / (a + n)
        total += term
        if term < total * 1e-17:
            break
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a))) if x > 0 else 0.0


def _chi2_tail(x: float, p: int) -> float:
    """1 - distribution for odd p, without cancellation."""
    total, term = math.erfc(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, (p + 1) // 2):
        total += term
        term *= x / (2 * k + 1)
    return total


def limit(p: int = len(VECTOR), once_in: float = ONCE_IN) -> float:
    low, high = 0.0, 500.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_tail(mid, p) > 1 / once_in else (low, mid)
    return high


def consistency(p: int = len(VECTOR), share: float = SUPPORT) -> float:
    """What the covariance of the nearest share is too small by, for a normal cloud."""
    low, high = 0.0, 100.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, p) < share else (low, mid)
    return share / _chi2(high, p + 2)


def _estimates(rows: DataFrame, factor: float) -> DataFrame:
    """Per group the mean and the inverse covariance of the rows given, from exact sums."""
    p = len(VECTOR)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]

    def whole(c: Column) -> Column:
        return F.sum(c.cast("decimal(38,0)"))

    sums = rows.groupBy("pool").agg(
        F.count("*").alias("n"),
        *(whole(F.col(f"v{i}")).cast("double").alias(f"s{i}") for i in range(p)),
        *(whole(F.col(f"v{i}") * F.col(f"v{j}")).cast("double").alias(f"q{i}{j}") for i, j in pairs),
    )

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                mean = np.array([r[f"s{i}"] for i in range(p)]) / r["n"]
                cov = np.zeros((p, p))
                for i, j in pairs:
                    cov[i, j] = cov[j, i] = r[f"q{i}{j}"] / r["n"] - mean[i] * mean[j]
                cov = cov / SCALE**2 * factor + np.diag(np.square(FLOORS))
                out.append((r["pool"], [float(m) for m in mean / SCALE], [float(x) for x in np.linalg.inv(cov).ravel()]))
            yield pd.DataFrame(out, columns=["pool", "center", "inverse"])

    return sums.mapInPandas(invert, "pool string, center array<double>, inverse array<double>")


def _distance() -> Column:
    """Mahalanobis distance, in whole steps of 1 / FINE."""
    p = len(VECTOR)
    away = [F.col(f"v{i}") / SCALE - F.col("center")[i] for i in range(p)]
    terms = [F.col("inverse")[i * p + j] * away[i] * away[j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]
    square = reduce(lambda a, b: a + b, terms)
    return F.least(F.floor(F.sqrt(F.greatest(square, F.lit(0.0))) * FINE), F.lit(FARTHEST * FINE)).cast("int")


def verdicts(docs: DataFrame, support: float = SUPPORT, steps: int = STEPS, once_in: float = ONCE_IN, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Statistics, base_failed and kept for every row.

    Rows that pass the base rules form a pool per language and source. The minimum
    covariance determinant starts from the coordinates' medians; each step takes the mean
    and covariance of the nearest share of the pool, all rows of it: sums and exact
    quantiles of binned distances, merged in the tasks first, so that no pool meets in one
    task. Groups of fewer than ``least_rows`` rows are judged by an estimate over the small
    groups of their language, and where these are too few as well, by one over all rows of
    the table; so every row is judged, in a table of any size. Nulls in lang or source
    are values of their own. Ties get the same verdict.
    """
    rows = stored(statistics(docs), "statistics").withColumn("base_failed", base_failed())
    named = rows.withColumns({"__l": F.coalesce(F.concat(F.lit("l"), "lang"), F.lit("-")), "__s": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-"))})
    sizes = named.where("NOT base_failed").groupBy("__l", "__s").agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") < least_rows)
    by_lang = small.groupBy(F.col("__l").alias("__ll")).agg(F.sum("n").alias("nl"))
    rest = by_lang.where(F.col("nl") < least_rows).agg(F.coalesce(F.sum("nl"), F.lit(0))).first()[0]
    pool = (
        F.when(F.col("n") >= least_rows, F.concat_ws("\n", "__l", "__s"))
        .when(F.col("nl") >= least_rows, F.col("__l"))
        .otherwise(F.lit("all"))
    )
    pools = (
        sizes.join(by_lang, F.col("__l") == F.col("__ll"), "left")
        .select(F.col("__l").alias("__pl"), F.col("__s").alias("__ps"), pool.alias("pool"))
    )
    # Stored, it has a known size: broadcast if small, else both sides are dealt for the join alone.
    pools = stored(pools, "pools")
    joined = named.join(pools, (F.col("__l") == F.col("__pl")) & (F.col("__s") == F.col("__ps")), "left").drop("__l", "__s", "__pl", "__ps")
    vectors = stored(joined.select("*", *transformed()), "vectors")
    cloud = vectors.where("NOT base_failed").select("pool", *(f"v{i}" for i in range(len(VECTOR))))
    if rest:
        cloud = cloud.unionByName(cloud.where("pool <> 'all'").withColumn("pool", F.lit("all")))

    middle = cloud.groupBy("pool").agg(*(F.percentile(f"v{i}", F.lit(0.5)).alias(f"m{i}") for i in range(len(VECTOR))))
    floors = [F.lit(1 / f**2) if i == j else F.lit(0.0) for i, f in enumerate(FLOORS) for j in range(len(FLOORS))]
    found = middle.select("pool", F.array(*(F.col(f"m{i}") / SCALE for i in range(len(VECTOR)))).alias("center"), F.array(*floors).alias("inverse"))
    for _ in range(steps):
        placed = cloud.join(stored(found, "estimates"), "pool").withColumn("far", _distance()).drop("center", "inverse")
        nearest = stored(placed.groupBy("pool").agg(F.percentile("far", F.lit(support)).alias("__upto")), "quantiles")
        found = _estimates(placed.join(nearest, "pool").where(F.col("far") <= F.col("__upto")), consistency(share=support))
    far = vectors.join(stored(found, "estimates"), "pool", "left").withColumn("far", _distance())
    outside = F.coalesce(F.col("far") > math.ceil(math.sqrt(limit(once_in=once_in)) * FINE), F.lit(False))
    return far.withColumn("kept", ~F.col("base_failed") & ~outside).withColumn("distance", F.col("far") / FINE).drop("center", "inverse", "far", "pool", *(f"v{i}" for i in range(len(VECTOR))))


def passed(docs: DataFrame, **options) -> DataFrame:
    """The documents that no rule rejects, columns as they were."""
    bad = verdicts(docs, **options).where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("__h").alias("__k"), F.col("lang").alias("__lang"), F.col("source").alias("__source"))
    rows = docs.select(F.struct("*").alias("__row"), F.xxhash64(text_or_empty()).alias("__of"))
    same = F.col("__row.doc_id").eqNullSafe(F.col("__id")) & F.col("__row.lang").eqNullSafe(F.col("__lang")) & F.col("__row.source").eqNullSafe(F.col("__source"))
    return rows.join(bad, (F.col("__of") == F.col("__k")) & same, "left_anti").select("__row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
