"""Quality classifier: hashed word n-grams, logistic regression by FTRL, sparse scores."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import PieceCache, stored, table, texts_of, text_or_empty

THRESHOLD = 0.7
_WORDS = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``bits``: of the hashed feature space. ``most_rows``: labelled rows to learn from, about;
    of more, those with the lowest hashes are taken. ``shard_rows``: rows a trainer holds,
    about. ``epochs``: passes of a trainer over its rows."""

    bits: int = 18
    most_rows: int = 30_000
    shard_rows: int = 10_000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


def _shape(word: str) -> str:
    """What kind of word it is: case, digits or the marks themselves."""
    if word.isdigit():
        return "0"
    if not word[0].isalpha():
        return word[:4]
    return "A" if len(word) > 1 and word.isupper() else "Aa" if word[0].isupper() else "a"


@cache
def word_hashes() -> PieceCache:
    """Two hashes per word, of its lower case and of its shape; kept while the worker lives."""

    def learn(new: list[str]) -> list[bytes]:
        return [xxhash.xxh32_digest(w.lower()) + xxhash.xxh32_digest("shape " + _shape(w)) for w in new]

    return PieceCache(learn, 2)


def features(hashes: PieceCache, text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of one and two words, and of one to three shapes."""
    words = _WORDS.findall(text)
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    rows, _ = hashes.gather(words)
    word, shape = rows.view(np.uint32).astype(np.uint64).T
    grams = []
    for salt, run in enumerate(([word], [word[:-1], word[1:]], [shape], [shape[:-1], shape[1:]], [shape[:-2], shape[1:-1], shape[2:]]), 1):
        mixed = np.full(max(0, len(run[-1])), salt, np.uint64)
        for part in run:
            mixed = (mixed ^ part[: len(mixed)]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        grams.append((mixed * _MIX) >> np.uint64(64 - bits))
    places, counts = np.unique(np.concatenate(grams), return_counts=True)
    return places.astype(np.int32), counts.astype(np.int32)


def amounts(counts: np.ndarray) -> np.ndarray:
    """Logarithmic counts, as a vector of length one."""
    values = np.log1p(counts)
    return values / np.sqrt(max(1e-12, values @ values))


class Ftrl:
    """Follow the regularised leader, one row at a time; the last place is the constant."""

    def __init__(self, settings: Settings, z: np.ndarray, n: np.ndarray):
        self.s, self.z, self.n = settings, z.astype(np.float64), n.astype(np.float64)

    def weights(self, at) -> np.ndarray:
        z, s = self.z[at], self.s
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: float) -> None:
        at, x = np.append(places, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + g * g


def is_held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def chosen(labels: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, label and shard of the rows to learn from; of several labels the lower counts."""
    rows = labels.where(~is_held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    one = rows.groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").cast("double").alias("label"))
    n = one.count()
    # Hashes below this share of their range; the shards cut the rest evenly.
    share = min(1.0, settings.most_rows / max(n, 1))
    shards = max(1, round(n * share / settings.shard_rows))
    place = F.pmod(F.xxhash64("__id"), F.lit(1 << 40)) / float(1 << 40)
    return one.withColumn("__place", place).where(F.col("__place") < share).withColumn("shard", F.floor(F.col("__place") / share * shards).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weights learnt from labelled rows that are not held out; the constant comes last.

    The labels are few by their bound and go to the texts. A shard's trainer holds the
    features of its rows and passes over them in an order set by content; the mean of the
    trainers' states is the model. No rows: all weights zero.
    """
    picked = stored(chosen(labels, settings), "labels")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for batch in batches:
            found = [features(hashes, t, settings.bits) for t in texts_of(batch["text"])]
            yield pd.DataFrame(
                {"shard": batch["shard"], "turn": batch["turn"], "label": batch["label"], "places": [p.tobytes() for p, _ in found], "counts": [np.minimum(c, 65535).astype("<u2").tobytes() for _, c in found]}
            )

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shards: dict[int, list] = {}
        for batch in batches:
            for r in batch.itertuples():
                shards.setdefault(r.shard, []).append((np.frombuffer(r.places, np.int32), np.frombuffer(r.counts, "<u2"), r.label))
        size = (1 << settings.bits) + 1
        for shard, rows in shards.items():
            learner = Ftrl(settings, np.zeros(size), np.zeros(size))
            for _ in range(settings.epochs):
                for places, counts, label in rows:
                    learner.learn(places, amounts(counts), label)
            yield pd.DataFrame({"shard": [shard], "z": [learner.z.astype("<f4").tobytes()], "n": [learner.n.astype("<f4").tobytes()]})

    rows = (
        docs.select("doc_id", text_or_empty().alias("text"))
        .join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
        .select("text", "label", "shard", F.xxhash64("doc_id", "text").alias("turn"))
        .mapInPandas(run, "shard int, turn long, label double, places binary, counts binary")
    )
    most = max(1, round(settings.most_rows / settings.shard_rows)) + 1
    ordered = rows.repartition(most, "shard").sortWithinPartitions("shard", "turn")
    states = sorted(ordered.mapInPandas(train, "shard int, z binary, n binary").collect(), key=lambda r: r.shard)
    if not states:
        return np.zeros((1 << settings.bits) + 1, np.float32)
    z, n = (np.mean([np.frombuffer(r[k], "<f4") for r in states], 0) for k in ("z", "n"))
    return Ftrl(settings, z, n).weights(slice(None)).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """doc_id and score, 0 to 1, of every row. An empty or null text has the constant's score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, w = word_hashes(), shared.value
        for batch in batches:
            sums = []
            for text in texts_of(batch["text"]):
                places, counts = features(hashes, text, settings.bits)
                sums.append(float(w[places] @ amounts(counts)) + float(w[-1]))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": 1 / (1 + np.exp(-np.clip(sums, -35, 35)))})

    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(run, "doc_id long, score double")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
