"""MinHash near-dedup by an LSH forest: sorted signature orders, nearest prefixes as candidates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import PieceCache, gather_words, is_empty, sent_if_small, stored, table
from tidemark.llm.components import components

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PART = 2048


@dataclass(frozen=True)
class Settings:
    """``width``: words of a shingle. ``percent``: similarity of a link, at least.

    ``trees`` orders of ``depth`` hashes each. Neighbours share ``least`` hashes or more; a
    region of more than ``dense`` rows is cut one hash deeper, and so on, for a start; what
    is still apart in it then meets ``leaders`` of its rows and is joined exactly. So every
    pair of a region is linked if it is similar, dense or not. Two documents of similarity s
    share a region of depth d in one of t trees at least with probability 1 - (1 - s**d)**t:
    for 24 trees and depth 5 that is 1 - 8e-7 for s = 0.85 and 1 - 7e-5 for s = 0.8.
    """

    width: int = 5
    percent: int = 80
    trees: int = 24
    depth: int = 8
    least: int = 5
    dense: int = 16
    window: int = 4
    leaders: int = 3


@cache
def _word_hashes() -> PieceCache:
    return PieceCache(lambda new: [xxhash.xxh64_digest(w) for w in new], 2)


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingles, hashed to 64 bits; fewer words make one."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    mixed = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ words[k : k + len(mixed)]) * _MIX
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Of each whole text; A-Z count as a-z, words are what ASCII white space separates."""
    rows, lengths = gather_words(_word_hashes(), pc.ascii_lower(texts))
    words = np.ascontiguousarray(rows).view(np.uint64).ravel()
    at = 0
    for n in lengths.tolist():
        yield _shingles(words[at : at + n], width)
        at += n


@cache
def _family(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_229)
    return rng.integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, size, np.uint64)


def labels(shingles: np.ndarray, trees: int, depth: int) -> bytes:
    """For each tree its hashes in a row, 16 bits each, highest byte first."""
    a, b = _family(trees * depth)
    least = np.full(trees * depth, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _PART):
        np.minimum(least, (shingles[i : i + _PART, None] * a + b).min(0), out=least)
    return (least * _MIX >> np.uint64(48)).astype(">u2").tobytes()


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, size and digest of the set of shingles, and the labels; per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, marks = [], [], []
            for found in shingle_sets(batch.column("text"), s.width):
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                marks.append(labels(found, s.trees, s.depth) if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary())],
                ["doc_id", "n_shingles", "key", "labels"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, key binary, labels binary")


def _all_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    for size in np.unique(sizes).tolist():
        i, j = np.triu_indices(size, 1)
        at = starts[sizes == size][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def neighbours(tree: np.ndarray, label: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in a stretch of sorted rows.

    A region is a run of rows that share a prefix. Where it holds up to ``dense`` rows all
    its pairs are candidates; a larger one is cut at the next hash. Rows also meet the next
    rows in the order, as long as the least prefix is shared; what agrees in every hash and
    is still dense meets the first of its kind too.
    """
    n = len(tree)
    if n < 2:
        return np.empty(0, int), np.empty(0, int)
    same = np.cumprod(label[1:] == label[:-1], axis=1).sum(1)
    common = np.concatenate([[-1], np.where(tree[1:] == tree[:-1], same, -1)])
    left, right = [], []
    open_rows = np.ones(n, bool)
    for d in range(s.least, s.depth + 1):
        starts = np.nonzero(common < d)[0]
        sizes = np.diff(np.append(starts, n))
        live = open_rows[starts]
        small = live & (sizes <= s.dense)
        i, j = _all_pairs(starts[small & (sizes > 1)], sizes[small & (sizes > 1)])
        left.append(i)
        right.append(j)
        open_rows &= ~np.repeat(small, sizes)
    if open_rows.any():
        dense = live & (sizes > s.dense)
        first = np.repeat(starts, sizes)
        rest = np.repeat(dense, sizes) & (first != np.arange(n))
        left.append(first[rest])
        right.append(np.nonzero(rest)[0])
    least = common
    for step in range(1, s.window + 1):
        ok = np.nonzero(least >= s.least)[0]
        left.append(ok - step)
        right.append(ok)
        # The prefix shared with a row further back is the shortest on the way.
        least = np.minimum(least, np.concatenate([[-1] * step, common[:-step]])) if step < n else np.full(n, -1)
    return np.concatenate(left), np.concatenate(right)


def _paired(s: Settings, edges: bool):
    """A task's part of an order: pairs (kind 0) and the rows of dense regions (kind 2).
    With ``edges`` it also hands out the rows at its ends (kind 1), whose regions go on in
    the neighbouring tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        first = True

        def matrix(rows: pd.DataFrame) -> np.ndarray:
            return np.frombuffer(b"".join(rows["label"]), ">u2").reshape(len(rows), s.depth)

        def pairs(rows: pd.DataFrame) -> pd.DataFrame:
            i, j = neighbours(rows["tree"].to_numpy(), matrix(rows), s)
            ids, sizes = rows["rep"].to_numpy(), rows["n"].to_numpy()
            fits = 100 * np.minimum(sizes[i], sizes[j]) >= s.percent * np.maximum(sizes[i], sizes[j])
            a, b = ids[i][fits], ids[j][fits]
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            both = both[both[:, 0] < both[:, 1]]
            return pd.DataFrame({"kind": 0, "rep": both[:, 0], "n": both[:, 1], "tree": -1, "label": b""})

        def breaks(rows: pd.DataFrame) -> np.ndarray:
            """Where a row does not share the least prefix with the one before."""
            tree, label = rows["tree"].to_numpy(), matrix(rows)[:, : s.least]
            return np.nonzero((tree[1:] != tree[:-1]) | (label[1:] != label[:-1]).any(1))[0] + 1

        def edge(rows: pd.DataFrame) -> pd.DataFrame:
            return rows.assign(kind=1)[["kind", "rep", "n", "tree", "label"]]

        def crowd(rows: pd.DataFrame) -> pd.DataFrame:
            sizes = np.diff([0, *breaks(rows), len(rows)])
            inside = rows[np.repeat(sizes > s.dense, sizes)]
            return inside.assign(kind=2, label=inside["label"].map(lambda x: x[: 2 * s.least]))[["kind", "rep", "n", "tree", "label"]]

        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held) < 20_000:
                continue
            cuts = breaks(held)
            if edges and first:
                yield edge(held[: min(cuts[0] if len(cuts) else len(held), s.dense)])
                first = False
            yield pairs(held)
            yield crowd(held)
            # The last region is not over; of a very large one the last rows go on.
            held = held[max(cuts[-1] if len(cuts) else 0, len(held) - 5_000) :].reset_index(drop=True)
        if held is not None and len(held):
            cuts = breaks(held)
            if edges and first:
                yield edge(held[: min(cuts[0] if len(cuts) else len(held), s.dense)])
            yield pairs(held)
            yield crowd(held)
            if edges:
                yield edge(held[max(cuts[-1] if len(cuts) else 0, len(held) - s.dense) :])

    return run


def _ordered(reps: DataFrame, s: Settings) -> DataFrame:
    """Pairs of neighbours in an order (kind 0) and rows of dense regions (kind 2), stored.

    Each order is sorted over all tasks by tree, label and identifier, so even rows of one
    label are dealt over several. Tasks stream their part in bounded memory. Regions that
    a border cuts are joined from the rows at the tasks' ends; of a dense region every part
    with more than ``dense`` rows is seen in its task, and smaller ones among the ends.
    """
    size = 2 * s.depth
    rows = reps.select(
        "rep",
        "n",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(s.trees - 1)), lambda t: F.substring("labels", t * size + 1, F.lit(size)))).alias("tree", "label"),
    )
    schema = "kind int, rep long, n long, tree int, label binary"
    ordered = rows.repartitionByRange("tree", "label", "rep").sortWithinPartitions("tree", "label", "rep")
    found = stored(ordered.mapInPandas(_paired(s, True), schema), "neighbours")
    ends = found.where("kind = 1").drop("kind").distinct()
    again = ends.repartition("tree", F.substring("label", 1, 2 * s.least)).sortWithinPartitions("tree", "label", "rep")
    return found.where("kind <> 1").unionByName(stored(again.mapInPandas(_paired(s, False), schema), "neighbours"))


def _pairs(ordered: DataFrame) -> DataFrame:
    return ordered.where("kind = 0").select(F.col("rep").alias("a"), F.col("n").alias("b")).distinct()


def candidates(reps: DataFrame, s: Settings) -> DataFrame:
    """Distinct pairs a < b of representatives that are neighbours in an order."""
    return _pairs(_ordered(reps, s))


def _sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """The whole sets of shingles of the documents that some pair names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f.view(np.int64) for f in shingle_sets(batch.column("text"), s.width)]
            ends = np.cumsum([0, *map(len, found)])
            held = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held.cast(pa.list_(pa.int64()))], ["id", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(sent_if_small(wanted), F.col("doc_id") == F.col("__id"), "left_semi").mapInArrow(run, "id long, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of a stored table whose whole sets are similar enough."""
    a, b = sets.toDF("__a", "__sa"), sets.toDF("__b", "__sb")
    joined = a.join(sent_if_small(pairs), F.col("a") == F.col("__a")).join(b, F.col("b") == F.col("__b"))
    shared = F.size(F.array_intersect("__sa", "__sb"))
    return joined.where(100 * shared >= percent * (F.size("__sa") + F.size("__sb") - shared)).select("a", "b")


def near_groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest identifier reached) and kept.

    Equal sets are one node, found by digest. Every candidate pair is confirmed on whole
    sets unless its ends have met by then: first each document with its smallest partners,
    then all pairs whose ends are still apart, then what is apart in dense regions. So no
    link between groups is lost, and a group of thousands does not have all its pairs
    confirmed. Texts without words are
    linked with nothing. A row without an identifier has its copies' component, null if
    there are none, and links nothing. Rows that repeat an identifier are one node; if
    their texts differ, a link of any counts.
    """
    s = settings
    rows = stored(signatures(docs, s), "signatures")
    reps = stored(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("labels").alias("labels")),
        "representatives",
    )
    ordered = _ordered(reps, s)
    pairs = stored(_pairs(ordered), "pairs")
    dense = stored(ordered.where("kind = 2").select("tree", "label", "rep", "n").distinct(), "dense")
    ids = pairs.select(F.col("a").alias("__id")).unionByName(pairs.select(F.col("b").alias("__id"))).unionByName(dense.select(F.col("rep").alias("__id"))).distinct()
    sets = stored(_sets(docs, stored(ids, "ids"), s), "sets")

    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    second = pairs.groupBy("a").agg(F.min("b").alias("b")).select("a", "b")
    links = stored(confirmed(stored(first.unionByName(second).distinct(), "pairs"), sets, s.percent), "confirmed")
    met = components(links)
    apart = stored(_apart(pairs, met), "pairs")
    if not is_empty(apart):
        links = links.unionByName(stored(confirmed(apart, sets, s.percent), "confirmed"))
        met = components(links)
    met = _joined_regions(dense, sets, links, met, s)
    nodes = reps.select(F.col("key").alias("__key"), "rep").join(met, F.col("rep") == F.col("id"), "left").select("__key", F.coalesce("component", "rep").alias("__component"))
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return (
        rows.join(nodes, F.col("key") == F.col("__key"), "left")
        .select("doc_id", "n_shingles", F.coalesce(alone, "__component").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _apart(pairs: DataFrame, met: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components so far."""
    a, b = met.toDF("__a", "__ca"), met.toDF("__b", "__cb")
    joined = pairs.join(a, F.col("a") == F.col("__a"), "left").join(b, F.col("b") == F.col("__b"), "left")
    return joined.where(F.coalesce("__ca", "a") != F.coalesce("__cb", "b")).select("a", "b")


def _open(dense: DataFrame, met: DataFrame) -> DataFrame:
    """The rows of the dense regions that hold more than one component, with theirs as c."""
    held = met.toDF("__id", "__c")
    rows = dense.join(sent_if_small(held), F.col("rep") == F.col("__id"), "left").select("tree", "label", "rep", "n", F.coalesce("__c", "rep").alias("c"))
    apart = stored(rows.groupBy("tree", "label").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("tree", "label"), "regions")
    return stored(rows.join(sent_if_small(apart), ["tree", "label"], "left_semi"), "open")


def _fits(a: str, b: str, percent: int) -> Column:
    """Sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _joined_regions(dense: DataFrame, sets: DataFrame, links: DataFrame, met: DataFrame, s: Settings) -> DataFrame:
    """The components, once the rows of each dense region are linked wherever they are similar.

    A region's first row, over all tasks that hold a part of it, meets its other rows; then
    another is elected, the one with most links so far, as the original of many copies has
    them. That joins large groups at a small price. What is still apart is joined by rare
    shingles, which misses nothing.
    """
    if is_empty(dense):
        return met
    apart = _open(dense, met)
    led: DataFrame | None = None
    for _ in range(s.leaders):
        if is_empty(apart):
            return met
        degrees = links.select(F.col("a").alias("__id")).unionByName(links.select(F.col("b").alias("__id"))).groupBy("__id").agg(F.count("*").alias("__links"))
        rows = apart.join(sent_if_small(stored(degrees, "degrees")), F.col("rep") == F.col("__id"), "left")
        if led is not None:
            rows = rows.join(sent_if_small(led.select("tree", "label", "rep")), ["tree", "label", "rep"], "left_anti")
        order = F.struct(F.coalesce("__links", F.lit(0)), -F.col("rep"))
        first = rows.groupBy("tree", "label").agg(F.max_by(F.struct("rep", "n", "c"), order).alias("f")).select("tree", "label", F.col("f.rep").alias("rep"), F.col("f.n").alias("fn"), F.col("f.c").alias("fc"))
        first = stored(first, "leaders")
        led = first if led is None else led.unionByName(first)
        meet = apart.join(sent_if_small(first.withColumnRenamed("rep", "f")), ["tree", "label"]).where((F.col("c") != F.col("fc")) & _fits("n", "fn", s.percent))
        pairs = stored(meet.select(F.least("rep", "f").alias("a"), F.greatest("rep", "f").alias("b")).distinct(), "pairs")
        more = stored(confirmed(pairs, sets, s.percent), "confirmed")
        if is_empty(more):
            break
        links = links.unionByName(more)
        met = components(links)
        apart = _open(dense, met)
    if is_empty(apart):
        return met
    pairs = stored(_sharing_rare(apart, sets, s), "pairs")
    more = stored(confirmed(pairs, sets, s.percent), "confirmed")
    return met if is_empty(more) else components(links.unionByName(more))


_BUCKETS, _PARITY_LONGS = 1 << 20, 8


def _sharing_rare(apart: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs a < b of different components that may be similar, by their rare shingles.

    Shingles are in one order, rare ones first. Similar sets of n >= m shingles have
    k >= (n + m) * percent / (100 + percent) in common; of these the first in the order stands
    at the place n - k + 1 or before in the larger set, and m - k + 1 in the smaller. So the
    smaller set shows its first shingles for k at n = m, the larger one for k at m = n *
    percent / 100, and they meet on one of them. Three bounds on what they can share then act
    in the join itself: their sizes, what stands behind the shingle in both, and the parity of
    their shingles by hashed bit, as every bit that differs is a shingle that only one has.
    None of them loses a similar pair. The order is by counts of hashed shingles: any order
    will do, so collisions cost time only.
    """
    rows = stored(apart.select(F.col("rep").alias("__id"), "n", "c").distinct(), "apart")
    held = stored(sets.join(sent_if_small(rows), F.col("id") == F.col("__id")).select("id", "n", "c", "shingles"), "sets")

    def bucket(values: np.ndarray) -> np.ndarray:
        return (values.view(np.uint64) * _MIX >> np.uint64(44)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            total += np.bincount(bucket(batch.column("shingles").flatten().to_numpy()), minlength=_BUCKETS)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    counts = np.zeros(_BUCKETS, np.int64)
    for batch in held.select("shingles").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow().to_batches():
        counts[batch.column("at").to_numpy()] = batch.column("n").to_numpy()
    shared = held.sparkSession.sparkContext.broadcast(counts)
    marks = [f"p{k}" for k in range(_PARITY_LONGS)]

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, places, shows, parity = [], [], [], []
            for one in batch.column("shingles"):
                values = one.values.to_numpy()
                n = len(values)
                first = np.lexsort((values, shared.value[bucket(values)]))[: n - -(-n * s.percent // 100) + 1]
                found.append(values[first])
                places.append(np.arange(1, len(first) + 1))
                shows.append(places[-1] <= n - -(-2 * n * s.percent // (100 + s.percent)) + 1)
                parity.append(parities(values))
            lengths = [len(f) for f in found]
            columns = [pa.array(np.repeat(batch.column(k).to_numpy(), lengths)) for k in ("id", "n", "c")]
            bits = np.repeat(np.array(parity, np.int64).reshape(-1, _PARITY_LONGS), lengths, axis=0)
            columns += [pa.array(np.concatenate(x) if x else np.empty(0, kind)) for x, kind in ((found, np.int64), (places, np.int64), (shows, bool))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(bits[:, k]) for k in range(_PARITY_LONGS))], ["id", "n", "c", "shingle", "place", "shown", *marks])

    few = stored(held.mapInArrow(rare, f"id long, n long, c long, shingle long, place long, shown boolean, {', '.join(f'{m} long' for m in marks)}"), "rare")
    a = few.select("shingle", *(F.col(c).alias(f"__a_{c}") for c in ("id", "n", "c", "place", *marks)))
    b = few.where("shown").select("shingle", *(F.col(c).alias(f"__b_{c}") for c in ("id", "n", "c", "place", *marks)))
    sizes = F.col("__a_n") + F.col("__b_n")
    behind = F.least(F.col("__a_n") - F.col("__a_place"), F.col("__b_n") - F.col("__b_place")) + 1
    differ = sum((F.bit_count(F.col(f"__a_{m}").bitwiseXOR(F.col(f"__b_{m}"))) for m in marks), start=F.lit(0))
    needed = s.percent * sizes
    may = (
        (F.col("__a_id") != F.col("__b_id")) & (F.col("__a_c") != F.col("__b_c")) & (F.col("__a_n") >= F.col("__b_n")) & _fits("__a_n", "__b_n", s.percent)
        & ((100 + s.percent) * behind >= needed) & ((100 + s.percent) * (sizes - differ) >= 2 * needed)
    )
    both = a.withColumnRenamed("shingle", "__shingle").join(b, (F.col("__shingle") == F.col("shingle")) & may)
    return both.select(F.least("__a_id", "__b_id").alias("a"), F.greatest("__a_id", "__b_id").alias("b")).distinct()


def parities(values: np.ndarray) -> np.ndarray:
    """Whether an odd number of the shingles falls on each of 64 * ``_PARITY_LONGS`` hashed bits."""
    at = (values.view(np.uint64) * _MIX >> np.uint64(32)).astype(np.int64) % (64 * _PARITY_LONGS)
    return np.packbits((np.bincount(at, minlength=64 * _PARITY_LONGS) & 1).astype(np.uint8)).view(np.int64)


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents with one of each group, columns as they were; rows without an identifier stay."""
    gone = near_groups(docs, settings).where("NOT kept").select(F.col("doc_id").alias("__id")).distinct()
    rows = docs.select(F.struct("*").alias("__row"))
    return rows.join(gone, F.col("__row.doc_id") == F.col("__id"), "left_anti").select("__row.*")


def op1_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), Settings(width=3, percent=85))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w
), n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS c FROM n UNION SELECT u.b, r.c FROM r JOIN u ON r.id = u.a WHERE r.c < u.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id, n.doc_id = min(r.c) AS kept
FROM n JOIN r ON r.id = n.doc_id GROUP BY n.doc_id, n.n
"""
