"""Source divergence audit: which terms and which other sources set a source apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import sent_if_small, stored, table, text_or_empty

SCALE = 1_000_000_000
#: Bytes of text that a task counts at a time, and pairs of sources that it evaluates at a time.
HELD_BYTES, HELD_PAIRS = 32 << 20, 1 << 20

#: What a byte counts as: A-Z as a-z, the other ASCII bytes but a-z as a gap (0).
_FOLD = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0 for b in range(256)], np.uint8)


def terms_of(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All terms of some texts in a line, and the place of the text each is in."""
    _, offsets, data = texts.buffers()
    begins = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    if begins[0] == begins[-1]:
        return pa.array([], pa.large_string()), np.empty(0, np.int64)
    folded = _FOLD[np.frombuffer(data, np.uint8)[begins[0] : begins[-1]]]
    begins = begins - begins[0]
    inside = folded != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = begins[:-1][begins[:-1] < len(inside)]
    first[borders] = inside[borders]
    starts, upto = np.nonzero(first)[0], np.cumsum(inside)
    ends = np.append(upto[starts] - 1, upto[-1]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(folded[inside]))
    return terms, np.searchsorted(begins, starts, "right") - 1


def counted(rows: pa.Table) -> pa.RecordBatch:
    """Occurrences and documents of each term by language and source."""
    lang, source = (rows[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
    lang, source = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (lang, source))
    text = rows["text"].cast(pa.large_string()).combine_chunks()
    terms, doc = terms_of(text.chunk(0) if isinstance(text, pa.ChunkedArray) else text)
    known = terms.dictionary_encode()
    size, sources = max(1, len(known.dictionary)), max(1, len(source.dictionary))
    once, times = np.unique(doc * size + known.indices.to_numpy(zero_copy_only=False), return_counts=True)
    group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * sources + source.indices.to_numpy(zero_copy_only=False)
    cell = group[once // size] * size + once % size
    order = np.argsort(cell, kind="stable")
    cell, times = cell[order], times[order]
    heads = np.nonzero(np.diff(cell, prepend=-1))[0]
    n = np.add.reduceat(times, heads) if len(heads) else times
    group, term = cell[heads] // size, cell[heads] % size
    columns = [lang.dictionary.take(pa.array(group // sources)), source.dictionary.take(pa.array(group % sources)), known.dictionary.take(pa.array(term)).cast(pa.string())]
    docs = np.diff(np.append(heads, len(cell)))
    return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield counted(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield counted(pa.Table.from_batches(held))


def vocabulary(docs: DataFrame, least_docs: int = 3) -> DataFrame:
    """``lang, term, total, held`` of every term that ``least_docs`` documents of its language hold.

    ``total`` counts its occurrences in the language, ``held`` has them by source. A task
    counts the texts it reads; the counts move once, by (lang, term).
    """
    rows = docs.select(*(text_or_empty(c).alias(c) for c in ("lang", "source", "text")))
    counts = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    by_source = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = by_source.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held"))
    return terms.where(F.col("docs") >= least_docs).drop("docs")


def _over(top: Column, bottom: Column) -> Column:
    return F.call_function("div", top, bottom)


def share(count: Column, total: Column) -> Column:
    """1 + floor(10**9 * (count + 1) / total), exact for counts of any size."""
    return F.lit(1) + _over(F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)"), total.cast("decimal(19,0)"))


def distance(p: str, q: str) -> Column:
    """floor((p - q)**2 / q)."""
    return _over((F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(q))


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source) with its terms, its share of a term it lacks, and its language's sums.

    ``sid`` numbers the sources of a language.
    """
    found = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    own = kept.select("lang", F.inline("held")).groupBy("lang", "source").agg(F.sum("n").alias("n_all"), F.count("*").alias("n_terms"))
    langs = kept.groupBy("lang").agg(F.sum("total").alias("lang_all"), F.count("*").alias("v"))
    rows = found.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    total = F.col("n_all") + F.col("v")
    numbered = rows.withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
    return numbered.withColumn("p0", F.when(total > 0, share(F.lit(0), total)).otherwise(F.lit(1)))


def _term_part(scored: DataFrame, most: int) -> DataFrame:
    """Terms that a source has more of than its language, the ``most`` first.

    Terms of equal (group count, language count) are one cell, with one value. Cells of equal
    value are merged, and the ranks of a value begin behind the terms of all larger ones. Of a
    group only ``most`` values can matter, of a value only ``most`` terms; both limits act
    before rows move, so that no group or cell meets in one task.
    """
    group = ["lang", "source"]
    cells = scored.groupBy(*group, "n", "total").agg(F.first("p").alias("p"), F.first("q").alias("q"), F.count("*").alias("terms"))
    cells = stored(cells.where("p > q").select(*group, "n", "total", distance("p", "q").alias("value"), "terms"), "cells")
    values = cells.groupBy(*group, "value").agg(F.sum("terms").alias("terms"))
    down = Window.partitionBy(*group).orderBy(F.desc("value"))
    first = values.withColumn("__place", F.row_number().over(down)).where(F.col("__place") <= most)
    before = F.coalesce(F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = first.withColumn("__before", before).where(F.col("__before") < most).select(*group, "value", "__before")
    won = stored(cells.join(sent_if_small(stored(ranked, "values")), [*group, "value"]).select(*group, "n", "total", "value", "__before"), "cells")
    terms = scored.select(*group, "term", "n", "total").join(sent_if_small(won), [*group, "n", "total"])
    inside = terms.withColumn("__at", F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))).where(F.col("__at") <= most)
    rank = F.col("__before") + F.col("__at")
    return inside.where(rank <= most).select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.cast("int").alias("rank"))


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per pair of sources of a language: what their shared terms add to its value.

    A term that both have counts f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), as the sums over
    each source's own terms and over all terms hold it as one that the other lacks.
    """

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        heads = np.nonzero(np.diff(key, prepend=-1))[0]
        return key[heads], np.add.reduceat(value, heads)

    for batch in batches:
        for lang, rows in batch.groupby("lang", sort=False):
            lengths = rows["sid"].map(len).to_numpy()
            starts = np.cumsum(lengths) - lengths
            sid, p, p0 = (np.concatenate(rows[c].to_numpy()).astype(np.int64) for c in ("sid", "p", "p0"))
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for k in np.unique(lengths[lengths > 1]).tolist():
                at = starts[lengths == k]
                # Every place with the one ``step`` behind it, around the row: all ordered pairs.
                many = max(1, HELD_PAIRS // k)
                for some in (at[i : i + many] for i in range(0, len(at), many)):
                    left = (some[:, None] + np.arange(k)).ravel()
                    for step in range(1, k):
                        right = (some[:, None] + (np.arange(k) + step) % k).ravel()
                        value = f(p[left], p[right]) - f(p[left], p0[right]) - f(p0[left], p[right]) + f(p0[left], p0[right])
                        found.append(sums(sid[left] << 32 | sid[right], value))
                        if sum(len(x) for x, _ in found) > HELD_PAIRS:
                            found = [sums(*(np.concatenate(x) for x in zip(*found)))]
            if found:
                key, value = sums(*(np.concatenate(x) for x in zip(*found)))
                yield pd.DataFrame({"lang": lang, "g": key >> 32, "h": key & 0xFFFFFFFF, "value": value})


def _pair_part(scored: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language by the sum of f over all its kept terms.

    The sum is taken over cells of equal counts: terms that neither has are one cell; those of
    one source are its cells against the other's share of a lacking term; shared ones correct
    both. Per term only sums leave a task, not its pairs.
    """
    big = "decimal(38,0)"
    own = groups.select("lang", F.col("sid").alias("g"), F.col("source"), F.col("p0").alias("__p0"), F.col("n_terms").alias("__n"))
    other = groups.select("lang", F.col("sid").alias("h"), F.col("source").alias("item"), F.col("p0").alias("__q0"), F.col("n_terms").alias("__m"), "v")
    both = own.join(sent_if_small(other), "lang").where("g <> h")
    neither = both.select("lang", "g", "h", ((F.col("v") - F.col("__n") - F.col("__m")).cast(big) * distance("__p0", "__q0")).alias("value"))
    cells = scored.groupBy("lang", F.col("sid").alias("s"), "p").agg(F.count("*").alias("terms"))
    others = groups.select("lang", F.col("sid").alias("o"), F.col("p0").alias("__o0"))
    met = cells.join(sent_if_small(others), "lang").where("s <> o")
    sums = met.groupBy("lang", "s", "o").agg(
        F.sum(F.col("terms").cast(big) * distance("p", "__o0")).alias("has"), F.sum(F.col("terms").cast(big) * distance("__o0", "p")).alias("lacks")
    )
    sums = stored(sums, "sums")
    vectors = scored.groupBy("lang", "term").agg(*(F.collect_list(c).alias(c) for c in ("sid", "p", "p0"))).where(F.size("sid") > 1)
    shared = vectors.select("lang", "sid", "p", "p0").mapInPandas(_shared, "lang string, g int, h int, value long")
    parts = [
        neither,
        sums.select("lang", F.col("s").alias("g"), F.col("o").alias("h"), F.col("has").alias("value")),
        sums.select("lang", F.col("o").alias("g"), F.col("s").alias("h"), F.col("lacks").alias("value")),
        shared.select("lang", "g", "h", F.col("value").cast(big).alias("value")),
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).groupBy("lang", "g", "h").agg(F.sum("value").cast("long").alias("value"))
    named = whole.join(both.select("lang", "g", "h", "source", "item"), ["lang", "g", "h"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, least_docs: int = 3, most: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets each source apart in its language.

    Part ``pair`` has every other source of the language, part ``term`` the ``most`` first of
    the terms that the source has a larger share of than the language. Nulls in text, language
    and source count as empty, and an empty name is a group like any other; a group without
    terms has the share of a lacking term everywhere. Rows that repeat an identifier are
    documents of their own. Equal values are ranked by the item's UTF-8 bytes. A language
    with one source has no pairs, one without kept terms has pairs of value 0. An empty table
    gives no rows. Columns beside text, lang and source are not read.
    """
    kept = stored(vocabulary(docs, least_docs), "vocabulary")
    groups = stored(_groups(docs, kept), "groups")
    sides = groups.select("lang", "source", "sid", "n_all", "lang_all", "v", "p0")
    terms = kept.select("lang", "term", "total", F.inline("held")).join(sent_if_small(sides), ["lang", "source"])
    p, q = share(F.col("n"), F.col("n_all") + F.col("v")), share(F.col("total"), F.col("lang_all") + F.col("v"))
    scored = stored(terms.select("lang", "source", "sid", "term", "n", "total", "p0", p.alias("p"), q.alias("q")), "shares")
    return _term_part(scored, most).unionByName(_pair_part(scored, groups))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS nl FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS ng FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
a AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.ng + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (l.nl + l.v) AS q
  FROM s JOIN k ON k.lang = s.lang JOIN l ON l.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(sum(((a.p - b.p) * (a.p - b.p)) // b.p), 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN a ON a.lang = x.lang AND a.source = x.source LEFT JOIN a b ON b.lang = y.lang AND b.source = y.source AND b.term = a.term GROUP BY ALL
), u AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM a WHERE n > 0 AND p > q
), r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
