"""Personal data: spans by pattern, and more from contexts that they are found in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, ascii_lower, is_empty, stored, table, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Each finds what the plain pattern beside it finds, in linear time and without recursion:
#: a match that begins inside a run would also begin where the run does.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.(?=[A-Za-z0-9-]))(?:[A-Za-z0-9-]|\.(?=[A-Za-z0-9-]))++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind's pattern to fit.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A word that could be an identifier.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Marks around a word that belong to the sentence and not to an identifier.
LEAD, TRAIL = r"""^["'(\[{<,;:*|#.!?]*+""", r"""^["')\]}>,;:*|.!?]*+"""
#: What stands for a neighbour that could be an identifier itself.
IDENTIFIER = "<id>"
_PART = 256


@dataclass(frozen=True)
class Settings:
    """``rounds`` of scoring. A pattern needs ``support`` different seeds; ``prior``
    occurrences count against each. Patterns and instances are taken from ``accept``."""

    rounds: int = 3
    support: int = 5
    prior: float = 2.0
    accept: float = 0.8


def running_sums(sizes: Column) -> Column:
    """0 and the sums up to each element but the last, in parts, so that no long array is
    copied for each element."""
    n = F.size(sizes)
    last = lambda a: F.element_at(a, -1)
    grow = lambda begin, part: F.aggregate(part, F.array(begin), lambda a, x: F.array_append(a, last(a) + x))
    parts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _PART).cast("int")), lambda k: F.slice(sizes, k * _PART + 1, F.lit(_PART)))
    totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x))
    begins = F.aggregate(totals, F.array(F.lit(0).cast("long")), lambda a, x: F.array_append(a, last(a) + x))
    run = F.flatten(F.transform(F.arrays_zip(parts.alias("p"), F.slice(begins, 1, F.size(parts)).alias("b")), lambda z: F.slice(grow(z["b"], z["p"]), 1, F.size(z["p"]))))
    small = F.slice(grow(F.lit(0).cast("long"), sizes), 1, n)
    return F.when(n <= _PART, small).otherwise(run)


def placed(hits: Column, gaps: Column) -> Column:
    """Each match with its start and end in code points.

    ``gaps`` are the pieces that splitting at the pattern leaves.
    """
    before = F.slice(gaps, 1, F.size(hits))
    steps = F.zip_with(before, hits, lambda gap, hit: (F.length(gap) + F.length(hit)).cast("long"))
    pairs = F.zip_with(before, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.zip_with(
        running_sums(steps),
        pairs,
        lambda at, m: F.struct((at + F.length(m["gap"])).alias("start"), (at + F.length(m["gap"]) + F.length(m["hit"])).alias("end"), m["hit"].alias("hit")),
    )


def _last_words(gap: Column) -> Column:
    """The last two words of a text, or fewer if it has fewer. Read from its end, so in linear time."""
    back, two = F.reverse(gap), rf"^{SPACE}*+([^\x20\x09-\x0D]++)(?:{SPACE}++([^\x20\x09-\x0D]++))?"
    words = F.array(F.reverse(F.regexp_extract(back, two, 2)), F.reverse(F.regexp_extract(back, two, 1)))
    return F.array_remove(words, "")


def _first_word(gap: Column) -> Column:
    return F.regexp_extract(gap, rf"^{SPACE}*+([^\x20\x09-\x0D]++)", 1)


def _trimmed(word: Column) -> Column:
    """A word without the marks around it, with its place."""
    lead = F.length(F.regexp_extract(word["hit"], LEAD, 0))
    size = F.length(word["hit"]) - lead - F.length(F.regexp_extract(F.reverse(word["hit"]), TRAIL, 0))
    return F.struct((word["start"] + lead).alias("start"), (word["start"] + lead + size).alias("end"), F.substr(word["hit"], lead + 1, size).alias("hit"))


def around(placed_words: Column, gaps: Column) -> Column:
    """The last two words of the text before each word that could be an identifier, and the first after it."""
    n = F.size(placed_words)
    return F.zip_with(F.slice(gaps, 1, n), F.slice(gaps, 2, n), lambda b, a: F.struct(_last_words(b).alias("left"), _first_word(a).alias("right")))


def in_context(placed_words: Column, around: Column) -> Column:
    """Each word that could be an identifier, bare, with up to two words ``left`` of it and the
    one ``right`` of it. Of these, those that could be identifiers are one class.

    Both arguments are columns and no expressions: lambdas would evaluate those per element.
    """
    n = F.size(placed_words)
    mark, none = F.array(F.lit(IDENTIFIER)), F.array().cast("array<string>")
    before = lambda i: F.when(i >= 1, F.concat(F.when(i >= 2, mark).otherwise(none), F.get(around, i - 1)["left"], mark)).otherwise(none)
    left = lambda c, i: F.concat(before(i), c["left"])
    right = lambda c, i: F.when(c["right"] != "", c["right"]).when(i + 1 < n, F.lit(IDENTIFIER))
    contexts = F.transform(around, lambda c, i: F.struct(left(c, i).alias("left"), right(c, i).alias("right")))
    nearest = lambda ws: F.when(F.size(ws) <= 2, ws).otherwise(F.slice(ws, -2, 2))
    return F.zip_with(
        F.transform(placed_words, _trimmed),
        contexts,
        lambda w, c: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["hit"].alias("hit"), nearest(c["left"]).alias("left"), c["right"].alias("right")),
    )


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """From the right every second digit counts double, less nine above nine."""
    values = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda d: d.try_cast("int"))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 1, F.when(v * 2 > 9, v * 2 - 9).otherwise(v * 2)).otherwise(v))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda part: F.length(F.regexp_replace(part, "^0+", "")).between(0, 3) & (F.coalesce(F.regexp_replace(part, "^0+", "").try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(_digits(hit))
        return F.when(n.between(14, 19), _luhn(_digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


# Lambdas of the functions below count their arguments, so what is fixed comes from outside.
def _holds(kind: str, field: str | None = None):
    return lambda m: _valid(kind, m[field] if field else m)


def _ranked(rank: int):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"))


def _seed(rank: int):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["hit"].alias("hit"))


def _of_rank(rank: int):
    return lambda s: s["rank"] == rank


SEEDS = "array<struct<start:bigint,rank:int,hit:string>>"
SPANS = "array<struct<start:bigint,rank:int,end:bigint>>"


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, base spans and words that could be identifiers, in one pass.

    Base spans come by start, then kind as listed. Texts are split at a pattern only where
    one of its matches holds.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kinds = [*KINDS, "word"]
    patterns = PATTERNS | {"word": TOKEN}
    hits = {}
    for kind in kinds:
        all_hits = F.regexp_extract_all("text", F.lit(patterns[kind]), F.lit(0))
        hint = HINTS.get(kind)
        hits[f"h_{kind}"] = all_hits if hint is None else F.when(F.contains("text", F.lit(hint)), all_hits)
    rows = rows.withColumns(hits)
    wanted = {k: F.size("h_word") > 0 if k == "word" else F.exists(f"h_{k}", _holds(k)) for k in kinds}
    rows = rows.withColumns({f"g_{k}": F.when(wanted[k], F.split("text", patterns[k], -1)) for k in kinds})
    rows = rows.withColumns({f"m_{k}": F.when(F.col(f"g_{k}").isNotNull(), placed(F.col(f"h_{k}"), F.col(f"g_{k}"))) for k in kinds})
    spans, seeds = [], []
    for rank, kind in enumerate(KINDS):
        good = F.filter(f"m_{kind}", _holds(kind, "hit"))
        spans.append(F.coalesce(F.transform(good, _ranked(rank)), F.array().cast(SPANS)))
        seeds.append(F.coalesce(F.transform(good, _seed(rank)), F.array().cast(SEEDS)))
    rows = rows.withColumn("c_word", around(F.col("m_word"), F.col("g_word")))
    words = in_context(F.col("m_word"), F.col("c_word"))
    return rows.select("doc_id", F.xxhash64("text").alias("hash"), F.array_sort(F.concat(*spans)).alias("base"), F.concat(*seeds).alias("seeds"), words.alias("words"))


def as_text(spans: Column) -> Column:
    kind = lambda rank: F.element_at(F.array(*map(F.lit, KINDS)), rank + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def occurrences(found: DataFrame) -> DataFrame:
    """Each word that could be an identifier, with its contexts and the kind it begins, if any.

    Words inside a span, but not at its start, are left out.
    """
    rows = found.select("doc_id", "hash", "base", "seeds", F.explode("words").alias("w"))
    began = F.filter("seeds", lambda s: (s["start"] >= F.col("w.start")) & (s["start"] < F.col("w.end")))
    inside = F.exists("base", lambda s: (s["start"] < F.col("w.start")) & (s["end"] > F.col("w.start")))
    left, right = F.transform("w.left", ascii_lower), ascii_lower(F.col("w.right"))
    found_here = rows.where(~inside).select(
        "doc_id", "hash", F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.get(began, F.lit(0)).alias("__seed"), F.col("w.hit").alias("__hit"), left.alias("__left"), right.alias("__right")
    )
    # What is right of a seed of several words is not right of its first word.
    ends_here = F.coalesce(F.col("__seed.start") + F.length("__seed.hit") <= F.col("end"), F.lit(True))
    one, after = F.element_at("__left", -1), F.when(ends_here, F.col("__right"))
    patterns = F.array(
        F.when(F.size("__left") >= 1, F.concat(F.lit("1 "), one)),
        F.when(F.size("__left") >= 2, F.concat(F.lit("2 "), F.array_join("__left", " "))),
        F.concat(F.lit("> "), after),
        F.when(F.size("__left") >= 1, F.concat(F.lit("< "), one, F.lit(" > "), after)),
    )
    return (
        found_here.withColumn("patterns", F.array_compact(patterns))
        .withColumn("instance", ascii_lower(F.coalesce("__seed.hit", "__hit")))
        .withColumn("seed", F.col("__seed.rank"))
        .drop("__left", "__right", "__seed", "__hit")
    )


def _plausible() -> Column:
    """An unseen identifier has four digits or an at sign."""
    return F.contains("instance", F.lit("@")) | (F.length(_digits(F.col("instance"))) >= 4)


def discovered(seen: DataFrame, s: Settings) -> DataFrame:
    """Occurrences that are no seeds, but stand in good patterns and look like their kind.

    Patterns are the one and two words before, the word after, and the words on both sides,
    of any length, with "<id>" for any that could be an identifier. Each round scores a pattern, per kind, by
    the scores of the instances it is seen with, against all it is seen with, and an
    instance that is no seed by its best pattern. Only what reaches ``accept`` counts in
    the next round, so that weak beliefs do not feed each other. Both scores are sums over the links of the graph, added up in the
    tasks first, so a pattern of a third of all rows is one row per task.
    """
    link = stored(
        seen.select("instance", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance", "seed").agg(F.count("*").alias("n")),
        "links",
    )
    # Only patterns that seeds induce, with enough different ones.
    induced = (
        link.where("seed IS NOT NULL").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count_distinct("instance").alias("seeds")).where(F.col("seeds") >= s.support).select("pattern", "kind")
    )
    graph = stored(link.join(induced, "pattern"), "graph")
    if is_empty(graph):
        return seen.select("doc_id", "hash", "start", "end", F.col("seed").alias("kind")).where("false")
    sure = F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed").isNotNull(), 0.0)
    scored = graph.withColumn("score", F.coalesce(sure, F.lit(0.0)))
    patterns = None
    for _ in range(s.rounds):
        patterns = stored(
            scored.groupBy("pattern", "kind").agg((F.sum(F.col("n") * F.col("score")) / (F.sum("n") + s.prior)).alias("belief")), "patterns"
        )
        unseen = (
            graph.where("seed IS NULL").join(patterns, ["pattern", "kind"]).groupBy("instance", "kind").agg(F.max("belief").alias("worth")).where(F.col("worth") >= s.accept)
        )
        unseen = stored(unseen, "instances")
        scored = graph.join(unseen, ["instance", "kind"], "left").withColumn("score", F.coalesce(sure, F.col("worth"), F.lit(0.0)))
    good = patterns.where(F.col("belief") >= s.accept)
    fits = seen.where("seed IS NULL").where(_plausible()).select("doc_id", "hash", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    trusted = unseen.select("instance", "kind")
    return fits.join(good.select("pattern", "kind"), "pattern").join(trusted, ["instance", "kind"]).select("doc_id", "hash", "start", "end", "kind").distinct()


def find(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, base spans and all spans, as arrays of (start, rank, end).

    Offsets count code points. A null text counts as empty and has no spans. Rows that
    repeat an identifier and its text get the same spans. A word that several kinds'
    patterns claim is a span of each.
    """
    rows = stored(scanned(docs), "scanned")
    seen = stored(occurrences(rows), "occurrences")
    more = (
        discovered(seen, settings)
        .groupBy(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"))
        .agg(F.collect_set(F.struct("start", F.col("kind").alias("rank"), "end")).alias("more"))
    )
    joined = rows.join(more, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash")), "left")
    return joined.select("doc_id", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.array_union("base", "more"))).alias("spans"))


def op7_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of_rank(rank))).cast("long").alias(f"n_{kind}") for rank, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))
