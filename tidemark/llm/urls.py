"""URL filters: a sort-merge range join over reversed-host keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, table

#: (host, path, verdict). The query's production rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DEFAULT = "allow"
#: Rules are a list in the driver; beyond this many it is refused.
MOST_RULES = 1_000_000
#: Boundaries of intervals that one sweep holds; more make further blocks.
BLOCK = 8192


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)?", 1)


def canonical(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot: a domain is a prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def boundaries(spark: SparkSession, rules) -> DataFrame:
    """Where the set of active rules changes: key, and the stack from there on.

    The hosts under a rule's host are the keys from ``org.`` up to ``org/``, as ``/``
    follows ``.``. Intervals nest, so the stack at a key holds the rules of its ancestors;
    where an interval ends, its own rules are gone. Longest rules come first in a stack.
    """
    rows = spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")
    rule = F.concat("host", "path")
    entry = F.struct(
        (-F.length(rule)).alias("order"), (-F.length("host")).alias("inner"), rule.alias("rule"), "path", "verdict"
    )
    ruled = rows.dropDuplicates(["host", "path"]).select(canonical(ascii_lower(F.col("host"))).alias("of"), entry.alias("entry"))
    hosts = ruled.select("of").distinct().withColumn("labels", F.split(F.rtrim(F.col("of"), F.lit(".")), r"\."))
    # The key of each ancestor, itself last.
    above = F.transform(
        F.sequence(F.lit(1), F.size("labels")),
        lambda n: F.concat(F.array_join(F.slice("labels", F.lit(1), n), "."), F.lit(".")),
    )
    opened = hosts.select(F.col("of").alias("key"), F.explode(above).alias("of"))
    end = F.concat(F.substring("of", 1, F.length("of") - 1), F.lit("/"))
    parents = F.filter(above, lambda key: key != F.col("of"))
    closed = hosts.select(end.alias("key"), F.explode_outer(parents).alias("of"))
    return (
        opened.unionByName(closed)
        .join(ruled, "of", "left")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("entry")).alias("stack"))
    )


def block_of(key: Column, starts: list[str]) -> Column:
    """The number of the last start that is not after the key: a balanced tree of tests."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high + 1) // 2
        return F.when(key < starts[mid], tree(low, mid - 1)).otherwise(tree(mid, high))

    return tree(0, len(starts) - 1)


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT, block: int = BLOCK) -> DataFrame:
    """Each page's host, path, longest fitting rule and verdict.

    Pages and boundaries are sorted by key together; the sweep carries the stack of active
    rules to the pages that follow. Every salt of a block sweeps on its own with a copy of
    the block's boundaries, so a host with a third of all pages is spread evenly. Without
    a rule (no fit, null or odd url) the verdict is ``default``. Rules of equal length:
    the longer host wins, then the first by code point. Repeated pages are judged each.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    spark = pages.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = boundaries(spark, rules).withColumn("n", F.row_number().over(Window.orderBy("key")) - 1)
    if len(rules) * 2 > block:
        starts = [""] + [r[0] for r in numbered.where((F.col("n") % block == 0) & (F.col("n") > 0)).sort("n").select("key").collect()]
    else:
        starts = [""]
    # A block begins with the stack that the boundary before it has left.
    carried = numbered.where(F.col("n") % block == block - 1).select(
        ((F.col("n") + 1) / block).cast("int").alias("block"), F.lit("").alias("key"), "stack"
    )
    edges = (
        numbered.select((F.col("n") / block).cast("int").alias("block"), "key", "stack")
        .unionByName(carried)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .withColumn("kind", F.lit(0))
    )
    host = F.coalesce(host_of(F.col("url")), F.lit(""))
    rows = (
        pages.select("page_id", "url")
        .withColumn("host", host)
        .withColumn("path", F.coalesce(path_of(F.col("url")), F.lit("")))
        .drop("url")
        .withColumn("key", canonical(F.col("host")))
        .withColumn("block", block_of(F.col("key"), starts))
        .withColumn("salt", F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(salts)).cast("int"))
        .withColumn("kind", F.lit(1))
    )
    sweep = Window.partitionBy("block", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = rows.unionByName(edges, allowMissingColumns=True).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
    fits = F.filter("stack", lambda r: F.col("path").startswith(r["path"]))
    return (
        swept.where("kind = 1")
        .withColumn("top", F.get(fits, F.lit(0)))
        .select("page_id", "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"))
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


OP3_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(/[^?#]*)?', 1), '') AS path,
         row_number() OVER () AS n FROM pages
), r(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (
  SELECT u.*, rh || rp AS rule, v, row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC, rh || rp) AS k
  FROM u LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""
