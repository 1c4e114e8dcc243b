"""URL rules by hashed host-suffix and path-prefix expressions.

Every distinct URL is expanded into expressions: the suffixes of its host with as many labels as
some rule's host has, joined to the prefixes of its path with a length that some rule's path has
(which numbers occur is read from the rules, so no rule is missed).  The expressions meet the rules in an
equi-join on the first four bytes of their SHA-256; the full digest confirms a match.  Of the
confirmed rules the longest (host and path together) wins; then the longer host, then block.

Defined cases: a null URL or one without ``://`` has empty host and path and fits no rule; an
empty rule table allows everything; an empty page table has an empty result; a repeated rule
counts once; repeated pages are judged alike, one result row for each; of the pages only id and
URL are read, so other columns may have any name; a very long URL costs time in proportion to its
length times the number of different rule lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import ascii_lower, join_classes, materialise

#: Hexadecimal digits of the short hash prefix.
PREFIX_DIGITS = 8
#: Rules up to this many are broadcast to the join; more are joined by shuffle.
BROADCAST_RULES = 100_000

#: The contract's rules: verdict and rule text (host, then path).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def rules_frame(spark, rules: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, rule string")


def parse(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with host and path columns (both empty without ``://``)."""
    url = F.col(url_col)
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    has = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.when(has, ascii_lower(host)).otherwise("")).withColumn("path", F.when(has, path).otherwise(""))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules``: verdict ('allow' or 'block') and rule (host, then path from the first slash).
    """
    rules = rules.filter(F.col("rule").isNotNull() & F.col("verdict").isNotNull()).distinct()
    rule = F.concat(ascii_lower(F.substring_index("rule", "/", 1)), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)"))
    digest = F.sha2(rule, 256)
    known = rules.select(
        digest.alias("digest"), F.substring(digest, 1, PREFIX_DIGITS).alias("short"), "verdict", F.col("rule").alias("fits"),
        F.length("rule").alias("long"), F.length(F.substring_index("rule", "/", 1)).alias("host_long"),
    )
    # as many numbers as rules have different path lengths, at most the longest rule's length
    lengths = [r[0] for r in rules.select(F.expr("length(rule) - length(substring_index(rule, '/', 1))").alias("n")).distinct().collect()]

    labels_in = lambda host: F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    labels = [r[0] for r in rules.select(labels_in(F.substring_index("rule", "/", 1)).alias("n")).distinct().collect()]

    text = F.concat_ws("\u0000", "host", "path")
    rows = parse(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))).select("page_id", "host", "path")
    rows = materialise(rows.withColumn("name", F.sha2(text, 256)), "urls")
    total = rows.count()
    names = rows.groupBy("name").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.count(F.lit(1)).alias("rows"))

    held = labels_in(F.col("host"))
    suffixes = F.array_compact(F.array(*(F.when(held >= n, F.substring_index("host", ".", -n)) for n in labels)).cast("array<string>"))
    prefixes = F.array_compact(F.array(*(F.when(F.length("path") >= n, F.col("path").substr(1, n)) for n in lengths)).cast("array<string>"))
    expressions = names.select("name", "rows", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    expressions = expressions.select("name", "rows", "suffix", F.explode("prefixes").alias("prefix"))
    expressions = expressions.select("name", "rows", F.sha2(F.concat("suffix", "prefix"), 256).alias("full"))
    expressions = expressions.withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
    if rules.count() <= BROADCAST_RULES:
        known = F.broadcast(known)
    met = expressions.join(known, "short").filter(F.col("full") == F.col("digest"))
    best = F.max(F.struct("long", "host_long", (F.col("verdict") == "block").alias("blocks"), "fits", "verdict")).alias("best")
    judged = met.groupBy("name").agg(best)
    judged = names.select("name", "rows").join(judged, "name", "left").select("name", "rows", F.col("best.fits").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return join_classes(rows, materialise(judged, "judged"), "name", "rows", total).select("page_id", "host", "path", "rule", "verdict")


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_frame(spark, RULES))


SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u),
r(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
