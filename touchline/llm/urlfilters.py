"""URL rules by a sort-merge range join (operator 7).

A rule (host, path, verdict) fits the urls of its host and all subdomains whose
path starts with the rule's path.  With a canonical key of the reversed host
labels followed by the path, the paths under one host that start with a rule's
path are one interval of keys.  A url has one key for each suffix of its host
that has as many labels as some rule's host, so that rules for parent domains
are met by the same interval search, and a host of thousands of labels has no
more keys than the rules have label counts.

Rule intervals are nested or apart.  They are swept once, in key order: depth
is the running sum of starts and ends, and the rule on top of the stack after
an event at depth d is the last rule that started at depth d.  That gives
segments of keys with their deepest rule.  Segments and url keys are then
sorted together by range; each url key takes the last segment at or before it,
across partitions by one carried row for each.  The longest rule of a url's
keys wins (the longer host first among equally long ones).

Native DataFrame operations only.

Edge cases: a null url or one without ``://`` has empty host and path and fits
no rule; a url that no rule fits gets DEFAULT_VERDICT; of rules with the same host and path,
the least verdict counts; repeated pages are judged each; empty pages or empty
rules give no rows or only default verdicts; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, write_scratch
from .prefixsums import ranged

#: The rules of the registered query: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: The verdict on a url that no rule fits.
DEFAULT_VERDICT = "allow"

#: Sorts before every byte of a host or path; sorts behind all text that starts alike (no UTF-8 text has it).
_LOW, _HIGH = b"\x00", b"\xff"


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of the url in column ``url``."""
    rest = F.expr(f"CASE WHEN instr(`{url}`, '://') > 0 THEN substring(`{url}`, instr(`{url}`, '://') + 3) END")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def canonical_key(host: Column, path: Column) -> Column:
    """Binary key that sorts by reversed host, then path: reversed host, a low byte, path."""
    return F.concat(reversed_host(host).cast("binary"), F.lit(bytearray(_LOW)), path.cast("binary"))


def segments(rules: DataFrame) -> DataFrame:
    """``key`` and ``rule`` (struct of host, path, verdict; null outside all rules):
    from each key on, up to the next, ``rule`` is the deepest rule that holds."""
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.select(canonical_key(F.col("host"), F.col("path")).alias("from"), F.struct("host", "path", "verdict").alias("rule"),
                         reversed_host(F.col("host")).alias("site"))
    # rules of different hosts never nest under one key, so the sweep runs host by host; an end sorts behind all it encloses
    events = rules.select("site", F.col("from").alias("key"), F.lit(1).alias("step"), "rule").unionAll(
        rules.select("site", F.concat("from", F.lit(bytearray(_HIGH))), F.lit(-1), F.lit(None)))
    swept = events.withColumn("depth", F.sum("step").over(Window.partitionBy("site").orderBy("key")))
    top = F.last("rule", ignorenulls=True).over(Window.partitionBy("site", "depth").orderBy("key"))
    return swept.select("key", F.when(F.col("depth") > 0, top).alias("rule"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page."""
    host, path = url_parts("url")
    pages = write_scratch(pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
                          .withColumn("row", F.monotonically_increasing_id()), "urls")
    labels = F.split("host", r"\.", -1)
    # one row: the label counts that rules' hosts have; only suffixes of as many labels can meet a rule
    depths = rules.agg(F.collect_set(F.size(F.split("host", r"\.", -1))).alias("depths"))
    suffixes = F.transform(F.filter("depths", lambda d: d <= F.size(labels)),
                           lambda d: F.array_join(F.slice(labels, -d, d), "."))
    keys = pages.crossJoin(F.broadcast(depths)).select("row", F.explode(suffixes).alias("suffix"), "path").select(
        canonical_key(F.col("suffix"), F.col("path")).alias("key"), "row")
    found = segments(rules)
    merged = ranged(
        found.select("key", F.lit(0).alias("kind"), F.struct("rule").alias("segment"), F.lit(None).cast("long").alias("row"))
        .unionAll(keys.select("key", F.lit(1), F.lit(None), "row")), [F.col("key"), F.col("kind"), F.col("row")], "keys")
    # the segment that a partition begins in is the last one of the partitions before it
    ends = merged.filter("kind = 0").groupBy("part").agg(F.max_by("segment", "key").alias("last"))
    parts = merged.select("part").distinct().join(ends, "part", "left")  # one row per partition
    carried = parts.select("part", F.last("last", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    in_order = Window.partitionBy("part").orderBy("key", "kind", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = (merged.withColumn("segment", F.last("segment", ignorenulls=True).over(in_order)).filter("kind = 1")
               .join(F.broadcast(carried), "part")
               .select("row", F.coalesce("segment", "carried")["rule"].alias("rule")).filter("rule is not null"))
    longest = F.struct((F.length("rule.host") + F.length("rule.path")).alias("n"), F.length("rule.host").alias("h"), F.col("rule"))
    best = fitting.groupBy("row").agg(F.max(longest)["rule"].alias("rule"))
    return pages.join(best, "row", "left").select(
        "page_id", "host", "path", F.concat("rule.host", "rule.path").alias("rule"),
        F.coalesce("rule.verdict", F.lit(default)).alias("verdict"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(list(RULES), "host string, path string, verdict string"))


OP7_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE '{DEFAULT_VERDICT}' END AS verdict FROM judged
"""
