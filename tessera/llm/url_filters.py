"""URL filters as a sort-merge range join, in DataFrame functions only.

A rule (host, path) fits its host and all subdomains if the url's path starts with the rule's. For each depth of host
that a rule has, a url gets the canonical key (its last labels, reversed; the bytes of its path), and a rule turns
into an interval of keys: it opens at (its labels, reversed; its path) and closes after the last key that starts with
it. Intervals of one host are nested or disjoint. Rules and distinct urls are sorted together by key over range
partitions, and a sweep keeps the stack of open rules: its height is the running sum of openings and closings, and
its top is the last opening at that height. A partition starts with the stack that the ones before it leave.

Of the fitting rules the one with the longest string (host then path) wins, then the longer host, then the later
string. A rule given twice with both verdicts blocks. Neither rules nor urls are ever collected or broadcast; only a
row for each partition is.

Defined results. Null url, or one without "://": empty host and path, which only rules with an empty host can fit.
Null host or path of a rule: empty. No rules: the default verdict throughout. Repeated rows: each is judged. Empty
table: no rows. Urls of any length; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.durable import checkpoint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of op1.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Of what follows the first "://": up to one of / ? # in lower case, then up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def rules_frame(spark: SparkSession, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """A few rules as a local relation."""
    values = ", ".join("(" + ", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in rule) + ")" for rule in rules)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)" if rules else "SELECT '' AS host, '' AS path, '' AS verdict WHERE false")


def _labels(host: Column) -> Column:
    return F.split(host, r"\.")


def _events(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Openings and closings of rules (step 1 and -1) and the urls at each depth that rules have (step 0)."""
    depths = sorted(r[0] for r in rules.select(F.size(_labels(F.col("host")))).distinct().collect())
    reversed_host = lambda labels, n: F.array_join(F.reverse(F.slice(labels, -n, n)), ".")
    labels = _labels(F.col("host"))
    name = F.concat("host", "path")
    rule = F.struct(F.length(name).alias("size"), F.length("host").alias("host_size"), name.alias("name"), F.col("verdict"))
    path = F.encode("path", "UTF-8")
    ruled = rules.select(reversed_host(labels, F.size(labels)).alias("at"), path.alias("key"), rule.alias("rule"))
    opens = ruled.select("at", "key", F.lit(1).alias("step"), "rule", F.lit("").alias("host"), F.lit("").alias("path"))
    closes = ruled.select("at", F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(-1).alias("step"), F.lit(None).cast(ruled.schema["rule"].dataType).alias("rule"), F.lit("").alias("host"), F.lit("").alias("path"))
    levels = F.array(*[F.when(F.size(labels) >= d, reversed_host(labels, F.lit(d))) for d in depths]).cast("array<string>")
    asked = urls.select(F.explode(F.array_compact(levels)).alias("at"), path.alias("key"), F.lit(0).alias("step"), F.lit(None).cast(ruled.schema["rule"].dataType).alias("rule"), "host", "path")
    return opens.unionByName(closes).unionByName(asked)


def winning_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict of each distinct (host, path) of `urls` that some rule fits."""
    partitions = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rules = rules.select(F.coalesce(F.translate("host", UPPER, LOWER), F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    # Openings come before urls with the same key; a closing's key equals no other.
    order = ["at", "key", F.desc("step"), "host"]
    events = _events(urls.distinct(), rules).repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id())
    events = checkpoint(events)  # the bounds of the ranges are drawn once

    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heights = events.groupBy("part").agg(F.sum("step").alias("rise")).select("part", F.coalesce(F.sum("rise").over(by_part), F.lit(0)).alias("base"))
    in_part = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    raised = events.join(F.broadcast(heights), "part").withColumn("height", F.col("base") + F.sum("step").over(in_part))

    at_height = Window.partitionBy("part", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    topped = raised.withColumn("top", F.last("rule", ignorenulls=True).over(at_height))
    # The top at a height on entering a partition: the last opening there in any partition before. Of each partition one
    # row a height counts, so that a window never sees more rows than there are partitions.
    last_opening = F.max_by("rule", F.when(F.col("step") == 1, F.struct("at", "key"))).alias("rule")
    at_heights = raised.where("step = 1 OR (step = 0 AND height > 0)").groupBy("part", "height").agg(last_opening)
    earlier = Window.partitionBy("height").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    entering = at_heights.select("part", "height", F.last("rule", ignorenulls=True).over(earlier).alias("below"))
    asked = topped.where("step = 0 AND height > 0").join(entering, ["part", "height"], "left")
    rule = F.coalesce("top", "below")
    best = asked.select("host", "path", rule.alias("rule")).groupBy("host", "path").agg(F.max("rule").alias("rule"))
    return best.select("host", "path", F.col("rule.name").alias("rule"), F.col("rule.verdict").alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """A row for each page: its id, host, path, the winning rule or null, and the verdict."""
    host, path = host_and_path(F.coalesce(F.col(url_col), F.lit("")))
    judged = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    won = winning_rules(judged.select("host", "path"), rules)
    return judged.join(won, ["host", "path"], "left").select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every page's url judged by the five rules."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_frame(spark, RULES))


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_VALUES}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
urls AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
fits AS (SELECT host, path, rhost || rpath AS rule, verdict,
                row_number() OVER (PARTITION BY host, path ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, rhost || rpath DESC) AS rank
         FROM (SELECT DISTINCT host, path FROM urls) JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fits WHERE rank = 1) AS best USING (host, path)"""
