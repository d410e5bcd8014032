"""URL filters as a sort-merge range join.

A host's canonical key is its labels in reverse, each followed by a dot, so a rule's host and all
its subdomains are one interval of keys. Rule hosts and page hosts are sorted together; a sweep
holds the stack of rules that is open at the latest rule host, which is nested because intervals
of prefixes never cross. Of the stack, those count that still hold the page's key and whose path
starts the page's; the longest decides. The sweep runs in parts of (top label, salt): a label has
as many salts as its rows need, and rules are copied to those, so a hot host is shared out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_or_not

#: Production rules (verdict, host, path).
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Rows of a part: at least so many, and so many for each rule, of which each part has a copy.
PART_ROWS, ROWS_PER_RULE = 64, 16
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """com.example.www. for www.example.com; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """For each rule host its key and the rules on it and on the hosts around it, longest first."""
    keyed = rules.select("verdict", F.lower("host").alias("host"), "path", F.concat(F.lower("host"), "path").alias("rule")).withColumn("key", host_key(F.col("host")))
    keyed = keyed.groupBy("rule", "key", "path").agg(F.min("verdict").alias("verdict"))
    hosts = keyed.select("key").distinct()
    labels = F.split(F.expr("substr(key, 1, length(key) - 1)"), r"\.")
    around = hosts.select(F.col("key").alias("own"), labels.alias("labels"))
    around = around.select("own", F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.concat(F.array_join(F.slice("labels", F.lit(1), i), "."), F.lit(".")))).alias("key"))
    # Longest first; of equally long ones the first by text.
    one = F.struct((-F.length("rule")).alias("less"), "rule", "key", "path", "verdict")
    return around.join(keyed, "key").groupBy(F.col("own").alias("key")).agg(F.sort_array(F.collect_list(one)).alias("stack"))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, part_rows: int | None = None) -> DataFrame:
    """The pages with host, path, rule and verdict added; rules: (verdict, host, path).

    A rule fits its host and all subdomains if the page's path starts with the rule's; the longest
    (host and path) wins, of repeated rules block before allow is not assumed: the least verdict.
    Without a rule, ``rule`` is null and the verdict is the default. A null url, or one without
    ://, has an empty host and path and gets the default. Every row stays, repeated ones too;
    columns that are named like an added one are replaced. Very long urls are judged whole. Rows
    are carried with all their columns, so leave out those that aren't needed.
    """
    added = ("host", "path", "rule", "verdict")
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in added])
    probes = pages.select(row.alias("row"), url_host(F.col(url)).alias("p_host"), url_path(F.col(url)).alias("p_path"))
    probes = probes.withColumn("key", host_key(F.col("p_host")))
    top = F.substring_index("key", ".", 1)
    part_rows = part_rows or max(PART_ROWS, ROWS_PER_RULE * rules.count())
    parts = probes.groupBy(top.alias("top")).agg(F.ceil(F.count("*") / part_rows).alias("salts")).where("salts > 1")
    parts = small_or_not(cut(parts))
    # A row's salt is its own hash: a task that runs again deals it alike.
    told = [f.name for f in pages.schema if f.name not in added and not re.search(r"map<|variant", f.dataType.simpleString())]
    own = F.xxhash64("key", "p_path", *[F.col(f"row.`{c}`") for c in told])
    probes = probes.withColumn("top", top).join(parts, "top", "left")
    probes = probes.select("row", "p_host", "p_path", "key", "top", F.pmod(own, F.coalesce("salts", F.lit(1)).cast("long")).alias("salt"), F.lit(1).alias("turn"), F.lit(None).cast("array<struct<less:int,rule:string,key:string,path:string,verdict:string>>").alias("stack"))
    marks = rule_stacks(rules).withColumn("top", top).join(parts, "top", "left").select(
        F.lit(None).cast(probes.schema["row"].dataType).alias("row"), F.lit(None).cast("string").alias("p_host"), F.lit(None).cast("string").alias("p_path"), "key", "top",
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("salts") - 1, F.lit(0)).cast("long"))).alias("salt"), F.lit(0).alias("turn"), "stack",
    )
    sweep = Window.partitionBy("top", "salt").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = probes.unionByName(marks).withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("turn = 1")
    fits = F.filter("open", lambda r: F.col("key").startswith(r["key"]) & F.col("p_path").startswith(r["path"]))
    best = swept.withColumn("best", F.get(fits, F.lit(0)))
    return best.select("row.*", F.col("p_host").alias("host"), F.col("p_path").alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rule_table(spark, rules: tuple = RULES) -> DataFrame:
    """Rules as a table, made by SQL only."""
    rows = ", ".join("(" + ", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in r) + ")" for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(verdict, host, path)")


def op7_urlfilter(spark, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


SQL = rf"""
WITH h AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{UPPER}', '{LOWER}') host, regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) path FROM pages),
r AS (SELECT * FROM (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}) r(verdict, rule_host, rule_path))
SELECT page_id, host, path,
  (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM r WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) rule,
  coalesce((SELECT max_by(verdict, length(rule_host || rule_path)) FROM r WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), '{DEFAULT}') verdict
FROM h
"""
