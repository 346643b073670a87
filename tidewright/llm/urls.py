"""Allow and block rules for urls by a sort-merge range join.

A host is written backwards with a closing dot, so that "this host and all its
subdomains" is an interval of keys that share a prefix. Intervals of rules are
nested or disjoint. Rule hosts and urls are sorted together once over range
partitions; a running value carries the stack of rules active at each key (the
last rule host and the rule hosts around it), and each partition starts from the
stack that the partitions before it left behind. A url then only looks at its
stack. Rows of one hot host are spread over partitions by a hash of the url.

The stack holds the rules of one chain of nested hosts: its size follows the
rules written for one site, never the urls.

Edge cases: a null url, or one without ``://``, has an empty host and path and
gets the default verdict; a path without a leading slash is empty and starts with
no rule's path; equal rules with both verdicts block; repeated rows are judged
each; an empty url or rule table is fine; extra columns keep their names, and an
input column named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import partitions
from tidewright.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.reverse(host), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): for each rule host, the rules of that host and of the hosts around it."""
    nodes = rules.groupBy(host_key(F.col("host")).alias("key")).agg(F.collect_set(F.struct("host", "path", "verdict")).alias("own"))
    dots = F.length("key") - F.length(F.replace("key", F.lit("."), F.lit("")))
    around = nodes.select("key", F.explode(F.sequence(F.lit(1), dots)).alias("i")).select(
        "key", F.concat(F.expr("substring_index(key, '.', i)"), F.lit(".")).alias("outer_key")
    )
    return (
        around.join(nodes.withColumnRenamed("key", "outer_key"), "outer_key")
        .groupBy("key")
        .agg(F.flatten(F.collect_list("own")).alias("stack"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict of the rule with
    the longest host, then the longest path."""
    spark = pages.sparkSession
    n = partitions(spark)
    stacks = rule_stacks(rules)
    points = pages.select(
        host_key(host_of(F.col(url_col))).alias("key"),
        F.lit(1).alias("kind"),
        F.xxhash64(*pages.columns).alias("spread"),
        F.struct(*pages.columns).alias("row"),
    )
    starts = stacks.select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("spread"), "stack")
    # the number of a range partition must not change between the uses below
    swept = cut_lineage(
        points.unionByName(starts, allowMissingColumns=True)
        .repartitionByRange(n, "key", "kind", "spread")
        .withColumn("part", F.spark_partition_id())
    )
    left_behind = swept.where("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("stack"))
    # one row per partition
    carried = (
        swept.select("part").distinct()
        .join(left_behind, "part", "left")
        .select("part", F.last("stack", True).over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    )
    so_far = W.partitionBy("part").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    active = (
        swept.withColumn("active", F.last("stack", True).over(so_far))
        .where("kind = 1")
        .join(carried, "part", "left")
        .select("row", "key", F.coalesce("active", "carried").alias("stack"))
    )
    url = F.col("row")[url_col]
    path = path_of(url)
    fits = F.filter(
        "stack",
        lambda r: F.col("key").startswith(F.concat(F.reverse(r["host"]), F.lit("."))) & path.startswith(r["path"]),
    )
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(r["host"]).alias("a"), F.length(r["path"]).alias("b"), r["verdict"].alias("verdict"),
        F.concat(r["host"], r["path"]).alias("rule"))))
    out = ("host", "path", "rule", "verdict")
    return active.withColumn("best", best).select(
        *[F.col("row")[c].alias(c) for c in pages.columns if c not in out],
        host_of(url).alias("host"), path.alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
