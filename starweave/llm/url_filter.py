"""URL rules as a sort-merge range join over reversed-host keys.

A rule is (host, path, verdict).  It fits a URL whose host is the rule's host
or a subdomain of it and whose path starts with the rule's path; the longest
rule that fits (characters of host and path; of equal ones the greater key)
wins.

A host's labels are reversed and joined, so that hosts of one domain sort
together, and the path follows after a ``/`` (which no host contains):
``blog.example.org`` with ``/es/7`` has the key ``org.example.blog//es/7``.
Because a rule also fits subdomains, a URL has one key for each domain above
its host that is no deeper than the deepest rule.  A rule's key is then the
prefix of all keys it fits: an interval in key order.

Rules and keys are sorted together by range partition, and the sorted table
is written with its partition numbers.  The sweep carries the stack of active
rules forward: every rule row holds the rules nested around it, outermost
first, and a key sees the last rule row at or before it (a window over the
partition; for the first rows, the last rule of the partitions before, one
row per partition).  Rules of the stack that are no prefix of the key have
ended; of the others the innermost fits.  A key of a hot host is only as wide
as its own row: ties are spread over partitions by page and repeated rows are
counted before the sort.

Output: page_id, host, path, rule (``host + path``, null if none fits),
verdict (the rule's, else ``default``).  One row per input row.

A null URL or one without ``://`` has empty host and path.  Hosts keep ports
and user names as written.  Null page_ids are kept.  Equal rules with
different verdicts: the verdict that sorts first; a rule with null host, path
or verdict is left out; a rule with an empty host fits no URL.  Empty pages
give no rows, empty rules give the default for all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_az, take, written

DEFAULT = "allow"
# host, path, verdict
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    place = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_az(place), F.lit("")), F.coalesce(path, F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, "[.]"))


def _nested(rules: DataFrame) -> DataFrame:
    """(key, stack): each rule with the rules around it, outermost first."""
    rules = rules.where("host <> ''").groupBy("host", "path").agg(F.min("verdict").alias("verdict")) \
        .where("path is not null and verdict is not null")
    rules = rules.select(
        _key(_labels(lower_az(F.col("host"))), F.col("path")).alias("key"),
        F.concat("host", "path").alias("rule"), "verdict")
    rules = written(rules, "rules")
    # The prefixes of a rule's key that are rules themselves.
    prefixes = rules.select("key", F.explode(F.sequence(F.lit(1), F.char_length("key"))).alias("n")) \
        .select("key", F.expr("substring(key, 1, n)").alias("around"))
    around = rules.select(F.col("key").alias("around"), "rule", "verdict")
    return prefixes.join(around, "around").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct(
            F.char_length("around").alias("size"), F.col("around").alias("prefix"),
            "rule", "verdict"))).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """One row per page; see the module's text."""
    host, path = host_and_path(F.col("url"))
    pages = take(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    nested = written(_nested(take(rules, "host", "path", "verdict")), "nested")
    depth = nested.agg(F.max(F.size(F.split(F.substring_index("key", "/", 1), "[.]")))).first()[0] or 0

    rows = pages.groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).alias("n"))
    levels = F.least(F.size("labels"), F.lit(depth))
    # A URL's levels; one with none still has a row, whose key fits no rule.
    level = F.explode(F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array(F.lit(0))))
    probes = rows.withColumn("labels", _labels(F.col("host"))) \
        .select("page_id", "host", "path", "n", "labels", level.alias("level")) \
        .select(_key(F.expr("slice(labels, 1, level)"), F.col("path")).alias("key"),
                F.lit(1).alias("kind"), "page_id", "host", "path", "n")
    starts = nested.select("key", F.lit(0).alias("kind"), "stack")
    both = starts.unionByName(probes, allowMissingColumns=True)
    order = ["key", "kind", "page_id"]
    swept = written(both.repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
                    "sweep")

    # The last rule before each partition: one row per partition.
    last = swept.groupBy("part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key")))
                                     .alias("own"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("part", F.last("own", ignorenulls=True).over(earlier).alias("carried"))
    so_far = Window.partitionBy("part").orderBy(*order)
    active = F.coalesce(F.last("stack", ignorenulls=True).over(so_far), F.col("carried"))
    fitting = F.filter("active", lambda s: F.startswith(F.col("key"), s["prefix"]))
    met = swept.join(F.broadcast(carried), "part").withColumn("active", active) \
        .where("kind = 1").withColumn("fit", F.try_element_at(fitting, F.lit(-1)))
    best = met.groupBy("page_id", "host", "path").agg(
        F.max(F.struct(F.col("fit.size").alias("size"), F.col("fit.prefix").alias("prefix"),
                       F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict")))
        .alias("best"), F.max("n").alias("n"))
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"), "n") \
        .select("page_id", "host", "path", "rule", "verdict",
                F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).drop("copy")
