"""URL filters by a sort-merge range join.

A host read label by label from the right, each label closed by a dot
(``www.example.com`` -> ``com.example.www.``), turns "this host and all its
subdomains" into the interval [key, key with its last dot raised to '/'): the
next character.  Intervals of two hosts are nested or apart, so a sweep over
the sorted keys needs only a stack.  Rule hosts put two events each on the key
axis, where their interval opens and closes; each event carries the stack that
holds from there on.  Url hosts - distinct ones, so a hot host is one row -
are range-partitioned together with the events, and each takes the stack of the
last event at or before it: a running ``last`` inside a partition, and for
the hosts before a partition's first event the last one of the partitions
before.  Path prefixes are tested against the rules on the stack; the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotbook.llm.common import unused, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULE_SCHEMA = "host string, path string, action string"
STACK = "array<struct<size:int,host:string,path:string,action:string>>"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    '' for null or a url without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; '' as above."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the right, each closed by a dot: the sweep's sort key."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_events(rules: DataFrame) -> DataFrame:
    """(key, stack): where an interval opens or closes, and the rules (all
    paths of each host on the stack) that hold from there on.

    The stack of a host is its own rules and those of the hosts that enclose it,
    found by joining its label prefixes with the rule hosts.  Rules with a null
    host, path or action fit nothing and are left out; equal rules count once.
    """
    r = (rules.select(F.translate("host", UPPER, UPPER.lower()).alias("host"), "path", "action")
         .dropna().groupBy("host", "path").agg(F.min("action").alias("action")))
    hosts = r.groupBy("host").agg(F.collect_list(F.struct(
        F.length(F.concat("host", "path")).alias("size"), "host", "path", "action")).alias("own"))
    hosts = hosts.withColumn("key", host_key(F.col("host")))
    # every label prefix of the key: the keys of all hosts that enclose this one
    labels = F.split(F.rtrim(F.col("key"), F.lit(".")), r"\.", -1)
    up = hosts.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("outer_key"))
    stacks = (up.join(hosts.select(F.col("key").alias("outer_key"), "own"), "outer_key")
              .groupBy("key").agg(
                  F.flatten(F.collect_list("own")).alias("opens"),
                  F.flatten(F.collect_list(F.when(F.col("outer_key") != F.col("key"), F.col("own"))))
                  .alias("closes")))
    shut = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    return stacks.select(F.col("key"), F.col("opens").cast(STACK).alias("stack")).unionByName(
        stacks.select(shut.alias("key"), F.col("closes").cast(STACK).alias("stack")))


def sweep(hosts: DataFrame, events: DataFrame) -> DataFrame:
    """(host, stack): for each distinct host, the stack at its place on the key axis."""
    both = (events.select("key", F.lit(0).alias("is_host"), F.lit(None).cast("string").alias("host"),
                          F.struct("stack").alias("state"))
            .unionByName(hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("is_host"),
                                      "host", F.lit(None).cast(f"struct<stack:{STACK}>").alias("state"))))
    n = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, so that the partition number stays what it was in a later stage
    swept = written(both.repartitionByRange(n, "key").select("*", F.spark_partition_id().alias("part")),
                    "url-sweep")
    order = Window.partitionBy("part").orderBy("key", "is_host")
    run = swept.withColumn("seen", F.last("state", ignorenulls=True).over(order))
    # one row for each partition: its last state, carried into the next partitions
    ends = swept.groupBy("part").agg(
        F.max_by("state", F.when(F.col("is_host") == 0, F.struct("key"))).alias("end_state"))
    carry = ends.select("part", F.last("end_state", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    return (run.filter("is_host = 1").join(F.broadcast(carry), "part", "left")
            .select("host", F.coalesce("seen", "carried")["stack"].alias("stack")))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url",
                default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row.

    ``rule`` is the longest fitting rule (host + path; ties: the longer host, then
    the text), null if none fits, and then ``verdict`` is ``default``.  Two
    rules of one host and path: the smaller action text.  A null url, or one
    without ``://``, has an empty host and path and fits no rule.  Input columns
    of the added names are replaced; all others, and repeated rows, are kept.
    """
    added = ("host", "path", "rule", "verdict")
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in added]
    parsed = pages.select(*keep, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    stacks = sweep(parsed.select("host").filter("host <> ''").distinct(), rule_events(rules))
    fit = lambda stack: F.array_max(F.transform(
        F.filter(stack, lambda r: F.col("path").startswith(r["path"])),
        lambda r: F.struct(r["size"].alias("size"), F.length(r["host"]).alias("n"),
                           F.concat(r["host"], r["path"]).alias("rule"), r["action"].alias("action"))))
    best, stack = unused([*pages.columns, *added], "best"), unused([*pages.columns, *added], "stack")
    out = parsed.join(stacks.withColumnRenamed("stack", stack), "host", "left").select(
        *keep, "host", "path", fit(stack).alias(best))
    return out.select(*keep, "host", "path", F.col(best)["rule"].alias("rule"),
                      F.coalesce(F.col(best)["action"], F.lit(default)).alias("verdict"))


def rules_table(spark: SparkSession, rules) -> DataFrame:
    """A rule table from (host, path, action) rows."""
    return spark.createDataFrame(list(rules), RULE_SCHEMA)
