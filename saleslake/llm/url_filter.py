"""Operator 4 (native): URL rules by a sort-merge range join.

A host's key is its labels from the right, each followed by a dot, so that a rule's host and all its subdomains are one
interval of keys; the paths that begin with a rule's path are an interval too.  Both are found by the same
sweep: points and interval starts are sorted together by range partitions, and each point takes over the stack of the last
start before it, in which only nested intervals can still be open.  The last stack of each partition is handed on
to the next ones.  Hosts are swept first (one point per different host, so a host with a third of all
pages counts once), then the paths under each open rule host.

Only DataFrame functions run here.  Defined results: a null url, or one without ``://``, has an empty host and path; a rule
without a host fits every host; of the rules that fit, the longest (host and path together) wins, then that with the
longer host; of a rule given twice with different verdicts, block wins; without rules every page gets the default;
repeated rows are judged each; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.common import written

#: Separates host key and path in a key; sorts before every printable character.
SEP = "\u0001"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; path: then up to ``?``, ``#`` or end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``a.example.net`` -> ``net.example.a.``; an empty host has an empty key."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rule_table(spark, rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """rule (``host/path``, A-Z of the host lower-cased), rule_host, rule_path and verdict; of a rule given twice, also with its
    host in another case, block wins.  rules: (verdict, rule) pairs, or a table with these columns."""
    if not isinstance(rules, DataFrame):
        rows = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in sorted(set(rules))])
        rules = (spark.range(1).select(F.explode(rows).alias("r")).select("r.*") if rules
                 else spark.range(0).select(F.lit("").alias("verdict"), F.lit("").alias("rule")))
    slash = F.instr("rule", "/")
    host = lower_ascii(F.when(slash > 0, F.substr("rule", F.lit(1), slash - 1)).otherwise(F.col("rule")))
    path = F.when(slash > 0, F.substr("rule", slash)).otherwise("")
    parts = rules.where("rule is not null and verdict is not null").select("verdict", host.alias("rule_host"), path.alias("rule_path"))
    once = parts.groupBy("rule_host", "rule_path").agg(F.max(F.struct(F.col("verdict") == "block", "verdict")).alias("v"))
    return once.select(F.concat("rule_host", "rule_path").alias("rule"), "rule_host", "rule_path", F.col("v.verdict").alias("verdict"))


def stacks(nodes: DataFrame) -> DataFrame:
    """nodes: key, info.  key and stack: the intervals (key, info) that hold the start of each, itself included.

    A key's own prefixes are looked up among the keys, so a stack has at most as many entries as its key has characters.
    """
    prefix = F.explode(F.transform(F.sequence(F.lit(0), F.length("key")), lambda n: F.substr(F.col("key"), F.lit(1), n)))
    up = nodes.select(F.col("key").alias("start"), prefix.alias("key")).join(nodes, "key")
    return up.groupBy(F.col("start").alias("key")).agg(F.collect_list(F.struct("key", "info")).alias("stack"))


def sweep(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """points: different keys.  key and open: the intervals (key, info) of ``nodes`` that hold it."""
    nodes = written(stacks(nodes), "url-stacks")
    starts = nodes.select("key", F.lit(0).alias("kind"), "stack")
    events = starts.unionByName(points.select("key", F.lit(1).alias("kind"),
                                              F.lit(None).cast(nodes.schema["stack"].dataType).alias("stack")))
    events = written(events.repartitionByRange("key").sortWithinPartitions("key", "kind")
                     .withColumn("part", F.spark_partition_id()), "url-events")
    # one row per partition: the stack that its last start left
    tails = events.where("stack is not null").groupBy("part").agg(F.max_by("stack", "key").alias("tail"))
    parts = events.select("part").distinct().join(tails, "part", "left")
    handed = parts.select("part", F.last("tail", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("handed"))
    so_far = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("own", F.last("stack", ignorenulls=True).over(so_far)).where("kind = 1").join(handed, "part")
    return swept.select("key", F.filter(F.coalesce("own", "handed"), lambda s: F.col("key").startswith(s["key"])).alias("open"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    table = rule_table(pages.sparkSession, rules)
    table = table.select("rule", "verdict", host_key(F.col("rule_host")).alias("host_key"), "rule_path")
    host, path = host_and_path(F.col(f"`{url_col}`"))
    parts = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    # hosts under rule hosts
    hosts = parts.select("host").distinct().withColumn("key", host_key(F.col("host")))
    rule_hosts = table.select(F.col("host_key").alias("key")).distinct().withColumn("info", F.lit(True))
    under = hosts.join(sweep(hosts.select("key").distinct(), rule_hosts), "key").select(
        "host", F.explode(F.transform("open", lambda s: s["key"])).alias("host_key"))
    # paths under the rules of those hosts
    places = written(parts.select("host", "path").distinct().join(under, "host").select(
        "host", "path", F.concat("host_key", F.lit(SEP), "path").alias("key"),
        F.length("host_key").alias("host_length")), "url-places")
    rule_paths = table.select(F.concat("host_key", F.lit(SEP), "rule_path").alias("key"),
                              F.struct(F.length("rule").alias("size"), "rule", "verdict").alias("info"))
    fits = sweep(places.select("key").distinct(), rule_paths).where(F.size("open") > 0).select(
        "key", F.array_max(F.transform("open", lambda s: s["info"])).alias("best"))
    best = places.join(fits, "key").groupBy("host", "path").agg(
        F.max(F.struct("best.size", "host_length", "best.rule", "best.verdict")).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
