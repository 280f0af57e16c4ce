"""URL filters by a sorted sweep over reversed hosts.

``example.net`` becomes ``net.example.``: a host and all its subdomains are the keys from that text up
to ``net.example/``, as ``/`` follows ``.`` in code point order. Rule intervals are nested or apart.
Swept in order, an opening interval goes on the stack and a closing one leaves its parent on top; the
stack below a rule's host is known from the rules alone, so that the sweep carries just its top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import literal_rows, lower_ascii, staged

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(rest), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_table(spark, rules=RULES) -> DataFrame:
    return literal_rows(spark, rules, "verdict string, host string, path string")


def _stacks(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per rule host its parent host's key, and the rules of all hosts on its stack."""
    hosts = rules.select("key").distinct()
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.", -1)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )
    above = hosts.select(F.col("key").alias("node"), F.explode(prefixes).alias("key")).join(hosts, "key")
    parents = above.where("key <> node").groupBy("node").agg(
        F.max(F.struct(F.length("key"), "key")).alias("p")
    ).select("node", F.col("p.key").alias("parent"))
    stacks = above.join(rules, "key").groupBy("node").agg(
        F.collect_list(F.struct(F.length(F.concat("host", "path")).alias("size"), "host", "path", "verdict")).alias("rules")
    )
    return parents, stacks


def _top_of_stack(hosts: DataFrame, nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """(host, node): for each host the innermost rule host around it, '' if none."""
    opened = nodes.select("key", F.lit(1).alias("ord"), F.col("key").alias("top"), F.lit(None).cast("string").alias("host"))
    ends = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    closed = nodes.join(parents, F.col("key") == F.col("node"), "left").select(
        ends.alias("key"), F.lit(0).alias("ord"), F.coalesce("parent", F.lit("")).alias("top"),
        F.lit(None).cast("string").alias("host"),
    )
    # Of intervals that end together the outermost ends last; there are none: ends differ as keys do.
    points = hosts.select(
        reversed_host(F.col("host")).alias("key"), F.lit(2).alias("ord"), F.lit(None).cast("string").alias("top"), "host"
    )
    events = opened.unionByName(closed).unionByName(points)
    ranged = events.repartitionByRange(F.col("key"), F.col("ord")).withColumn("range", F.spark_partition_id())
    ranged = staged(ranged, "sweep")
    sweep = Window.partitionBy("range").orderBy("key", "ord")
    swept = ranged.withColumn("seen", F.last("top", ignorenulls=True).over(sweep))
    # What a range leaves open is the start of the next: one row per range.
    left = ranged.groupBy("range").agg(F.max(F.when(F.col("top").isNotNull(), F.struct("key", "ord", "top"))).alias("e"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = left.select("range", F.last("e.top", ignorenulls=True).over(before).alias("carry"))
    return (
        swept.where("host is not null")
        .join(carried, "range")
        .select("host", F.coalesce("seen", "carry", F.lit("")).alias("node"))
    )


def judge_urls(
    urls: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """(id, host, path, rule, verdict), one row per row of ``urls``.

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with the rule's.
    The longest host and path wins; of equally long ones the longer host, then ``block``. Without a
    rule: null and ``default``. Null urls and those without ``://`` have empty host and path. Rules
    with a null or empty host are void, a null path is ``/``; repeated rules count once. Either table
    may be empty.

    The sweep runs over distinct hosts in ranges of equal size, however many pages one host has; urls
    are joined to their host's stack at the end.
    """
    clean = rules.select(
        F.col("verdict"), lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("/")).alias("path")
    ).where("host <> ''").distinct()
    clean = staged(clean.withColumn("key", reversed_host(F.col("host"))), "rules")
    parsed = urls.select(F.col(id).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    parents, stacks = _stacks(clean)
    nodes = clean.select("key").distinct()
    tops = staged(_top_of_stack(parsed.select("host").distinct(), nodes, parents), "tops")
    known = tops.join(stacks, "node").select(F.col("host").alias("known"), "rules")
    joined = parsed.join(known, F.col("host") == F.col("known"), "left")
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(
        F.transform(
            fitting,
            lambda r: F.struct(
                r["size"].alias("size"), F.length(r["host"]).alias("h"), (r["verdict"] == "block").alias("b"),
                r["verdict"].alias("verdict"), F.concat(r["host"], r["path"]).alias("rule"),
            ),
        )
    )
    judged = joined.select("id", "host", "path", best.alias("best"))
    return judged.select(
        F.col("id").alias(id), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
