"""URL rules by a sort-merge range join, in DataFrame functions only.

A host is keyed by its labels in reverse order, each closed by a dot, so the hosts
below a rule's host are the interval from its key ("com.example.") to the key whose
last dot is the next character ("com.example/").  Intervals of rules nest.  Their
starts and ends are sorted together with the urls; each carries the stack of rules
that are active from there on, and a sweep over every sorted partition hands each url
the stack that was set last before it.  The longest rule of the stack whose path the
url's path starts with decides.

Urls are range-partitioned by key, path and id, so a hot host spreads over many
tasks; the stack that is open where a partition starts comes from a table of one row
per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmine.session import stage

DEFAULT_VERDICT = "allow"
#: The rules of the registered query: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STACK = "array<struct<length:int,rule:string,path:string,verdict:string>>"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*+([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _key(host: Column) -> Column:
    """The labels of a host in reverse, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows (verdict, host, path)."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _bounds(rules: DataFrame) -> DataFrame:
    """(key, stack): from each key on, the rules that are active; one row per start or end.

    The rules above a host are found by its ancestors, an equi-join.
    """
    listed = rules.select(
        F.lower("host").alias("host"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.concat("host", "path").alias("rule"),
            F.col("path").alias("path"),
            F.col("verdict").alias("verdict"),
        ).alias("entry"),
    )
    hosts = listed.select("host").distinct()
    labels = F.split("host", r"\.")
    above = hosts.select(
        "host",
        F.explode(F.sequence(F.lit(1), F.size(labels))).alias("from"),
        labels.alias("labels"),
    ).select("host", F.expr("array_join(slice(labels, from, size(labels)), '.')").alias("ancestor"))
    held = (
        above.join(listed.withColumnRenamed("host", "ancestor"), "ancestor")
        .groupBy("host")
        .agg(
            F.collect_set("entry").alias("inside"),
            F.collect_set(F.when(F.col("ancestor") != F.col("host"), F.col("entry"))).alias("outside"),
        )
    )
    key = _key(F.col("host"))
    starts = held.select(key.alias("key"), F.sort_array("inside", asc=False).cast(_STACK).alias("stack"))
    after = F.concat(F.expr("left(k, length(k) - 1)"), F.lit("/"))
    ends = held.withColumn("k", key).select(after.alias("key"), F.sort_array("outside", asc=False).cast(_STACK).alias("stack"))
    return starts.union(ends)


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    A rule fits its host and all hosts below it if the path starts with the rule's; the
    longest wins, of equal length the last by name.  A null url, or one without ``://``, has
    an empty host and path and gets the default; so does any url without a rule.
    Repeated rows are judged each, null ids stay null, other columns are ignored, and
    rules of empty host fit nothing.
    """
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    )
    no_stack = F.lit(None).cast(_STACK)
    events = urls.select(
        _key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path", no_stack.alias("stack")
    ).unionByName(
        _bounds(rules.filter(F.length("host") > 0)).select("key", F.lit(0).alias("kind"), "stack"), allowMissingColumns=True
    )
    ordered = events.repartitionByRange("key", "kind", "path", "page_id").withColumn("part", F.spark_partition_id())
    swept = stage(ordered, "url-events")
    # The last stack of each partition, carried on to the next ones: a row per partition.
    lasts = swept.groupBy("part").agg(
        F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("last")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    stacked = (
        swept.withColumn("own", F.last("stack", ignorenulls=True).over(inside))
        .join(F.broadcast(carried), "part", "left")
        .filter("kind = 1")
        .withColumn("active", F.coalesce("own", "carried"))
    )
    # The stack is sorted by length, longest first.
    fits = F.filter("active", lambda r: F.col("path").startswith(r["path"]))
    best = stacked.withColumn("best", F.get(fits, F.lit(0)))
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
