"""Connected components of a link table, by alternating star contraction.

Links are rows (a, b) of long ids.  A round hooks every larger neighbour of a node to
its smallest one (large star), then does the same with the smaller neighbours (small
star), until the links are stars around the smallest id of each component.  Each
round is a written table in the shared folder, so its lineage is cut and a lost
executor costs its own tasks only.  Minima are combined before the shuffle, so a node
with very many links sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmine.session import stage


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Every node's neighbours, hooked to the smallest of them and the node."""
    seen = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        seen = seen.union(links.select(F.col("b"), F.col("a")))
    centre = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    pairs = seen.join(centre, "u")
    if both:
        hooked = pairs.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        others = pairs.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        hooked = others.union(centre.select(F.col("u"), F.col("m")))
    return hooked.filter("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; component is its smallest node.

    Links may repeat, point either way or join a node to itself; null ends are left
    out.  Without links there are no rows.
    """
    whole = stage(links.filter("a is not null and b is not null"), "links")
    straight = whole.select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    loops = straight.filter("a = b").select("a").distinct()
    current = stage(straight.filter("a <> b").distinct(), "links")
    before = _mark(current)
    while before[0]:
        current = stage(_star(_star(current, True), False), "links")
        after = _mark(current)
        if after == before:
            break
        before = after
    found = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = loops.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return found.union(centres.distinct()).union(
        alone.join(found.union(centres).select("node").distinct(), "node", "left_anti")
    )
