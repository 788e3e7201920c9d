"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words.  It is filled with complete epochs first; what
remains of it is filled with a weighted sample without repetition: each document draws
``-ln(u) / weight``, the documents of a source are sorted by that key, and those whose
running size stays within the rest are taken once more.  The document at the edge is
taken in part, so a source meets its budget to the word (copies at the edge: to one word
a copy).

``u`` is a hash of id and size, so reruns agree and copies of a row draw the same key;
they are exchangeable and are given equal shares.  No source is sorted as a whole: sizes are summed
per bucket of the key, running sums over the buckets find the one in which the budget
ends, its rows are summed per narrower bucket, and only the rows of the last one are
ranked.  A source that holds most rows costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmine.llm.common import WHITE
from pairmine.llm.rows import sized
from pairmine.session import stage

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
BUCKETS = 4096
_DRAW_BITS = 52


def word_count(text: Column) -> Column:
    """Words without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^ {WHITE}]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS
) -> DataFrame:
    """(source, source_size, target) for ``sizes`` (source, source_size), one row per source.

    Targets share ``share`` of all sizes by weight; one above ``epochs`` times its source
    stops there, and the excess goes to the others by weight until none is above.  The sources
    fill up in the order of size by weight, so it is known for each how much is left for it
    and those after it; from the first one on that is not filled up, they share the rest.
    """
    if share > epochs:
        raise ValueError("the sources cannot hold that share")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int") + 1)
    limits = sizes.withColumn("weight", weight.cast("long")).withColumn("limit", F.col("source_size") * epochs)
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    left = limits.withColumn("rest", rest).withColumn("among", F.sum("weight").over(after))
    open_ = left.withColumn("open", F.col("weight") * F.col("rest") / F.col("among") <= F.col("limit"))
    # The sources that are open share what the first of them finds.
    first = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "source", "rest", "among")))
    shared = open_.withColumn("first", first.over(everything))
    part = F.col("weight") * F.col("first.rest") / F.col("first.among")
    target = F.when(F.col("open"), F.least(part, F.col("limit").cast("double"))).otherwise(F.col("limit"))
    return shared.select("source", "source_size", target.cast("double").alias("target"))


def draw_key(key: Column, size: Column, weight: Column) -> Column:
    """The exponential key of a document: small keys are taken first."""
    name = F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), size.cast("string"))
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, _DRAW_BITS // 4), 16, 10).cast("long")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << _DRAW_BITS))) / weight


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) from ``labels`` (doc_id, quality 0 or 1): 2 for good ones, 1/2 for bad ones."""
    known = labels.filter("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg((0.5 + 1.5 * F.avg("quality")).alias("weight"))


def _narrow(rows: DataFrame, edges: DataFrame, order: list[str]) -> DataFrame:
    """Per source the group of ``rows`` (source, size, ...) by ``order`` in which its budget ends.

    ``edges`` (name, rest, before, at_...): the budget, the words taken before the rows whose
    columns equal the ``at_`` ones, which alone are summed.
    """
    fixed = [c for c in edges.columns if c.startswith("at_")]
    same = rows["source"].eqNullSafe(edges["name"])
    for column in fixed:
        same &= rows[column.removeprefix("at_")].eqNullSafe(edges[column])
    inside = rows.join(edges, same).withColumns({f"at_{c}": F.col(c) for c in order})
    kept = ["name", "rest", *fixed, *[f"at_{c}" for c in order]]
    sums = inside.groupBy(*kept, "before").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies"))
    running = Window.partitionBy("name").orderBy(*[f"at_{c}" for c in order])
    upto = F.col("before") + F.sum("words").over(running.rowsBetween(Window.unboundedPreceding, 0))
    reached = sums.withColumn("upto", upto).filter("upto >= rest and upto - words < rest")
    return sized(reached.select(*kept, (F.col("upto") - F.col("words")).alias("before"), "copies"), "mix-edge")


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs`` (doc_id, text, source).

    ``quality`` (doc_id, weight; an id once) makes documents likelier in the part of a source
    that is no whole epoch; documents without a positive weight weigh 1.  ``taken`` counts the
    words the mix takes of the row, repeats included: ``taken // size`` times all of it, then
    its first ``taken % size`` words.  Null texts have size 0 and give none.  A null source
    is a source; a null id is drawn by its size alone.  Rows equal in id, size and source get
    equal shares.  Extra columns are left out.  No rows give no rows.
    """
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"), "source"
    )
    weight = F.lit(1.0)
    if quality is not None:
        known = sized(quality.select(F.col("doc_id").alias("weighed"), F.col("weight").cast("double")), "mix-weights")
        given = given.join(known, given["doc_id"] == known["weighed"], "left")
        weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0)
    drawn = given.withColumn("draw", draw_key(F.col("doc_id"), F.col("size"), weight))
    # Keys of weight 1 spread evenly over the buckets.
    spread = (1 - F.exp(-F.col("draw"))) * BUCKETS
    last = F.lit(BUCKETS - 1)
    bucket = F.least(F.floor(spread), last).cast("int")
    finer = F.least(F.floor((spread - bucket) * BUCKETS), last).cast("int")
    rows = stage(
        drawn.select("doc_id", "size", "source", "draw", bucket.alias("bucket"), finer.alias("finer")), "mix-rows"
    )
    buckets = stage(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-buckets")
    sizes = buckets.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = sized(
        source_targets(sizes, weights, share, epochs)
        .withColumn("whole", whole.cast("long"))
        .withColumn("rest", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "name"),
        "mix-targets",
    )
    edges = targets.filter("rest > 0").select("name", "rest", F.lit(0).cast("long").alias("before"))
    edges = _narrow(buckets, edges, ["bucket"])
    edges = _narrow(rows, edges, ["finer"])
    edges = _narrow(rows, edges, ["draw", "doc_id", "size"])
    order = ["bucket", "finer", "draw", "doc_id", "size"]
    mine = F.struct(*order)
    edge = F.struct(*[F.col(f"at_{c}").alias(c) for c in order])
    part = (
        F.when(F.col("copies").isNull() | (mine > edge), 0)
        .when(mine < edge, F.col("size"))
        .otherwise(F.floor((F.col("edge_rest") - F.col("before")) / F.col("copies")))
    )
    ends = edges.select(F.col("name").alias("ends_in"), F.col("rest").alias("edge_rest"), "before", "copies", *[f"at_{c}" for c in order])
    placed = rows.join(targets, rows["source"].eqNullSafe(targets["name"])).join(
        ends, rows["source"].eqNullSafe(ends["ends_in"]), "left"
    )
    taken = F.col("whole") * F.col("size") + part
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
