"""Byte-balanced shards of indivisible groups, by Karmarkar-Karp differencing.

Rows of equal text are a group and stay together.  A partial partition is a tuple of
shard sums; at first every group is one with a single sum.  The two partial partitions
of largest spread are combined again and again, the largest sum of one with the
smallest of the other, until one is left.

Differencing takes large groups first, and so does the job: groups are dealt in classes
of size, a factor of 64 apart, from the largest down.  A class is cut by hash into
parts of about ``PART_GROUPS`` groups, each differenced in a task of its own, together with
one more partial partition: the part's share of what the shards hold so far.  The
smaller groups thus level out the larger ones, and no task sees more than a bounded
number of groups; the driver sees one sum per shard and class.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmine.llm.common import ship_code
from pairmine.llm.rows import sized
from pairmine.session import stage

SHARDS = 40
ROW_BYTES = 16
PART_GROUPS = 4_096
_CLASS_BITS = 6
SLOT_ROWS = 20_000


def difference(sums: np.ndarray) -> np.ndarray:
    """For partial partitions (rows) of k sums each: the shard that each sum goes to."""
    count, k = sums.shape
    # Partial partition: its sums in falling order, and which subsets they are.
    order = np.argsort(-sums, axis=1, kind="stable")
    values = {i: sums[i][order[i]] for i in range(count)}
    subsets = {i: [[(i, int(s))] for s in order[i]] for i in range(count)}
    heap = [(int(v[-1]) - int(v[0]), i) for i, v in values.items()]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = values[a] + values.pop(b)[::-1]
        left, right = subsets[a], subsets.pop(b)[::-1]
        for mine, other in zip(left, right, strict=True):
            if len(mine) < len(other):
                mine[:], other[:] = other[:], mine[:]
            mine.extend(other)
        falling = np.argsort(-joined, kind="stable")
        values[a], subsets[a] = joined[falling], [left[s] for s in falling]
        heapq.heappush(heap, (int(joined.min()) - int(joined.max()), a))
    out = np.empty((count, k), dtype=np.int64)
    if count:
        for shard, members in enumerate(subsets[heap[0][1]]):
            for i, s in members:
                out[i, s] = shard
    return out


def _deal_part(rows: pd.DataFrame, held: np.ndarray) -> pd.DataFrame:
    """Shard of each group of a part, where the shards already hold ``held``."""
    rows = rows.sort_values(["bytes", "digest"], ascending=[False, True], ignore_index=True)
    sums = np.zeros((len(rows) + 1, len(held)), dtype=np.int64)
    sums[0] = held
    sums[1:, 0] = rows["bytes"].to_numpy()
    dealt = difference(sums)
    # Shards keep the names they have in ``held``.
    name = np.argsort(dealt[0])
    rows["shard"] = name[dealt[1:, 0]].astype(np.int32)
    return rows[["digest", "shard", "bytes"]]


def _dealer(held: np.ndarray):
    return lambda rows: _deal_part(rows, held)


def assign_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(digest, shard) for groups (digest, bytes)."""
    ship_code(groups.sparkSession)
    size_class = F.floor((F.length(F.bin("bytes")) - 1) / _CLASS_BITS).cast("int")
    classed = stage(groups.select("digest", "bytes", size_class.alias("class")), "shard-groups")
    sizes = classed.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    sums = np.zeros(shards, dtype=np.int64)
    done = []
    for row in sorted(sizes, reverse=True):
        parts = -(-row["n"] // PART_GROUPS)
        held = (sums - sums.min()) // parts
        own = classed.filter(F.col("class") == row["class"])
        part = F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("long")
        dealt = own.withColumn("part", part).groupBy("part").applyInPandas(
            _dealer(held), "digest binary, shard int, bytes long"
        )
        done.append(stage(dealt, "shard-class"))
        for total in done[-1].groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():  # one row per shard
            sums[total["shard"]] += total["bytes"]
    whole = classed.select("digest", F.lit(0).alias("shard"), "bytes").limit(0)
    for one in done:
        whole = whole.union(one)
    return whole.select("digest", "shard")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs`` (doc_id, text).

    ``size`` is the UTF-8 length plus ``ROW_BYTES``.  Null and empty texts are one group;
    repeated rows belong to one group and have a slot each; slots are gapless from 0
    in every shard, in no order that means anything.  A group larger than a shard's share
    makes its shard that much larger.  No rows give no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    dealt = assign_groups(groups, shards)
    buckets = max(1, rows.count() // (shards * SLOT_ROWS) + 1)
    placed = stage(
        rows.join(dealt, "digest").withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(4 * buckets)).cast("int")
        ),
        "shard-placed",
    )
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sized(
        counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "shard-offsets"
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "digest")
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot")
    )
