"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are computed in one pass over whole texts.  Distinct fingerprints that
differ in at most ``MAX_BITS`` bits agree on some of ``blocks`` bit blocks, so each goes
to one table per choice of agreeing blocks, keyed by their bits.  A task sorts its
fingerprints by key and Gray rank and builds an index over them: the bits that all
members of a node share stand in the node, bits already shared higher up are not
repeated, and up to ``FANOUT`` neighbours form the node above.  A fingerprint walks down
from the root of its key with the differences added up so far, and a node whose sum
exceeds the limit is dropped with everything below it.

Links found in a task are merged at once into a spanning forest, so a group of n
similar fingerprints yields n - 1 rows however many pairs it has.  Keys with more than
``MAX_GROUP`` fingerprints are split into chunks, and every two chunks meet in a task
of their own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmine.llm.common import partitions_for, ship_code
from pairmine.llm.components import components
from pairmine.llm.rows import drop_rows
from pairmine.session import stage

SHINGLE = 3
SEED = 42
MAX_BITS = 3
FANOUT = 16
MAX_GROUP = 100_000
ROWS_EACH = 200_000
_FRONTIER = 2_000_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ADDED = ("fingerprint",)


# --- fingerprints ---------------------------------------------------------------


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of a text, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(line, SEED)], dtype=np.uint64)
    ends = list(itertools.accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *[e + 1 for e in ends]]
    return np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)], dtype=np.uint64
    )


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """Per text: the bits set in over half of its hashes; zero without any."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    for k, values in enumerate(hashes):
        if len(values):
            bits = np.zeros(64, dtype=np.int64)
            for part in range(0, len(values), 65_536):
                some = values[part : part + 65_536].astype(">u8").view(np.uint8)
                bits += np.unpackbits(some).reshape(-1, 64).sum(axis=0, dtype=np.int64)
            out[k] = np.packbits(2 * bits > len(values)).view(">u8")[0]
    return out


def with_fingerprint(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``fingerprint`` (long, the 64 bits) of the whole text.

    Null and empty texts have fingerprint zero; a column of that name is replaced.
    """
    ship_code(docs.sparkSession)
    kept = docs.select(*[docs[c] for c in docs.columns if c.lower() not in _ADDED])
    out = (kept if keep_text else kept.drop("text")).withColumn("fingerprint", F.lit(0).cast("long"))
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            place = batch.schema.get_field_index("text")
            codes = fingerprints([shingle_hashes(t.as_py()) for t in batch.column(place)])
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes.view(np.int64))], names=names)

    return kept.mapInArrow(run, out.schema)


# --- index ----------------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Index:
    """Nodes over codes that are sorted by group and Gray rank; a root per group."""

    def __init__(self, group: np.ndarray, codes: np.ndarray):
        self.codes = codes
        n = len(codes)
        change = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, dtype=bool)
        self.levels: list[dict[str, np.ndarray]] = []
        low, high = np.arange(n), np.arange(n) + 1
        every, some = codes, codes
        opens = change
        while True:
            start = np.flatnonzero(self._cuts(opens))
            last = np.concatenate([start[1:], [len(low)]]) - 1
            every = np.bitwise_and.reduceat(every, start)
            some = np.bitwise_or.reduceat(some, start)
            low, high = low[start], high[last]
            opens = opens[start]
            self.levels.append(
                {"child": start, "stop": last + 1, "high": high, "mask": ~(every ^ some), "bits": every}
            )
            if opens.all():
                break
        for upper, lower in zip(self.levels[1:], self.levels, strict=False):
            parent = np.repeat(np.arange(len(upper["child"])), upper["stop"] - upper["child"])
            lower["own"] = lower["mask"] & ~upper["mask"][parent]
        self.levels[-1]["own"] = self.levels[-1]["mask"]
        self.root = np.cumsum(change) - 1

    @staticmethod
    def _cuts(opens: np.ndarray) -> np.ndarray:
        """Where the nodes above start: at a new group and after every ``FANOUT``."""
        at = np.arange(len(opens))
        begin = np.maximum.accumulate(np.where(opens, at, 0))
        return (at - begin) % FANOUT == 0

    def links(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of positions whose codes differ in at most ``limit`` bits."""
        top = len(self.levels) - 1
        root = self.levels[top]
        for start in range(0, len(self.codes), _FRONTIER // FANOUT):
            query = np.arange(start, min(start + _FRONTIER // FANOUT, len(self.codes)))
            node = self.root[query]
            more = root["high"][node] > query + 1
            query, node = query[more], node[more]
            differ = np.bitwise_count((self.codes[query] ^ root["bits"][node]) & root["own"][node])
            yield from self._walk(top, query, node, differ.astype(np.int64), limit)

    def _walk(self, level: int, query, node, differ, limit: int):
        step = _FRONTIER // FANOUT
        if len(query) > step:
            for k in range(0, len(query), step):
                yield from self._walk(level, query[k : k + step], node[k : k + step], differ[k : k + step], limit)
            return
        if not len(query):
            return
        here = self.levels[level]
        first, count = here["child"][node], here["stop"][node] - here["child"][node]
        child = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        query, differ = np.repeat(query, count), np.repeat(differ, count)
        if level == 0:
            rest = ~np.repeat(here["mask"][node], count)
            total = differ + np.bitwise_count((self.codes[query] ^ self.codes[child]) & rest)
            near = (total <= limit) & (child > query)
            if near.any():
                yield query[near], child[near]
            return
        below = self.levels[level - 1]
        differ = differ + np.bitwise_count((self.codes[query] ^ below["bits"][child]) & below["own"][child])
        alive = (differ <= limit) & (below["high"][child] > query + 1)
        yield from self._walk(level - 1, query[alive], child[alive], differ[alive], limit)


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position that each position is linked with, over any number of links."""
    root = np.arange(n)
    for a, b in links:
        while True:
            a, b = root[a], root[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = root[root]
                if (jumped == root).all():
                    break
                root = jumped
    return root


def _link_partition(batches: Iterator[pa.RecordBatch], limit: int):
    tables = [pa.table({"unit": b.column(0), "code": b.column(1), "fp": b.column(2)}) for b in batches if len(b)]
    if not tables:
        return
    rows = pa.concat_tables(tables)
    unit = rows["unit"].to_numpy()
    code = rows["code"].to_numpy().view(np.uint64)
    fp = rows["fp"].to_numpy()
    order = np.lexsort((gray_rank(code), unit))
    unit, code, fp = unit[order], code[order], fp[order]
    root = forest(len(fp), Index(unit, code).links(limit))
    linked = np.flatnonzero(root != np.arange(len(root)))
    yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], names=["a", "b"])


# --- links over the whole table --------------------------------------------------


def _block_bounds(blocks: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each block."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def _keyed(codes: DataFrame, blocks: int, limit: int) -> DataFrame:
    """(unit key, code with the key's bits in front, fp), a row per table."""
    bounds = _block_bounds(blocks)
    rows = []
    for number, agree in enumerate(itertools.combinations(range(blocks), blocks - limit)):
        key, front = "0L", "0L"
        for k in [*agree, *[k for k in range(blocks) if k not in agree]]:
            low, width = bounds[k]
            bits = f"(shiftrightunsigned(fp, {low}) & {(1 << width) - 1}L)"
            front = f"(shiftleft({front}, {width}) | {bits})"
            if k in agree:
                key = f"(shiftleft({key}, {width}) | {bits})"
        rows.append(f"struct({number} as t, {key} as k, {front} as code)")
    return codes.select("fp", F.expr(f"inline(array({', '.join(rows)}))"))


def fingerprint_links(
    codes: DataFrame, limit: int = MAX_BITS, blocks: int = MAX_BITS + 1, max_group: int = MAX_GROUP
) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (``fp`` long) within ``limit`` bits.

    They span the components, pairs that others imply are left out.  More ``blocks`` than
    ``limit + 1`` give more tables of smaller groups, for very large inputs.
    """
    spark = codes.sparkSession
    ship_code(spark)
    keyed = stage(_keyed(codes, blocks, limit), "simhash-keys")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"))
    hot = stage(sizes.filter(F.col("n") > max_group), "simhash-hot")
    plain = keyed
    split = None
    if not hot.isEmpty():
        plain = keyed.join(hot, ["t", "k"], "left_anti")
        chunks = F.ceil(F.col("n") / F.lit(max_group / 2)).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("m")).cast("int")
        split = (
            keyed.join(hot.select("t", "k", chunks.alias("m")), ["t", "k"])
            .withColumn("c", own)
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
            .filter("o <> c")
            .select(F.xxhash64("t", "k", F.least("c", "o"), F.greatest("c", "o")).alias("unit"), "code", "fp")
        )
    units = plain.select(F.xxhash64("t", "k").alias("unit"), "code", "fp")
    units = units if split is None else units.union(split)
    count = partitions_for(spark, keyed.count(), ROWS_EACH)
    return units.repartition(count, "unit").mapInArrow(lambda b: _link_partition(b, limit), "a long, b long")


def with_component(codes: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """``codes`` (doc_id, fingerprint) with ``component_id``, the smallest doc_id reachable.

    Rows of equal fingerprint are one node, so any number of copies costs one row.  Null
    ids belong to a component but never name it, unless it has no other.
    """
    firsts = stage(
        codes.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first")), "simhash-firsts"
    )
    blocks = limit + 1 if firsts.count() < 1 << 26 else limit + 2
    found = components(fingerprint_links(firsts.select("fp"), limit, blocks))
    classes = firsts.join(found, firsts["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("class")
    )
    classes = stage(classes, "simhash-classes")
    ids = classes.groupBy("class").agg(F.min("first").alias("component_id"))
    named = stage(classes.join(ids, "class").select(F.col("fp").alias("fingerprint"), "component_id"), "simhash-named")
    return codes.join(named, "fingerprint", "left").select(*[codes[c] for c in codes.columns], "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text).

    Repeated rows each have theirs; no rows give no rows; other columns are ignored.
    """
    codes = with_fingerprint(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")), False)
    return with_component(stage(codes, "simhash-codes"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id."""
    coded = with_fingerprint(docs.withColumn("_row_", F.monotonically_increasing_id()))
    held = stage(coded, "simhash-docs")
    codes = held.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_row_").alias("row"), "fingerprint")
    named = with_component(codes)
    # Of rows that share the smallest id, the first one stays.
    first = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id"), F.col("row"))).alias("f")
    )
    gone = codes.join(first.select(F.col("f.row").alias("row")), "row", "left_anti").select(F.col("row").alias("_row_"))
    return drop_rows(held, gone, "_row_").select(*[held[c] for c in docs.columns])
