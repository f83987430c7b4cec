"""N-gram Jaccard join: T-occurrence search with DivideSkip, and the components of its links.

Texts with equal shingle sets are one node. Two nodes link if ``percent`` % of the union of their sets is shared.

1. Shingle hashes are counted over all documents, dealt by their first bits in packed lists of 32-bit rests. The ones that come
   twice or more, and the frequent ones, set bits in two filters of ``filter_bits`` bits, which go to all tasks, through the driver by
   some MB at a time: their size is fixed. They only order shingles, the rarest first, and tell some that surely come once; a wrong bit costs time, never a link.
2. A node with n shingles shares T = ceil(n * percent / 100) at least with any partner, so one of its n - T + 1 rarest. If so
   many come once, it links with nothing and is done. The others post their rarest repeated shingles: the short lists,
   one for each class of sizes, since sets of very unlike sizes don't link. Shingles that come once are in the union of a pair
   but not shared; a node with too many of them beside the least that a list's nodes have can link with none there. Nodes
   that meet in a short list form clusters.
3. Clusters of up to ``PACKED`` nodes are searched in groups of about ``block`` nodes. Each node is a query: the short lists of
   its shingles are merged by a heap that skips what can't reach T - L, and the L longest lists are probed by binary search for
   each candidate.
4. A larger cluster is first linked to the smallest node of each list by binary probes. Its nodes outside the largest component
   so made are then the queries, in blocks, against all of the cluster, in blocks of about ``block`` nodes. Pairs inside that
   component need no search, others are all searched. So no query of a group of near copies merges the lists of all the others.

Defined results: texts without words, or null, have an empty set and link with nothing. Rows that repeat an identifier are
documents of their own; component_id is the smallest identifier reached, null counting as none. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialize
from .components import components
from .line_dedup import BLOCK_BITS, packed, unpacked
from .words import run_sets, slices, words

SIZE, PERCENT = 4, 85
FILTER_BITS = 1 << 27
FREQUENT = 16
BLOCK = 512
PACKED = 32  # nodes of a cluster whose queries are all searched: their work grows with the square
PROBE_COST = 0.05
BROADCAST_ROWS = 150_000
SENT_BYTES = 1 << 20  # of the filters in the driver at a time
_NODE = "doc_id bigint, row bigint, node bigint, n int"


def least_overlap(n: int, percent: int) -> int:
    """Shared shingles that a set of ``n`` needs with any partner."""
    return -(-n * percent // 100)


def linked(shared: int, a: int, b: int, percent: int) -> bool:
    return shared > 0 and 100 * shared >= percent * (a + b - shared)


def node_of(shingles: np.ndarray) -> int:
    """Equal sets are one node."""
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def nodes_of(rows: DataFrame, size: int) -> DataFrame:
    """(doc_id, row, node, n) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = run_sets(words(part.column("text")), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row"),
                        pa.array([node_of(s) for s in sets], type=pa.int64()),
                        pa.array([len(s) for s in sets], type=pa.int32()),
                    ],
                    names=["doc_id", "row", "node", "n"],
                )

    return rows.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", "text").mapInArrow(run, _NODE)


def repeated_blocks(rows: DataFrame, size: int, total: int, filter_bits: int) -> DataFrame:
    """(level, block, bits): blocks of the filters of shingles that come twice (0) and ``FREQUENT`` times (1) or more."""
    bucket_bits = min(16, max(6, int(log2(max(1, total) / (1 << 19))) + 1))
    rest_shift, place_bits = np.uint64(32 - bucket_bits), int(log2(filter_bits))

    def packed_rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for part in slices(batch, "text") for s in run_sets(words(part.column("text")), size)]
            every = np.sort(np.concatenate(sets)) if sets else np.zeros(0, dtype=np.uint64)
            cuts = np.searchsorted(every >> np.uint64(64 - bucket_bits), np.arange((1 << bucket_bits) + 1))
            rests = ((every >> rest_shift) & np.uint64(0xFFFFFFFF)).astype("<u4")
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, type=pa.int32()), pa.array([rests[cuts[b] : cuts[b + 1]].tobytes() for b in full], type=pa.binary())],
                names=["bucket", "rests"],
            )

    def counted(table: pa.Table) -> pa.Table:
        bucket = np.uint64(table.column("bucket")[0].as_py())
        rests, counts = np.unique(np.frombuffer(b"".join(table.column("rests").to_pylist()), dtype="<u4"), return_counts=True)
        found = []
        for level, least in enumerate((2, FREQUENT)):
            hashes = (bucket << np.uint64(32)) | rests[counts >= least].astype(np.uint64)
            places = np.unique(hashes >> np.uint64(32 + bucket_bits - place_bits)).astype(np.int64)
            for part in np.split(places, np.flatnonzero(np.diff(places // BLOCK_BITS)) + 1) if len(places) else ():
                flags = np.zeros(BLOCK_BITS, dtype=bool)
                flags[part % BLOCK_BITS] = True
                found.append((level, int(part[0] // BLOCK_BITS), packed(np.packbits(flags, bitorder="little"))))
        return pa.table(
            {
                "level": pa.array([f[0] for f in found], type=pa.int32()),
                "block": pa.array([f[1] for f in found], type=pa.int32()),
                "bits": pa.array([f[2] for f in found], type=pa.binary()),
            }
        )

    def united(table: pa.Table) -> pa.Table:
        """The parts of a block that buckets smaller than it have set, as one."""
        first, *others = table.column("bits").to_pylist()
        for bits in others:
            first = packed(unpacked(first) | unpacked(bits))
        return table.slice(0, 1).set_column(2, "bits", pa.array([first], type=pa.binary()))

    fields = "level int, block int, bits binary"
    parts = rows.select("text").mapInArrow(packed_rests, "bucket int, rests binary").groupBy("bucket").applyInArrow(counted, fields)
    return parts.groupBy("level", "block").applyInArrow(united, fields)


def repeated_filters(rows: DataFrame, size: int, total: int, filter_bits: int) -> dict[int, dict[int, bytes]]:
    """The blocks by level and number, as ``near_nodes`` has them in its tasks."""
    out: dict[int, dict[int, bytes]] = {0: {}, 1: {}}
    for r in repeated_blocks(rows, size, total, filter_bits).toLocalIterator():  # two filters of filter_bits / 8 bytes at most
        out[r.level][r.block] = bytes(r.bits)
    return out


def sent_in_parts(blocks: DataFrame) -> list[Broadcast]:
    """The blocks as broadcasts of about ``SENT_BYTES``: the driver has one of them and one partition of the blocks at a time, not all."""
    context, sent, part, held = blocks.sparkSession.sparkContext, [], [], 0
    for r in blocks.toLocalIterator():
        part.append((r.level, r.block, bytes(r.bits)))
        held += len(part[-1][2])
        if held >= SENT_BYTES:
            sent.append(context.broadcast(part))
            part, held = [], 0
    return [*sent, context.broadcast(part)] if part else sent


def near_nodes(rows: DataFrame, size: int, percent: int, sent: list[Broadcast], filter_bits: int) -> DataFrame:
    """(node, n, prefix, repeated) of the nodes that may have a partner.

    ``repeated`` has the shingles that may come elsewhere, sorted; ``prefix`` the rarest of them.
    """
    shift = np.uint64(64 - int(log2(filter_bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(filter_bits // 8, dtype=np.uint8) for _ in range(2)]
        for part in sent:
            for level, block, bits in part.value:
                tables[level][block * (BLOCK_BITS // 8) : (block + 1) * (BLOCK_BITS // 8)] = unpacked(bits)

        def known(level: int, hashes: np.ndarray) -> np.ndarray:
            places = (hashes >> shift).astype(np.int64)
            return ((tables[level][places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool)

        for batch in batches:
            for part in slices(batch, "text"):
                found: list[tuple[int, int, list[int], list[int]]] = []
                for shingles in run_sets(words(part.column("text")), size):
                    short = len(shingles) - least_overlap(len(shingles), percent) + 1
                    repeated = shingles[known(0, shingles)]
                    once = len(shingles) - len(repeated)
                    if len(shingles) and once < short:
                        order = np.lexsort((repeated, known(1, repeated)))[: short - once]
                        found.append((node_of(shingles), len(shingles), repeated[order].view(np.int64), repeated.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f[0] for f in found], type=pa.int64()),
                        pa.array([f[1] for f in found], type=pa.int32()),
                        pa.array([f[2] for f in found], type=pa.list_(pa.int64())),
                        pa.array([f[3].astype("<i8").tobytes() for f in found], type=pa.binary()),
                    ],
                    names=["node", "n", "prefix", "repeated"],
                )

    return rows.select("text").mapInArrow(run, "node bigint, n int, prefix array<bigint>, repeated binary").dropDuplicates(["node"])


def t_occurrence(lists: list[list[int]], need: int, probe_cost: float = PROBE_COST) -> Iterator[tuple[int, int]]:
    """(item, count) of the items that ``need`` or more of the sorted lists hold (DivideSkip).

    The L longest lists are only probed. An item must then be in need - L of the others, which a heap merges: it takes so many
    heads less one off, and skips in their lists to the next head that is left.
    """
    lists = sorted((x for x in lists if x), key=len)
    if len(lists) < need or need < 1:
        return
    longs = min(need - 1, int(need / (probe_cost * log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[: len(lists) - longs], lists[len(lists) - longs :]
    least = need - longs
    heap = [(x[0], i, 0) for i, x in enumerate(short)]
    heapq.heapify(heap)
    while len(heap) >= least:
        top, taken = heap[0][0], []
        while heap and heap[0][0] == top:
            taken.append(heapq.heappop(heap))
        if len(taken) >= least:
            count = len(taken)
            for left, x in zip(range(len(long) - 1, -1, -1), reversed(long), strict=True):
                at = bisect_left(x, top)
                count += at < len(x) and x[at] == top
                if count + left < need:
                    break
            if count >= need:
                yield top, count
            beyond = top + 1
        else:
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                return
            beyond = heap[0][0]
        for _, i, at in taken:
            at = bisect_left(short[i], beyond, at)
            if at < len(short[i]):
                heapq.heappush(heap, (short[i][at], i, at))


def search(percent: int):
    """Links of one group: its queries against its indexed nodes; of links that join the same nodes again, none is given."""

    def run(table: pa.Table) -> pa.Table:
        nodes, labels = table.column("node").to_pylist(), table.column("label").to_pylist()
        sizes, roles = table.column("n").to_pylist(), table.column("role").to_pylist()
        sets = [np.frombuffer(x, dtype="<i8").tolist() for x in table.column("repeated").to_pylist()]
        places: dict[int, list[int]] = defaultdict(list)
        for i, role in enumerate(roles):
            if role & 1:
                for shingle in sets[i]:
                    places[shingle].append(i)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        links = []
        for i, role in enumerate(roles):
            if role & 2:
                lists = [places[s] for s in sets[i] if s in places]
                for j, shared in t_occurrence(lists, least_overlap(sizes[i], percent)):
                    if nodes[j] != nodes[i] and linked(shared, sizes[i], sizes[j], percent):
                        a, b = root(labels[i]), root(labels[j])
                        if a != b:
                            parent[a] = b
                            links.append((nodes[i], nodes[j]))
        return pa.table({"a": pa.array([x[0] for x in links], type=pa.int64()), "b": pa.array([x[1] for x in links], type=pa.int64())})

    return run


def probe(pairs: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, by binary probes of one set in the other."""
    sides = [near.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("repeated").alias(f"set_{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, set_a, n_b, set_b in zip(*(batch.column(c).to_pylist() for c in ("n_a", "set_a", "n_b", "set_b")), strict=True):
                x, y = np.frombuffer(set_a, dtype="<u8"), np.frombuffer(set_b, dtype="<u8")
                at = np.searchsorted(y, x)
                shared = int(np.sum(y[np.minimum(at, len(y) - 1)] == x)) if len(y) else 0
                keep.append(linked(shared, n_a, n_b, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "set_a", "n_b", "set_b").mapInArrow(run, "a bigint, b bigint")


def part(of: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(of, F.lit(7)), parts).cast("int")


def node_links(near: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (a, b) that join the same nodes as all links together do."""
    once, share = F.col("n") - F.col("r"), 100 - percent
    kind = F.floor(F.log("n") / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    posted = (
        near.select("node", "n", (F.octet_length("repeated") / 8).cast("int").alias("r"), F.explode("prefix").alias("shingle"), kind.alias("kind"))
        .withColumn("kind", F.explode(F.array(F.col("kind"), F.col("kind") + 1)))
        .withColumn("once", once)
    )
    least = posted.groupBy("shingle", "kind").agg(F.min("once").alias("least"), F.count("*").alias("held")).filter("held > 1").drop("held")
    able = posted.join(least, ["shingle", "kind"]).filter(percent * (F.col("once") + F.col("least")) <= share * F.col("r")).select("shingle", "kind", "node")
    leaders = able.groupBy("shingle", "kind").agg(F.min("node").alias("b"), F.count("*").alias("held")).filter("held > 1").drop("held")
    met = able.join(leaders, ["shingle", "kind"]).filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    met = materialize(met, "met")
    clusters = components(met).withColumnRenamed("component", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    placed = materialize(clusters.join(sizes, "cluster").select("node", "cluster", "size"), "clusters")

    alone = min(block, PACKED)
    small = placed.filter(F.col("size") <= alone)
    packs = F.lit(max(1, -(-small.count() // block)))
    pack = part(F.col("cluster"), packs).cast("long").alias("cluster")
    rows = small.select("node", F.col("node").alias("label"), pack, F.lit(3).alias("role"), F.lit(-1).alias("i"), F.lit(-1).alias("q"))
    large = placed.filter(F.col("size") > alone)
    if large.isEmpty():
        return materialize(searched(rows, near, percent), "links")
    first = materialize(probe(met.join(large.select(F.col("node").alias("a")), "a"), near, percent), "links")
    rows = rows.unionByName(blocks_of(large, components(first), block))
    return materialize(first.unionByName(searched(rows, near, percent)), "links")


def searched(rows: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    if rows.count() < BROADCAST_ROWS:  # some ten MB at most; beyond, both sides are dealt by node
        rows = F.broadcast(rows)
    found = near.select("node", "n", "repeated").join(rows, "node")
    return found.groupBy("cluster", "i", "q").applyInArrow(search(percent), "a bigint, b bigint")


def blocks_of(large: DataFrame, linked_so_far: DataFrame, block: int) -> DataFrame:
    """Large clusters in blocks: all nodes as index, and those outside the largest component so far as queries."""
    labels = linked_so_far.withColumnRenamed("component", "label")
    named = materialize(large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    held = named.groupBy("cluster", "label").agg(F.count("*").alias("held"))
    largest = held.groupBy("cluster").agg(F.max(F.struct("held", "label")).alias("most"), F.sum("held").alias("size"))
    blocks = largest.select(
        "cluster",
        F.col("most.label").alias("most"),
        F.ceil(F.col("size") / block).cast("int").alias("index_blocks"),
        F.ceil((F.col("size") - F.col("most.held")) / block).cast("int").alias("query_blocks"),
    ).filter("query_blocks > 0")
    dealt = named.select("node", "cluster", "label").join(blocks, "cluster")
    index = dealt.select(
        "node", "label", "cluster", F.lit(1).alias("role"), part(F.col("node"), F.col("index_blocks")).alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("q"),
    )
    asked = dealt.filter("label <> most").select(
        "node", "label", "cluster", F.lit(2).alias("role"), F.explode(F.sequence(F.lit(0), F.col("index_blocks") - 1)).alias("i"),
        part(F.col("node"), F.col("query_blocks")).alias("q"),
    )
    return index.unionByName(asked)


def ngram_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    filter_bits: int = FILTER_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, row, n_shingles, component_id) of every row; ``row`` tells rows with equal identifiers apart."""
    rows = id_and_text(docs, doc_id, text)
    every = materialize(nodes_of(rows, size), "nodes")
    total = every.agg(F.sum("n")).first()[0] or 0
    filters = sent_in_parts(repeated_blocks(rows, size, total, filter_bits))
    near = materialize(near_nodes(rows, size, percent, filters, filter_bits), "near")
    for part in filters:  # what follows reads the written nodes
        part.destroy()
    joined = components(node_links(near, percent, block))
    labels = joined.withColumnRenamed("component", "label")
    full = every.filter("n > 0").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    full = materialize(full.select("doc_id", "row", "n", "label"), "labelled")
    count = every.count()
    smallest = full.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("held"))
    hot = smallest.filter(F.col("held") > count // 1000).select(F.col("label").alias("hot"), F.col("component_id").alias("hot_id"))  # under 1,000 rows
    told = full.join(F.broadcast(hot), F.col("label") == F.col("hot"), "left")
    cold = told.filter("hot IS NULL").select("doc_id", "row", "n", "label").join(smallest.select("label", "component_id"), "label")
    names = ("doc_id", "row", F.col("n").cast("long").alias("n_shingles"))
    return (
        told.filter("hot IS NOT NULL")
        .select(*names, F.col("hot_id").alias("component_id"))
        .unionByName(cold.select(*names, "component_id"))
        .unionByName(every.filter("n = 0").select(*names, F.col("doc_id").alias("component_id")))
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the one with the smallest identifier.

    Rows that repeat identifier and text go or stay together. Rows without an identifier go before others.
    """
    named = docs.withColumn("__llm_key", F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))))
    found = ngram_join(named, "__llm_key", text, size, percent).select(F.col("doc_id").alias("key"), F.col("component_id").alias("component"))
    first = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).cast("long").alias("id"), F.col("__llm_key").alias("key"))
    grouped = materialize(found.distinct().join(named.select(F.col("__llm_key").alias("key"), first.alias("first")).distinct(), "key"), "grouped")
    stays = grouped.groupBy("component").agg(F.min("first").alias("first"), F.count("*").alias("held")).filter("held > 1")
    gone = grouped.select("key", "component").join(stays.select("component", F.col("first.key").alias("stay")), "component").filter("key <> stay")
    return named.join(gone.select(F.col("key").alias("__llm_key")), "__llm_key", "left_anti").drop("__llm_key")
