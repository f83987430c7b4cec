"""Hard negatives of anchor vectors, by exact integer scores from Four-Russians tables.

Components become whole numbers, floor(scale * x). A candidate is packed into bit planes of two's complement: eight components
make one byte of each plane. An anchor has, for each group of eight components, a table of all 256 sums of subsets of them. Its
score with a candidate, their inner product, is then read off the tables: the sum over the groups of the entry at the
plane's byte, shifted by the plane's weight and added up from the highest plane, which counts negative, down to the lowest. The
result is the exact inner product; nothing is estimated or left out.

The candidates are packed once and written. Anchors are a stated query set: they meet all candidates in blocks of at most about
``ANCHORS`` anchors, each a broadcast of bounded size and two passes. The first scores an anchor with the candidates of its own label
and keeps the best ``positives``. The second scores it with those of other labels and keeps, for each positive, the best
``negatives`` in the positive's band. Each task keeps these few for the whole of its candidates, and only they are shuffled, so a label,
or copies of one vector, with a third of all rows cost no more than other rows do. A task scores ``TILE`` anchors with ``SLICE``
candidates at a time, whatever the sizes of labels.

Defined results: rows with a null identifier, label or vector, or a null or non-finite component take no part. A shorter vector counts as
filled up with zeros. An identifier counts once: of rows that repeat it, the one with the smallest label, then the smallest packed
vector, takes part. Equal scores are in the order of identifiers. An anchor without positives, and a positive without
negatives in its band, has no row. An empty table gives no rows. Vectors whose products could exceed 62 bits raise a ValueError.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

SCALE = 256
ANCHORS = 16_384
TILE = 64
SLICE = 2048
ROWS_PER_TASK = 8192
PACKED = "vec_id bigint, label bigint, planes binary"


@dataclass(frozen=True)
class Layout:
    """Groups of eight components, and bit planes, the highest of which is the sign."""

    groups: int
    planes: int
    wide: bool

    @classmethod
    def of(cls, size: int, lowest: int, highest: int) -> Layout:
        planes = max(int(highest), -int(lowest) - 1).bit_length() + 1
        largest = 8 * max(1, ceil(size / 8)) << 2 * (planes - 1)
        if planes > 32 or largest >= 1 << 62:
            raise ValueError(f"components from {lowest} to {highest} are too large for exact scores")
        return cls(ceil(size / 8), planes, largest >= 1 << 31)

    @property
    def number(self) -> type:
        return np.int64 if self.wide else np.int32

    def pack(self, values: np.ndarray) -> np.ndarray:
        """Bytes (rows, planes, groups) of whole numbers (rows, components)."""
        filled = np.zeros((len(values), 8 * self.groups), dtype=np.int64)
        filled[:, : values.shape[1]] = values
        bits = (filled[:, None, :] >> np.arange(self.planes)[None, :, None]) & 1
        return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
        weights = 1 << np.arange(self.planes)
        weights[-1] = -weights[-1]
        return np.tensordot(bits, weights, axes=(1, 0))

    def read(self, planes: pa.Array) -> np.ndarray:
        """The packed rows of an Arrow column."""
        size = self.planes * self.groups
        return np.frombuffer(b"".join(planes.to_pylist()), dtype=np.uint8).reshape(len(planes), self.planes, self.groups) if size else np.zeros((len(planes), self.planes, 0), dtype=np.uint8)


class Tables:
    """Subset sums of some anchors: for each group and each byte, a row with an entry for each anchor."""

    def __init__(self, layout: Layout, values: np.ndarray):
        self.layout, self.anchors = layout, len(values)
        self.sums = np.zeros((layout.groups, 256, len(values)), dtype=layout.number)
        for g in range(layout.groups):
            for j in range(8):  # each component doubles the number of known sums
                self.sums[g, 1 << j : 2 << j] = self.sums[g, : 1 << j] + values[:, 8 * g + j].astype(layout.number)

    def scores(self, packed: np.ndarray) -> np.ndarray:
        """Inner products (candidates, anchors)."""
        total = np.zeros((len(packed), self.anchors), dtype=self.layout.number)
        entry = np.empty_like(total)
        for plane in reversed(range(self.layout.planes)):
            total += total
            for g in range(self.layout.groups):
                np.take(self.sums[g], packed[:, plane, g], axis=0, out=entry, mode="clip")
                if plane == self.layout.planes - 1:
                    total -= entry
                else:
                    total += entry
        return total


def best(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each key, by falling score and rising identifier; sorted by key."""
    order = np.lexsort((ids, -scores, keys))
    sorted_keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


class Kept:
    """The first k of each key so far, as flat arrays, and each key's score from which a candidate may still enter."""

    def __init__(self, keys: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.int64)
        self.keys, self.scores, self.ids = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        at = best(keys, scores, ids, self.k)
        self.waiting.append((keys[at], scores[at], ids[at]))
        self.size += len(at)
        if self.size > 2 * len(self.floor) * self.k:
            self.settle()

    def settle(self) -> None:
        keys, scores, ids = (np.concatenate(x) for x in zip((self.keys, self.scores, self.ids), *self.waiting, strict=True))
        at = best(keys, scores, ids, self.k)
        self.keys, self.scores, self.ids, self.waiting, self.size = keys[at], scores[at], ids[at], [], 0
        full = np.flatnonzero(np.bincount(self.keys, minlength=len(self.floor)) >= self.k)
        last = np.searchsorted(self.keys, full, side="right") - 1
        self.floor[full] = np.maximum(self.floor[full], self.scores[last])

    def batch(self, names: list[str]) -> pa.RecordBatch:
        self.settle()
        return pa.RecordBatch.from_arrays([pa.array(a) for a in (self.keys, self.scores, self.ids)], names=names)


@dataclass
class Block:
    """Anchors in the order of their labels; after the first pass with their positives' scores."""

    layout: Layout
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray

    def tiles(self) -> Iterator[tuple[slice, Tables]]:
        """The tables are made anew for each slice, which costs little beside its lookups: a task holds one tile's at a time."""
        for first in range(0, len(self.ids), TILE):
            part = slice(first, min(first + TILE, len(self.ids)))
            yield part, Tables(self.layout, self.values[part])

    def positives(self, k: int, batches: Iterator[pa.RecordBatch]) -> Kept:
        kept = Kept(len(self.ids), k, np.full(len(self.ids), -(1 << 62)))
        for ids, labels, packed in _slices(self.layout, batches):
            for part, tables in self.tiles():
                own = np.flatnonzero(np.isin(labels, self.labels[part]))
                if not len(own):
                    continue
                scores = tables.scores(packed[own])
                here = (labels[own][:, None] == self.labels[part][None, :]) & (ids[own][:, None] != self.ids[part][None, :])
                c, a = np.nonzero(here & (scores >= kept.floor[part][None, :]))
                kept.add(a + part.start, scores[c, a].astype(np.int64), ids[own][c])
        return kept

    def negatives(self, k: int, low: np.ndarray, high: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Kept:
        """``low`` and ``high`` are the bands (anchors, positives); a band that is not there has high below low."""
        each = low.shape[1]
        kept = Kept(low.size, k, low.ravel())
        for ids, labels, packed in _slices(self.layout, batches):
            for part, tables in self.tiles():
                floor = kept.floor.reshape(low.shape)[part]
                able = np.where(floor <= high[part], floor, 1 << 62).min(axis=1)
                if (able == 1 << 62).all():
                    continue
                scores = tables.scores(packed)
                c, a = np.nonzero((scores >= able[None, :]) & (scores <= high[part].max(axis=1)[None, :]) & (labels[:, None] != self.labels[part][None, :]))
                found = scores[c, a].astype(np.int64)
                for p in range(each):
                    inside = np.flatnonzero((found >= floor[a, p]) & (found <= high[part][a, p]))
                    if len(inside):
                        kept.add((a[inside] + part.start) * each + p, found[inside], ids[c[inside]])
        return kept


def _slices(layout: Layout, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE):
            part = batch.slice(first, SLICE)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), layout.read(part.column(2))


def _first(rows: DataFrame, keys: list[str], score: str, tie: str, k: int, alias: str) -> DataFrame:
    """The first k rows of each key; each task keeps its own k before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return rows.withColumn(alias, F.row_number().over(order)).filter(F.col(alias) <= k)


def pack(vectors: DataFrame, vec_id: str, label: str, embedding: str, scale: int) -> tuple[DataFrame, Layout, int]:
    """(vec_id, label, planes) of the rows that take part, written; their layout, and their number."""
    numbers = F.transform(F.col(embedding).cast("array<double>"), lambda x: F.floor(F.lit(scale) * x))
    sound = F.forall(F.col(embedding).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull() & sound)
        .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), numbers.alias("numbers"))
    )
    bounds = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.size("numbers")), F.lit(0)).alias("size"),
        F.coalesce(F.min(F.array_min("numbers")), F.lit(0)).alias("lowest"),
        F.coalesce(F.max(F.array_max("numbers")), F.lit(0)).alias("highest"),
    ).first()
    layout = Layout.of(bounds["size"], bounds["lowest"], bounds["highest"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            values = np.zeros((batch.num_rows, 8 * layout.groups), dtype=np.int64)
            values[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
            planes = pa.array([p.tobytes() for p in layout.pack(values)], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), planes], names=["vec_id", "label", "planes"])

    once = rows.mapInArrow(packed, PACKED).groupBy("vec_id").agg(F.min(F.struct("label", "planes")).alias("row"))
    tasks = max(1, ceil(bounds["n"] / ROWS_PER_TASK))
    return materialize(once.select("vec_id", "row.label", "row.planes").coalesce(tasks), "packed"), layout, bounds["n"]


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    floor_percent: int = 80,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    block: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on ``vec_id``. Positives are the best rows of the anchor's label. Negatives are the best rows of other
    labels whose score is between ``floor_percent`` hundredths of the positive's score and that score. ``rank`` counts from 1 among
    the negatives of a positive.
    """
    spark = vectors.sparkSession
    rows, layout, n = pack(vectors, vec_id, label, embedding, scale)
    tasks = max(spark.sparkContext.defaultParallelism, ceil(n / (64 * ROWS_PER_TASK)))  # candidates are dealt out evenly, however they are stored
    dealt = rows.repartition(tasks)
    asked = rows.filter(anchor)
    blocks = max(1, ceil(asked.count() / block))
    parts = [_mined(dealt, asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b), layout, positives, negatives, floor_percent) for b in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _mined(dealt: DataFrame, asked: DataFrame, layout: Layout, positives: int, negatives: int, floor_percent: int) -> DataFrame:
    """The rows of one block of anchors. Its identifiers, vectors and positives pass the driver, a bounded number of each."""
    spark = dealt.sparkSession
    table = asked.orderBy("label", "vec_id").toArrow().combine_chunks()
    ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
    block = Block(layout, ids, labels, layout.unpack(layout.read(table.column("planes"))))
    sent = spark.sparkContext.broadcast(block)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield sent.value.positives(positives, batches).batch(["anchor", "score", "vec_id"])

    found = _first(dealt.mapInArrow(near, "anchor bigint, score bigint, vec_id bigint"), ["anchor"], "score", "vec_id", positives, "place").toArrow()
    anchor, place = found.column("anchor").to_numpy(), found.column("place").to_numpy() - 1
    scores = found.column("score").to_numpy().astype(np.int64)
    low, high = np.full((len(ids), positives), 1 << 62), np.full((len(ids), positives), -(1 << 62))
    named = np.zeros((len(ids), positives), dtype=np.int64)
    low[anchor, place], high[anchor, place] = -(-floor_percent * scores // 100), scores
    named[anchor, place] = found.column("vec_id").to_numpy()
    bands = spark.sparkContext.broadcast((low, high, named))

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, named = bands.value
        kept = sent.value.negatives(negatives, low, high, batches)
        kept.settle()
        a, p = kept.keys // positives, kept.keys % positives
        columns = [sent.value.ids[a], named[a, p], kept.ids, high[a, p], kept.scores]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
        )

    rows = dealt.mapInArrow(hard, "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    ranked = _first(rows, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v AS a JOIN v AS c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
p AS (
  SELECT anchor_id, other_id AS positive_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank,
       s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""
