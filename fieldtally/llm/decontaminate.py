"""Benchmark decontamination by spaced seeds.

A mask looks at some of the words in a window and ignores the others, so a substituted word at an ignored place does not
hide a hit. Hashes of the masked windows of test and training texts are joined; each hit names a diagonal, and along it item
and text are compared word by word. The overlap is the longest stretch that is equal in ``identity`` of its words or more, given without
unequal ends; it counts from ``min_words`` words on. An item of at most ``min_words`` words counts if its whole length, ends included, is
such a stretch; one of less than ``SHORT_WORDS`` words only if it is equal. The masks leave no such overlap out.

The test side goes to all tasks in blocks of about ``block_chars`` characters, one pass over the training texts for each
block: a stated query set against all rows. Blocks are dealt by a hash of the item, so their size is known beforehand.

Words are as in ``words``; A-Z count as a-z.

Defined results: null, empty and blank texts and items overlap with nothing. Repeated rows on either side are compared one by
one; of a repeated pair of identifiers, equal rows are given once. An empty table on either side gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, whole_text
from .words import Words, mix, slices, words

# Together they hit every stretch of 13 words or more, of which 80 % are equal, wherever the unequal ones stand; see the tests.
MASKS = ("1101100101", "11100010011", "101001110001", "100001010111")
# Likewise for whole items of 10 to 12 words, whose ends may be unequal; looked for in such items only.
SHORT_MASKS = ("111011", "11010011", "11111")
SHORT_WORDS = 10
MIN_WORDS = 13
IDENTITY = 0.8
BLOCK_CHARS = 8_000_000
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def seeds(found: Words, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window that lies within one text."""
    span = len(mask)
    n = len(found.hashes) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.full(n, np.uint64(int(mask, 2)) * np.uint64(0x9E3779B1), dtype=np.uint64)
    for place, looked_at in enumerate(mask):
        if looked_at == "1":
            total = total * _STEP + found.hashes[place : place + n]
    inside = np.ones(n, dtype=bool)
    for cut in found.bounds[1:-1]:
        inside[max(0, cut - span + 1) : cut] = False
    first = np.flatnonzero(inside)
    return mix(total[first]), first


def stretch(equal: np.ndarray, identity: float) -> tuple[int, int]:
    """The longest stretch with at least ``identity`` of its words equal, the first of several."""
    gain = np.where(equal, round((1 - identity) * 1000), -round(identity * 1000))
    sums = np.concatenate(([0], np.cumsum(gain)))
    least = np.minimum.accumulate(sums)
    most = np.maximum.accumulate(sums[::-1])[::-1]
    ends = np.searchsorted(-most, -least, side="right") - 1  # the last end for each begin
    begin = int(np.argmax(ends - np.arange(len(sums))))
    return (begin, int(ends[begin])) if ends[begin] > begin else (0, 0)


def trimmed(equal: np.ndarray, begin: int, end: int) -> tuple[int, int]:
    """The stretch without unequal ends."""
    while begin < end and not equal[begin]:
        begin += 1
    while begin < end and not equal[end - 1]:
        end -= 1
    return begin, end


class TestSide:
    """Seeds of some items, sorted by hash, and a small table that tells most other hashes."""

    def __init__(self, ids: list[int], texts: list[str], masks: tuple[str, ...]):
        self.ids = ids
        self.found = words(pa.array(texts, type=pa.string()))
        sizes = np.diff(self.found.bounds)
        owner = np.repeat(np.arange(len(ids)), sizes)
        # Each mask with the sizes of the items it is for: all, short ones, and of the shortest ones their own size as a whole.
        uses = [(m, 0, 1 << 62) for m in masks]
        uses += [(m, SHORT_WORDS, MIN_WORDS) for m in SHORT_MASKS if ((sizes >= SHORT_WORDS) & (sizes < MIN_WORDS)).any()]
        uses += [("1" * n, n, n + 1) for n in sorted({int(n) for n in sizes if 0 < n < SHORT_WORDS})]
        self.masks, self.tables = [mask for mask, _, _ in uses], []
        for mask, least, below in uses:
            hashes, first = seeds(self.found, mask)
            fits = (sizes[owner[first]] >= least) & (sizes[owner[first]] < below)
            hashes, first = hashes[fits], first[fits]
            order = np.argsort(hashes, kind="stable")
            likely = np.zeros(1 << 20, dtype=bool)
            likely[hashes & np.uint64(0xFFFFF)] = True
            items = owner[first[order]]
            self.tables.append((hashes[order], items, first[order] - self.found.bounds[items], likely))

    def overlaps(self, texts: Words, min_words: int, identity: float) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, first word in text, first word in item, words, equal words) of the longest overlap of each pair."""
        hits = []
        for mask, (hashes, items, places, likely) in zip(self.masks, self.tables, strict=True):
            found, first = seeds(texts, mask)
            some = np.flatnonzero(likely[found & np.uint64(0xFFFFF)])
            found, first = found[some], first[some]
            a, b = np.searchsorted(hashes, found), np.searchsorted(hashes, found, side="right")
            many = b - a
            at = np.repeat(a - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            first = np.repeat(first, many)
            doc = np.searchsorted(texts.bounds, first, side="right") - 1
            hits.append(np.stack((doc, items[at], first - texts.bounds[doc] - places[at])))
        hits = np.unique(np.concatenate(hits, axis=1), axis=1).T if hits else []
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for doc, item, shift in hits:
            text = texts.hashes[texts.bounds[doc] : texts.bounds[doc + 1]]
            own = self.found.hashes[self.found.bounds[item] : self.found.bounds[item + 1]]
            lo, hi = max(0, -shift), min(len(own), len(text) - shift)
            equal = own[lo:hi] == text[lo + shift : hi + shift]
            long = stretch(equal, identity)
            begin, end = trimmed(equal, *long)
            needed = identity if len(own) >= SHORT_WORDS else 1.0
            whole = len(own) <= min_words and long[1] - long[0] == len(own) and equal.mean() >= needed - 1e-9
            if end - begin >= min_words or whole:
                row = (end - begin, -(lo + begin + shift), -(lo + begin), int(equal[begin:end].sum()))
                best[doc, item] = max(row, best.get((doc, item), row))
        return [(d, i, -r[1], -r[2], r[0], r[3]) for (d, i), r in sorted(best.items())]


def test_sides(benchmark: DataFrame, item_id: str, item_text: str, masks: tuple[str, ...], block_chars: int) -> Iterator[Broadcast]:
    """The items in blocks of about ``block_chars`` characters, sent to all tasks one after the other."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), whole_text(item_text).alias("item_text"))
    blocks = -(-(items.agg(F.sum(F.length("item_text"))).first()[0] or 0) // block_chars)
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(blocks)) == block).distinct().orderBy("item_id", "item_text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(TestSide([r.item_id for r in mine], [r.item_text for r in mine], masks))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_words: int = MIN_WORDS,
    identity: float = IDENTITY,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words, n_equal) of the longest overlap of each document and item."""
    rows = id_and_text(docs, doc_id, text)
    schema = "doc_id bigint, item_id bigint, doc_start bigint, item_start bigint, n_words bigint, n_equal bigint"

    def against(side: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    found = side.value.overlaps(words(part.column("text")), min_words, identity)
                    ids = part.column("doc_id").to_pylist()
                    columns = [[ids[r[0]] for r in found], [side.value.ids[r[1]] for r in found], *([int(r[k]) for r in found] for k in range(2, 6))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=pa.int64()) for c in columns], names=["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"]
                    )

        return rows.mapInArrow(run, schema)

    found = [against(s) for s in test_sides(benchmark, item_id, item_text, masks, block_chars)]
    return reduce(DataFrame.unionByName, found).distinct() if found else rows.sparkSession.createDataFrame([], schema)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_words: int = MIN_WORDS,
    identity: float = IDENTITY,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with all their columns. Each row goes by its own text, without a join."""

    def clean(rows: DataFrame, side: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    keep = np.ones(part.num_rows, dtype=bool)
                    keep[[r[0] for r in side.value.overlaps(words(part.column(text)), min_words, identity)]] = False
                    yield part.filter(pa.array(keep))

        return rows.mapInArrow(run, docs.schema)

    return reduce(clean, test_sides(benchmark, item_id, item_text, masks, block_chars), docs)
