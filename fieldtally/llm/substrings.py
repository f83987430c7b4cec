"""Substring dedup by compact windows: passages of ``min_words`` words or more that come, nearly alike, in another document.

Texts are sequences of shingles of ``size`` words. Only shingles that two documents hold can be shared; filters of fixed size
tell most others (as in the n-gram join), and stretches with too few of them can't be part of a repeated passage.

1. For each of ``HASHES`` hashes, a text's subsequences of at least the wanted length are grouped by the place of their least
   hash: the nodes of a Cartesian tree. A window (l, c, r) stands for all subsequences from l..c to c..r. Its signature
   is the shingle at c. Shared shingles come before frequent ones, and those before the ones that come once.
2. Of equal texts, the one of the smallest document is compared with others; the others repeat it as a whole.
3. A document with windows of a signature meets the smallest document that has some, so a passage in a third of all documents
   gives one pair for each. Shingles that come once are in the union of a pair but not shared, so a document whose windows have
   too many of them, beside the least of the signature, has no partner. Pairs for which ``NEED`` hashes agree so far are verified
   once: all their windows are joined as intervals along a diagonal, and where ``NEED`` hashes agree, the Jaccard similarity of
   the shingle sets is to be ``similarity`` or more.
4. Windows that are not found repeated go into another round with other documents to be compared with, sixteen times as many in
   each round, until every window was found repeated or its document has met all others of the signature. A window that was
   found repeated is compared with no further documents, but its document is met by others until it has led once.

Defined results: a null text is an empty text and has no passage. Rows that repeat an identifier are documents of their own, of
which the first read counts as smaller; a null identifier is the smallest. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialize
from .decontaminate import stretch
from .line_dedup import BLOCK_BITS, unpacked
from .ngram_join import repeated_filters
from .words import mix, runs, slices, spread, words

SIZE, MIN_WORDS, SIMILARITY = 5, 50, 0.8
FILTER_BITS = 1 << 27
HASHES, NEED = 4, 2
DRIFT = 8  # words by which the parts of a passage may be shifted
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))
_WINDOW = np.dtype([("f", "<i4"), ("value", "<i8"), ("c", "<i4"), ("l", "<i4"), ("r", "<i4")])
_KEYS = "array<struct<f:int,value:bigint,once:int,places:array<int>>>"
_PIECES = f"row bigint, doc_id bigint, sequence binary, windows binary, keys {_KEYS}"
HITS = 1 << 20  # pairs of windows that are looked at together
_FOUND = (
    "row bigint, doc_id bigint, start_word bigint, n_words bigint, other bigint, of_doc_id bigint, of_start_word bigint, of_n_words bigint, similarity double"
)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each window of ``width``, from windows of doubling width."""
    least, have = keys, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def compact_windows(keys: np.ndarray, centres: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int, int]]:
    """(l, c, r) of the centres, in order, within the stretches that ``cuts`` ends; r is inclusive.

    The nearest smaller keys of a centre are the centres of longer windows, so a stack of centres is enough.
    """
    left, right = {}, {}
    stack: list[int] = []
    stretch_of = np.searchsorted(cuts, centres, side="right") - 1
    before = -1
    for c, own in zip(centres.tolist(), stretch_of.tolist(), strict=True):
        if own != before:
            for x in stack:
                right[x] = int(cuts[before + 1]) - 1
            stack, before = [], own
        while stack and keys[stack[-1]] > keys[c]:
            right[stack.pop()] = c - 1
        left[c] = stack[-1] + 1 if stack else int(cuts[own])
        stack.append(c)
    for x in stack:
        right[x] = int(cuts[before + 1]) - 1
    return [(left[c], c, right[c]) for c in centres.tolist()]


def pieces(rows: DataFrame, filters: dict, filter_bits: int, size: int, min_words: int, similarity: float) -> DataFrame:
    """(row, doc_id, sequence, windows, keys: by signature) of the documents that have windows; ``sequence`` has 32 bits of each shingle."""
    sent = rows.sparkSession.sparkContext.broadcast(filters)
    width = min_words - size + 1
    shift = np.uint64(64 - int(np.log2(filter_bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for level in (0, 1):
            table = np.zeros(filter_bits // 8, dtype=np.uint8)
            for block, bits in sent.value[level].items():
                table[block * (BLOCK_BITS // 8) : (block + 1) * (BLOCK_BITS // 8)] = unpacked(bits)
            tables.append(table)
        for batch in batches:
            for part in slices(batch, "text"):
                yield from one(part, tables)

    def one(part: pa.RecordBatch, tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        shingles, bounds = runs(words(part.column("text")), size)
        n = len(shingles)
        if n < width:
            return
        places = (shingles >> shift).astype(np.int64)
        repeated, frequent = (((t[places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool) for t in tables)
        shared = np.concatenate(([0], np.cumsum(repeated)))
        starts = np.arange(n - width + 1)
        text_of = np.searchsorted(bounds, np.arange(n), side="right") - 1
        inside = text_of[starts] == text_of[starts + width - 1]
        dense = inside & (shared[starts + width] - shared[starts] >= (similarity - 0.1) * width)
        if not dense.any():
            return
        cover = np.zeros(n + 1, dtype=np.int64)  # dense windows, and as much on both sides, within the text
        hits = np.flatnonzero(dense)
        np.add.at(cover, np.maximum(hits - width, bounds[text_of[hits]]), 1)
        np.add.at(cover, np.minimum(hits + 2 * width, bounds[text_of[hits] + 1]), -1)
        eligible = np.cumsum(cover[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (eligible * (text_of + 1)).astype(np.int64), [0]))))
        begins = np.array([e for e in edge if e < n and eligible[e]], dtype=np.int64)
        missing = np.concatenate(([0], np.cumsum(~eligible)))
        valid = np.flatnonzero(inside & (missing[starts + width] == missing[starts]))
        rank = np.where(repeated, np.where(frequent, np.uint64(1), np.uint64(0)), np.uint64(2)) << np.uint64(62)
        windows: dict[int, list[tuple[int, int, int, int, int]]] = {}
        keys_of: dict[int, dict[tuple[int, int], dict]] = {}
        cuts = np.concatenate((begins, [n]))
        stops = np.array([e for e in edge if e > 0 and eligible[e - 1]], dtype=np.int64)
        for f in range(HASHES):
            low = mix(shingles + _SEEDS[f]) >> np.uint64(26)
            keys = rank | (low << np.uint64(24)) | np.arange(n, dtype=np.uint64)
            centres = np.unique((sliding_least(keys, width)[valid] & np.uint64(0xFFFFFF)).astype(np.int64))
            for l, c, r in compact_windows(keys, centres, cuts):
                if repeated[c]:
                    own = int(text_of[c])
                    r = min(r, int(stops[np.searchsorted(begins, c, side="right") - 1]) - 1)
                    base, at = int(bounds[own]), np.arange(max(l, c - width + 1), min(c, r - width + 1) + 1)
                    once = width - int((shared[at + width] - shared[at]).max()) if len(at) else width
                    if once <= (1 - similarity) * width:
                        value = int(shingles[c].view(np.int64))
                        windows.setdefault(own, []).append((f, value, c - base, l - base, r - base))
                        key = keys_of.setdefault(own, {}).setdefault((f, value), {"f": f, "value": value, "once": once, "places": []})
                        key["once"] = min(key["once"], once)
                        key["places"].append(c - base)
        texts = sorted(windows)
        chosen = pa.array(texts, type=pa.int64())
        kind = pa.list_(pa.struct([("f", pa.int32()), ("value", pa.int64()), ("once", pa.int32()), ("places", pa.list_(pa.int32()))]))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("row").take(chosen),
                part.column("doc_id").take(chosen),
                pa.array([(shingles[bounds[t] : bounds[t + 1]] >> np.uint64(32)).astype("<u4").tobytes() for t in texts], type=pa.binary()),
                pa.array([np.array(windows[t], dtype=_WINDOW).tobytes() for t in texts], type=pa.binary()),
                pa.array([list(keys_of[t].values()) for t in texts], type=kind),
            ],
            names=["row", "doc_id", "sequence", "windows", "keys"],
        )

    return rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text").mapInArrow(run, _PIECES)


def signatures(windows: np.ndarray) -> np.ndarray:
    return windows["value"].astype(np.uint64) ^ _SEEDS[windows["f"]]


def diagonals(mine: np.ndarray, other: np.ndarray, need: int) -> list[tuple[int, int, int]]:
    """(diagonal, first, end) of the places where the windows of ``need`` hashes or more overlap, nearby diagonals together; the
    longest come first. ``other`` is sorted by signature."""
    low, high = (np.searchsorted(signatures(other), signatures(mine), side=side) for side in ("left", "right"))
    sizes = high - low
    if not sizes.sum():
        return []
    mine = np.repeat(mine, sizes)
    other = other[spread(low, high)]
    shift = mine["c"] - other["c"]
    order = np.argsort(shift, kind="stable")
    shift, f = shift[order], mine["f"][order]
    first = np.maximum(mine["l"][order], other["l"][order] + shift)
    end = np.minimum(mine["r"][order], other["r"][order] + shift) + 1
    begins, start = [], None
    for value, at in zip(*(x.tolist() for x in np.unique(shift, return_index=True)), strict=True):
        if start is None or value - start > DRIFT:
            begins.append(at)
            start = value
    hashes = np.bitwise_or.reduceat(1 << f, begins)
    firsts, ends = np.minimum.reduceat(first, begins).tolist(), np.maximum.reduceat(end, begins).tolist()
    middles = shift[(np.array(begins) + np.array([*begins[1:], len(shift)])) // 2].tolist()
    found = [(m, a, b) for m, a, b, h in zip(middles, firsts, ends, hashes.tolist(), strict=True) if h.bit_count() >= need]
    return sorted(found, key=lambda d: (d[1] - d[2], d))


def alike(mine: np.ndarray, other: np.ndarray, windows: np.ndarray, of_windows: np.ndarray, width: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """The verified passages of a pair of texts; places found repeated are not verified again on other diagonals."""
    of_windows = of_windows[np.argsort(signatures(of_windows), kind="stable")]
    windows = windows[np.argsort(windows["c"], kind="stable")]
    covered, found = np.zeros(len(mine) + 1, dtype=bool), []
    step = max(8, HITS // max(1, len(of_windows)))
    for at in range(0, len(windows), step):  # parts overlap by half
        part = windows[max(0, at - step // 2) : at + step]
        for shift, first, end in diagonals(part[~covered[part["c"]]], of_windows, NEED):
            if not covered[max(0, first) : end].all():
                new = passages(mine, other, shift, first, end, width, similarity)
                for a, b, *_ in new:
                    covered[a:b] = True
                found += new
    return found


def held(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the values are among the others."""
    if not len(others):
        return np.zeros(len(values), dtype=bool)
    others = np.sort(others)
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def passages(
    mine: np.ndarray, other: np.ndarray, shift: int, first: int, end: int, width: int, similarity: float, share: float | None = None
) -> list[tuple[int, int, int, int, float]]:
    """(first, end, first in the other, end in the other, similarity) of the verified passages between two places.

    The longest stretch whose shingles the other text holds nearby, in a share that the similarity implies, is verified. If it
    fails, stretches within it with more shared shingles are; then what lies before and after it.
    """
    first, end = max(0, first), min(len(mine), end)
    if end - first < width:
        return []
    share = share or 2 * similarity / (1 + similarity)
    near = other[max(0, first - shift - DRIFT) : max(0, end - shift + DRIFT)]
    begin, stop = stretch(held(mine[first:end], near), share)
    if stop - begin < width:
        return []
    begin, stop = begin + first, stop + first
    here = mine[begin:stop]
    at = max(0, begin - shift - DRIFT)
    span = np.flatnonzero(held(other[at : max(at, stop - shift + DRIFT)], here))
    found = []
    if len(span):
        a, b = at + int(span[0]), at + int(span[-1]) + 1
        x, y = np.unique(here), np.unique(other[a:b])
        both = int(held(x, y).sum())
        if both >= similarity * (len(x) + len(y) - both):
            found = [(begin, stop, a, b, both / (len(x) + len(y) - both))]
    if not found and share < 0.999:
        found = passages(mine, other, shift, begin, stop, width, similarity, (1 + share) / 2 if share < 0.98 else 1.0)
    sides = ((first, begin), (stop, end))
    return found + [p for lo, hi in sides for p in passages(mine, other, shift, lo, hi, width, similarity, share)]


def verified(pairs: DataFrame, size: int, min_words: int, similarity: float) -> DataFrame:
    width = min_words - size + 1
    names = ["row", "doc_id", "sequence", "windows", "other", "of_doc_id", "of_sequence", "of_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 8 + [pa.float64()]
        for batch in batches:
            out = []
            for values in zip(*(batch.column(n) for n in names), strict=True):
                row, doc_id, mine, windows, other, of_doc_id, of_mine, of_windows = (
                    np.frombuffer(v.as_buffer(), dtype="<u4" if "sequence" in n else _WINDOW) if pa.types.is_binary(v.type) or pa.types.is_large_binary(v.type) else v.as_py()
                    for n, v in zip(names, values, strict=True)
                )
                for a, b, c, d, share in set(alike(mine, of_mine, windows, of_windows, width, similarity)):
                    out.append((row, doc_id, a, b - a + size - 1, other, of_doc_id, c, d - c + size - 1, share))
            out = sorted(out, key=lambda r: (r[0], r[4], r[2:4], r[6:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], type=k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in _FOUND.split(", ")]
            )

    return pairs.select(*names).mapInArrow(run, _FOUND)


def repeated_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, start_word, n_words, of_doc_id, of_start_word, of_n_words, similarity): passages of a document, and the passage
    of a smaller document that each repeats."""
    rows = id_and_text(docs, doc_id, text)
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    filters = repeated_filters(rows, size, total // 6, filter_bits)
    parts = materialize(pieces(rows, filters, filter_bits, size, min_words, similarity), "pieces")
    same = parts.select("row", "doc_id", F.sha2("sequence", 256).alias("digest"), (F.length("sequence") / 4 + size - 1).cast("long").alias("n"))
    first = same.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("held"))
    first = materialize(first.filter("held > 1").select("digest", "first"), "firsts")
    copies = same.join(first, "digest").filter(F.col("row") != F.col("first.row"))
    zero = F.lit(0).cast("long")
    copies = copies.select("row", "doc_id", zero, "n", "first.row", "first.doc_id", zero, "n", F.lit(1.0))
    found = materialize(copies.toDF(*[c.split()[0] for c in _FOUND.split(", ")]), "passages")
    sides = parts.select("row", "doc_id", "sequence", "windows")
    sides = sides, sides.toDF("other", "of_doc_id", "of_sequence", "of_windows")
    width, me, seen, checked, leads = min_words - size + 1, F.struct("doc_id", "row"), None, None, 1
    keys = parts.join(found.select("row"), "row", "left_anti").select("doc_id", "row", F.explode("keys").alias("k")).select("doc_id", "row", "k.*")
    least = keys.groupBy("f", "value").agg(F.min("once").alias("least"), F.min("row").alias("low"), F.max("row").alias("high"))
    least = materialize(least.filter("high > low").select("f", "value", "least"), "signatures")
    able = keys.join(least, ["f", "value"]).filter((F.col("once") + F.col("least")) * similarity <= (1 - similarity) * (width - F.col("once")))
    left = materialize(able.select("doc_id", "row", "f", "value", "places", F.lit(False).alias("led")), "keys")  # places that are not found repeated
    while True:
        live = left.filter(F.size("places") > 0)
        last = live.groupBy("f", "value").agg(F.max(me).alias("last"))
        lead = left.filter("NOT led").join(last, ["f", "value"]).filter(me < F.col("last"))
        lead = lead.groupBy("f", "value", F.pmod(F.xxhash64("row"), F.lit(leads)).alias("share")).agg(F.min(me).alias("lead"))
        lead = materialize(lead.drop("share"), "leads")
        if lead.isEmpty():
            break
        met = live.join(lead, ["f", "value"]).filter(F.col("lead") < me).select("row", F.col("lead.row").alias("other"), "f").distinct()
        seen = materialize(met if seen is None else seen.unionByName(met).distinct(), "met")
        pairs = seen.groupBy("row", "other").agg(F.count(F.lit(1)).alias("hashes")).filter(F.col("hashes") >= NEED).drop("hashes")
        pairs = materialize(pairs if checked is None else pairs.join(checked, ["row", "other"], "left_anti"), "pairs")
        checked = pairs if checked is None else checked.unionByName(pairs)
        now = materialize(verified(pairs.join(sides[0], "row").join(sides[1], "other"), size, min_words, similarity), "passages")
        found = found.unionByName(now)
        spans = now.groupBy(F.col("row").alias("of")).agg(
            F.collect_set(F.struct(F.col("start_word").alias("from"), (F.col("start_word") + F.col("n_words") - size + 1).alias("to"))).alias("spans")
        )
        used = lead.select(F.col("f").alias("of_f"), F.col("value").alias("of_value"), F.col("lead.row").alias("of_row"))
        inside = F.filter("places", lambda c: ~F.exists("spans", lambda s: (c >= s["from"]) & (c < s["to"])))
        left = left.join(spans, F.col("row") == F.col("of"), "left").withColumn("places", F.when(F.col("of").isNull(), F.col("places")).otherwise(inside))
        left = left.join(used, (F.col("f") == F.col("of_f")) & (F.col("value") == F.col("of_value")) & (F.col("row") == F.col("of_row")), "left")
        left = left.withColumn("led", F.col("led") | F.col("of_row").isNotNull()).select("doc_id", "row", "f", "value", "places", "led")
        left = materialize(left.filter("NOT led OR size(places) > 0"), "keys")
        leads = min(16 * leads, 1 << 40)
    return found.drop("row", "other").distinct()
