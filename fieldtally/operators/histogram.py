"""Feature values as small bin numbers, and weighted histograms of them: what a decision stump is found from.

A bin's number is the count of its feature's cuts below the value. A row keeps only the codes (feature * bins + bin) of the
features that are not in the bin of 0, so a sparse vector stays short; the bin of 0 gets what the others leave of the total.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldtally.operators.equal_rows import equal_rows
from fieldtally.session import materialize

BINS = 32
SAMPLE_ROWS = 100_000
# A block has a number of rows, which add up to that of all rows, the label of each, the row and the code of each code, the weight of each row. Rows by themselves
# take longer on their way to Python than all sums over them. Rows of equal label and codes always weigh alike, so they are one row of a
# block with their weights together, as far as that halves a block.
BLOCK_BYTES = 1 << 22  # of codes in a block, at most
BLOCK_FIELDS = ["n", "kinds", "rows", "codes", "w"]
BLOCKS = "n bigint, kinds binary, rows binary, codes binary, w binary"


@dataclass(frozen=True)
class Bins:
    """Cuts of each feature in rising order; a value up to a cut is on its left."""

    cuts: list[list[float]]
    bins: int

    @property
    def width(self) -> int:
        return len(self.cuts)

    @property
    def default(self) -> np.ndarray:
        """Each feature's bin of 0."""
        return np.array([sum(c < 0 for c in own) for own in self.cuts], dtype=int)

    def held(self, feature: int, cut: int, left: float, right: float) -> tuple[int, int, float, float]:
        """A range of codes, and the answers of rows that hold one of it and of all others, which are on the side of 0."""
        first = feature * self.bins
        if sum(c < 0 for c in self.cuts[feature]) <= cut:
            return first + cut + 1, first + self.bins - 1, right, left
        return first, first + cut, left, right


def find_cuts(rows: DataFrame, array: str, bins: int = BINS, sample_rows: int = SAMPLE_ROWS, n: int | None = None) -> DataFrame:
    """(pos, cuts): half-way between neighbouring values if a position has at most ``bins`` values, else where the running count
    of rows passes a multiple of one ``bins``-th of them.

    Counted over all rows, or over a sample of about ``sample_rows`` of them, drawn by a hash of the row, if there are more. Zeros are
    not exploded: their count is what the others leave. ``n`` is the number of rows, if it is known.
    """
    n = rows.count() if n is None else n
    if n > sample_rows:
        hashed = F.xxhash64(*rows.columns).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
        rows = rows.filter(hashed < F.lit(sample_rows / n))
    # A leading 1 counts the rows.
    cells = rows.select(F.posexplode(F.concat(F.array(F.lit(1.0)), F.col(array))).alias("pos", "v"))
    counts = cells.filter((F.col("v") != 0) & ~F.isnan("v")).groupBy((F.col("pos") - 1).alias("pos"), "v").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "values")
    total = F.coalesce(counts.filter("pos = -1").agg(F.sum("n").alias("n")).scalar(), F.lit(0))
    zeros = counts.filter("pos >= 0").groupBy("pos").agg((total - F.sum("n")).alias("n")).filter("n > 0")
    every = counts.filter("pos >= 0").unionByName(zeros.select("pos", F.lit(0.0).alias("v"), "n"))
    up = Window.partitionBy("pos").orderBy("v")
    placed = every.select(
        "pos",
        "v",
        F.lead("v").over(up).alias("next"),
        F.count(F.lit(1)).over(Window.partitionBy("pos")).alias("values"),
        F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        "n",
    )
    passes = F.floor(F.col("upto") * bins / total) > F.floor((F.col("upto") - F.col("n")) * bins / total)
    cut = placed.filter(F.col("next").isNotNull() & ((F.col("values") <= bins) | passes))
    return cut.groupBy("pos").agg(F.array_sort(F.collect_list(F.col("v") / 2 + F.col("next") / 2)).alias("cuts"))


def binned(rows: DataFrame, width: int, bins: int = BINS, sample_rows: int = SAMPLE_ROWS, features: str = "features") -> tuple[DataFrame, Bins]:
    """Blocks of rows with weights of 1, written, and the bins. Their cuts, at most width * bins numbers, pass the driver."""
    arrays = rows.select("label", vector_to_array(features).alias("_x"))
    cuts = materialize(find_cuts(arrays, "_x", bins, sample_rows), "cuts")
    found = {r["pos"]: list(r["cuts"]) for r in cuts.collect()}
    own = Bins([found.get(p, []) for p in range(width)], bins)
    return materialize(arrays.mapInArrow(_packed(own), BLOCKS), "binned"), own


def _packed(bins: Bins) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(label, values) → blocks of rows. Functions made by a call travel to the tasks by value, so these need not have the package."""
    default, step, fields = bins.default, bins.bins, BLOCK_FIELDS
    cuts = [np.asarray(own, dtype=float) for own in bins.cuts]
    most = max(1, min(1 << 16, BLOCK_BYTES // (8 * max(len(cuts), 1))))
    cell = np.uint8 if step <= 256 else np.uint16 if step <= 1 << 16 else np.int32

    def packed(batches):
        n, held, rows = 0, [], 0

        def shortened():
            """What is held as fewer rows, if that halves them."""
            kind, code, w = [np.concatenate(part) for part in zip(*held, strict=True)]
            found = equal_rows([kind, code])
            return found and [(kind[found[0]], code[found[0]], np.bincount(found[1], w))]

        def block():
            kind, code, w = [np.concatenate(part) for part in zip(*held, strict=True)]
            row, feature = np.nonzero(code != default)
            codes = (code[row, feature] + feature * step).astype(np.int32)
            parts = [kind.tobytes(), row.astype(np.int32).tobytes(), codes.tobytes(), w.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *[pa.array([part], pa.binary()) for part in parts]], names=fields)

        for whole, kind, code in coded(batches):
            n += whole
            for start in range(0, max(len(kind), 1), most):
                part = slice(start, start + most)
                if rows + len(kind[part]) > most and (fewer := shortened()):
                    held, rows = fewer, len(fewer[0][0])
                if rows + len(kind[part]) > most:
                    yield block()
                    n, held, rows = 0, [], 0
                held.append((kind[part], code[part], np.ones(len(kind[part]))))
                rows += len(kind[part])
        if held:
            held = shortened() or held
            yield block()

    def coded(batches):
        """(rows, label and bins of each row with features) of each batch."""
        for batch in batches:
            n = batch.num_rows
            batch = batch.filter(pc.is_valid(batch["_x"]))
            values, lengths = batch["_x"].flatten().to_numpy(zero_copy_only=False), pc.list_value_length(batch["_x"]).to_numpy(zero_copy_only=False)
            if (lengths != len(cuts)).any():  # rows of another width: without what is beyond it, with 0 for what lacks
                row = np.repeat(np.arange(batch.num_rows), lengths)
                position = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                full, inside = np.zeros((batch.num_rows, len(cuts))), position < len(cuts)
                full[row[inside], position[inside]] = values[inside]
                values = full
            values = values.reshape(batch.num_rows, len(cuts))
            code = np.empty(values.shape, dtype=cell)
            for j, own in enumerate(cuts):
                code[:, j] = np.searchsorted(own, values[:, j], side="left")  # of 0, and so of the features that are left out: the default
            given = pc.is_valid(batch["label"]).to_numpy(zero_copy_only=False)
            label = batch["label"].to_numpy(zero_copy_only=False)
            # 0 and 1, 2 for any other number, which every answer misses, 3 for none, which no answer misses.
            kind = np.where(~given, 3, np.where(label == 1.0, 1, np.where(label == 0.0, 0, 2))).astype(np.int8)
            yield n, kind, code

    return packed


@dataclass(frozen=True)
class Carried:
    """What multiplies a row's written weight ``w``: a scale, and exp of the weights of those stumps that miss its label.

    A stump is a range of codes, the answers of rows with and without a code in it, and its weight.
    """

    stumps: list[tuple[int, int, float, float, float]]
    scale: float

    def opened(self) -> Callable[[pa.RecordBatch], Iterator[tuple]]:
        stumps, power_of_all = self.stumps, math.log(self.scale)

        def opened(batch):
            """(kinds, rows of the codes, codes, weights as they are now) of each block."""
            for kind, row, code, w in zip(*[batch[c].to_pylist() for c in ("kinds", "rows", "codes", "w")], strict=True):
                kind, row, code = np.frombuffer(kind, np.int8), np.frombuffer(row, np.int32), np.frombuffer(code, np.int32)
                power = np.full(len(kind), power_of_all)
                for first, last, within, without, weight in stumps:
                    answer = np.full(len(kind), without)
                    answer[row[(code >= first) & (code <= last)]] = within
                    power += np.where((answer != kind) & (kind != 3), weight, 0.0)
                yield kind, row, code, np.frombuffer(w) * np.exp(power)

        return opened


def carried_on(blocks: DataFrame, carried: Carried) -> DataFrame:
    """The blocks with the weights as they are now."""
    opened, fields = carried.opened(), BLOCK_FIELDS

    def write(batches):
        for batch in batches:
            now = pa.array([w.tobytes() for _, _, _, w in opened(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in fields[:-1]], now], names=fields)

    return blocks.mapInArrow(write, BLOCKS)


def _summed(carried: Carried, cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Weight by code and label of a task's rows; the code -1 is of every row."""
    opened = carried.opened()

    def summed(batches):
        sums = np.zeros((2, cells + 1))
        for batch in batches:
            for kind, row, code, w in opened(batch):
                one = kind == 1
                both = np.bincount(code + cells * one[row], weights=w[row], minlength=2 * cells)
                sums[:, :-1] += both.reshape(2, cells)
                sums[:, -1] += w[~one].sum(), w[one].sum()
        filled = np.flatnonzero(sums.any(axis=0))
        code = np.where(filled == cells, -1, filled).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(sums[0, filled]), pa.array(sums[1, filled])], names=["code", "w0", "w1"])

    return summed


def label_weights(blocks: DataFrame, carried: Carried, bins: Bins) -> np.ndarray:
    """Weight by (label, feature, bin), and in one more feature the total: added up in each task, then over the tasks."""
    cells = blocks.mapInArrow(_summed(carried, bins.width * bins.bins), "code int, w0 double, w1 double")
    sums = cells.groupBy("code").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1"))
    table = np.zeros((2, bins.width + 1, bins.bins))
    for code, w0, w1 in sums.collect():  # at most width * bins rows
        feature, at = (code // bins.bins, code % bins.bins) if code >= 0 else (bins.width, 0)
        table[:, feature, at] = w0, w1
    features = np.arange(bins.width)
    table[:, features, bins.default] += table[:, -1, :1] - table[:, :-1].sum(axis=2)
    return table


@dataclass(frozen=True)
class Cut:
    """The best split of a histogram: feature and number of its cut (-1: no split), answers, and weights of all and of the missed."""

    feature: int
    cut: int
    left: float
    right: float
    total: float
    missed: float


def best_cut(table: np.ndarray, bins: Bins, tolerance: float = 1e-12) -> Cut:
    """The cut that leaves the least weighted Gini impurity, the first of equal ones; each side answers with its heavier label."""
    total = table[:, -1, 0]
    left = np.cumsum(table[:, :-1], axis=2)
    right = total[:, None, None] - left
    lw, rw = left.sum(axis=0), right.sum(axis=0)
    able = np.array([[j < len(own) for j in range(bins.bins)] for own in bins.cuts]).reshape(lw.shape) & (lw > tolerance) & (rw > tolerance)
    if not able.any():
        answer = float(total[1] > total[0])
        return Cut(0, -1, answer, answer, float(total.sum()), float(total.min()))
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = np.where(able, 2 * left[0] * left[1] / lw + 2 * right[0] * right[1] / rw, np.inf)
    feature, cut = divmod(int(np.flatnonzero(impurity <= impurity.min() + tolerance)[0]), bins.bins)
    sides = left[:, feature, cut], right[:, feature, cut]
    return Cut(feature, cut, *(float(s[1] > s[0]) for s in sides), float(total.sum()), float(sum(s.min() for s in sides)))
