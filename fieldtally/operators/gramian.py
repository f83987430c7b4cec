"""Correlation of all pairs of positions of wide rows: one pass, partial sums in column tiles, no matrix on the driver.

Each task adds up the products of its rows' numbers, shifted so that no digits are lost, and hands on the tiles of the upper
triangle. Tiles of the same place are added up where they meet. A correlation needs the sums of its two columns besides its own cell;
they are ``width`` numbers each, the only ones that pass the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.session import materialize

TILE = 128
CELLS = 1 << 22  # of a matrix that a task adds up: beyond that, stripes of columns take a pass each
AT_ONCE = 1 << 21  # numbers in a product
SHIFT_ROWS = 256
SUMS = "a int, b int, sums binary"


def dense_rows(column: pa.Array, width: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def sparse_rows(column: pa.Array, width: int) -> np.ndarray:
    """Lists of struct<pos, v> as rows; what is not listed is 0."""
    out = np.zeros((len(column), width))
    cells = column.flatten()
    out[np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())), cells.field(0).to_numpy()] = cells.field(1).to_numpy()
    return out


def find_shift(rows: DataFrame, column: str, width: int) -> np.ndarray:
    """A value of each position from the middle of a few rows: a constant one becomes exactly 0, a large offset goes."""
    few = rows.select(column).limit(SHIFT_ROWS).toArrow()
    return np.nan_to_num(np.sort(dense_rows(few.column(0), width), axis=0)[few.num_rows // 2], posinf=0.0, neginf=0.0) if few.num_rows else np.zeros(width)


def _tiles(first: int, last: int) -> range:
    return range(first // TILE, (last + TILE - 1) // TILE)


def gramian(rows: DataFrame, column: str, width: int, shift: np.ndarray | None = None, sparse: bool = False) -> DataFrame:
    """(a, b, sums), written: products of the columns of tile a with those of tile b, a ≤ b, summed over all rows.

    Column 0 is 1 in every row, column k + 1 is position k less its shift.
    """
    full, moved = width + 1, np.zeros(width) if shift is None else shift
    stripe = max(TILE, CELLS // full // TILE * TILE)
    read = sparse_rows if sparse else dense_rows

    def summed(first: int, last: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((last - first, full - first))
            size = max(1, AT_ONCE // full)
            for batch in batches:
                for at in range(0, batch.num_rows, size):
                    part = batch.column(0).slice(at, size)
                    x = np.ones((len(part), full))
                    x[:, 1:] = read(part, width) - moved
                    total += x[:, first:last].T @ x[:, first:]
            for a in _tiles(first, last):
                for b in _tiles(a * TILE, full):
                    cells = total[a * TILE - first : (a + 1) * TILE - first, b * TILE - first : (b + 1) * TILE - first]
                    yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([cells.tobytes()])], names=["a", "b", "sums"])

        return run

    parts = [rows.select(column).mapInArrow(summed(first, min(first + stripe, full)), SUMS) for first in range(0, full, stripe)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for a, b, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cells = np.frombuffer(sums)
                tiles[a, b] = tiles[a, b] + cells if (a, b) in tiles else cells
        for (a, b), cells in tiles.items():
            yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([cells.tobytes()])], names=["a", "b", "sums"])

    return materialize(every.repartition("a", "b").mapInArrow(merged, SUMS), "gramian")


def correlations(tiles: DataFrame, width: int, rows: int | None = None) -> DataFrame:
    """(i, j, r) of all pairs from the tiles of ``gramian``; null where a side is constant.

    ``rows`` counts the rows if all-zero ones were left out of the sums.
    """
    full = width + 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cells = _shaped(sums, a, b, full)
                at = np.arange(b * TILE, b * TILE + cells.shape[1], dtype=np.int32)
                found = [("sum", cells[0])] * (a == 0) + [("square", np.diagonal(cells))] * (a == b)
                for kind, values in found:
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(at)), pa.array(at), pa.array(values)], names=["kind", "at", "value"])

    few = tiles.filter("a = 0 OR a = b").mapInArrow(moments, "kind string, at int, value double").toArrow()
    values = {k: np.zeros(full) for k in ("sum", "square")}
    kinds, at, found = np.array(few.column("kind").to_pylist(), dtype=object), few.column("at").to_numpy(), few.column("value").to_numpy()
    for kind, into in values.items():
        into[at[kinds == kind]] = found[kinds == kind]
    n = float(rows if rows is not None else values["sum"][0])
    mean = values["sum"] / max(n, 1.0)
    variance = values["square"] / max(n, 1.0) - mean**2

    def divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cells = _shaped(sums, a, b, full)
                i, j = (np.arange(t * TILE, t * TILE + k) for t, k in zip((a, b), cells.shape, strict=True))
                spread = variance[i][:, None] * variance[j][None, :]
                able = (variance[i] > 0)[:, None] & (variance[j] > 0)[None, :] & np.isfinite(spread) & (spread > 0)
                with np.errstate(invalid="ignore", divide="ignore"):
                    r = (cells / n - mean[i][:, None] * mean[j][None, :]) / np.sqrt(np.where(able, spread, 1.0))
                r = np.where(able & np.isfinite(r), r, np.nan)
                yield from _long(i, j, r)
                if a != b:
                    yield from _long(j, i, r.T)

    return tiles.mapInArrow(divided, "i int, j int, r double").filter("i >= 0 AND j >= 0")


def _shaped(sums: bytes, a: int, b: int, full: int) -> np.ndarray:
    return np.frombuffer(sums).reshape(min(TILE, full - a * TILE), min(TILE, full - b * TILE))


def _long(i: np.ndarray, j: np.ndarray, r: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One tile as rows, positions counted without the column of ones; that column's own rows get -1."""
    flat = r.ravel()
    arrays = [pa.array(np.repeat(i - 1, len(j)).astype(np.int32)), pa.array(np.tile(j - 1, len(i)).astype(np.int32)), pa.array(flat, mask=np.isnan(flat))]
    yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "r"])
