"""Words and word hashes of whole Arrow text columns, computed on the UTF-8 bytes without a Python object per word.

A word is a longest run of bytes other than ``[\\x20\\x09-\\x0D]``; A-Z count as a-z. Null texts count as empty.
Hashes are 64 bits wide and depend on the word alone, not on the process, the machine or its place in a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_NEXT = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_VALUE = mix(_LOWER.astype(np.uint64) + np.uint64(1))


class _Powers:
    """Powers of a multiplier modulo 2**64, extended on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.values = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 2 * len(self.values)), self.base, dtype=np.uint64)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_BASE_INVERSE)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; the offsets count from the first byte returned."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` bytes of text each; a longer text is a part of its own."""
    _, offsets = utf8(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def spread(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of all ranges, one range after the other."""
    sizes = ends - begins
    return np.repeat(begins - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())


@dataclass
class Words:
    """Words of some texts in order: hash, first byte and end within all bytes, and each text's range of words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # text i has the words bounds[i]:bounds[i + 1]
    offsets: np.ndarray  # and the bytes offsets[i]:offsets[i + 1]
    data: np.ndarray
    sums: np.ndarray  # of the weighted bytes before each place

    def __len__(self) -> int:
        return len(self.bounds) - 1


def words(column: pa.Array) -> Words:
    data, offsets = utf8(column)
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64), offsets, data, np.zeros(1, dtype=np.uint64))
    solid = ~_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)  # a text begins or ends here
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, ~solid[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, ~solid[1:]
    starts = np.flatnonzero(solid & (before | cut[:-1]))
    ends = np.flatnonzero(solid & (after | cut[1:])) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * _UP.upto(n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _DOWN.upto(n)[starts])
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), offsets, data, sums)


def prefixes(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of the words that are longer, and which words these are."""
    which = np.flatnonzero(found.ends - found.starts > size)
    starts = found.starts[which]
    return mix(mix((found.sums[starts + size] - found.sums[starts]) * _DOWN.upto(len(found.data))[starts]) + np.uint64(size)), which


def runs(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words, and each text's range of runs.

    A text with fewer words, but one at least, has the whole sequence as its one run; a text without words has none.
    """
    counts = np.diff(found.bounds)
    per_text = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(per_text)))
    if not bounds[-1]:
        return np.zeros(0, dtype=np.uint64), bounds
    first = np.repeat(found.bounds[:-1] - bounds[:-1], per_text) + np.arange(bounds[-1])
    padded = np.concatenate((found.hashes, np.zeros(k, dtype=np.uint64)))
    total = np.zeros(len(first), dtype=np.uint64)
    lengths = np.repeat(np.minimum(counts, k), per_text)
    for step in range(k):
        total = total * _NEXT + np.where(lengths > step, padded[first + step], np.uint64(step + 1))
    return mix(total + lengths.astype(np.uint64)), bounds


def run_sets(found: Words, k: int) -> list[np.ndarray]:
    """Each text's distinct runs, sorted."""
    hashes, bounds = runs(found, k)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
