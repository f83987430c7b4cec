"""Equal rows of a block as one row with a count: what a fit over small bin numbers, or over a few values, needs to read of them."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # functions travel to the tasks by value, which need not have the package

FACTOR = 0x9E3779B97F4A7C15


def equal_rows(parts: list[np.ndarray], most: float = 0.5) -> tuple[np.ndarray, np.ndarray] | None:
    """(first row of each group of equal rows, group of each row), or None if there are more groups than that share of the rows.

    ``parts`` are columns or tables of plain numbers; rows are equal if all their bytes are. Groups are found by a hash and then compared,
    so unlike rows never meet: if two of them have one hash, the answer is None, too.
    """
    n = len(parts[0])
    if not n:
        return None
    cells = [np.ascontiguousarray(p).reshape(n, -1) for p in parts]
    cells = np.concatenate([c.view(np.uint8).reshape(n, -1) for c in cells], axis=1)
    words = np.zeros((n, -(-cells.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, : cells.shape[1]] = cells
    words = words.view(np.uint64)
    hashed = np.zeros(n, dtype=np.uint64)
    for j in range(words.shape[1]):
        hashed = (hashed ^ words[:, j]) * np.uint64(FACTOR)
        hashed ^= hashed >> np.uint64(29)
    _, first, group = np.unique(hashed, return_index=True, return_inverse=True)
    if len(first) > most * n or (words != words[first[group]]).any():
        return None
    return first, group
