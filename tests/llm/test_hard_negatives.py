"""Hard negatives: table scores against inner products, and whole results against a comparison of every pair."""

from __future__ import annotations

from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label int, embedding array<float>, row string, place int, anchor bigint, planes string"


def plain(rows, every=3, positives=5, negatives=5, percent=80):
    """Every pair, in Python integers."""
    sound = {}
    for i, label, e in rows:
        if i is None or label is None or e is None or any(x is None or not isfinite(x) for x in e):
            continue
        v = [floor(256 * float(np.float32(x))) for x in e]
        sound.setdefault(i, []).append((label, v))
    assert all(len(x) == 1 or all(y == x[0] for y in x) for x in sound.values())
    vectors = {i: x[0] for i, x in sound.items()}
    out = []
    for a, (label, v) in vectors.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, (other, w) in vectors.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            band = [(ns, i) for ns, i, other in scored if other != label and percent * -ps <= 100 * -ns <= 100 * -ps]
            out += [(a, p, r + 1, i, -ps, -ns) for r, (ns, i) in enumerate(band[:negatives])]
    return sorted(out)


def vectors(seed, n, size=11, labels=3, spread=0.4):
    chance = np.random.default_rng(seed)
    centres = chance.normal(0, spread, (4, size))
    return [(int(i), int(chance.integers(labels)), [float(x) for x in centres[i % 4] + chance.normal(0, 0.15, size)]) for i in range(n)]


def mined(spark, rows, **more):
    table = spark.createDataFrame([(*r, *[None] * 4) for r in rows], SCHEMA)
    return sorted(map(tuple, hn.hard_negatives(table, F.col("vec_id") % 3 == 0, **more).collect()))


@pytest.mark.parametrize(("size", "low", "high"), [(1, -1, 1), (8, -300, 300), (64, -256, 255), (13, 0, 7), (20, -(1 << 20), 1 << 20), (3, -1, 0), (0, 0, 1)])
def test_table_scores_are_inner_products(size, low, high):
    chance = np.random.default_rng(size)
    a, c = chance.integers(low, high, (7, size)), chance.integers(low, high, (50, size))
    layout = hn.Layout.of(size, min(a.min(initial=0), c.min(initial=0)), max(a.max(initial=0), c.max(initial=0)))
    packed = layout.pack(c)
    assert (layout.unpack(packed)[:, :size] == c).all()
    filled = np.zeros((7, 8 * layout.groups), dtype=np.int64)
    filled[:, :size] = a
    assert (hn.Tables(layout, filled).scores(packed) == c @ a.T).all()


def test_too_large_components_are_refused():
    with pytest.raises(ValueError):
        hn.Layout.of(64, 0, 1 << 31)


@pytest.mark.parametrize("block", [hn.ANCHORS, 17])
def test_equals_every_pair(spark, block, monkeypatch):
    monkeypatch.setattr(hn, "TILE", 5)
    monkeypatch.setattr(hn, "SLICE", 16)
    rows = vectors(1, 150)
    found = mined(spark, rows, block=block)
    assert found == plain(rows) and len(found) > 300


def test_hot_label_and_copies(spark, monkeypatch):
    """Half of all rows are one vector, of two labels: ties go by identifier."""
    monkeypatch.setattr(hn, "SLICE", 32)
    rows = [(i, 1 if i % 4 else 2, [0.5, 0.25, -0.125]) if i % 2 else r for i, r in enumerate(vectors(2, 160, 3))]
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    odd = [(200, None, [1.0] * 11), (201, 1, None), (203, 1, [None] * 11), (204, 1, [nan] * 11), (205, 1, [inf] * 11), (None, 1, [0.1] * 11), (207, 1, [0.3, 0.2]), (208, 2, []), (-3, 1, [0.2] * 11)]
    rows = [*vectors(3, 60), *odd, *vectors(3, 60)[:9]]
    assert mined(spark, rows) == plain(rows)


def test_a_repeated_identifier_counts_once(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 0, [0.9, 0.1]), (2, 1, [0.95, 0.0]), (4, 5, [0.94, 0.0])]
    assert mined(spark, rows) == plain([r for r in rows if r != (1, 1, [1.0, 0.0])])


def test_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == [] and mined(spark, [(3, 1, []), (4, 1, [])]) == []
    table = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(table, F.lit(True)).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
