"""Fits the library's perceptron by L-BFGS, with its loss summed up over blocks of rows by matrix products in the tasks.

The library goes through the rows of a block one number at a time in its layers; here a step takes a few large products. Start,
loss, memory of ten steps, tests for the end and the fitted model are the library's; the mean is over rows, not over blocks. Rows that
repeat label and features are one row with a count, where that leaves a quarter of them at most.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.equal_rows import equal_rows
from fieldtally.operators.order import cache_input

BLOCKS = "label binary, x binary, n binary"  # no n: each row counts once
STEPS_KEPT = 10
VALUES_KEPT = 20
SMALL_GRADIENT = 1e-8
ARMIJO, CURVATURE = 1e-4, 0.9
BLOCK_ROWS = 512  # the numbers of a block's layers stay in a core's own cache
FEWER = 0.25  # the most rows that are left where equal ones become one
HELD_ROWS = 1 << 13  # rows with counts that a task holds, to merge them with more
TASK_BYTES = 1 << 25  # of blocks to a task of a step, on average; a step has as many tasks as cores at least


def _packed(width: int, classes: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(label, values) → blocks of rows. Functions made by a call travel to the tasks by value."""

    def blocks(label, x, n):
        for start in range(0, len(label), most):
            part = slice(start, start + most)
            columns = [label[part].tobytes(), x[part].tobytes(), b"" if n is None else n[part].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["label", "x", "n"])

    def merged(label, x, n):
        found = equal_rows([label, x], FEWER)
        return found and (label[found[0]], x[found[0]], np.bincount(found[1], n))

    def packed(batches):
        held, rows = [], 0
        for batch in batches:
            label = batch["label"].to_numpy(zero_copy_only=False)
            if batch["label"].null_count or not np.isin(label, np.arange(classes)).all():
                raise ValueError(f"labels must be 0 to {classes - 1}")
            if batch["_x"].null_count or (pc.list_value_length(batch["_x"]).to_numpy(zero_copy_only=False) != width).any():
                raise ValueError(f"a row without {width} features")
            x = batch["_x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            if not np.isfinite(x).all():
                raise ValueError("features must be numbers")
            label = label.astype(np.int32)
            fewer = merged(label, x, np.ones(len(label)))
            if fewer is None:
                yield from blocks(label, x, None)
                continue
            held.append(fewer)
            rows += len(fewer[0])
            if rows > HELD_ROWS:
                every = [np.concatenate(part) for part in zip(*held, strict=True)]
                held, rows = [merged(*every) or every], 0
                if len(held[0][0]) > HELD_ROWS // 2:
                    yield from blocks(*held.pop())
                rows = len(held[0][0]) if held else 0
        if held:
            every = [np.concatenate(part) for part in zip(*held, strict=True)]
            yield from blocks(*(merged(*every) or every))

    return packed


def _sums(layers: list[int], weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows, loss and gradient of a task's rows."""

    def sums(batches):
        views, at = [], 0
        gradient = np.zeros_like(weights)
        for n, m in zip(layers[:-1], layers[1:], strict=True):
            end = at + n * m
            views.append(tuple(v[a:b].reshape(s) for v in (weights, gradient) for a, b, s in ((at, end, (n, m)), (end, end + m, (m,)))))
            at = end + m
        rows, loss = 0, 0.0
        for batch in batches:
            counts = batch["n"].to_pylist() if "n" in batch.schema.names else [b""] * batch.num_rows
            for label, x, n in zip(batch["label"].to_pylist(), batch["x"].to_pylist(), counts, strict=True):
                label, n = np.frombuffer(label, np.int32), np.frombuffer(n) if n else None
                held = [np.frombuffer(x).reshape(len(label), layers[0])]
                for w, b, _, _ in views:
                    z = held[-1] @ w
                    z += b
                    if len(held) < len(views):
                        np.negative(z, out=z)
                        np.minimum(z, 700.0, out=z)  # exp would overflow, for an answer of 0 either way
                        np.exp(z, out=z)
                        z += 1.0
                        np.reciprocal(z, out=z)
                    held.append(z)
                z = held.pop()
                z -= z.max(axis=1, keepdims=True)
                told = np.arange(len(label)), label
                loss -= z[told].sum() if n is None else z[told] @ n
                np.exp(z, out=z)
                total = z.sum(axis=1, keepdims=True)
                loss += np.log(total).sum() if n is None else np.log(total[:, 0]) @ n
                z /= total
                z[told] -= 1.0
                if n is not None:
                    z *= n[:, None]
                for i in range(len(views) - 1, -1, -1):
                    w, _, dw, db = views[i]
                    dw += held[i].T @ z
                    db += z.sum(axis=0)
                    if i:
                        z = z @ w.T
                        z *= held[i]
                        z *= 1.0 - held[i]
                rows += len(label) if n is None else int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], names=["n", "loss", "g"])

    return sums


def _loss_of(blocks: DataFrame, layers: list[int]) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    def loss_at(weights):
        # One row for each partition, of the size of the weights.
        got = blocks.mapInArrow(_sums(layers, weights), "n long, loss double, g binary").toArrow()
        n = sum(got["n"].to_pylist())
        gradient = np.zeros_like(weights)
        for g in got["g"]:
            gradient += np.frombuffer(g.as_buffer())
        return math.fsum(got["loss"].to_pylist()) / n, gradient / n

    return loss_at


def _search(loss_at: Callable, x: np.ndarray, f0: float, slope: float, direction: np.ndarray, step: float) -> tuple | None:
    """A step along a direction of descent that fulfils the strong Wolfe conditions: (step, loss, gradient)."""

    def told(s):
        f, g = loss_at(x + s * direction)
        return s, f, float(g @ direction), g

    low, high = (0.0, f0, slope, None), None
    best = None
    for _ in range(30):
        now = told(step)
        s, f, d, g = now
        if not math.isfinite(f):
            high, step = (s, math.inf, math.inf, None), (low[0] + s) / 2
            continue
        if f <= f0 + ARMIJO * s * slope and (best is None or f < best[1]):
            best = now
        if f > f0 + ARMIJO * s * slope or f >= low[1] and low[3] is not None:
            high = now
        elif abs(d) <= -CURVATURE * slope:
            return s, f, g
        elif d * ((high[0] if high else math.inf) - low[0]) >= 0:
            low, high = now, low
        else:
            low = now
        if high is None:
            step = 2.0 * s
            continue
        (a, fa, da), (b, fb, db) = low[:3], high[:3]
        if abs(b - a) < 1e-12:
            break
        step = (a + b) / 2
        if math.isfinite(fb):  # the least of the cubic through both ends, kept off them
            p = da + db - 3 * (fa - fb) / (a - b)
            root = p * p - da * db
            if root >= 0:
                q = math.copysign(math.sqrt(root), b - a)
                if (under := db - da + 2 * q) != 0:
                    inside = b - (b - a) * (db + q - p) / under
                    least, most = min(a, b) + 0.1 * abs(b - a), max(a, b) - 0.1 * abs(b - a)
                    step = min(max(inside, least), most)
    return (best[0], best[1], best[3]) if best else None


def minimise(loss_at: Callable, x: np.ndarray, most: int, tolerance: float) -> np.ndarray:
    """L-BFGS until the loss has not changed by more than ``tolerance`` of its first value over ``VALUES_KEPT`` steps, the gradient is
    as small as ``tolerance`` of the loss, or no step helps."""
    if most == 0:
        return x
    f, g = loss_at(x)
    first, values, kept = abs(f), deque([f], VALUES_KEPT), deque(maxlen=STEPS_KEPT)
    for _ in range(most):
        direction, saved = -g, []
        for s, y, r in reversed(kept):
            saved.append(r * (s @ direction))
            direction = direction - saved[-1] * y
        if kept:
            s, y, _ = kept[-1]
            direction = direction * ((s @ y) / (y @ y))
        for (s, y, r), a in zip(kept, reversed(saved), strict=True):
            direction = direction + s * (a - r * (y @ direction))
        slope = float(g @ direction)
        if not slope < 0:
            if not kept:
                break
            kept.clear()
            continue
        found = _search(loss_at, x, f, slope, direction, 1.0 if kept else 1.0 / max(float(np.linalg.norm(direction)), 1e-300))
        if found is None:
            if not kept:
                break
            kept.clear()
            continue
        step, f, now = found
        s, y = step * direction, now - g
        if s @ y > 0:
            kept.append((s, y, 1.0 / (s @ y)))
        x, g = x + s, now
        if len(values) == VALUES_KEPT and abs(f - max(values)) <= tolerance * first:
            break
        values.append(f)
        if np.linalg.norm(g) <= max(tolerance * abs(f), SMALL_GRADIENT):
            break
    return x


def fit_perceptron(estimator: MultilayerPerceptronClassifier, train: DataFrame) -> MultilayerPerceptronClassificationModel:
    """The estimator's fit. Its start and its model come from the library, by a fit of no step on one row."""
    if estimator.getSolver() != "l-bfgs":
        return estimator.fit(train)
    layers, label, features = estimator.getLayers(), estimator.getLabelCol(), estimator.getFeaturesCol()
    rows = train.select(F.col(label).cast("double").alias("label"), vector_to_array(features).alias("_x"))
    if rows.isEmpty():
        raise ValueError("no rows to fit on")
    row = train.select(label, features).limit(1)
    none = estimator.copy({estimator.maxIter: 0})
    start = none.fit(row).weights.toArray()
    blocks = cache_input(rows.mapInArrow(_packed(layers[0], layers[-1], BLOCK_ROWS), BLOCKS))
    try:
        # A step's jobs read little where rows were merged: some large tasks instead of one for each partition of the rows.
        held = blocks.agg(F.sum(F.length("x"))).first()[0]
        tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(held / TASK_BYTES))
        weights = minimise(_loss_of(blocks.coalesce(tasks), layers), start, estimator.getMaxIter(), estimator.getTol())
    finally:
        blocks.unpersist()
    return none.copy({none.initialWeights: Vectors.dense(weights)}).fit(row)
