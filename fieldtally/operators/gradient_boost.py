"""Gradient boosting of shallow trees over binned rows.

Each level of a tree is one aggregate: rows and residuals by node, feature and bin. Rows with equal bins and label are one row with a
count from the start. A row's margin is the one written last plus the trees since then.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.operators.forest import CELL, _block_rows, _chosen, _descend, _encoder, _subset
from fieldtally.operators.histogram import find_cuts
from fieldtally.operators.order import cache_input
from fieldtally.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # functions travel to the tasks by value, which need not have the package

PIN_EVERY = 5
GAIN = 1e-12
BLOCKS = "kinds binary, n binary, margin binary, codes binary"
FIELDS = ["kinds", "n", "margin", "codes"]
CLASS = "fieldtally.Boosted"


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; ``feature`` is -1 at leaves, else the children are ``left``, for bins up to ``cut``, and the next one."""

    weight: float
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def margin(self, codes: np.ndarray) -> np.ndarray:
        return self.weight * self.value[_descend(codes, np.zeros(len(codes), dtype=np.int64), self.feature, self.cut, self.left)]


def _encoded(cuts: list[list[float]], size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    encoder = _encoder(cuts, size)

    def encoded(batches):
        for batch in batches:
            label = batch["label"].to_numpy(zero_copy_only=False)
            if batch["label"].null_count or not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            codes = encoder(batch["_x"])
            rows = [row.tobytes() for row in codes]
            yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int8)), pa.array(rows, pa.binary())], names=["kind", "codes"])

    return encoded


def _packed(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(kind, codes, n) → blocks of rows with a margin of 0."""

    def packed(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, most):
                batch = whole.slice(start, most)
                kinds, n = [batch[c].to_numpy(zero_copy_only=False) for c in ("kind", "n")]
                parts = [kinds.astype(np.int8).tobytes(), n.astype(float).tobytes(), np.zeros(len(n)).tobytes(), b"".join(batch["codes"].to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=FIELDS)

    return packed


def _opened(batch: pa.RecordBatch, width: int, size: int, trees: list[Tree]) -> Iterator[tuple]:
    """(sign of the label, rows, margin as it is now, codes) of each block."""
    for kinds, n, margin, codes in zip(*[batch[c].to_pylist() for c in FIELDS], strict=True):
        codes, margin = np.frombuffer(codes, CELL[size]).reshape(-1, width), np.frombuffer(margin).copy()
        for tree in trees:
            margin += tree.margin(codes)
        yield 2.0 * np.frombuffer(kinds, np.int8) - 1.0, np.frombuffer(n), margin, codes


def _pinned(width: int, size: int, trees: list[Tree]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pinned(batches):
        for batch in batches:
            now = pa.array([margin.tobytes() for _, _, margin, _ in _opened(batch, width, size, trees)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["kinds"], batch["n"], now, batch["codes"]], names=FIELDS)

    return pinned


def _level_sums(width: int, size: int, bins: int, trees: list[Tree], first: bool, tree: Tree, open_nodes: np.ndarray, chosen: np.ndarray) -> Callable:
    """Rows and residuals of each open node by feature and bin, added up in a task."""
    features = chosen.shape[1]
    cells = len(open_nodes) * features * bins
    slot = np.full(len(tree.feature), -1)
    slot[open_nodes] = np.arange(len(open_nodes))

    def sums(batches):
        table = np.zeros((2, cells))
        for batch in batches:
            for sign, n, margin, codes in _opened(batch, width, size, trees):
                at = slot[_descend(codes, np.zeros(len(n), dtype=np.int64), tree.feature, tree.cut, tree.left)]
                rows = np.flatnonzero(at >= 0)
                at, codes, sign, n, margin = at[rows], codes[rows], sign[rows], n[rows], margin[rows]
                # The first tree is fitted to the signs, the others to minus the slope of the log loss.
                residual = n * sign if first else 4.0 * n * sign / (1.0 + np.exp(np.minimum(2.0 * sign * margin, 700.0)))
                for j in range(features):
                    cell = (at * features + j) * bins + codes[np.arange(len(rows)), chosen[at, j]]
                    table[0] += np.bincount(cell, n, cells)
                    table[1] += np.bincount(cell, residual, cells)
        filled = np.flatnonzero(table[0])
        yield pa.RecordBatch.from_arrays([pa.array(filled), *[pa.array(t[filled]) for t in table]], names=["cell", "n", "s"])

    return sums


def _best(sums: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From (nodes, features, bins, (rows, residuals)): the fall in variance, feature and cut of each node's best split."""
    upto = np.cumsum(sums, axis=2)
    total = upto[:, :1, -1:, :]
    rest = total - upto

    def square(side):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(side[..., 0] > 0, side[..., 1] ** 2 / side[..., 0], 0.0)

    able = (upto[..., 0] >= least) & (rest[..., 0] >= least)
    gain = np.where(able, (square(upto) + square(rest) - square(total)) / np.maximum(total[..., 0], 1.0), -1.0).reshape(len(sums), -1)
    best = np.argmax(gain, axis=1)
    return gain[np.arange(len(sums)), best], best // sums.shape[2], best % sums.shape[2]


def _grow(blocks: DataFrame, shape: tuple[int, int, int], trees: list[Tree], number: int, get: Callable, features: int) -> Tree:
    width, size, bins = shape
    feature, cut, left, value, nodes = [-1], [0], [-1], [0.0], [0]
    weight = 1.0 if number == 0 else get("stepSize")
    # The root has its value from its own histogram, so one is taken even for trees without a split.
    for depth in range(max(get("maxDepth"), 1)):
        tree = Tree(weight, np.array(feature), np.array(cut), np.array(left), np.array(value))
        chosen = _chosen(get("seed") + number, depth, np.array(nodes), width, features)
        sums_of = _level_sums(width, size, bins, trees, number == 0, tree, np.array(nodes), chosen)
        got = blocks.mapInArrow(sums_of, "cell long, n double, s double").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
        sums = np.zeros((len(nodes) * features * bins, 2))
        sums[got["cell"].to_numpy()] = np.column_stack([got[c].to_numpy() for c in ("n", "s")])
        sums = sums.reshape(len(nodes), features, bins, 2)
        if depth == 0:
            n, s = sums[0, 0].sum(axis=0)
            value[0] = s / max(n, 1.0)
        if get("maxDepth") == 0:
            break
        gain, which, at = _best(sums, get("minInstancesPerNode"))
        following = []
        for i, node in enumerate(nodes):
            if gain[i] < max(get("minInfoGain"), GAIN):
                continue
            feature[node], cut[node], left[node] = int(chosen[i, which[i]]), int(at[i]), len(feature)
            own = sums[i, which[i]]
            for n, s in (own[: at[i] + 1].sum(axis=0), own[at[i] + 1 :].sum(axis=0)):
                following.append(len(feature))
                feature.append(-1), cut.append(0), left.append(-1), value.append(s / n)
        nodes = following
        if not nodes:
            break
    return Tree(weight, np.array(feature), np.array(cut), np.array(left), np.array(value))


def fit_boosted(estimator: GBTClassifier, train: DataFrame) -> Boosted | PipelineModel:
    """The estimator's fit: variance, log loss, first tree of weight 1. What is not covered here goes to the library."""
    get = estimator.getOrDefault
    if get("subsamplingRate") < 1.0 or estimator.isDefined("validationIndicatorCol") or estimator.isDefined("weightCol"):
        return PipelineModel([estimator.fit(train)])
    rows = train.select(F.col(get("labelCol")).cast("double").alias("label"), vector_to_array(get("featuresCol")).alias("_x"))
    first = rows.select(F.size("_x").alias("width")).first()
    if first is None:
        raise ValueError("no rows to fit on")
    width, bins = first["width"], get("maxBins")
    size = 1 if bins <= 256 else 2
    drawn = rows.select("_x", F.monotonically_increasing_id().alias("_row"))  # a sample is drawn by the hash of both, as rows may be equal
    found = {r["pos"]: list(r["cuts"]) for r in find_cuts(drawn, "_x", bins).collect()}  # at most width * bins numbers
    cuts = [found.get(j, []) for j in range(width)]
    counted = rows.mapInArrow(_encoded(cuts, size), "kind tinyint, codes binary").groupBy("kind", "codes").agg(F.count(F.lit(1)).alias("n"))
    blocks = cache_input(materialize(counted.mapInArrow(_packed(_block_rows(width, size)), BLOCKS), "boosted_rows"))
    features, trees, recent = _subset(get("featureSubsetStrategy") if get("featureSubsetStrategy") != "auto" else "all", width, 1), [], []
    try:
        for number in range(get("maxIter")):
            if len(recent) == PIN_EVERY:
                pinned = materialize(blocks.mapInArrow(_pinned(width, size, recent), BLOCKS), "margins")
                blocks.unpersist()
                blocks, recent = cache_input(pinned), []
            tree = _grow(blocks, (width, size, bins), recent, number, get, features)
            trees.append(tree)
            recent.append(tree)
    finally:
        blocks.unpersist()
    return Boosted(trees, cuts, size)


@dataclass
class Boosted:
    """Fitted trees, each of at most 2 ** (depth + 1) nodes."""

    trees: list[Tree]
    cuts: list[list[float]]
    size: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``score``, the probability of 1, and ``prediction``."""
        encoded, trees = _encoder(self.cuts, self.size), self.trees

        def scores(values: pa.Array) -> pa.Array:
            codes = encoded(values)
            margin = np.zeros(len(codes))
            for tree in trees:
                margin += tree.margin(codes)
            return pa.array(1.0 / (1.0 + np.exp(np.minimum(-2.0 * margin, 700.0))))

        scored = df.withColumn("score", F.arrow_udf(scores, "double")(vector_to_array("features")))
        return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))

    def save(self, spark: SparkSession, path: str) -> None:
        trees = [[t.weight, *[getattr(t, k).tolist() for k in ("feature", "cut", "left", "value")]] for t in self.trees]
        line = json.dumps({"class": CLASS, "trees": trees, "cuts": self.cuts, "size": self.size})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        told = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
        return cls([Tree(t[0], *[np.array(c) for c in t[1:]]) for t in told["trees"]], told["cuts"], told["size"])

    @staticmethod
    def is_saved(spark: SparkSession, path: str) -> bool:
        return f'"class": "{CLASS}"' in spark.read.text(f"{path}/metadata").first()["value"]
