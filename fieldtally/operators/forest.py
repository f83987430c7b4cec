"""Deep forests whose trees need not fit into the driver.

The upper part of each tree grows level by level from histograms, as long as a node holds more than ``NODE_ROWS`` rows. The rows of each
smaller node are dealt to one group, which grows its branch to the end in a task. Branches are written as rows of numpy arrays; the
driver holds the upper nodes and one short row a branch, so it grows with the rows by the hundred thousand, not with the leaves. A node
that can't be split, whatever its size, is a leaf at once; its rows go nowhere.

Of more than ``NODE_ROWS`` rows, those of a block that are equal in label, weight and bins become one with a count. A tree draws it as
often as it would draw them all together: Poisson and binomial draws add up.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.operators.equal_rows import equal_rows
from fieldtally.operators.histogram import find_cuts
from fieldtally.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # functions travel to the tasks by value, which need not have the package

NODE_ROWS = 1 << 16  # a node with at most so many drawn rows is grown by one task
BLOCK_BYTES = 1 << 24  # of bin numbers in a block of rows
SMALL_NODES = 1 << 21  # a forest with at most so many nodes is scored from a broadcast, a larger one by a shuffle
SCORED_ROWS = 1 << 17  # rows that a task scores with one branch, on average
SCORED_CELLS = 1 << 20  # with at most so many combinations of bins, a task goes down the trees once for each that it meets
GAIN = 1e-12
CELL = {2: "<u2", 1: "u1"}

BLOCKS = "block bigint, kinds binary, w binary, n binary, codes binary"  # no n: each row counts once
PIECES = "branch int, kinds binary, w binary, times binary, codes binary"
BRANCHES = "branch int, nodes int, feature binary, cut binary, left binary, prob binary"
NODES = {"feature": "<i4", "cut": "<u2", "left": "<i4", "prob": "<i8"}
UNIT = 1 << 40  # of a probability
CLASS = "fieldtally.Forest"


def _encoder(cuts: list[list[float]], size: int) -> Callable[[pa.Array], np.ndarray]:
    """Lists of values → (rows, features) of bin numbers: the count of a feature's cuts below the value."""
    own, width, cell = [np.asarray(c, dtype=float) for c in cuts], len(cuts), CELL[size]

    def encoded(lists):
        if lists.null_count:
            raise ValueError("a row without features")
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        if (lengths != width).any():
            raise ValueError(f"a row without {width} features")
        values = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)
        if not np.isfinite(values).all():
            raise ValueError("features must be numbers")
        codes = np.empty(values.shape, dtype=cell)
        for j, c in enumerate(own):
            codes[:, j] = np.searchsorted(c, values[:, j], side="left")
        return codes

    return encoded


def _block_rows(width: int, size: int) -> int:
    return max(1, min(1 << 16, BLOCK_BYTES // max(width * size, 1)))


def _packed(cuts: list[list[float]], size: int, merge: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(label, w, values) → numbered blocks of rows. The number seeds the draws, and is written with the block.

    With ``merge``, equal rows of a block become one if that halves them, and the block takes up more rows.
    """
    encoded, most, width, cell = _encoder(cuts, size), _block_rows(len(cuts), size), len(cuts), CELL[size]

    def packed(batches):
        number, held, rows, merged = TaskContext.get().partitionId() << 32, [], 0, False

        def block():
            kinds, w, n, codes = [np.concatenate(part) for part in zip(*held, strict=True)]
            columns = [kinds.tobytes(), w.tobytes(), n.tobytes() if merged else b"", codes.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([c], pa.binary()) for c in columns]], names=["block", "kinds", "w", "n", "codes"])

        def shortened():
            """What is held as fewer rows, if that halves them."""
            kinds, w, n, codes = [np.concatenate(part) for part in zip(*held, strict=True)]
            found = equal_rows([kinds, w, codes])
            return found and [(kinds[found[0]], w[found[0]], np.bincount(found[1], n), codes[found[0]])]

        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                label = part["label"].to_numpy(zero_copy_only=False)
                if part["label"].null_count or not np.isin(label, (0.0, 1.0)).all():
                    raise ValueError("labels must be 0 or 1")
                w = part["w"].to_numpy(zero_copy_only=False).astype(float)
                if part["w"].null_count or not (w >= 0).all():
                    raise ValueError("weights must not be negative")
                if rows + part.num_rows > most and merge and (fewer := shortened()):
                    held, rows, merged = fewer, len(fewer[0][0]), True
                if rows + part.num_rows > most:
                    yield block()
                    number, held, rows, merged = number + 1, [], 0, False
                held.append((label.astype(np.int8), w, np.ones(part.num_rows), encoded(part["_x"]).reshape(-1, width).astype(cell, copy=False)))
                rows += part.num_rows
        if held:
            if merge and (fewer := shortened()):
                held, merged = fewer, True
            yield block()

    return packed


@dataclass
class Upper:
    """Upper nodes of all trees as arrays. ``feature`` is -1 where a branch hangs; its number is in ``left``. Else the children are
    ``left``, for bins up to ``cut``, and the next one."""

    roots: list[int]
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray


def _descend(codes: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node without children that each row arrives at, from ``at``."""
    rows = np.flatnonzero(feature[at] >= 0)
    while len(rows):
        node = at[rows]
        at[rows] = node = left[node] + (codes[rows, feature[node]] > cut[node])
        rows = rows[feature[node] >= 0]
    return at


def _drawn(seed: int, tree: int, block: int, n: int, times: np.ndarray | None, bootstrap: bool, rate: float) -> np.ndarray:
    """How often a tree draws each row of a block, or the rows that each of them stands for."""
    if not bootstrap and rate >= 1.0:
        return np.ones(n) if times is None else times
    rng = np.random.default_rng([seed & 0xFFFFFFFF, tree, block])
    if times is not None:
        return (rng.poisson(rate * times) if bootstrap else rng.binomial(times.astype(np.int64), rate)).astype(float)
    return rng.poisson(rate, n).astype(float) if bootstrap else (rng.random(n) < rate).astype(float)


def _opened(batch: pa.RecordBatch, width: int, size: int) -> Iterator[tuple]:
    for block, kinds, w, n, codes in zip(*[batch[c].to_pylist() for c in ("block", "kinds", "w", "n", "codes")], strict=True):
        yield block, np.frombuffer(kinds, np.int8), np.frombuffer(w), np.frombuffer(n) if n else None, np.frombuffer(codes, CELL[size]).reshape(-1, width)


def _chosen(seed: int, tree: int, nodes: np.ndarray, width: int, features: int) -> np.ndarray:
    """(nodes, features): the features that each node may split by, without repeats."""
    if features >= width:
        return np.tile(np.arange(width), (len(nodes), 1))
    rng = np.random.default_rng([seed & 0xFFFFFFFF, 1 + tree, *[int(n) for n in nodes[:1]], 7])
    chosen = np.empty((len(nodes), features), dtype=np.int64)
    step = max(1, (1 << 22) // width)
    for start in range(0, len(nodes), step):
        draws = rng.random((min(step, len(nodes) - start), width))
        chosen[start : start + step] = np.argpartition(draws, features - 1, axis=1)[:, :features]
    return chosen


def _best(sums: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From (nodes, features, bins, (w0, w1, rows)): gain, and number of feature and cut, of each node's best split by weighted Gini."""
    upto = np.cumsum(sums, axis=2)
    total = upto[:, :1, -1:, :]
    rest = total - upto

    def impure(side):
        weight = side[..., 0] + side[..., 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(weight > 0, 2 * side[..., 0] * side[..., 1] / weight, 0.0)

    able = (upto[..., 2] >= least) & (rest[..., 2] >= least)
    all_weight = np.maximum(total[..., 0] + total[..., 1], 1e-300)
    gain = np.where(able, (impure(total) - impure(upto) - impure(rest)) / all_weight, -1.0).reshape(len(sums), -1)
    best = np.argmax(gain, axis=1)
    return gain[np.arange(len(sums)), best], best // sums.shape[2], best % sums.shape[2]


@dataclass(frozen=True)
class Params:
    """What a task has to know of a fit."""

    trees: int
    depth: int
    bins: int
    width: int
    size: int
    features: int
    least: float
    gain: float
    seed: int
    bootstrap: bool
    rate: float


def _level_sums(p: Params, upper: Upper, open_nodes: np.ndarray, chosen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Weights, draws and drawn rows of each open node by feature and bin, added up in a task."""
    slot = np.full(len(upper.feature), -1)
    slot[open_nodes] = np.arange(len(open_nodes))

    def summed(batches):
        cells = len(open_nodes) * p.features * p.bins
        table = np.zeros((4, cells))
        for batch in batches:
            for block, kinds, w, n, codes in _opened(batch, p.width, p.size):
                for tree, root in enumerate(upper.roots):
                    drawn = _drawn(p.seed, tree, block, len(kinds), n, p.bootstrap, p.rate)
                    rows = np.flatnonzero(drawn)
                    own = codes[rows]
                    at = slot[_descend(own, np.full(len(rows), root), upper.feature, upper.cut, upper.left)]
                    keep = at >= 0
                    rows, own, at = rows[keep], own[keep], at[keep]
                    if not len(rows):
                        continue
                    one, times = kinds[rows] == 1, drawn[rows]
                    weight = w[rows] * times
                    for j in range(p.features):
                        code = (at * p.features + j) * p.bins + own[np.arange(len(rows)), chosen[at, j]]
                        sums = [np.bincount(code, part, cells) for part in (np.where(one, 0.0, weight), np.where(one, weight, 0.0), times)]
                        sums.append(sums[2] if n is None else np.bincount(code, minlength=cells))
                        for mine, more in zip(table, sums, strict=True):
                            mine += more
        filled = np.flatnonzero(table.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(filled), *[pa.array(t[filled]) for t in table]], names=["cell", "w0", "w1", "n", "held"])

    return summed


def _grow_upper(blocks: DataFrame, p: Params, rows: int) -> tuple[Upper, list[tuple[int, int]], dict[int, float]]:
    """The upper nodes, (tree, depth) of each branch, and the probability of 1 of those branches that are only a leaf."""
    feature, cut, left, tree, depth = [-1] * p.trees, [0] * p.trees, [-1] * p.trees, list(range(p.trees)), [0] * p.trees
    branches: list[tuple[int, int]] = []
    leaves: dict[int, float] = {}

    def hang(node, weights=None):
        """A branch, or a leaf if its weights are given."""
        if weights is not None:
            leaves[len(branches)] = float(weights[1] / max(weights[0] + weights[1], 1e-300))
        left[node] = len(branches)
        branches.append((tree[node], depth[node]))

    expected = rows * p.rate
    nodes = list(range(p.trees))
    if expected <= NODE_ROWS or p.depth == 0:
        for node in nodes:
            hang(node)
        nodes = []
    roots = list(range(p.trees))
    again: set[int] = set()  # without a split by the features drawn first: others are drawn once
    while nodes:
        upper = Upper(roots, np.array(feature), np.array(cut), np.array(left))
        chosen = np.concatenate([_chosen(p.seed + (n in again), tree[n], np.array([n]), p.width, p.features) for n in nodes])
        summed = blocks.mapInArrow(_level_sums(p, upper, np.array(nodes), chosen), "cell long, w0 double, w1 double, n double, held double")
        # At most nodes * features * bins rows, and only nodes of more than NODE_ROWS rows are open.
        got = summed.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("w0", "w1", "n", "held")]).toArrow()
        sums = np.zeros((len(nodes) * p.features * p.bins, 4))
        sums[got["cell"].to_numpy()] = np.column_stack([got[c].to_numpy() for c in ("w0", "w1", "n", "held")])
        sums = sums.reshape(len(nodes), p.features, p.bins, 4)
        gain, which, at = _best(sums[..., :3], p.least)
        following = []
        for i, node in enumerate(nodes):
            if gain[i] < max(p.gain, GAIN):
                whole = sums[i, 0, :, :2].sum(axis=0)
                if p.features < p.width and node not in again and (whole > 0).all():
                    again.add(node)
                    following.append(node)
                else:
                    hang(node, whole)
                continue
            feature[node], cut[node], left[node] = int(chosen[i, which[i]]), int(at[i]), len(feature)
            side = sums[i, which[i]]
            for own in (side[: at[i] + 1].sum(axis=0), side[at[i] + 1 :].sum(axis=0)):
                child = len(feature)
                feature.append(-1), cut.append(0), left.append(-1), tree.append(tree[node]), depth.append(depth[node] + 1)
                if depth[child] >= p.depth or not (own[:2] > 0).all():
                    hang(child, own[:2])
                elif own[3] <= NODE_ROWS:
                    hang(child)
                else:
                    following.append(child)
        nodes = following
    return Upper(roots, np.array(feature), np.array(cut), np.array(left)), branches, leaves


def _pieces(branch: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row for each branch met in a block, with its rows' parts of the columns."""
    order = np.argsort(branch, kind="stable")
    met, starts = np.unique(branch[order], return_index=True)
    parts = [pa.array(met.astype(np.int32))]
    for column in columns:
        parts.append(pa.array([c.tobytes() for c in np.split(column[order], starts[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(parts, names=["branch", *names])


def _dealt(p: Params, upper: Upper, leaf: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each tree's drawn rows, sent to their branch unless it is only a leaf; ``times`` tells how often they were drawn."""

    def dealt(batches):
        for batch in batches:
            for block, kinds, w, n, codes in _opened(batch, p.width, p.size):
                for tree, root in enumerate(upper.roots):
                    drawn = _drawn(p.seed, tree, block, len(kinds), n, p.bootstrap, p.rate)
                    rows = np.flatnonzero(drawn)
                    own = codes[rows]
                    branch = upper.left[_descend(own, np.full(len(rows), root), upper.feature, upper.cut, upper.left)]
                    grows = ~leaf[branch]
                    rows, own, branch = rows[grows], own[grows], branch[grows]
                    if len(rows):
                        yield _pieces(branch, [kinds[rows], w[rows], drawn[rows], own], ["kinds", "w", "times", "codes"])

    return dealt


def _branch(p: Params, seed: int, depth: int, kinds: np.ndarray, w: np.ndarray, times: np.ndarray, codes: np.ndarray) -> tuple:
    """(feature, cut, left, probability of 1) of the nodes of a branch, grown level by level. Sibling leaves with one answer are one."""
    one, weight = kinds == 1, w * times
    rows, at = np.arange(len(kinds)), np.zeros(len(kinds), dtype=np.int64)
    feature, cut, left, prob = [], [], [], []
    first, count = 0, 1  # of the level's nodes
    while True:
        w1 = np.bincount(at, np.where(one[rows], weight[rows], 0.0), count)
        w0 = np.bincount(at, np.where(one[rows], 0.0, weight[rows]), count)
        prob.append(w1 / np.maximum(w0 + w1, 1e-300))
        f, c, l = np.full(count, -1), np.zeros(count, dtype=np.int64), np.full(count, -1)
        open_nodes = np.flatnonzero((w0 > 0) & (w1 > 0)) if depth < p.depth else np.zeros(0, dtype=np.int64)
        slot = np.full(count, -1)
        slot[open_nodes] = np.arange(len(open_nodes))
        keep = slot[at] >= 0
        rows, at = rows[keep], slot[at[keep]]
        split = np.zeros(len(open_nodes), dtype=bool)
        step = max(1, (1 << 21) // (p.features * p.bins))  # nodes at a time, so that their sums stay small
        chosen = _chosen(seed, depth, np.arange(first, first + len(open_nodes)), p.width, p.features)
        order = np.argsort(at, kind="stable")
        rows, at = rows[order], at[order]
        for start in range(0, len(open_nodes), step):
            m = min(step, len(open_nodes) - start)
            lo, hi = np.searchsorted(at, (start, start + m))
            own, node = rows[lo:hi], at[lo:hi] - start
            sums = np.empty((m, p.features, p.bins, 3))
            for j in range(p.features):
                code = node * p.bins + codes[own, chosen[at[lo:hi], j]]
                for k, part in enumerate((np.where(one[own], 0.0, weight[own]), np.where(one[own], weight[own], 0.0), times[own])):
                    sums[:, j, :, k] = np.bincount(code, part, m * p.bins).reshape(m, p.bins)
            gain, which, where = _best(sums, p.least)
            able = gain >= max(p.gain, GAIN)
            here = open_nodes[start : start + m]
            split[start : start + m] = able
            f[here[able]], c[here[able]] = chosen[start + np.flatnonzero(able), which[able]], where[able]
        parents = open_nodes[split]
        l[parents] = first + count + 2 * np.arange(len(parents))
        feature.append(f), cut.append(c), left.append(l)
        if not len(parents):
            break
        keep = split[at]
        rows, node = rows[keep], open_nodes[at[keep]]
        at = l[node] + (codes[rows, f[node]] > c[node]) - (first + count)
        first, count, depth = first + count, 2 * len(parents), depth + 1
    feature, cut, left, prob = (np.concatenate(part) for part in (feature, cut, left, prob))
    return _merged(feature, cut, left, prob)


def _merged(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, prob: np.ndarray) -> tuple:
    """Without pairs of leaves that give one answer: their parent is the leaf, with its own probability."""
    leaf, answer = feature < 0, prob > 0.5
    inner = np.flatnonzero(~leaf)
    # Children come after parents and a level's parents have their children in one run, so going back by runs sees children first.
    for node in inner[::-1].tolist():
        a = left[node]
        if leaf[a] and leaf[a + 1] and answer[a] == answer[a + 1]:
            leaf[node] = True
    feature = np.where(leaf, -1, feature)
    reached = np.zeros(len(feature), dtype=bool)
    level = np.zeros(1, dtype=np.int64)
    while len(level):
        reached[level] = True
        level = level[feature[level] >= 0]
        level = np.concatenate([left[level], left[level] + 1]) if len(level) else level
    place = np.cumsum(reached) - 1
    left = np.where(feature >= 0, place[np.maximum(left, 0)], -1)
    return tuple(part[reached] for part in (feature, cut, left, prob))


def _grown(p: Params, branches: list[tuple[int, int]]) -> Callable[[pa.Table], pa.Table]:
    where = np.array(branches, dtype=np.int64)

    def grown(pieces):
        number = pieces["branch"][0].as_py()
        kinds, w, times, codes = [b"".join(pieces[c].to_pylist()) for c in ("kinds", "w", "times", "codes")]
        tree, depth = where[number]
        feature, cut, left, prob = _branch(
            p, (p.seed + 1_000_003 * (number + 1) + int(tree)) & 0x7FFFFFFF, int(depth), np.frombuffer(kinds, np.int8), np.frombuffer(w),
            np.frombuffer(times), np.frombuffer(codes, CELL[p.size]).reshape(-1, p.width),
        )
        arrays = [a.astype(t) for a, t in zip((feature, cut, left, np.rint(prob * UNIT)), NODES.values(), strict=True)]
        return pa.table(
            [pa.array([number], pa.int32()), pa.array([len(feature)], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]],
            names=["branch", "nodes", *NODES],
        )

    return grown


def fit_forest(estimator: RandomForestClassifier, train: DataFrame) -> Forest:
    """A forest with the estimator's parameters (Gini, two classes), for depths at which its nodes would fill the driver.

    Bins come from ``find_cuts``. Draws are seeded by the number of a written block of rows, so a retried task draws the same.
    """
    get = estimator.getOrDefault
    spark, bins, weight = train.sparkSession, get("maxBins"), estimator.getWeightCol() if estimator.isDefined("weightCol") else None
    if get("impurity") != "gini" or get("minWeightFractionPerNode") > 0:
        raise ValueError("only Gini impurity, without a least share of the weight")
    rows = train.select(
        F.col(get("labelCol")).cast("double").alias("label"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        vector_to_array(get("featuresCol")).alias("_x"),
    )
    first = rows.select(F.size("_x").alias("width")).first()
    if first is None:
        raise ValueError("no rows to fit on")
    width, size = first["width"], 1 if bins <= 256 else 2
    drawn = rows.select("_x", F.monotonically_increasing_id().alias("_row"))  # a sample is drawn by the hash of both, as rows may be equal
    every = rows.count()
    found = {r["pos"]: list(r["cuts"]) for r in find_cuts(drawn, "_x", bins, n=every).collect()}  # at most width * bins numbers
    cuts = [found.get(j, []) for j in range(width)]
    merge = every * get("subsamplingRate") > NODE_ROWS  # else a task grows a tree of all rows as they are
    blocks = materialize(rows.mapInArrow(_packed(cuts, size, merge), BLOCKS), "forest_rows")
    n = blocks.agg(F.sum(F.length("kinds"))).first()[0]
    features = _subset(get("featureSubsetStrategy"), width, get("numTrees"))
    p = Params(get("numTrees"), get("maxDepth"), bins, width, size, features, get("minInstancesPerNode"), get("minInfoGain"), get("seed"),
               get("bootstrap"), get("subsamplingRate"))
    upper, branches, leaves = _grow_upper(blocks, p, n)
    leaf = np.zeros(len(branches), dtype=bool)
    leaf[list(leaves)] = True
    dealt = blocks.mapInArrow(_dealt(p, upper, leaf), PIECES)
    parts = max(spark.sparkContext.defaultParallelism, min(len(branches), 4096))
    grown = dealt.repartition(parts, "branch").groupBy("branch").applyInArrow(_grown(p, branches), BRANCHES)
    if leaves:
        grown = grown.unionByName(spark.createDataFrame([_leaf(*found) for found in leaves.items()], BRANCHES))
    return Forest(materialize(grown, "forest"), upper, cuts, size)


def _leaf(branch: int, prob: float) -> tuple:
    """The row of a branch that is only a leaf."""
    return branch, 1, *[np.array([v], dtype=t).tobytes() for v, t in zip((-1, 0, -1, round(prob * UNIT)), NODES.values(), strict=True)]


def _subset(strategy: str, width: int, trees: int) -> int:
    """Features a split may choose from, as ``pyspark.ml`` counts them."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    if strategy in ("all", "sqrt", "log2", "onethird"):
        return {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}[strategy]
    number = float(strategy)
    return max(1, min(width, int(number))) if strategy.isdigit() else max(1, math.ceil(number * width))


def _of_branch(row: pa.Table, at: int = 0) -> tuple:
    return tuple(np.frombuffer(row[c][at].as_py(), t) for c, t in NODES.items())


def _router(cuts: list[list[float]], size: int, upper: Upper, salts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows to score, sent to the branches they arrive at: one for each tree."""
    encoded = _encoder(cuts, size)

    def routed(batches):
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            codes, ids = encoded(batch["_x"]), batch["_id"].to_numpy(zero_copy_only=False)
            for root in upper.roots:
                branch = upper.left[_descend(codes, np.full(len(codes), root), upper.feature, upper.cut, upper.left)]
                pieces = _pieces(branch, [ids, codes], ["ids", "codes"])
                yield pa.RecordBatch.from_arrays([*pieces.columns, pa.array(np.full(len(pieces), (part + i) % salts, dtype=np.int32))], names=["branch", "ids", "codes", "salt"])

    return routed


def _answered(width: int, size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One branch's answers for its rows."""

    def answered(pieces, branches):
        if not pieces.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64())], names=["_id", "answer"])
        ids = np.frombuffer(b"".join(pieces["ids"].to_pylist()), np.int64)
        codes = np.frombuffer(b"".join(pieces["codes"].to_pylist()), CELL[size]).reshape(-1, width)
        if branches.num_rows:
            feature, cut, left, prob = _of_branch(branches)
            answer = prob[_descend(codes, np.zeros(len(codes), dtype=np.int64), feature, cut, left)]
        else:  # no row was drawn into it
            answer = np.full(len(codes), UNIT // 2)
        return pa.table([pa.array(ids), pa.array(answer)], names=["_id", "answer"])

    return answered


@dataclass
class Forest:
    """A fitted forest: its branches as a written table, the rest here. Answers are whole parts of ``UNIT``, so their sum does not
    depend on the order of the trees."""

    branches: DataFrame
    upper: Upper
    cuts: list[list[float]]
    size: int

    @property
    def trees(self) -> int:
        return len(self.upper.roots)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``score``, the mean of the trees' probabilities of 1, and ``prediction``.

        With more than ``SMALL_NODES`` nodes the rows are written with a number and sent to the branches; else every task has all trees.
        """
        small = (self.branches.agg(F.sum("nodes")).first()[0] or 0) <= SMALL_NODES
        scored = self._by_broadcast(df) if small else self._by_shuffle(df)
        return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))

    def _by_broadcast(self, df: DataFrame) -> DataFrame:
        roots, nodes = self._joined()
        encoded, scale = _encoder(self.cuts, self.size), float(self.trees * UNIT)
        steps = [math.prod(len(c) + 1 for c in self.cuts[j + 1 :]) for j in range(len(self.cuts))]
        cells = math.prod(len(c) + 1 for c in self.cuts)
        known: list[np.ndarray] = []  # a task's own: the sum of each combination of bins met so far

        def summed(codes):
            total = np.zeros(len(codes), dtype=np.int64)
            feature, cut, left, prob = nodes
            for root in roots:
                total += prob[_descend(codes, np.full(len(codes), root), feature, cut, left)]
            return total

        def scores(values: pa.Array) -> pa.Array:
            codes = encoded(values)
            if cells > SCORED_CELLS:
                return pa.array(summed(codes) / scale)
            if not known:
                known.append(np.full(cells, -1, dtype=np.int64))
            place = codes.astype(np.int64) @ np.array(steps, dtype=np.int64)
            fresh, at = np.unique(place[known[0][place] < 0], return_index=True)
            if len(fresh):
                known[0][fresh] = summed(codes[known[0][place] < 0][at])
            return pa.array(known[0][place] / scale)

        return df.withColumn("score", F.arrow_udf(scores, "double")(vector_to_array("features")))

    def _joined(self) -> tuple[list[int], list[np.ndarray]]:
        """All nodes of a small forest as arrays: a branch's root takes the place of the node it hangs on."""
        got = self.branches.select("branch", *NODES).toArrow()
        found = {b: i for i, b in enumerate(got["branch"].to_pylist())}
        upper = [self.upper.feature.astype("<i4"), self.upper.cut.astype("<u2"), self.upper.left.astype("<i4"), np.full(len(self.upper.feature), UNIT // 2)]
        parts, start = [upper], len(upper[0])
        for node in np.flatnonzero(self.upper.feature < 0).tolist():
            at = found.get(int(self.upper.left[node]))
            upper[2][node] = -1
            if at is None:  # no row was drawn into it
                continue
            feature, cut, left, prob = _of_branch(got, at)
            left = np.where(left >= 0, left + start, -1).astype("<i4")
            for mine, theirs in zip(upper, (feature, cut, left, prob), strict=True):
                mine[node] = theirs[0]
            parts.append([feature, cut, left, prob])
            start += len(feature)
        return self.upper.roots, [np.concatenate(column) for column in zip(*parts, strict=True)]

    def _by_shuffle(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        pinned = materialize(df.withColumn("_id", F.monotonically_increasing_id()), "to_score")
        average = pinned.count() * self.trees / max(int((self.upper.feature < 0).sum()), 1)
        salts = max(1, math.ceil(average / SCORED_ROWS))
        rows = pinned.select("_id", vector_to_array("features").alias("_x"))
        pieces = rows.mapInArrow(_router(self.cuts, self.size, self.upper, salts), "branch int, ids binary, codes binary, salt int")
        salted = self.branches.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        parts = max(spark.sparkContext.defaultParallelism, min(self.branches.count() * salts, 4096))
        pieces, salted = [f.repartition(parts, "branch", "salt").groupBy("branch", "salt") for f in (pieces, salted)]
        answers = pieces.cogroup(salted).applyInArrow(_answered(len(self.cuts), self.size), "_id long, answer long")
        score = answers.groupBy("_id").agg((F.sum("answer") / F.lit(float(self.trees * UNIT))).alias("score"))
        return materialize(pinned.join(score, "_id", "left").select(*df.columns, "score"), "scored")

    def save(self, spark: SparkSession, path: str) -> None:
        self.branches.write.mode("overwrite").parquet(f"{path}/branches")
        upper = {k: getattr(self.upper, k).tolist() for k in ("feature", "cut", "left")}
        line = json.dumps({"class": CLASS, "roots": self.upper.roots, **upper, "cuts": self.cuts, "size": self.size})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        told = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
        upper = Upper(told["roots"], *[np.array(told[k]) for k in ("feature", "cut", "left")])
        return cls(spark.read.schema(BRANCHES).parquet(f"{path}/branches"), upper, told["cuts"], told["size"])

    @staticmethod
    def is_saved(spark: SparkSession, path: str) -> bool:
        """Whether a saved model is a forest of this class; ``pyspark.ml`` has a ``metadata`` folder, too."""
        return f'"class": "{CLASS}"' in spark.read.text(f"{path}/metadata").first()["value"]
