"""AdaBoost (SAMME, two classes) over weighted decision stumps, which ``pyspark.ml`` does not offer."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.histogram import BINS, SAMPLE_ROWS, Bins, Carried, Cut, best_cut, binned, carried_on, label_weights
from fieldtally.operators.order import cache_input
from fieldtally.operators.stumps import Stump, Stumps
from fieldtally.session import materialize

# Rounds and learning rate.
ROUNDS = 100
LEARNING_RATE = 0.9
PIN_EVERY = 10


def fit_adaboost(
    train: DataFrame,
    rounds: int = ROUNDS,
    learning_rate: float = LEARNING_RATE,
    bins: int = BINS,
    sample_rows: int = SAMPLE_ROWS,
    history: list[dict] | None = None,
) -> Stumps:
    """Each round is one aggregate: the weight by feature, bin and label, from whose running sums the best stump follows.

    Values are binned once, into a written frame. A row's weight is the one written last times exp of the weights of the stumps
    since then that miss it; it is written anew every ``PIN_EVERY`` rounds, so the cost of a round does not grow. ``history``
    collects each round's stump, error, alpha and weight total.
    """
    width = _width(train)
    frame, cuts = binned(train, width, bins, sample_rows)
    frame = cache_input(frame)
    stumps, alphas, recent = [], [], []
    scale = 1.0 / max(frame.agg(F.sum("n")).first()[0] or 0, 1)
    try:
        for t in range(rounds):
            if len(recent) == PIN_EVERY:
                pinned = materialize(carried_on(frame, _carried(recent, cuts, scale)), "weights")
                frame.unpersist()
                frame, recent, scale = cache_input(pinned), [], 1.0
            found = best_cut(label_weights(frame, _carried(recent, cuts, scale), cuts), cuts)
            error = found.missed / found.total if found.total else 0.0
            if error >= 0.5 and stumps:
                break
            alpha = 1.0 if error <= 0.0 else learning_rate * math.log((1.0 - error) / error)
            stump = Stump(found.feature, cuts.cuts[found.feature][found.cut] if found.cut >= 0 else math.inf, found.left, found.right)
            if history is not None:
                history.append({"round": t, "error": error, "alpha": alpha, "total": found.total, "stump": stump})
            stumps.append(stump)
            alphas.append(alpha if alpha > 0.0 else 1.0)
            if error <= 0.0 or error >= 0.5:
                break
            recent.append((found, alpha))
            # The next round starts from weights that sum to 1; the new total follows from this round's sums.
            scale /= found.total + found.missed * (math.exp(alpha) - 1.0)
    finally:
        frame.unpersist()
    return Stumps(stumps, alphas)


def _width(train: DataFrame) -> int:
    meta = train.schema["features"].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return meta["num_attrs"]
    first = train.select("features").first()
    return first["features"].size if first else 0


def _carried(recent: list[tuple[Cut, float]], cuts: Bins, scale: float) -> Carried:
    """The stumps since the weights were written."""
    listed = []
    for cut, alpha in recent:
        first, last, within, without = cuts.held(cut.feature, cut.cut, cut.left, cut.right) if cut.cut >= 0 else (1, 0, cut.left, cut.left)
        listed.append((first, last, within, without, alpha))
    return Carried(listed, scale)
