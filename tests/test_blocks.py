"""Boosting sums over blocks of rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.histogram import Carried, binned, carried_on, label_weights


def test_blocks_give_the_sums_of_their_rows(spark):
    rows = spark.range(3000).repartition(3, "id").select(
        "id",
        F.when(F.col("id") % 5 < 2, 1.0).otherwise(0.0).alias("label", metadata=LABEL_META),
        F.array(F.col("id") % 7 - 3.0, F.lit(0.0), F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 4 * 1.0)).alias("v"),
    )
    frame, bins = binned(sparse_vector(rows, "v", 3).drop("v"), 3)
    # Before, each row went to the sums by itself.
    assert frame.count() <= 3 and frame.agg(F.sum("n")).first()[0] == 3000
    own = rows.toPandas()
    y, v = own["label"].to_numpy(), np.array(own["v"].tolist())
    code = np.array([[sum(c < x if x == x else True for c in bins.cuts[j]) for j, x in enumerate(r)] for r in v])
    first, last, within, without = bins.held(0, 2, 1.0, 0.0)
    carried = Carried([(first, last, within, without, 0.7)], 2.0)
    answer = np.where(code[:, 0] <= 2, 1.0, 0.0)
    w = 2.0 * np.exp(np.where(answer != y, 0.7, 0.0))
    for table in (label_weights(frame, carried, bins), label_weights(carried_on(frame, carried), Carried([], 1.0), bins)):
        for label in (0, 1):
            assert math.isclose(table[label, 3, 0], w[y == label].sum())
            for j in range(3):
                want = np.bincount(code[y == label, j], weights=w[y == label], minlength=bins.bins)
                assert np.allclose(table[label, j], want)


def test_equal_rows_of_a_task_are_one_row_with_their_weight(spark):
    """Before, each row went to every round by itself, in blocks of whole Arrow batches."""
    rows = spark.range(40_000, numPartitions=4).select(
        F.when(F.col("id") % 5 < 2, 1.0).when(F.col("id") % 41 == 0, F.lit(None)).when(F.col("id") % 43 == 0, 7.0).otherwise(0.0).alias("label", metadata=LABEL_META),
        F.array(F.col("id") % 7 - 3.0, F.col("id") % 2 * 1.0).alias("v"),
    )
    frame, bins = binned(sparse_vector(rows, "v", 2).drop("v"), 2)
    blocks = frame.collect()
    assert sum(b.n for b in blocks) == 40_000 and sum(np.frombuffer(b.w).sum() for b in blocks) == 40_000
    assert sum(len(b.kinds) for b in blocks) <= len(blocks) * 7 * 2 * 4
    own = rows.toPandas()
    v, miss = np.array(own["v"].tolist()), own["label"].to_numpy()
    table = label_weights(frame, Carried([], 0.5), bins)
    for label in (0, 1):
        held = (miss == 1) == bool(label)
        code = np.searchsorted(bins.cuts[0], v[held, 0], side="left")
        assert np.allclose(table[label, 0], 0.5 * np.bincount(code, minlength=bins.bins))
    assert math.isclose(table[:, 2, 0].sum(), 20_000)


def test_wide_rows_stay_in_small_blocks(spark):
    """Unlike rows, which can't be merged: a block's codes are bounded whatever the width."""
    columns = [(F.pmod(F.hash("id", F.lit(i)), F.lit(1000)) / 1000.0).alias(f"x{i}") for i in range(200)]
    rows = spark.range(9000, numPartitions=1).select(*columns, F.lit(1.0).alias("label", metadata=LABEL_META))
    frame, _ = binned(sparse_vector(rows.select("label", F.array(*[f"x{i}" for i in range(200)]).alias("v")), "v", 200).drop("v"), 200)
    blocks = frame.collect()
    assert sum(len(b.kinds) for b in blocks) == 9000 and max(len(b.codes) for b in blocks) <= 1 << 22
