"""Confusion counts, accuracy and the area under the ROC curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldtally.operators.order import running_total


def parse_predictions(lines: DataFrame, line: str = "value") -> DataFrame:
    """``id,label,prediction`` lines → columns, with the score if the lines have one."""
    parts = F.split(F.col(line), ",")
    return lines.select(
        F.get(parts, F.lit(0)).alias("id"),
        F.get(parts, F.lit(1)).try_cast("double").alias("label"),
        F.get(parts, F.lit(2)).try_cast("double").alias("prediction"),
        F.get(parts, F.lit(3)).try_cast("double").alias("score"),
    )


def confusion_accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row. A label other than 0 and 1 counts in ``total`` only, and so lowers the accuracy."""
    y, p = F.col(label), F.col(prediction)
    counts = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("true_pos"),
        F.count_if((y == 0) & (p == 0)).alias("true_neg"),
        F.count_if((y == 0) & (p != 0)).alias("false_pos"),
        F.count_if((y == 1) & (p != 1)).alias("false_neg"),
        F.count(F.lit(1)).alias("total"),
    )
    right = F.col("true_pos") + F.col("true_neg")
    return counts.withColumn("accuracy", F.when(F.col("total") > 0, right / F.col("total")))


def auc_roc(df: DataFrame, label: str = "label", score: str = "score") -> float:
    """Exact area: ``numBins=0`` keeps every distinct score. Sorted and summed by partition in the JVM."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(df.select(F.col(score).cast("double").alias(score), label))


def grouped_auc(df: DataFrame, groups: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve and its variance, per group, from the ranks of the distinct scores: one row for each group.

    (groups…, positives, negatives, auc, variance). The area is the share of (positive, negative) pairs in which the positive has the
    higher score, ties counting half. The variance is DeLong's, from the shares of each score. Rows are counted by group and score first,
    so a score that many rows have is one row; without groups the running counts go over ranges of scores, with groups over the
    distinct scores of each. Rows without a label of 0 or 1, or without a score, take no part. The area is null where a label is
    missing, and the variance where a label has fewer than two rows.
    """
    y, keys = F.col(label), list(groups)
    rows = df.filter(y.isin(0, 1) & F.col(score).isNotNull()).select(*keys, y.cast("double").alias("_y"), F.col(score).cast("double").alias("_s"))
    counts = rows.groupBy(*keys, "_s").agg(F.count_if(F.col("_y") == 1).alias("_p"), F.count_if(F.col("_y") == 0).alias("_q"))
    if keys:
        up = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        below = counts.withColumns({f"_{c}_below": F.coalesce(F.sum(f"_{c}").over(up), F.lit(0)) for c in "pq"})
    else:
        below = running_total(counts, "_s", amount="_q", alias="_q_below")
        below = running_total(below, "_s", amount="_p", alias="_p_below")
    # Of a positive: the negatives below it and half of those beside it. Of a negative: the positives above, and half beside.
    won = F.col("_q_below") + F.col("_q") / 2
    lost = F.col("_p_below") + F.col("_p") / 2
    sums = below.groupBy(*keys).agg(
        F.sum(F.col("_p") * won).alias("_won"),
        F.sum(F.col("_p") * won * won).alias("_won2"),
        F.sum(F.col("_q") * lost).alias("_lost"),
        F.sum(F.col("_q") * lost * lost).alias("_lost2"),
        F.sum("_p").alias("positives"),
        F.sum("_q").alias("negatives"),
    )
    p, q = (F.col(c).cast("double") for c in ("positives", "negatives"))
    auc = F.col("_won") / F.when(p * q > 0, p * q)
    spread_p = (F.col("_won2") - F.col("_won") * F.col("_won") / F.when(p > 0, p)) / F.when((p > 1) & (q > 0), q * q * (p - 1))
    spread_q = (F.col("_lost2") - F.col("_lost") * F.col("_lost") / F.when(q > 0, q)) / F.when((q > 1) & (p > 0), p * p * (q - 1))
    return sums.select(*keys, "positives", "negatives", auc.alias("auc"), (spread_p / p + spread_q / q).alias("variance"))
