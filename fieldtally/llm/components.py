"""Connected components of a graph given by its links, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


ROWS_PER_TASK = 200_000


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component): the smallest node that links lead to, for each node that has a link.

    Each round gives every node the smallest label of its neighbours, and then the label of its label, so long chains
    need few rounds. Labels are written to the shared folder after each round; a node that a third of all links touch sends its
    label by a join and gets one back by a combined minimum. The tables of a round are narrow, so their tasks follow
    the number of links: one for each ``ROWS_PER_TASK``.
    """
    tasks = 1 + links.count() // ROWS_PER_TASK

    def written(rows: DataFrame, name: str) -> DataFrame:
        return materialize(rows.coalesce(tasks), name)

    both = links.select(F.col(first).alias("node"), F.col(second).alias("other"))
    both = written(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    labels = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        told = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        lower = labels.join(told, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("beyond"))
        moved = written(
            lower.join(jump, "label").select("node", F.least("label", "beyond").alias("component"), (F.least("label", "beyond") != F.col("old")).alias("moved")),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter("moved").isEmpty():
            return labels
