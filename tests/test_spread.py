"""Rows of a fit are dealt evenly, in partitions of a bounded size."""

from pyspark.sql import functions as F

from fieldtally.operators.engineer import sparse_vector
from fieldtally.plans import jobs
from fieldtally.queries import models


def sizes(frame):
    return [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]


def test_partitions_grow_with_the_rows(spark, monkeypatch):
    rows = sparse_vector(spark.range(4000).select("id", F.array(F.col("id") * 1.0, F.lit(0.0)).alias("v")), "v", 2).drop("v")
    small = jobs.spread(rows, "id")
    assert small.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(jobs, "PARTITION_BYTES", 100 * (jobs.ROW_BYTES + 2 * jobs.CELL_BYTES))
    large = jobs.spread(rows, "id")
    assert large.rdd.getNumPartitions() == 40 and max(sizes(large)) < 200 and large.count() == 4000
    small.unpersist(), large.unpersist()


def test_rule_rows_are_not_dealt_by_a_few_keys(spark, tmp_path, monkeypatch):
    lines = spark.range(4000).select((F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, spread = [], jobs.spread

    def kept(frame, *key):
        dealt = spread(frame, *key)
        seen.append(sizes(dealt))
        return dealt

    monkeypatch.setattr(models.jobs, "spread", kept)
    told = {(r.cat, r.prediction): r.rows for r in models._fit_the_rule(spark, str(tmp_path), "logistic_l1").collect()}
    assert sum(told.values()) == 4000
    assert len(seen[0]) == spark.sparkContext.defaultParallelism and max(seen[0]) < 2 * 4000 / len(seen[0])


def test_tasks_of_wide_lines_grow_in_number(spark, tmp_path, monkeypatch):
    from fieldtally.queries import tables

    spark.range(1000).select(F.col("id").alias("event_id"), F.col("id").alias("user_id")).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(tables, "WIDE_ROWS", 25)
    lines = tables.wide_lines(spark, str(tmp_path))
    assert max(sizes(lines)) <= 50 and lines.count() == 1000
