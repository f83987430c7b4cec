"""Checklists are dealt to all cores before they are cleaned."""

from fieldtally.operators.sampling import class_balance, random_split
from fieldtally.plans import jobs
from fieldtally.queries import models, tables
from fieldtally.queries.columns import checklist_plan


def test_a_table_of_one_split_is_cleaned_by_all_cores(spark, sf):
    assert tables.checklist(spark, sf).rdd.getNumPartitions() == 1
    plan, training, validation = models.frames(spark, sf)
    try:
        assert validation.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert training.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        parts = random_split(tables.checklist(spark, sf), plan.key(), jobs.SPLIT, jobs.SPLIT_SEED)
        rows = class_balance(plan.select_rows(parts.filter("split = 'train'")), plan.target(), plan.key())
        for dealt, whole in ((training, plan.transform(rows)), (validation, plan.transform(parts.filter("split = 'validation'")))):
            assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect()))
    finally:
        training.unpersist()


def test_a_partition_of_checklists_is_bounded(spark, sf, monkeypatch):
    monkeypatch.setattr(tables, "DEALT_ROWS", 20)
    rows = tables.dealt_checklist(spark, sf)
    assert rows.rdd.getNumPartitions() == -(-rows.count() // 20)
    assert sorted(rows.collect()) == sorted(tables.checklist(spark, sf).collect())
    plan = checklist_plan()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan.transform(rows)._jdf.queryExecution().executedPlan().toString()
