"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry
from fieldtally.queries.columns import checklist_plan
from fieldtally.queries.tables import checklist, obs

RUNS = entry.queries()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in RUNS if n[0] in "cefk" or n in ("p3_ensemble_vote", "p4_threshold", "s3_split_cells")])
def test_no_python_and_no_cross_product(spark, sf, name):
    plan = physical(RUNS[name](spark, sf))
    for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize("name", [n for n in RUNS if n[:2] in ("c1", "c2", "c3", "e1", "e2", "e4", "f1", "f5", "f6", "f8", "k4", "k8")])
def test_row_steps_do_not_shuffle(spark, sf, name):
    plan = physical(RUNS[name](spark, sf))
    assert plan.count("Exchange") == (1 if name in ("e1_one_hot_sums", "k8_clean_record_wide", "k8_clean_record_short_lines") else 0)


def test_scan_reads_only_what_a_query_needs(spark, sf):
    plan = physical(RUNS["f7_random_split"](spark, sf))
    assert "ReadSchema: struct<event_id:bigint>" in plan
    plan = physical(obs(spark, sf).select("event_id", "lat").filter("event_id > 10"))
    assert "ReadSchema: struct<event_id:bigint>" in plan and "GreaterThan(event_id,10)" in plan


def test_record_is_one_projection(spark, sf):
    plan = physical(checklist_plan().transform(checklist(spark, sf)))
    assert "Exchange" not in plan and "Join" not in plan


def test_cache_is_read(spark, sf):
    result = RUNS["o6_cache_input"](spark, sf)
    assert "InMemoryTableScan" in physical(result) and result.count() == 2
    spark.catalog.clearCache()
