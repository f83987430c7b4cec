"""The prepared store gives the jobs' rows without reading the text again, and jobs read only the folders and columns they need."""

import pytest
from pyspark.sql import functions as F

from fieldtally.plans import jobs, store
from fieldtally.queries.tables import wide_header, wide_lines


@pytest.fixture(scope="module")
def paths(spark, sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("prepared")
    lines = [r.value for r in wide_lines(spark, sf).collect()]
    (folder / "wide.csv").write_text("\n".join([",".join(wide_header()), *lines]) + "\n")
    store.prepare_job(spark, str(folder / "wide.csv"), str(folder / "store"))
    return str(folder / "wide.csv"), str(folder / "store")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(frame):
    return sorted((r.SAMPLING_EVENT_ID, r.label, r.features) for r in frame.collect())


def test_training_frame_is_the_jobs(spark, paths):
    text, prepared = paths
    raw, plan = jobs.open_wide(spark, text)
    opened = store.open_store(spark, prepared)
    assert opened.plan.spec == plan.spec and opened.plan.feature_names == plan.feature_names
    for strict in (False, True):
        want = jobs.training_frame(jobs.split_part(raw, plan, "train"), plan, strict=strict)
        got = opened.training_frame("train", strict=strict)
        assert rows_of(got) == rows_of(want) and got.schema["features"].metadata == want.schema["features"].metadata
    held = [r.SAMPLING_EVENT_ID for r in jobs.split_part(raw, plan, "validation").select(plan.key().alias("SAMPLING_EVENT_ID")).collect()]
    assert sorted(held) == sorted(r.key for r in opened.part("validation").collect())
    assert store.profile_prepared(spark, prepared).collect() == jobs.profile_job(spark, text).collect()


def test_no_text_and_only_the_needed_parts_are_read(spark, paths):
    opened = store.open_store(spark, paths[1])
    plan = physical(opened.training_frame("train"))
    assert "Scan text" not in plan and "FileScan text" not in plan and "(bucket#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    for part, bound in (("train", "(bucket#"), ("validation", "(bucket#")):
        assert bound in physical(opened.part(part)).split("PartitionFilters: ")[1].split("]")[0]
    folders = {p: {r[0] for r in opened.part(p).select(F.regexp_extract("_metadata.file_path", r"bucket=(\d)", 1)).distinct().collect()} for p in ("train", "validation")}
    assert folders == {"train": {"0", "1", "2", "3"}, "validation": {"4"}}
    assert "ReadSchema: struct<target:string>" in physical(store.profile_prepared(spark, paths[1]))


def test_jobs_from_the_store(spark, paths, tmp_path):
    text, prepared = paths
    outs = {n: str(tmp_path / n) for n in ("matrix", "pairs", "matrix2", "pairs2", "model", "predictions")}
    store.correlate_prepared(spark, prepared, outs["matrix"], outs["pairs"])
    jobs.correlation_job(spark, text, outs["matrix2"], outs["pairs2"])
    both = spark.read.parquet(outs["matrix"]).join(spark.read.parquet(outs["matrix2"]).withColumnRenamed("r", "s"), ["i", "j"])
    assert both.count() == 996**2
    assert both.filter("NOT r <=> s AND NOT abs(r - s) < 1e-9").count() == 0
    pairs = [{r.name: r.r for r in spark.read.csv(outs[n], header=True, schema="name string, r double").collect()} for n in ("pairs", "pairs2")]
    assert pairs[0] == pytest.approx(pairs[1])
    store.train_prepared(spark, prepared, outs["model"], "random_forest", {"numTrees": 2, "maxDepth": 3})
    report = store.validate_prepared(spark, prepared, outs["model"], outs["predictions"]).first()
    assert report.total == store.open_store(spark, prepared).part("validation").count() and report.auc is not None
    other = str(tmp_path / "other")
    store.prepare_job(spark, text, other, jobs.RecordSpec(fold_year=True))
    with pytest.raises(ValueError):
        store.validate_prepared(spark, other, outs["model"], str(tmp_path / "never"))
    assert store.open_store(spark, other).rows.select(F.size("values")).first()[0] == 996
