"""Samples of an exact size, against a plain ranking."""

import hashlib

import pytest
from pyspark.sql import functions as F

from fieldtally.catalog import TARGET
from fieldtally.operators import quota
from fieldtally.plans import jobs


def draw(salt, key):
    return int(hashlib.md5(f"{salt}:{'' if key is None else key}".encode()).hexdigest()[:15], 16)


def ranked(rows, quotas, salt):
    kept = set()
    for c, n in quotas.items():
        inside = sorted((draw(salt, k), str(k), k) for k, own in rows if own == c)
        kept |= {k for *_, k in inside[:n]}
    return kept


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, "abcd"[min(i % 10, 3)]) for i in range(20_000)]
    return data, spark.createDataFrame(data, "id int, class string").cache()


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("listed", [10_000, 3])
def test_equals_ranking_on_any_partitioning(rows, listed, monkeypatch):
    """With bins of eight draws each and few listed keys, every level is walked."""
    monkeypatch.setattr(quota, "LISTED", listed)
    monkeypatch.setattr(quota, "LEVEL", 15 if listed > 3 else 3)
    data, df = rows
    quotas = {"a": 7, "b": 1999, "c": 2000, "d": 9_000}
    want = sorted(ranked(data, quotas, "s"))
    assert ids(quota.quota_sample(df.repartition(3), "class", "id", quotas, "s")) == want
    assert ids(quota.quota_sample(df.repartition(7, "id"), "class", "id", quotas, "s")) == want
    assert len(want) == 7 + 1999 + 2000 + 9000


def test_small_unknown_and_missing_classes(spark, rows):
    df = rows[1].unionByName(spark.createDataFrame([(-1, None), (None, "a")], "id int, class string"))
    kept = quota.quota_sample(df, "class", "id", {"a": 5000, "zz": 4, "b": 0})
    assert kept.groupBy("class").count().collect() == [("a", 2001)]
    assert quota.quota_sample(df, "class", "id", {"b": 0}).count() == 0
    assert quota.quota_sample(df.limit(0), "class", "id", {"a": 3}).count() == 0
    with pytest.raises(ValueError):
        quota.quota_sample(df, "class", "id", {"a": -1})


def test_rows_of_a_key_go_together(spark):
    """A third of all rows share a key."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-5)).otherwise(F.col("id")).alias("id"), F.lit("a").alias("class"))
    order = sorted((draw("s", k), k) for k in {r.id for r in df.distinct().collect()})
    place = [k for _, k in order].index(-5)
    for need in (place, place + 1, place + 999, place + 1000, place + 1001):
        kept = quota.quota_sample(df, "class", "id", {"a": need}, "s")
        assert kept.count() == (place if need < place + 1000 else need)


def test_equal_draws_go_by_key(rows, monkeypatch):
    """All draws alike: the keys alone decide, and the bins run out of bits."""
    monkeypatch.setattr(quota, "draw60", lambda salt, key: F.lit(11).cast("bigint"))
    monkeypatch.setattr(quota, "LISTED", 5)
    kept = ids(quota.quota_sample(rows[1], "class", "id", {"a": 10}))
    assert kept == sorted(sorted((i for i, c in rows[0] if c == "a"), key=str)[:10])


def test_plan_has_no_shuffle(rows):
    plan = quota.quota_sample(rows[1], "class", "id", {"a": 10, "b": 5})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan


def test_job_writes_so_many_lines(spark, tmp_path):
    lines = [f"S{i},1,{i % 7}" for i in range(500)]
    (tmp_path / "in.csv").write_text("\n".join([f"SAMPLING_EVENT_ID,PRIMARY_CHECKLIST_FLAG,{TARGET}", *lines]) + "\n")
    jobs.sample_job(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), rows=40)
    got = {r.value for r in spark.read.text(str(tmp_path / "out")).collect()}
    want = sorted(lines, key=lambda v: draw("17", v.split(",")[0]))[:40]
    assert got == set(want)
