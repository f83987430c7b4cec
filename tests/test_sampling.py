from pyspark.sql import functions as F

from fieldtally.operators import sampling as s
from fieldtally.queries.tables import obs, table


def ids(df):
    return {r[0] for r in df.select("event_id").collect()}


def test_draws_do_not_depend_on_partitioning(spark, sf):
    rows = obs(spark, sf)
    for draw in (
        lambda d: s.class_balance(d, "target_raw", "event_id"),
        lambda d: s.target_sample(d, "target_raw", "event_id"),
        lambda d: s.random_split(d, "event_id", {"a": 0.8, "b": 0.2}, 345).filter("split = 'a'"),
        lambda d: s.nested_sample(d, "event_id", {"a": 9, "b": 1}, {"a": 9, "b": 1}),
    ):
        assert ids(draw(rows.repartition(3))) == ids(draw(rows.repartition(7, "user_id")))


def test_split_size(spark, sf_centi):
    parts = s.random_split(table(spark, sf_centi, "events"), "event_id", {"train": 0.8, "validation": 0.2}, 345)
    assert dict(parts.groupBy("split").count().collect()) == {"train": 7911, "validation": 2089}


def test_splits_are_disjoint_and_whole(spark, sf):
    parts = s.random_split(obs(spark, sf), "event_id", {"a": 1, "b": 1, "c": 2}, 7)
    counts = dict(parts.groupBy("split").count().collect())
    assert sum(counts.values()) == 1000 and sorted(counts) == ["a", "b", "c"]
    assert counts["c"] > counts["a"] > 150


def test_rates(spark):
    rows = spark.range(4000).withColumn("t", F.element_at(F.array(*map(F.lit, "x0?5")), (F.col("id") % 4 + 1).cast("int")))
    kept = dict(s.class_balance(rows, "t", "id").groupBy("t").count().collect())
    assert kept["x"] == kept["5"] == 1000 and 430 < kept["0"] < 570 and 430 < kept["?"] < 570
    kept = dict(s.target_sample(rows, "t", "id").groupBy("t").count().collect())
    assert "5" not in kept and 430 < kept["x"] < 570 and 270 < kept["0"] < 400


def test_subtract_lines(spark):
    lines = spark.createDataFrame([("h",), ("a",), ("a",), ("h",), ("b",)], "value string")
    header = spark.createDataFrame([("h",)], "value string")
    assert sorted(r[0] for r in s.subtract_lines(lines, header).collect()) == ["a", "a", "b"]


def test_filter_checklist(spark):
    rows = spark.createDataFrame([("1", "0"), ("0", "0"), ("0", "?"), ("0", "x"), ("0", "4")], "flag string, t string")
    assert [tuple(r) for r in s.filter_checklist(rows, "flag", "t").collect()] == [("1", "0"), ("0", "x"), ("0", "4")]
    assert s.filter_primary(rows, "flag").count() == 1


def test_replicate(spark):
    assert s.replicate(spark.range(3), 4).groupBy("model").count().count() == 4


def test_small_weights_are_not_rounded_away(spark):
    keys = spark.range(300_000)
    parts = s.random_split(keys, "id", {"small": 0.00004, "rest": 0.99996}, 3)
    small = parts.filter("split = 'small'").count()
    assert 2 <= small <= 30


def test_case_of_the_seen_mark(spark):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(["x", "X", "0"] * 200)], "id int, cell string")
    rates = s.Rates(seen=1.0, zero=0.0, missing=0.0, other=0.0)
    assert {r.cell for r in s.class_balance(rows, "cell", "id", rates).collect()} == {"x", "X"}
    assert {r.cell for r in s.class_balance(rows, "cell", "id", rates, case_sensitive=True).collect()} == {"x"}
    assert {r.cell for r in s.target_sample(rows, "cell", "id", rates, case_sensitive=True).collect()} == {"x"}


def test_header_filter_keeps_null_cells(spark):
    rows = spark.createDataFrame([("name",), (None,), ("a",)], "cell string")
    assert [r.cell for r in s.filter_header(rows, "cell", "name").collect()] == [None, "a"]
