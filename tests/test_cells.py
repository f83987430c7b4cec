"""Edge rows, one per rule."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldtally.functions import cells as c
from fieldtally.functions import features as f
from fieldtally.operators import clean
from fieldtally.operators import profile as p
from fieldtally.queries.tables import PREC, SNOW, obs

CELLS = ["0", "3", "2.5", "x", "X", "?", "", "n/a", "1e3", "nan", "inf", "1d", " 2 ", "-1", "0x1p3", "1_0", ".5", "7.", None]


def values(spark, cells, rule):
    rows = spark.createDataFrame([(i, cell) for i, cell in enumerate(cells)], "id int, cell string")
    return [r[0] for r in rows.select("id", rule(F.col("cell")).alias("v")).orderBy("id").select("v").collect()]


def test_to_number(spark):
    got = values(spark, CELLS, c.to_number)
    assert got == [0, 3, 2.5, 0, 0, 0, 0, 0, 1000, 0, 0, 0, 2, -1, 0, 0, 0.5, 7, 0]


def test_clean_count(spark):
    got = values(spark, CELLS, lambda cell: c.clean_count(cell, "s", F.col("id")))
    for cell, value in zip(CELLS, got, strict=True):
        if cell in ("x", "X"):
            assert value in range(2, 11)
    rest = [v for cell, v in zip(CELLS, got, strict=True) if cell not in ("x", "X")]
    assert rest == [0, 3, 2.5, 0, 0, 0, 1000, 0, 0, 0, 2, -1, 0, 0, 0.5, 7, 0]


def test_literal_case(spark):
    assert values(spark, ["X"], lambda cell: c.clean_count(cell, "s", F.col("id"), case_sensitive=True)) == [0.0]


def test_drawn_counts_cover_the_range(spark):
    drawn = spark.range(2000).select(c.clean_count(F.lit("x"), "s", F.col("id")).alias("v"))
    sizes = dict(drawn.groupBy("v").count().collect())
    assert sorted(sizes) == list(range(2, 11)) and min(sizes.values()) > 150


def test_labels(spark):
    direct = values(spark, CELLS, c.target_label)
    composed = values(spark, CELLS, lambda cell: c.binarize(c.clean_count(cell, "s", F.col("id"))))
    assert direct == composed
    assert values(spark, ["x", "X", "?", "0", "0.0", "4"], lambda x: c.target_value(x, "s", F.col("id"))) == [1, 1, 0, 0, 0, 1]
    coins = values(spark, ["n/a"] * 200, lambda x: c.target_value(x, "s", F.col("id")))
    assert 60 < sum(coins) < 140


def test_array_rule_equals_the_scalar_rule(spark):
    rows = spark.createDataFrame([("k1", CELLS), ("k2", CELLS[::-1])], "key string, a array<string>")
    got = clean.clean_array(rows, "a", "key", salt="s").orderBy("key").collect()
    flat = rows.select("key", F.posexplode("a").alias("i", "cell"))
    salt = F.concat(F.lit("s"), F.col("i").cast("string"))
    want = flat.select("key", "i", c.clean_count(F.col("cell"), salt, F.col("key")).alias("v")).orderBy("key", "i").collect()
    assert [v for r in got for v in r.a] == [r.v for r in want]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False), st.integers(), st.text(max_size=6)), min_size=1, max_size=20))
def test_numbers_survive_as_text(spark, items):
    cells = [repr(i) if not isinstance(i, str) else i for i in items]
    for item, value in zip(items, values(spark, cells, c.to_number), strict=True):
        assert value is not None and math.isfinite(value)
        if not isinstance(item, str) and abs(item) < 1e300:
            assert value == pytest.approx(float(item))


def test_time_slots(spark):
    rows = spark.createDataFrame([(h,) for h in ["0", "3", "7.99", "8", "15", "20", "23.5", "?", "-1"]], "hour string")
    slots = f.time_slots(c.to_number(F.col("hour")))
    got = {r.hour: tuple(int(v) for v in r[1:]) for r in rows.select("hour", *[v.alias(k) for k, v in slots.items()]).collect()}
    assert got == {
        "0": (0, 0, 0, 1), "3": (1, 0, 0, 1), "7.99": (1, 0, 0, 0), "8": (1, 1, 0, 0), "15": (0, 1, 1, 0),
        "20": (0, 0, 1, 1), "23.5": (0, 0, 0, 1), "?": (0, 0, 0, 1), "-1": (0, 0, 0, 1),
    }


def test_one_hot(spark):
    assert values(spark, ["P20", "P99", None], lambda cell: sum(f.one_hot(cell).values(), F.lit(0.0))) == [1, 0, 0]
    assert len(f.PROTOCOLS) == 20


def test_impute_monthly(spark):
    rows = spark.createDataFrame(
        [("?", "1"), ("?", "5"), ("?", "12"), ("?", "0"), ("?", None), ("?", "99"), ("4", "1")], "cell string, month string"
    )
    siblings = {m: F.lit(f"s{m}") for m in (1, 2, 3, 4, 10, 11, 12)}
    got = [r[0] for r in rows.select(c.impute_monthly(F.col("cell"), c.month_number(F.col("month")), siblings)).collect()]
    assert got == ["s1", "0", "s12", "s1", "s1", "0", "4"]


def test_year_parity(spark):
    assert values(spark, ["2000", "2013", "?", None], f.year_parity) == ["0", "1", "0", "0"]


def test_geo(spark):
    x, y, z = f.geo_xyz(F.lit(0.0), F.lit(90.0)).values()
    assert spark.range(1).select(x, y, z).first()[1] == pytest.approx(6371)
    literal = f.geo_xyz(F.lit(1.0), F.lit(2.0), radians=True)["x"]
    assert spark.range(1).select(literal).first()[0] == pytest.approx(6371 * math.cos(1) * math.cos(2))


def test_profile_edges(spark):
    rows = spark.createDataFrame([(v,) for v in ["0", "-0", "3", "2.5", "x", "X", "?", "", None, " 2 "]], "cell string")
    assert tuple(p.target_profile(rows, "cell").first()) == (2, 2, 2, 4, 10)


def test_known_figures(spark, sf_centi):
    """Published figures of the fixture at this scale."""
    rows = obs(spark, sf_centi)
    assert tuple(p.target_profile(rows, "target_raw").first()) == (5596, 2796, 1030, 578, 10000)
    key = F.col("event_id")
    sums = rows.agg(
        F.sum(c.clean_count(F.col("sp1_raw"), "sp1", key)),
        F.sum(c.clean_count(F.col("sp2_raw"), "sp2", key)),
        F.sum(c.clean_count(F.col("target_raw"), "t", key, case_sensitive=True)),
        *[F.sum(v) for v in f.time_slots(c.to_number(F.col("time_raw"))).values()],
    )
    assert tuple(sums.first()) == (20423, 11509, 15702, 2394, 3192, 2389, 3620)
    monthly = rows.withColumn("month", F.col("month").cast("string"))
    imputed = clean.impute_columns(monthly, "month", {"snow_raw": SNOW, "prec_raw": PREC})
    totals = imputed.agg(F.sum(c.to_number(F.col("snow_raw"))), F.sum(c.to_number(F.col("prec_raw")))).first()
    assert tuple(totals) == (125766, 1282504)
