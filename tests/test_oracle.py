"""Every registered query with an SQL twin gives the twin's rows; the others give rows."""

import pytest

import __spark_entry__ as entry
from check import duck, same
from fieldtally import queries as registry

RUNS, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


# A hundred rounds each: for ``check.py``; test_models has the same steps with fewer rounds.
LONG = {"s10_save_load_ensemble", "m5_rule_gbt", "m7_rule_mlp"}


@pytest.mark.parametrize("name", sorted(set(SQL) - LONG))
def test_equals_sql(spark, sf, con, name):
    assert same(RUNS[name](spark, sf).toPandas(), con.execute(SQL[name]).df()) is None


# Trainers run on every kind in test_models.
@pytest.mark.parametrize("name", ["a2_category_sizes"])
def test_gives_rows(spark, sf, name):
    assert RUNS[name](spark, sf).count() > 0


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.total == row.zeros + row.ones + row.missing + row.extra > 0


def test_names():
    assert set(SQL) <= set(RUNS)
    assert set(RUNS) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
