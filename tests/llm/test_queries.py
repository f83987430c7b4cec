"""Every query with SQL gives its rows; the others give a row for each document, or rows of known documents."""

import duckdb
import pytest
from check import duck, same

import __spark_entry__ as entry
from fieldtally.llm import queries as llm

RUNS, SQL = llm.queries(), llm.oracle_sql()


@pytest.fixture(scope="module")
def con(sf) -> duckdb.DuckDBPyConnection:
    return duck(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, con, name):
    assert same(RUNS[name](spark, sf).toPandas(), con.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQL)))
def test_rows(spark, sf, con, name):
    ids = con.execute("SELECT doc_id FROM documents").df().doc_id
    found = RUNS[name](spark, sf).toPandas()
    if name == "op11_html_text":
        assert sorted(found.page_id) == sorted(con.execute("SELECT page_id FROM pages").df().page_id)
        return
    if name in ("op6_substring_dedup", "op8_decontamination"):
        assert len(found) and set(found.doc_id) <= set(ids)
    else:
        assert sorted(found.doc_id) == sorted(ids)


def test_registered():
    names = entry.queries()
    assert set(RUNS) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
