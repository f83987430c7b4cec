"""Wide lines are written slice by slice, to the rules of their cells, and cut without splitting them."""

import math

from pyspark.sql import functions as F

import __spark_entry__ as entry
from fieldtally.functions.features import PROTOCOLS
from fieldtally.queries import tables

VOCABULARY = (*PROTOCOLS, "P99")


def rest(a, b):
    return int(math.copysign(abs(a) % b, a)) if a else 0


def cell(e, u, p):
    """A cell by the rules as they are told in SQL, or None."""
    if p == 1:
        return None if u is None else f"L{u}"
    if p == 18:
        return "0" if e is not None and e % 7 == 0 else "1"
    if e is None:
        return None
    if p in (0, 2, 3, 4, 5):
        return (f"S{e}", None, str(rest(e * 37, 180) - 90), str(rest(e * 91, 360) - 180), str(2000 + rest(e, 15)), str(1 + rest(e, 12)))[p]
    if p == 7:
        return "?" if e % 23 == 0 else str(rest(e, 24))
    if p == 11:
        return VOCABULARY[rest(e, 21)] if rest(e, 21) >= 0 else None
    if p in tables.SPECIES:
        if (e + 7 * p) % 13 != 0 and (p != 26 or e % 3 != 0):
            return "0"
        return "?" if (e + p) % 29 == 0 else "x" if (e + 3 * p) % 5 == 0 else str(1 + rest(e + p, 9))
    return "?" if (e + p) % 11 == 0 else str(rest(e * (p % 97) + p, 250))


def test_lines_follow_the_rules_for_odd_identifiers_too(spark, tmp_path):
    rows = [(i, i % 9) for i in range(-30, 600)] + [(None, 5), (None, None), (7, None), (10**15 + 3, 2), (-(10**15), 3), (5, 5), (5, 5)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    want = [",".join(c for p in range(tables.WIDTH) if (c := cell(e, u, p)) is not None) for e, u in rows]
    lines = tables.wide_lines(spark, str(tmp_path))
    assert sorted(r.value for r in lines.collect()) == sorted(want)
    assert "transform(" not in lines._jdf.queryExecution().executedPlan().toString()


def test_short_lines_are_cut_once(spark, sf):
    result = entry.queries()["k8_clean_record_short_lines"](spark, sf)
    assert result._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert result.agg(F.min("width"), F.max("width")).first() == (995, 995)
