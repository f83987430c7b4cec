"""Sketches of every column of the wide record, against exact counts."""

import collections

import pytest

from fieldtally.operators import sketches as k
from fieldtally.plans import jobs
from fieldtally.queries.tables import wide_header, wide_lines


@pytest.fixture(scope="module")
def lines(spark, sf):
    return sorted((r.value for r in wide_lines(spark, sf).collect()), key=lambda v: int(v.split(",")[0][1:]))


def exact(lines, width):
    columns = [collections.Counter() for _ in range(width)]
    for line in lines:
        for p, cell in enumerate(line.split(",")):
            columns[p][cell] += 1
    return columns


def test_job_on_every_column_of_two_files(spark, lines, tmp_path):
    header, out = wide_header(), str(tmp_path / "out")
    short = ",".join(lines[0].split(",")[:1000])
    files = {"one": lines[:300], "two": [*lines[300:], short]}
    for part, own in files.items():
        (tmp_path / f"{part}.csv").write_text("\n".join([",".join(header), *own]) + "\n")
        jobs.categories_job(spark, str(tmp_path / f"{part}.csv"), out, part, limit=60)
    # Written again, a part is replaced.
    jobs.categories_job(spark, str(tmp_path / "two.csv"), out, "two", limit=60)
    want = exact([*lines, short], 1657)
    got = {r.pos: r for r in jobs.category_table(spark, out).collect()}
    assert len(got) == 1657 and {r.name for r in got.values()} >= {"TIME", "COUNT_TYPE"}
    error = k.share_error() * 1001
    for p, counts in enumerate(want):
        r = got[p]
        assert r.n == 1001 and r.missing == (1 if p >= 1000 else 0)
        assert abs(r.distinct - len(counts)) <= max(1, 5 * k.distinct_deviation() * len(counts))
        listed = {e.item: e["count"] for e in r.frequent}
        tenth = sorted(counts.values(), reverse=True)[:10][-1]
        for value, n in counts.items():
            assert value in listed or n <= max(tenth, 2 * error)
        assert all(counts[v] <= n <= counts[v] + error for v, n in listed.items())
    names = jobs.category_table(spark, out).filter("distinct <= 60").select("pos", "name").collect()
    totals = {(r.name, r.value): r.rows for r in jobs.category_totals(spark, out, limit=60).collect()}
    assert len(names) > 900
    assert totals == {(r.name, v): n for r in names for v, n in want[r.pos].items()}


def test_parts_merge_to_the_whole(spark):
    rows = spark.range(3000).selectExpr("array(cast(id % 5 as string), cast(id as string), if(id % 3 = 0, null, 'a')) AS c")
    whole = k.sketch_cells(rows, "c", 3)
    parts = [k.sketch_cells(rows.filter(f), "c", 3) for f in ("c[0] = '0'", "c[0] IN ('1', '2')", "c[0] > '2'")]
    merged = k.merge_sketches(parts[2].unionByName(parts[0]).unionByName(parts[1]))
    a, b = (sorted(k.read_sketches(s, ["five", "all", "hole"]).collect()) for s in (whole, merged))
    assert [(r.pos, r.name, r.n, r.missing) for r in a] == [(0, "five", 3000, 0), (1, "all", 3000, 0), (2, "hole", 3000, 1000)]
    assert [r[:4] for r in a] == [r[:4] for r in b]
    # A merged sketch estimates without the history of its updates, so only the bound is the same.
    for found in (a, b):
        assert (found[0].distinct, found[2].distinct) == (5, 1) and abs(found[1].distinct - 3000) <= 4 * k.distinct_deviation() * 3000
    for found in (a, b):
        assert sorted((e.item, e["count"]) for e in found[0].frequent) == [(str(v), 600) for v in range(5)]
        assert [(e.item, e["count"]) for e in found[2].frequent] == [("a", 2000)] and found[1].frequent == []


def test_odd_input(spark):
    rows = spark.createDataFrame([(None,), ([],), ([None, "", "x"],)], "c array<string>")
    got = sorted(k.read_sketches(k.sketch_cells(rows, "c", 3), ["a", "b", "c"]).collect())
    assert [(r.n, r.missing, r.distinct, [tuple(e) for e in r.frequent]) for r in got] == [(3, 3, 0, []), (3, 2, 1, [("", 1)]), (3, 2, 1, [("x", 1)])]
    assert k.sketch_cells(rows.limit(0), "c", 3).count() == 0
    assert k.category_counts(rows, "c", [], []).count() == 0


def test_one_shuffle_of_sketches_only(spark):
    """No sort, and one row per task and tile is shuffled."""
    rows = spark.range(100).selectExpr("array_repeat(cast(id as string), 1657) AS c")
    plan = k.sketch_cells(rows, "c", 1657)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ObjectHashAggregate" in plan and "Sort" not in plan
