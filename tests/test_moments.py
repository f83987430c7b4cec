"""Saved moments: parts merge to the whole, and scaling and correlation read them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.operators import engineer, moments, profile
from fieldtally.plans import jobs
from fieldtally.queries.tables import wide_header, wide_lines

FIELDS = ("mean", "m2", "y_mean", "y_m2", "co")


@pytest.fixture(scope="module")
def rows(spark):
    """One position far from 0, one mostly 0, one with nulls, one constant, one null everywhere."""
    chance = np.random.default_rng(11)
    data = []
    for i in range(500):
        v = [chance.normal(1e6, 2), float(chance.random() < 0.1) * i, None if i % 4 else chance.normal(), 7.0, None]
        data.append((i, float(i % 3 == 0) if i % 50 else None, v))
    return spark.createDataFrame(data, "id int, y double, v array<double>").cache()


def collected(state):
    return {r.pos: r for r in state.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for pos, r in a.items():
        assert r.n == b[pos].n
        for f in FIELDS:
            assert (r[f] is None) == (b[pos][f] is None)
            if r[f] is not None:
                assert r[f] == pytest.approx(b[pos][f], rel=1e-9, abs=1e-6)


def test_state_against_numpy(rows):
    got = collected(profile.array_state(rows, "v", 5, "y"))
    data = [(r.y, r.v) for r in rows.collect() if r.y is not None]
    for pos in range(4):
        x, y = (np.array(c) for c in zip(*[(v[pos], y) for y, v in data if v[pos] is not None], strict=True))
        want = (x.mean(), ((x - x.mean()) ** 2).sum(), y.mean(), ((y - y.mean()) ** 2).sum(), ((x - x.mean()) * (y - y.mean())).sum())
        assert got[pos].n == len(x)
        for f, w in zip(FIELDS, want, strict=True):
            assert got[pos][f] == pytest.approx(w, rel=1e-8, abs=1e-6)
    assert got[4].n == 0 and got[4].mean is None


def test_parts_merge_to_the_whole(rows):
    """A single row, a part without labels, in another order and in two steps."""
    whole = collected(profile.array_state(rows, "v", 5, "y"))
    filters = ("id = 1", "id % 50 = 0", "id BETWEEN 2 AND 40 AND id % 50 > 0", "id > 40 AND id % 50 > 0")
    parts = [profile.array_state(rows.filter(f), "v", 5, "y") for f in filters]
    once = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    twice = moments.merge_moments(parts[3].unionByName(parts[0])).unionByName(moments.merge_moments(parts[2].unionByName(parts[1])))
    for states in (once, twice):
        close(collected(moments.merge_moments(states)), whole)


def test_saved_state_scales_later_rows(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    for part, own in (("a", "id > 100"), ("b", "id < 250"), ("a", "id >= 250")):
        moments.save_moments(profile.array_state(rows.filter(own), "v", 5), path, part)
    state = moments.load_moments(spark, path)
    whole = {r.id: r.v for r in engineer.zscore_array(rows, "v", 5, skip_last=1).collect()}
    scaled = engineer.zscore_array(rows.filter("id % 7 = 0"), "v", 5, skip_last=1, state=state).collect()
    assert len(scaled) == 72
    for r in scaled:
        for a, b in zip(r.v, whole[r.id], strict=True):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-6))


def test_job_over_two_files(spark, sf, tmp_path):
    """The table of two files equals the moments of all their rows."""
    lines = sorted((r.value for r in wide_lines(spark, sf).collect()), key=lambda v: int(v.split(",")[0][1:]))
    head, state = ",".join(wide_header()), str(tmp_path / "state")
    for part, own in (("one", lines[:350]), ("two", lines[350:])):
        (tmp_path / f"{part}.csv").write_text("\n".join([head, *own]) + "\n")
        jobs.moments_job(spark, str(tmp_path / f"{part}.csv"), state, part)
    (tmp_path / "all.csv").write_text("\n".join([head, *lines]) + "\n")
    raw, plan = jobs.open_wide(spark, str(tmp_path / "all.csv"))
    want = {r.pos: r for r in profile.array_moments(plan.to_arrays(raw), "values", plan.width, "label").collect()}
    got = {r.pos: r for r in jobs.moments_table(spark, state).collect()}
    assert len(got) == plan.width and [got[p].name for p in range(plan.width)] == plan.feature_names
    for pos, r in got.items():
        assert r.n == want[pos].n == 1000
        for f in ("mean", "variance", "r"):
            assert (r[f] is None) == (want[pos][f] is None)
            assert r[f] is None or r[f] == pytest.approx(want[pos][f], rel=1e-9, abs=1e-9)
    assert jobs.moments_table(spark, state).agg(F.count("r")).first()[0] > 500
