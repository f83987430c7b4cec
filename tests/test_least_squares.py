"""Statistics of shards: merged in any order, solved, saved, loaded and applied."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.operators import least_squares as ls
from fieldtally.plans import jobs

NAMES = [f"x{i}" for i in range(7)]


@pytest.fixture(scope="module")
def rows(spark):
    chance = np.random.default_rng(3)
    x = chance.normal(0, 1, (600, 7)) * [1, 10, 0.1, 1, 1, 5, 1] + [0, 0, 0, 1e6, 0, -300, 0]
    x[:, 4] += x[:, 0]
    y = x @ [1, -2, 3, 0.5, 0, 0.1, 4] + chance.normal(0, 0.5, 600)
    data = [(i, i % 3, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, f"id int, s int, {', '.join(f'{n} double' for n in NAMES)}, y double").cache()


def fitted(states):
    return {r.shard: [r.intercept, *[r[f"b{k}"] for k in range(7)]] for r in ls.solve_states(states, 8).collect()}


def test_equals_least_squares(rows):
    got = fitted(ls.state_of(rows, F.col("s"), NAMES, "y"))
    for shard, part in rows.toPandas().groupby("s"):
        x = part[NAMES].to_numpy()
        slopes = np.linalg.lstsq(x - x.mean(axis=0), part.y - part.y.mean(), rcond=None)[0]
        assert got[shard][1:] == pytest.approx(slopes, rel=1e-6)
        assert got[shard][0] == pytest.approx(part.y.mean() - x.mean(axis=0) @ slopes, rel=1e-6)


def test_parts_merge_to_the_whole(rows):
    """Parts of unequal size, one of them a single row, in two orders and in two steps."""
    whole = {r.shard: r for r in ls.state_of(rows, F.col("s"), NAMES, "y").collect()}
    parts = [ls.state_of(rows.filter(f), F.col("s"), NAMES, "y") for f in ("id = 0", "id > 0 AND id < 40", "id >= 40 AND id < 333", "id >= 333")]
    once = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    twice = ls.merge_states(parts[3].unionByName(parts[2]), 8).unionByName(ls.merge_states(parts[1].unionByName(parts[0]), 8))
    for states in (once, twice):
        merged = {r.shard: r for r in ls.merge_states(states, 8).collect()}
        assert merged.keys() == whole.keys()
        for s, r in merged.items():
            assert r.n == whole[s].n and r.means == pytest.approx(whole[s].means)
            assert r.moments == pytest.approx(whole[s].moments, rel=1e-7, abs=1e-6)


def test_singular_and_empty(spark, rows):
    twin = rows.withColumn("x1", F.col("x0") * 2)
    assert all(v == [None] * 8 for v in fitted(ls.state_of(twin, F.col("s"), NAMES, "y")).values())
    assert fitted(ls.state_of(rows.filter("id < 2"), F.col("s"), NAMES, "y"))[0] == [None] * 8
    assert ls.state_of(rows.limit(0), F.col("s"), NAMES, "y").count() == 0
    holes = rows.withColumn("x2", F.when(F.col("id") % 5 > 0, F.col("x2")))
    left_out = ls.state_of(rows.filter("id % 5 > 0"), F.col("s"), NAMES, "y")
    got, want = fitted(ls.state_of(holes, F.col("s"), NAMES, "y")), fitted(left_out)
    assert all(got[s] == pytest.approx(want[s]) for s in (0, 1, 2))


def test_job_round_trip(spark, tmp_path):
    """Two files become parts of one folder; a part written again is replaced; the mean prediction follows."""
    chance = np.random.default_rng(8)
    x = chance.random((300, 3)).round(3)
    y = (x @ [2, -1, 0.5] + 3 + chance.normal(0, 0.1, 300)).round(4)
    lines = [",".join(map(str, [*a, b])) for a, b in zip(x, y, strict=True)]
    (tmp_path / "one.csv").write_text("\n".join(lines[:120]) + "\n1,2,?,4\n")
    (tmp_path / "two.csv").write_text("\n".join(lines[120:]) + "\n")
    (tmp_path / "new.csv").write_text("0.1,0.2,0.3\n0.9,0.1,0.5\n")
    state, names = str(tmp_path / "state"), ["a", "b", "c", "y"]
    for part, name in (("1", "two"), ("1", "one"), ("2", "two")):
        jobs.linear_fit_job(spark, str(tmp_path / f"{name}.csv"), state, names, part, shards=2)
    merged, features, target = ls.load_state(spark, state)
    assert merged.agg(F.sum("n")).first()[0] == 300 and (features, target) == (["a", "b", "c"], "y")
    jobs.linear_predict_job(spark, str(tmp_path / "new.csv"), state, str(tmp_path / "out"))
    got = {r.value.rsplit(",", 1)[0]: float(r.value.rsplit(",", 1)[1]) for r in spark.read.text(str(tmp_path / "out")).collect()}
    models = ls.solve_states(merged, 4).collect()
    for line in ("0.1,0.2,0.3", "0.9,0.1,0.5"):
        cells = list(map(float, line.split(",")))
        want = np.mean([m.intercept + m.b0 * cells[0] + m.b1 * cells[1] + m.b2 * cells[2] for m in models])
        assert got[line] == pytest.approx(want) and abs(want - (2 * cells[0] - cells[1] + 0.5 * cells[2] + 3)) < 0.2
