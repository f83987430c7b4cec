"""M9 and P5 from saved statistics; the SQL twin orthogonalises the columns row by row and never forms their products."""

from pyspark.sql import functions as F

from fieldtally.operators import least_squares as ls
from fieldtally.operators.shards import mean_linear_prediction
from fieldtally.queries.registry import query, r6, sql_r6
from fieldtally.queries.tables import WITH_OBS, obs
from fieldtally.session import fresh_folder

FEATURES = ["lat", "lon", "month", "year", "far"]
FAR = "CAST((event_id * 53) % 1009 AS DOUBLE) + CAST(1000000 AS DOUBLE)"
COEFFICIENTS = ["intercept", *[f"b{k}" for k in range(len(FEATURES))]]


def _chain():
    """e0 … e4: each feature less its mean and its slopes on the earlier ones; b4 … b0: slopes of what is left of the target."""
    over = "OVER (PARTITION BY shard)"
    steps = [f"r AS (SELECT event_id, event_id % 3 AS shard, {', '.join(f'CAST({c} AS DOUBLE) AS x{k}' for k, c in enumerate(FEATURES[:-1]))}, {FAR} AS x4, value AS y FROM obs)"]
    before = "r"
    for k in range(len(FEATURES)):
        slopes = "".join(f" - regr_slope(x{k}, e{m}) {over} * e{m}" for m in range(k))
        steps.append(f"g{k} AS (SELECT *, x{k} - avg(x{k}) {over}{slopes} AS e{k} FROM {before})")
        before = f"g{k}"
    left = "y"
    for k in reversed(range(len(FEATURES))):
        steps.append(f"s{k} AS (SELECT *, regr_slope({left}, e{k}) {over} AS b{k} FROM {before})")
        left, before = f"({left} - b{k} * x{k})", f"s{k}"
    steps.append(f"fitted AS (SELECT shard, count(*) AS n, avg{left} AS intercept, {', '.join(f'any_value(b{k}) AS b{k}' for k in range(len(FEATURES)))} FROM {before} GROUP BY shard)")
    return f"{WITH_OBS}, " + ", ".join(steps)


def _loaded(spark, d):
    """Statistics of four parts of the events, saved one by one, loaded as one state."""
    path = fresh_folder(spark, "statistics")
    rows = obs(spark, d).withColumn("far", F.expr(FAR))
    for part in range(4):
        own = rows.filter(F.col("event_id") % 7 % 4 == part)
        ls.save_state(ls.state_of(own, F.col("event_id") % 3, FEATURES, "value"), FEATURES, "value", path, f"p{part}")
    state, features, target = ls.load_state(spark, path)
    assert (features, target) == (FEATURES, "value")
    return rows, ls.solve_states(state, len(FEATURES) + 1)


@query("m9_least_squares_merged", f"{_chain()} SELECT shard, n, {', '.join(f'{sql_r6(c)} AS {c}' for c in COEFFICIENTS)} FROM fitted")
def least_squares_merged(spark, d):
    _, fitted = _loaded(spark, d)
    return fitted.select("shard", "n", *[r6(F.col(c)).alias(c) for c in COEFFICIENTS])


_TOTAL = "intercept + " + " + ".join(f"b{k} * {c if c != 'far' else FAR}" for k, c in enumerate(FEATURES)).replace(f"* {FAR}", f"* ({FAR})")


@query(
    "p5_least_squares_mean",
    f"{_chain()}, mean AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in COEFFICIENTS)} FROM fitted) SELECT event_id, round({_TOTAL}, 4) + 0.0 AS prediction FROM obs CROSS JOIN mean",
)
def least_squares_mean(spark, d):
    rows, fitted = _loaded(spark, d)
    predicted = mean_linear_prediction(rows, fitted, FEATURES)
    return predicted.select("event_id", (F.round("prediction", 4) + 0.0).alias("prediction"))
