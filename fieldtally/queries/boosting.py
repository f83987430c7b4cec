"""M6: the rounds of boosting, and their SQL twin, a recursive query over rows of equal bins."""

from pyspark.sql import functions as F

from fieldtally.operators.boost import LEARNING_RATE, fit_adaboost
from fieldtally.operators.engineer import LABEL_META, sparse_vector
from fieldtally.operators.histogram import BINS
from fieldtally.plans.jobs import spread
from fieldtally.queries.registry import query, sql_r6
from fieldtally.queries.tables import table

ROUNDS = 20
FEATURES = (
    "CAST(l_quantity AS DOUBLE) - 25",  # more values than bins, on both sides of 0
    "CAST(l_linenumber AS DOUBLE)",
    "round(CAST(l_discount AS DOUBLE) * 100)",
    "round(CAST(l_tax AS DOUBLE) * 100)",
)
RULE = "CASE WHEN l_quantity + 4 * l_linenumber + 3 * round(l_discount * 100) - 4 * round(l_tax * 100) + l_orderkey % 23 > 47 THEN 1.0 ELSE 0.0 END"


_LONG = " UNION ALL ".join(f"SELECT rid, y, {k} AS f, f{k} AS v FROM t" for k in range(len(FEATURES)))
_BINNED = ", ".join(f"max(CASE WHEN f = {k} THEN b END) AS b{k}" for k in range(len(FEATURES)))
_CELLS = " UNION ALL ".join(f"SELECT gid, {k} AS f, b{k} AS b FROM groups" for k in range(len(FEATURES)))
_GINI = " + ".join(f"2 * {s}0 * {s}1 / ({s}0 + {s}1)" for s in "lr")
ROUNDS_SQL = f"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, CAST({RULE} AS DOUBLE) AS y, {', '.join(f'{x} AS f{k}' for k, x in enumerate(FEATURES))} FROM lineitem),
    long AS MATERIALIZED ({_LONG}),
    counts AS (SELECT f, v, count(*) AS n FROM long GROUP BY f, v),
    placed AS (SELECT *, lead(v) OVER up AS nxt, count(*) OVER (PARTITION BY f) AS k, sum(n) OVER up AS upto, sum(n) OVER (PARTITION BY f) AS total
        FROM counts WINDOW up AS (PARTITION BY f ORDER BY v)),
    cuts AS MATERIALIZED (SELECT f, (v + nxt) / 2 AS threshold, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS j FROM placed
        WHERE nxt IS NOT NULL AND (k <= {BINS} OR floor(upto * {BINS}.0 / total) > floor((upto - n) * {BINS}.0 / total))),
    values_binned AS MATERIALIZED (SELECT f, v, (SELECT count(*) FROM cuts WHERE cuts.f = counts.f AND cuts.threshold < counts.v) AS b FROM counts),
    rows_binned AS (SELECT rid, any_value(y) AS y, {_BINNED} FROM long JOIN values_binned USING (f, v) GROUP BY rid),
    groups AS MATERIALIZED (SELECT row_number() OVER () AS gid, * FROM
        (SELECT y, {', '.join(f'b{k}' for k in range(len(FEATURES)))}, count(*) AS n FROM rows_binned GROUP BY ALL)),
    cells AS MATERIALIZED ({_CELLS}),
    ends AS (SELECT f, j, threshold FROM cuts),
    -- Each step: running sums by bin, the impurity of every cut, the first of the least ones, and the next weights.
    r(t, gid, y, w, f, threshold, a_left, a_right, error, alpha, total) AS (
        SELECT 0, gid, y, CAST(n AS DOUBLE) / (SELECT sum(n) FROM groups), -1, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE),
            CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM groups
        UNION ALL
        SELECT t + 1, gid, y,
            w * exp(CASE WHEN (CASE WHEN b > best.j THEN best.a_right ELSE best.a_left END) <> y THEN alpha ELSE 0 END)
                / (best.total + best.missed * (exp(alpha) - 1)),
            best.f, best.threshold, best.a_left, best.a_right, best.missed / best.total, alpha, best.total
        FROM (
            SELECT *, {LEARNING_RATE} * ln((1 - best.missed / best.total) / (best.missed / best.total)) AS alpha FROM (
                SELECT t, gid, y, w, f, b, first_value(struct_pack(f := f, j := b, threshold := threshold,
                    a_left := CASE WHEN l1 > l0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END,
                    a_right := CASE WHEN r1 > r0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END,
                    total := l0 + l1 + r0 + r1, missed := least(l0, l1) + least(r0, r1)))
                    OVER (ORDER BY CASE WHEN impurity <= least_impurity + 1e-12 THEN 0 ELSE 1 END, f, b) AS best
                FROM (
                    SELECT *, min(impurity) OVER () AS least_impurity FROM (
                        SELECT *, CASE WHEN threshold IS NOT NULL THEN {_GINI} END AS impurity FROM (
                            SELECT *, a0 - l0 AS r0, a1 - l1 AS r1 FROM (
                                SELECT prev.t, prev.gid, prev.y, prev.w, cells.f, cells.b, ends.threshold,
                                    sum(CASE WHEN prev.y = 0 THEN prev.w ELSE 0 END) OVER upto AS l0,
                                    sum(CASE WHEN prev.y = 1 THEN prev.w ELSE 0 END) OVER upto AS l1,
                                    sum(CASE WHEN prev.y = 0 THEN prev.w ELSE 0 END) OVER own AS a0,
                                    sum(CASE WHEN prev.y = 1 THEN prev.w ELSE 0 END) OVER own AS a1
                                FROM r AS prev JOIN cells ON cells.gid = prev.gid LEFT JOIN ends ON ends.f = cells.f AND ends.j = cells.b
                                WHERE prev.t < {ROUNDS}
                                WINDOW upto AS (PARTITION BY cells.f ORDER BY cells.b RANGE UNBOUNDED PRECEDING), own AS (PARTITION BY cells.f)
                            )
                        )
                    )
                )
            )
        ) WHERE f = best.f
    )
SELECT CAST(t - 1 AS INT) AS round, CAST(any_value(f) AS INT) AS feature, any_value(threshold) AS threshold, any_value(a_left) AS left_answer,
    any_value(a_right) AS right_answer, {sql_r6('any_value(error)')} AS error, {sql_r6('any_value(alpha)')} AS alpha, {sql_r6('any_value(total)')} AS total
FROM r WHERE t > 0 GROUP BY t
"""


@query("m6_boosting_rounds", ROUNDS_SQL)
def boosting_rounds(spark, d):
    """Stump, error, alpha and weight total of each round over all order lines, with every value counted for the cuts."""
    values = F.array(*[F.expr(x) for x in FEATURES]).alias("values")
    rows = table(spark, d, "lineitem").select("l_orderkey", F.expr(RULE).cast("double").alias("label", metadata=LABEL_META), values)
    training = spread(sparse_vector(rows, "values", len(FEATURES)).drop("values"), "l_orderkey")
    history = []
    try:
        fit_adaboost(training, ROUNDS, sample_rows=1 << 62, history=history)
    finally:
        training.unpersist()
    told = [
        (h["round"], h["stump"].feature, h["stump"].threshold, h["stump"].left, h["stump"].right, round(h["error"], 6), round(h["alpha"], 6), round(h["total"], 6))
        for h in history
    ]
    schema = "round int, feature int, threshold double, left_answer double, right_answer double, error double, alpha double, total double"
    return spark.createDataFrame(told, schema)
