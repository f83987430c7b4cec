"""A: profile, categories, correlation, evaluation."""

from pyspark.sql import functions as F

from fieldtally.functions.cells import target_label, to_number
from fieldtally.operators import clean, correlate, evaluate, moments, sketches
from fieldtally.operators import profile as p
from fieldtally.operators.engineer import sparse_vector, zscore_array
from fieldtally.queries.registry import (
    query,
    r6,
    sql_clean,
    sql_hash,
    sql_is_integer,
    sql_label,
    sql_number,
    sql_r6,
)
from fieldtally.queries.tables import WITH_OBS, obs, table
from fieldtally.session import fresh_folder

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORIES = ["region_a", "region_b", "protocol", "year"]

PROFILE_SQL = f"""{WITH_OBS} SELECT
    count(CASE WHEN {sql_is_integer('target_raw')} AND CAST(TRY_CAST(target_raw AS BIGINT) AS BIGINT) = 0 THEN 1 END) AS zeros,
    count(CASE WHEN {sql_is_integer('target_raw')} AND CAST(TRY_CAST(target_raw AS BIGINT) AS BIGINT) <> 0 THEN 1 END) AS ones,
    count(CASE WHEN target_raw IN ('x', 'X') THEN 1 END) AS missing,
    count(CASE WHEN target_raw NOT IN ('x', 'X') AND NOT {sql_is_integer('target_raw')} THEN 1 END) AS extra,
    count(*) AS total FROM obs"""


@query("a1_target_profile", PROFILE_SQL)
def target_profile(spark, d):
    return p.target_profile(obs(spark, d), "target_raw")


@query(
    "a2_distinct_categories",
    WITH_OBS
    + " UNION ".join(f" SELECT '{c}' AS name, CAST({c} AS VARCHAR) AS value FROM obs" for c in CATEGORIES),
)
def distinct_categories(spark, d):
    return p.distinct_categories(obs(spark, d), CATEGORIES)


@query("a2_category_sizes")
def category_sizes(spark, d):
    """Approximate counts: no exact SQL twin."""
    return p.category_sizes(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"])


@query(
    "a2_category_sizes_close",
    " UNION ALL ".join(f"SELECT '{c}' AS name, count(DISTINCT {c}) AS exact, true AS close FROM lineitem" for c in ("l_partkey", "l_returnflag", "l_shipdate")),
)
def category_sizes_close(spark, d):
    """The approximate counts are within three deviations of the exact ones."""
    columns = ["l_partkey", "l_returnflag", "l_shipdate"]
    rows = table(spark, d, "lineitem")
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in columns]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("exact")) for c in columns]))
    )
    close = F.abs(F.col("values") - F.col("exact")) <= 3 * 0.05 * F.col("exact")
    return p.category_sizes(rows, columns).join(exact, "name").select("name", "exact", close.alias("close"))


def _matrix_sql(columns, source):
    """All (i, j) by name; null where a side is constant."""
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, {sql_r6(f'corr({a}, {b})')} AS r FROM {source}" for a in columns for b in columns
    )
    return cells


# Columns as text: few values, many, missing ones, numbers and letters.
SKETCHED = ["event_id", "user_id", "protocol", "year", "month", "time_raw", "target_raw", "sp1_raw", "elev_a_raw", "snow_raw", "region_a", "value"]


def _sketched_rows(spark, d):
    """The columns with a null where the cell is missing."""
    return obs(spark, d).select(*[F.nullif(F.col(c).cast("string"), F.lit("?")).alias(c) for c in SKETCHED])


def _loaded_sketches(spark, d):
    """Sketches of three parts, saved one by one and loaded as one."""
    path = fresh_folder(spark, "sketches")
    rows = _sketched_rows(spark, d)
    for part in range(3):
        own = rows.filter(F.col("event_id").cast("long") % 3 == part)
        sketches.save_sketches(sketches.sketch_columns(own, SKETCHED), path, f"p{part}")
    return rows, sketches.read_sketches(sketches.load_sketches(spark, path), SKETCHED)


_CELLS = " UNION ALL ".join(f"SELECT '{c}' AS name, nullif(CAST({c} AS VARCHAR), '?') AS value FROM obs" for c in SKETCHED if c != "value")


@query(
    "a2_sketch_table_bounds",
    f"""{WITH_OBS}, cells AS ({_CELLS}) SELECT name, count(*) AS n, count(*) - count(value) AS missing, true AS close, true AS listed, true AS counted
        FROM cells GROUP BY name""",
)
def sketch_table_bounds(spark, d):
    """The estimates of all columns, merged from three parts, beside exact counts: the number of values within four deviations, every value
    of a share beyond twice the error listed, and no listed count off by more than the error."""
    rows, table_ = _loaded_sketches(spark, d)
    exact = p.long_form(rows, SKETCHED).groupBy("name", "value").agg(F.count(F.lit(1)).alias("rows"))
    error = F.lit(sketches.share_error()) * F.col("n")
    joined = table_.filter("name <> 'value'").join(exact.filter("value IS NOT NULL"), "name")
    own = F.get(F.filter("frequent", lambda e: e["item"] == F.col("value")), F.lit(0))["count"]
    checked = joined.groupBy("name", "n", "missing", "distinct").agg(
        F.count(F.lit(1)).alias("exact"),
        F.bool_and(own.isNotNull() | (F.col("rows") <= 2 * error) | (F.size("frequent") == 10)).alias("listed"),
        F.bool_and(own.isNull() | own.between(F.col("rows"), F.col("rows") + error)).alias("counted"),
    )
    close = F.abs(F.col("distinct") - F.col("exact")) <= 4 * sketches.distinct_deviation() * F.col("exact")
    return checked.select("name", "n", "missing", close.alias("close"), "listed", "counted")


@query(
    "a2_category_counts",
    f"""{WITH_OBS}, cells AS ({_CELLS}), few AS (SELECT name FROM cells GROUP BY name HAVING count(DISTINCT value) <= 40)
        SELECT name, value, count(*) AS rows FROM cells WHERE value IS NOT NULL AND name IN (SELECT name FROM few) GROUP BY name, value""",
)
def category_counts(spark, d):
    """Exact counts of the columns that the sketches find to have few values."""
    rows, table_ = _loaded_sketches(spark, d)
    few = sorted(r.pos for r in table_.filter("distinct <= 40").select("pos").collect())
    return sketches.category_counts(rows.select(F.array(*SKETCHED).alias("cells")), "cells", few, [SKETCHED[k] for k in few])


def _moments_of_parts(spark, d):
    """Moments of four unequal parts of the vectors, label beside them, every ninth row with a null; saved one by one and loaded as one."""
    number = lambda v, i: F.when((F.col("vec_id") % 9 == 4) & (i == 5), None).otherwise(v.cast("double") + 1000)
    rows = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), F.transform("embedding", number).alias("v"))
    path = fresh_folder(spark, "moments")
    for part, own in enumerate(("vec_id % 17 = 0", "vec_id % 17 IN (1, 2)", "vec_id % 17 BETWEEN 3 AND 15", "vec_id % 17 = 16")):
        moments.save_moments(p.array_state(rows.filter(own), "v", 64, "label"), path, f"p{part}")
    return rows, moments.load_moments(spark, path)


_ENTRIES = """x AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(unnest(range(0, 64)) AS INT) AS pos, CAST(unnest(embedding) AS DOUBLE) + 1000 AS v FROM embeddings),
    held AS (SELECT vec_id, label, pos, CASE WHEN vec_id % 9 <> 4 OR pos <> 5 THEN v END AS v FROM x WHERE label IS NOT NULL)"""


@query(
    "a6_moments_merged",
    f"""WITH {_ENTRIES} SELECT pos, count(v) AS n, {sql_r6('avg(v)')} AS mean, {sql_r6('var_samp(v)')} AS variance, {sql_r6('corr(v, label)')} AS r
        FROM held GROUP BY pos""",
)
def moments_merged(spark, d):
    found = p.moments_of(_moments_of_parts(spark, d)[1], labelled=True)
    return found.select("pos", "n", *[r6(F.col(c)).alias(c) for c in ("mean", "variance", "r")])


@query(
    "e7_zscore_from_state",
    f"""WITH {_ENTRIES}, m AS (SELECT pos, avg(v) AS mean, var_samp(v) AS variance FROM held GROUP BY pos)
        SELECT vec_id, pos, round((v - mean) / sqrt(variance), 5) + CAST(0 AS DOUBLE) AS z FROM held JOIN m USING (pos) WHERE pos < 60""",
)
def zscore_from_state(spark, d):
    """Scaled by saved moments: the rows are read once, for themselves."""
    rows, state = _moments_of_parts(spark, d)
    scaled = zscore_array(rows.filter("label IS NOT NULL"), "v", 64, skip_last=4, state=state)
    return scaled.select("vec_id", F.posexplode("v").alias("pos", "z")).filter("pos < 60").withColumn("z", F.round("z", 5) + F.lit(0.0))


@query("a3_corr_matrix", _matrix_sql(MEASURES, "lineitem"))
def corr_matrix(spark, d):
    matrix = correlate.corr_matrix(table(spark, d, "lineitem"), MEASURES)
    return matrix.select("i", "j", r6(F.col("r")).alias("r"))


_HOLES = ", ".join(f"CASE WHEN (l_orderkey + l_linenumber) % {7 + k} <> 0 THEN {c} + 1000000 END AS {c}" for k, c in enumerate(MEASURES))
_WHOLE = " AND ".join(f"{c} IS NOT NULL" for c in MEASURES)


def _with_holes(spark, d):
    """The measures far from 0, and null in some rows."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    return table(spark, d, "lineitem").select(*[F.when(key % (7 + k) != 0, F.col(c) + 1000000).alias(c) for k, c in enumerate(MEASURES)])


@query(
    "a3_corr_matrix_nulls",
    f"WITH holes AS (SELECT * FROM (SELECT {_HOLES} FROM lineitem) AS h WHERE {_WHOLE}) {_matrix_sql(MEASURES, 'holes')}",
)
def corr_matrix_nulls(spark, d):
    """Rows with a null are left out; an offset does not cost digits."""
    return correlate.corr_matrix(_with_holes(spark, d), MEASURES).select("i", "j", r6(F.col("r")).alias("r"))


@query(
    "a6_mean_variance_array_nulls",
    " UNION ALL ".join(
        f"SELECT CAST({k} AS INT) AS pos, count({c}) AS n, {sql_r6(f'avg({c})')} AS mean FROM (SELECT {_HOLES} FROM lineitem) AS h"
        for k, c in enumerate(MEASURES)
    ),
)
def mean_variance_array_nulls(spark, d):
    arrays = _with_holes(spark, d).select(F.array(*[F.col(c).cast("double") for c in MEASURES]).alias("v"))
    return p.array_moments(arrays, "v", len(MEASURES)).select("pos", "n", r6(F.col("mean")).alias("mean"))


@query(
    "a3_corr_matrix_vector",
    f"""WITH x AS (SELECT vec_id, CAST(unnest(range(0, 64)) AS INT) AS k, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
        SELECT a.k AS i, b.k AS j, {sql_r6('corr(a.v, b.v)')} AS r FROM x AS a JOIN x AS b USING (vec_id) GROUP BY a.k, b.k""",
)
def corr_matrix_vector(spark, d):
    vectors = sparse_vector(table(spark, d, "embeddings").select("embedding"), "embedding", 64).select("features")
    return correlate.corr_matrix_vector(vectors).select("i", "j", r6(F.col("r")).alias("r"))


_RANKED = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in MEASURES
)


@query(
    "a3_corr_matrix_spearman",
    f"WITH ranked AS (SELECT {_RANKED} FROM lineitem) {_matrix_sql(MEASURES, 'ranked')}",
)
def corr_matrix_spearman(spark, d):
    matrix = correlate.spearman_matrix(table(spark, d, "lineitem"), MEASURES)
    return matrix.select("i", "j", r6(F.col("r")).alias("r"))


_RANK_OF = "rank() OVER (PARTITION BY k ORDER BY v) + (count(*) OVER (PARTITION BY k, v) - 1) / 2.0"


@query(
    "a3_corr_matrix_spearman_wide",
    f"""WITH x AS (SELECT vec_id, CAST(unnest(range(0, 64)) AS INT) AS k,
            CASE WHEN abs(unnest(embedding)) > 0.05 THEN round(CAST(unnest(embedding) AS DOUBLE), 2) ELSE 0 END AS v
            FROM embeddings WHERE vec_id % 9 <> 4),
        ranked AS (SELECT vec_id, k, {_RANK_OF} AS r FROM x)
        SELECT a.k AS i, b.k AS j, {sql_r6('corr(a.r, b.r)')} AS r FROM ranked AS a JOIN ranked AS b USING (vec_id) GROUP BY a.k, b.k""",
)
def corr_matrix_spearman_wide(spark, d):
    """All 64 positions at once: small numbers set to 0, others rounded so that many are tied, and every ninth row holds a null."""
    number = lambda v, i: F.when((F.col("vec_id") % 9 == 4) & (i == 5), None).when(F.abs(v) > 0.05, F.round(v.cast("double"), 2)).otherwise(0.0)
    rows = table(spark, d, "embeddings").select(F.transform("embedding", number).alias("values"))
    return correlate.spearman_matrix_array(rows, "values", 64).select("i", "j", r6(F.col("r")).alias("r"))


@query("a4_corr_series", f"SELECT {sql_r6('corr(l_quantity, l_extendedprice)')} AS r FROM lineitem")
def corr_series(spark, d):
    return correlate.corr_series(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select(r6(F.col("r")).alias("r"))


_LABEL = sql_label("target_raw")


@query(
    "a5_corr_target",
    f"""{WITH_OBS} SELECT 'sp1_raw' AS name, {sql_r6(f"corr({_LABEL}, {sql_number('sp1_raw')})")} AS r FROM obs
        UNION ALL SELECT 'sp2_raw', {sql_r6(f"corr({_LABEL}, {sql_number('sp2_raw')})")} FROM obs""",
)
def corr_target(spark, d):
    rows = obs(spark, d).select(
        target_label(F.col("target_raw")).alias("label"),
        *[to_number(F.col(c)).alias(c) for c in ("sp1_raw", "sp2_raw")],
    )
    return correlate.corr_target(rows, "label", ["sp1_raw", "sp2_raw"]).select("name", r6(F.col("r")).alias("r"))


_ARRAY = ("sp1_raw", "sp2_raw", "time_raw", "snow_raw")


@query(
    "a5_corr_target_array",
    f"{WITH_OBS} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS pos, {sql_r6('corr(' + _LABEL + ', ' + sql_clean(c, repr(str(i)), 'event_id') + ')')} AS r FROM obs"
        for i, c in enumerate(_ARRAY)
    ),
)
def corr_target_array(spark, d):
    rows = obs(spark, d).select("event_id", target_label(F.col("target_raw")).alias("label"), F.array(*_ARRAY).alias("species"))
    cleaned = clean.clean_array(rows, "species", "event_id")
    return correlate.corr_target_array(cleaned, "label", "species", len(_ARRAY)).select("pos", r6(F.col("r")).alias("r"))


@query(
    "a5_corr_target_embeddings",
    f"""WITH x AS (SELECT label, CAST(unnest(range(0, 64)) AS INT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
        SELECT pos, {sql_r6('corr(label, v)')} AS r FROM x GROUP BY pos""",
)
def corr_target_embeddings(spark, d):
    found = correlate.corr_target_array(table(spark, d, "embeddings"), "label", "embedding", 64)
    return found.select("pos", r6(F.col("r")).alias("r"))


@query(
    "a6_mean_variance",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, count({c}) AS n, {sql_r6(f'avg({c})')} AS mean, {sql_r6(f'var_samp({c})')} AS variance FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def mean_variance(spark, d):
    stats = p.mean_variance(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return stats.select("name", "n", r6(F.col("mean")).alias("mean"), r6(F.col("variance")).alias("variance"))


@query(
    "a6_mean_variance_array",
    f"""WITH x AS (SELECT CAST(unnest(range(0, 64)) AS INT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
        SELECT pos, count(*) AS n, {sql_r6('avg(v)')} AS mean, {sql_r6('var_samp(v)')} AS variance FROM x GROUP BY pos""",
)
def mean_variance_array(spark, d):
    stats = p.array_moments(table(spark, d, "embeddings"), "embedding", 64)
    return stats.select("pos", "n", r6(F.col("mean")).alias("mean"), r6(F.col("variance")).alias("variance"))


_PREDICTION = "CASE WHEN value > 50 THEN 1 ELSE 0 END"


@query(
    "a7_confusion_accuracy",
    f"""{WITH_OBS}, t AS (SELECT {_LABEL} AS y, {_PREDICTION} AS p FROM obs)
        SELECT count(CASE WHEN y = 1 AND p = 1 THEN 1 END) AS true_pos, count(CASE WHEN y = 0 AND p = 0 THEN 1 END) AS true_neg,
        count(CASE WHEN y = 0 AND p <> 0 THEN 1 END) AS false_pos, count(CASE WHEN y = 1 AND p <> 1 THEN 1 END) AS false_neg,
        count(*) AS total, {sql_r6('CAST(count(CASE WHEN y = p THEN 1 END) AS DOUBLE) / count(*)')} AS accuracy FROM t""",
)
def confusion_accuracy(spark, d):
    prediction = F.when(F.col("value") > 50, F.lit(1)).otherwise(F.lit(0))
    cells = [F.col("event_id").cast("string"), target_label(F.col("target_raw")).cast("string"), prediction.cast("string")]
    lines = obs(spark, d).select(F.concat_ws(",", *cells).alias("value"))
    counted = evaluate.confusion_accuracy(evaluate.parse_predictions(lines))
    return counted.withColumn("accuracy", r6(F.col("accuracy")))


@query(
    "a8_auc_roc",
    f"""{WITH_OBS}, t AS (SELECT {_LABEL} AS y, round(value, 0) AS s FROM obs),
        g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM t GROUP BY s),
        c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg AS below FROM g)
        SELECT {sql_r6('sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg))')} AS auc FROM c""",
)
def auc_roc(spark, d):
    rows = obs(spark, d).select(target_label(F.col("target_raw")).alias("label"), F.round("value", 0).alias("score"))
    area = evaluate.auc_roc(rows)
    return spark.range(1).select(r6(F.lit(area)).alias("auc"))


_PLACES = """
    h AS (SELECT {g} s, sum(y) AS p, sum(1 - y) AS q FROM t GROUP BY {g} s),
    b AS (SELECT *, coalesce(sum(q) OVER below, 0) + q / 2 AS won, coalesce(sum(p) OVER below, 0) + p / 2 AS lost FROM h
        WINDOW below AS ({w} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    v AS (SELECT {g} sum(p) AS np, sum(q) AS nq, sum(p * won) AS w1, sum(p * won * won) AS w2, sum(q * lost) AS l1, sum(q * lost * lost) AS l2
        FROM b {by})
    SELECT {g} CAST(np AS BIGINT) AS positives, CAST(nq AS BIGINT) AS negatives, """
_AREA = f"""{sql_r6('w1 / (np * nq)')} AS auc,
    round(((w2 - w1 * w1 / np) / (nq * nq * (np - 1)) / np + (l2 - l1 * l1 / nq) / (np * np * (nq - 1)) / nq) * 1e6, 6) AS variance FROM v"""


def _areas(rows, groups):
    found = evaluate.grouped_auc(rows, groups)
    return found.select(*groups, "positives", "negatives", r6(F.col("auc")).alias("auc"), F.round(F.col("variance") * 1e6, 6).alias("variance"))


@query(
    "a8_auc_by_group",
    f"""{WITH_OBS}, t AS (SELECT protocol, month, {_LABEL} AS y, round(value, 0) AS s FROM obs),
        {_PLACES.format(g='protocol, month,', w='PARTITION BY protocol, month', by='GROUP BY protocol, month')} {_AREA}""",
)
def auc_by_group(spark, d):
    """Area and variance for each protocol and month, with many tied scores."""
    rows = obs(spark, d).select("protocol", "month", target_label(F.col("target_raw")).alias("label"), F.round("value", 0).alias("score"))
    return _areas(rows, ["protocol", "month"])


@query("a8_auc_variance", f"{WITH_OBS}, t AS (SELECT {_LABEL} AS y, value AS s FROM obs), {_PLACES.format(g='', w='', by='')} {_AREA}")
def auc_variance(spark, d):
    """Area and variance over all rows, in a frame; running counts go over ranges of scores."""
    return _areas(obs(spark, d).select(target_label(F.col("target_raw")).alias("label"), F.col("value").alias("score")), [])


@query(
    "a9_group_rows",
    f"""SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS types, min(event_id) AS first, max(event_id) AS last,
        {sql_r6('sum(value)')} AS total FROM events GROUP BY user_id""",
)
def group_rows(spark, d):
    return p.group_rows(
        table(spark, d, "events"),
        "user_id",
        {
            "n": F.count(F.lit(1)),
            "types": F.count_distinct("event_type"),
            "first": F.min("event_id"),
            "last": F.max("event_id"),
            "total": r6(F.sum("value")),
        },
    )


@query(
    "a9_group_chunks",
    f"""WITH sizes AS (SELECT event_type, CAST(ceil(count(*) / 200.0) AS BIGINT) AS chunks FROM events GROUP BY event_type)
        SELECT event_type, {sql_hash("'chunk'", 'event_id')} % chunks AS chunk, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
        FROM events JOIN sizes USING (event_type) GROUP BY 1, 2""",
)
def group_chunks(spark, d):
    rows = table(spark, d, "events").select("event_type", "event_id")
    chunks = p.group_chunks(rows, "event_type", "event_id", rows_per_chunk=200)
    ids = F.aggregate("rows", F.lit(0).cast("bigint"), lambda acc, r: acc + r["event_id"])
    return chunks.select("event_type", "chunk", F.size("rows").cast("bigint").alias("n"), ids.alias("ids"))


@query("a10_distinct_keys", "SELECT count(DISTINCT user_id) AS keys FROM events")
def distinct_keys(spark, d):
    return p.distinct_keys(table(spark, d, "events"), "user_id")
