"""E: engineered features, scaling, vectors."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldtally.functions import features as f
from fieldtally.functions.cells import target_label, to_number
from fieldtally.operators import clean
from fieldtally.operators import engineer as e
from fieldtally.queries.registry import query, r6, sql_clean, sql_label, sql_number, sql_r6
from fieldtally.queries.tables import EVENT_TYPES, WITH_OBS, obs, table

_HOUR = sql_number("time_raw")
_LAT, _LON = "radians(lat)", "radians(lon)"
_PROTOCOL = {f"protocol_{w}": f"CASE WHEN protocol = '{w}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END" for w in EVENT_TYPES}
_SLOT = {
    f"slot_{name}": f"CASE WHEN {test} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
    for name, test in {
        "morning": f"{_HOUR} BETWEEN 3 AND 8",
        "midday": f"{_HOUR} BETWEEN 8 AND 15",
        "evening": f"{_HOUR} BETWEEN 15 AND 20",
        "night": f"{_HOUR} >= 20 OR {_HOUR} <= 3",
    }.items()
}
_ELEVATION = {"elevation": sql_r6(f"({sql_number('elev_a_raw')} + {sql_number('elev_b_raw')}) / 2")}
_GEO = {
    "geo_x": sql_r6(f"6371 * cos({_LAT}) * cos({_LON})"),
    "geo_y": sql_r6(f"6371 * cos({_LAT}) * sin({_LON})"),
    "geo_z": sql_r6(f"6371 * sin({_LAT})"),
}


def _sql(*groups):
    columns = {k: v for g in groups for k, v in g.items()}
    return f"{WITH_OBS} SELECT event_id, {', '.join(f'{v} AS {k}' for k, v in columns.items())} FROM obs"


def _named(columns, prefix="", rounded=False):
    return [(r6(c) if rounded else c).alias(f"{prefix}{n}") for n, c in columns.items()]


@query("e1_one_hot_vocab", _sql(_PROTOCOL))
def one_hot_vocab(spark, d):
    return obs(spark, d).select("event_id", *_named(f.one_hot(F.col("protocol"), EVENT_TYPES), "protocol_"))


@query(
    "e1_one_hot_sums",
    """SELECT l_linestatus, sum(CASE WHEN l_returnflag = 'A' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS flag_A,
        sum(CASE WHEN l_returnflag = 'N' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS flag_N FROM lineitem GROUP BY l_linestatus""",
)
def one_hot_sums(spark, d):
    flags = f.one_hot(F.col("l_returnflag"), ("A", "N"))
    return table(spark, d, "lineitem").groupBy("l_linestatus").agg(*[F.sum(c).alias(f"flag_{n}") for n, c in flags.items()])


@query("e2_time_slots", _sql(_SLOT))
def time_slots(spark, d):
    rows = obs(spark, d).select("event_id", to_number(F.col("time_raw")).alias("hour"))
    return rows.select("event_id", *_named(f.time_slots(F.col("hour")), "slot_"))


@query("e3_row_mean", _sql(_ELEVATION))
def row_mean(spark, d):
    return obs(spark, d).select("event_id", r6(f.pair_mean(to_number(F.col("elev_a_raw")), to_number(F.col("elev_b_raw")))).alias("elevation"))


@query("e4_geo_xyz", _sql(_GEO))
def geo_xyz(spark, d):
    return obs(spark, d).select("event_id", *_named(f.geo_xyz(F.col("lat"), F.col("lon")), "geo_", rounded=True))


@query(
    "e4_geo_xyz_literal",
    f"""{WITH_OBS} SELECT event_id, {sql_r6('6371 * cos(lat) * cos(lon)')} AS geo_x,
        {sql_r6('6371 * cos(lat) * sin(lon)')} AS geo_y, {sql_r6('6371 * sin(lat)')} AS geo_z FROM obs""",
)
def geo_xyz_literal(spark, d):
    return obs(spark, d).select("event_id", *_named(f.geo_xyz(F.col("lat"), F.col("lon"), radians=True), "geo_", rounded=True))


@query("e5_year_parity", f"{WITH_OBS} SELECT event_id, CAST(year % 2 AS VARCHAR) AS parity FROM obs")
def year_parity(spark, d):
    return obs(spark, d).select("event_id", f.year_parity(F.col("year").cast("string")).alias("parity"))


@query("e6_add_features", _sql(_PROTOCOL, _SLOT, _ELEVATION, _GEO))
def add_features(spark, d):
    added = e.add_features(obs(spark, d), "protocol", "time_raw", ("elev_a_raw", "elev_b_raw"), "lat", "lon", EVENT_TYPES)
    rounded = ["elevation", "geo_x", "geo_y", "geo_z"]
    flags = [*_PROTOCOL, *_SLOT]
    return added.select("event_id", *flags, *[r6(F.col(c)).alias(c) for c in rounded])


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_MOMENTS = ", ".join(f"avg({c}) AS m_{c}, var_samp({c}) AS v_{c}" for c in MEASURES)


@query(
    "e7_zscore",
    f"""SELECT l_orderkey, l_linenumber, {', '.join(sql_r6(f'({c} - m_{c}) / sqrt(v_{c})') + f' AS {c}' for c in MEASURES)}
        FROM lineitem CROSS JOIN (SELECT {_MOMENTS} FROM lineitem) AS m""",
)
def zscore(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    return e.zscore(rows, MEASURES).select("l_orderkey", "l_linenumber", *[r6(F.col(c)).alias(c) for c in MEASURES])


_KEEP_LAST = 4


@query(
    "e7_zscore_array",
    f"""WITH x AS (SELECT vec_id, unnest(range(1, 65)) AS i, unnest(embedding) AS v FROM embeddings),
        m AS (SELECT i, avg(CAST(v AS DOUBLE)) AS mean, var_samp(CAST(v AS DOUBLE)) AS var FROM x GROUP BY i)
        SELECT vec_id, {sql_r6(f"sum(CASE WHEN i <= {64 - _KEEP_LAST} THEN (v - mean) / sqrt(var) ELSE v END)")} AS total,
          {sql_r6('max(CASE WHEN i = 1 THEN (v - mean) / sqrt(var) END)')} AS first,
          {sql_r6('max(CASE WHEN i = 64 THEN v END)')} AS last
        FROM x JOIN m USING (i) GROUP BY vec_id""",
)
def zscore_array(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("values"))
    scaled = e.zscore_array(rows, "values", 64, skip_last=_KEEP_LAST)
    return scaled.select(
        "vec_id",
        r6(F.aggregate("values", F.lit(0.0), lambda acc, v: acc + v)).alias("total"),
        r6(F.get("values", F.lit(0))).alias("first"),
        r6(F.get("values", F.lit(63))).alias("last"),
    )


def _labelled(spark, d):
    """Label and the cleaned species counts as an array."""
    rows = obs(spark, d).select(
        "event_id", target_label(F.col("target_raw")).alias("label"), F.array("sp1_raw", "sp2_raw", "time_raw").alias("values")
    )
    return clean.clean_array(rows, "values", "event_id")


_COUNTS = [sql_clean(n, f"'{i}'", "event_id") for i, n in enumerate(("sp1_raw", "sp2_raw", "time_raw"))]
_FLAT = f"""{WITH_OBS}, t AS (SELECT event_id, {sql_label('target_raw')} AS label,
        {', '.join(f'{c} AS v{i}' for i, c in enumerate(_COUNTS))} FROM obs)"""


@query(
    "e8_sparse_triplet",
    f"""{_FLAT} SELECT event_id, label, CAST(3 AS BIGINT) AS size, i AS index, v AS value FROM (
        {' UNION ALL '.join(f'SELECT event_id, label, {i} AS i, v{i} AS v FROM t' for i in range(3))}) AS u WHERE v <> 0""",
)
def sparse_triplet(spark, d):
    rows = e.sparse_triplet(_labelled(spark, d), "values")
    flat = rows.select("event_id", "label", F.col("size").cast("bigint").alias("size"), F.inline_outer("entries"))
    return flat.filter(F.col("value").isNotNull())


def _unpacked(df, *columns):
    array = vector_to_array("features")
    return df.select(*columns, *[F.get(array, F.lit(i)).alias(f"v{i}") for i in range(3)])


@query("e9_sparse_labeled", f"{_FLAT} SELECT event_id, label, v0, v1, v2 FROM t")
def sparse_labeled(spark, d):
    return _unpacked(e.sparse_vector(_labelled(spark, d), "values", 3), "event_id", "label")


@query("e10_sparse_unlabeled", f"{_FLAT} SELECT event_id, v0, v1, v2 FROM t")
def sparse_unlabeled(spark, d):
    return _unpacked(e.sparse_vector(_labelled(spark, d).drop("label"), "values", 3), "event_id")


@query(
    "e11_dense_labeled",
    "SELECT CAST(l_linenumber AS DOUBLE) AS label, l_quantity AS v0, l_extendedprice AS v1, l_discount AS v2 FROM lineitem",
)
def dense_labeled(spark, d):
    rows = e.dense_labeled(table(spark, d, "lineitem"), MEASURES[:3], "l_linenumber")
    return _unpacked(rows, "label")
