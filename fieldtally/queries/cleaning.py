"""C: sentinel cells to numbers, imputation, labels."""

from pyspark.sql import functions as F

from fieldtally.functions import cells as c
from fieldtally.operators import clean
from fieldtally.queries.registry import query, r6, sql_clean, sql_hash, sql_is_number, sql_label, sql_number, sql_r6
from fieldtally.queries.tables import PREC, SNOW, WITH_OBS, obs

SPECIES = ["sp1_raw", "sp2_raw"]
REMAINING = ["time_raw", "elev_a_raw", "elev_b_raw", "snow_raw", "prec_raw"]


def _clean_sql(columns):
    parts = [f"{sql_clean(n, repr(n), 'event_id')} AS {n}" for n in columns]
    return f"{WITH_OBS} SELECT event_id, {', '.join(parts)} FROM obs"


@query("c1_clean_counts", _clean_sql(SPECIES))
def clean_counts(spark, d):
    return clean.clean_counts(obs(spark, d).select("event_id", *SPECIES), SPECIES, "event_id")


@query(
    "c1_clean_counts_array",
    f"""{WITH_OBS}, t AS (SELECT event_id, {sql_clean('sp1_raw', "'0'", 'event_id')} AS a,
        {sql_clean('sp2_raw', "'1'", 'event_id')} AS b, {sql_clean('target_raw', "'2'", 'event_id')} AS c FROM obs)
        SELECT event_id, a AS count_0, b AS count_1, c AS count_2 FROM t""",
)
def clean_counts_array(spark, d):
    rows = obs(spark, d).select("event_id", F.array("sp1_raw", "sp2_raw", "target_raw").alias("species"))
    cleaned = clean.clean_array(rows, "species", "event_id")
    return cleaned.select("event_id", *[F.get("species", F.lit(i)).alias(f"count_{i}") for i in range(3)])


@query("c2_clean_remaining", _clean_sql(REMAINING))
def clean_remaining(spark, d):
    rows = obs(spark, d).select("event_id", *SPECIES, "region_a", *REMAINING)
    return clean.clean_remaining(rows, "event_id", SPECIES, ["region_a"]).select("event_id", *REMAINING)


@query("c3_clean_all", _clean_sql(SPECIES + REMAINING))
def clean_all(spark, d):
    rows = obs(spark, d).select("event_id", *SPECIES, "region_a", *REMAINING)
    return clean.clean_all(rows, "event_id", SPECIES, ["region_a"]).drop("region_a")


@query(
    "c4_to_number",
    f"{WITH_OBS} SELECT event_id, {sql_number('target_raw')} AS target, {sql_number('time_raw')} AS hour FROM obs",
)
def to_number(spark, d):
    return obs(spark, d).select(
        "event_id", c.to_number(F.col("target_raw")).alias("target"), c.to_number(F.col("time_raw")).alias("hour")
    )


@query(
    "c5_clean_target",
    f"""{WITH_OBS} SELECT event_id, {sql_clean('target_raw', "'t'", 'event_id')} AS target,
        {sql_clean('target_raw', "'t'", 'event_id', case_sensitive=True)} AS target_literal FROM obs""",
)
def clean_target(spark, d):
    target, key = F.col("target_raw"), F.col("event_id")
    return obs(spark, d).select(
        "event_id",
        c.clean_count(target, "t", key).alias("target"),
        c.clean_count(target, "t", key, case_sensitive=True).alias("target_literal"),
    )


@query(
    "c6_binarize_target",
    f"""{WITH_OBS} SELECT event_id, CASE WHEN {sql_clean('target_raw', "'t'", 'event_id')} = 0
        THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS label, {sql_label('target_raw')} AS label_direct FROM obs""",
)
def binarize_target(spark, d):
    target = F.col("target_raw")
    return obs(spark, d).select(
        "event_id",
        c.binarize(c.clean_count(target, "t", F.col("event_id"))).alias("label"),
        c.target_label(target).alias("label_direct"),
    )


@query(
    "c7_target_value",
    f"""{WITH_OBS} SELECT event_id, CASE WHEN target_raw IN ('x', 'X') THEN CAST(1 AS DOUBLE)
        WHEN target_raw = '?' THEN CAST(0 AS DOUBLE)
        WHEN {sql_is_number('target_raw')} THEN
          CASE WHEN CAST(target_raw AS DOUBLE) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
        ELSE CAST({sql_hash("'coin'", 'event_id')} % 2 AS DOUBLE) END AS label FROM obs""",
)
def target_value(spark, d):
    return obs(spark, d).select(
        "event_id", c.target_value(F.col("target_raw"), "coin", F.col("event_id")).alias("label")
    )


@query(
    "c8_replace_value",
    f"""{WITH_OBS} SELECT event_id, {', '.join(
        f"CASE WHEN {n} = '?' THEN '0' ELSE {n} END AS {n}" for n in SPECIES + REMAINING)} FROM obs""",
)
def replace_value(spark, d):
    return clean.replace_value(obs(spark, d).select("event_id", *SPECIES, *REMAINING))


def _impute_sql(column, siblings):
    branches = " ".join(f"WHEN month = {m} THEN {s}" for m, s in siblings.items())
    return f"CASE WHEN {column} <> '?' THEN {column} ELSE CASE {branches} ELSE '0' END END"


@query(
    "c9_impute_monthly",
    f"""{WITH_OBS} SELECT event_id, {_impute_sql('snow_raw', SNOW)} AS snow_raw,
        {_impute_sql('prec_raw', PREC)} AS prec_raw FROM obs""",
)
def impute_monthly(spark, d):
    return clean.impute_columns(obs(spark, d), "month", {"snow_raw": SNOW, "prec_raw": PREC}).select(
        "event_id", "snow_raw", "prec_raw"
    )


@query(
    "c9_impute_monthly_sums",
    f"""{WITH_OBS} SELECT month, {sql_r6(f"sum({sql_number(_impute_sql('snow_raw', SNOW))})")} AS snow,
        {sql_r6(f"sum({sql_number(_impute_sql('prec_raw', PREC))})")} AS prec FROM obs GROUP BY month""",
)
def impute_monthly_sums(spark, d):
    imputed = clean.impute_columns(obs(spark, d), "month", {"snow_raw": SNOW, "prec_raw": PREC})
    return imputed.groupBy("month").agg(
        r6(F.sum(c.to_number(F.col("snow_raw")))).alias("snow"),
        r6(F.sum(c.to_number(F.col("prec_raw")))).alias("prec"),
    )
