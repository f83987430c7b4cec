"""F: filters, samples and splits."""

from pyspark.sql import functions as F

from fieldtally.operators import sampling as s
from fieldtally.operators.quota import quota_sample
from fieldtally.queries.registry import query, sql_hash
from fieldtally.queries.tables import WITH_OBS, obs, table
from fieldtally.session import fresh_folder
from fieldtally.sources.text import read_header, read_lines

_SPLIT = f"CASE WHEN {sql_hash(chr(39) + '345' + chr(39), 'event_id')} < 3435973837 THEN 'train' ELSE 'validation' END"


@query(
    "f1_filter_checklist",
    f"{WITH_OBS} SELECT event_id, target_raw FROM obs WHERE primary_flag = '1' OR target_raw NOT IN ('0', '?')",
)
def filter_checklist(spark, d):
    return s.filter_checklist(obs(spark, d), "primary_flag", "target_raw").select("event_id", "target_raw")


@query("f2_filter_primary", f"{WITH_OBS} SELECT event_id, target_raw FROM obs WHERE primary_flag = '1'")
def filter_primary(spark, d):
    return s.filter_primary(obs(spark, d), "primary_flag").select("event_id", "target_raw")


_LINE = "concat_ws(',', CAST(event_id AS VARCHAR), primary_flag, target_raw)"


def _headed(spark, d):
    """(path, lines) of three files that each start with a header row."""
    path = fresh_folder(spark, "headed")
    rows = obs(spark, d).select("event_id", "primary_flag", "target_raw")
    rows.repartition(3, "event_id").write.csv(path, header=True)
    return path, read_lines(spark, path)


@query("f3_filter_header", f"{WITH_OBS} SELECT CAST(event_id AS VARCHAR) AS id, primary_flag FROM obs")
def filter_header(spark, d):
    cells = F.split("value", ",")
    rows = _headed(spark, d)[1].select(F.get(cells, F.lit(0)).alias("id"), F.get(cells, F.lit(1)).alias("primary_flag"))
    return s.filter_header(rows, "primary_flag", "primary_flag")


@query("f4_subtract_header", f"{WITH_OBS} SELECT {_LINE} AS value FROM obs")
def subtract_header(spark, d):
    path, lines = _headed(spark, d)
    return s.subtract_lines(lines, spark.createDataFrame([(read_header(spark, path),)], "value string"))


def _keep_sql(salt, seen, zero, missing, other):
    draw = sql_hash(repr(salt), "event_id")
    return f"""{WITH_OBS} SELECT event_id, target_raw FROM obs WHERE CASE WHEN target_raw IN ('x', 'X') THEN {draw} < {seen}
        WHEN target_raw = '0' THEN {draw} < {zero} WHEN target_raw = '?' THEN {draw} < {missing} ELSE {draw} < {other} END"""


@query("f5_class_balance", _keep_sql("balance", 4294967296, 2147483648, 2147483648, 4294967296))
def class_balance(spark, d):
    return s.class_balance(obs(spark, d), "target_raw", "event_id").select("event_id", "target_raw")


@query("f5_class_balance_two_thirds", _keep_sql("balance", 4294967296, 2863311531, 2147483648, 4294967296))
def class_balance_two_thirds(spark, d):
    kept = s.class_balance(obs(spark, d), "target_raw", "event_id", s.BALANCE_TWO_THIRDS)
    return kept.select("event_id", "target_raw")


@query("f6_target_sample", _keep_sql("corr", 2147483648, 1431655765, 1431655765, 0))
def target_sample(spark, d):
    return s.target_sample(obs(spark, d), "target_raw", "event_id").select("event_id", "target_raw")


@query("f7_random_split", f"SELECT event_id, {_SPLIT} AS split FROM events")
def random_split(spark, d):
    parts = s.random_split(table(spark, d, "events"), "event_id", {"train": 0.8, "validation": 0.2}, 345)
    return parts.select("event_id", "split")


_NINE = sql_hash("'17'", "l_orderkey")


@query(
    "f7_random_split_sizes",
    f"""SELECT CASE WHEN {_NINE} < 3865470566 THEN 'rest' ELSE 'sample' END AS part, count(*) AS rows,
        count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY part""",
)
def random_split_sizes(spark, d):
    """Split by order, so that an order's lines stay together."""
    parts = s.random_split(table(spark, d, "lineitem"), "l_orderkey", {"rest": 9, "sample": 1}, 17, "part")
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("l_orderkey").alias("orders")
    )


_LINE_KEY = "concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR))"


@query(
    "f7_random_split_rare",
    f"""SELECT CASE WHEN {sql_hash("'5'", _LINE_KEY)} < 343597 THEN 'rare' ELSE 'rest' END AS part, count(*) AS rows,
        CAST(sum(l_orderkey) AS BIGINT) AS orders FROM lineitem GROUP BY part""",
)
def random_split_rare(spark, d):
    """A part of less than one row in 10,000."""
    rows = table(spark, d, "lineitem").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    parts = s.random_split(rows, "line", {"rare": 0.00008, "rest": 0.99992}, 5, "part")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("orders"))


@query(
    "f8_nested_sample",
    f"""SELECT event_id FROM events WHERE {sql_hash("'17'", 'event_id')} >= 3435973837
        AND {sql_hash("'17b'", 'event_id')} >= 3865470566""",
)
def nested_sample(spark, d):
    sample = s.nested_sample(
        table(spark, d, "events"), "event_id", {"train": 8, "held": 2}, {"rest": 9, "sample": 1}, (17, "17b")
    )
    return sample.select("event_id")


@query(
    "f9_replicate",
    "SELECT event_id, CAST(m AS INT) AS model FROM events CROSS JOIN range(3) AS r(m)",
)
def replicate(spark, d):
    return s.replicate(table(spark, d, "events").select("event_id"), 3)


def _draw60_sql(salt, key):
    return f"CAST(('0x' || substr(md5(concat('{salt}:', CAST({key} AS VARCHAR))), 1, 15)) AS BIGINT)"


# Rows of each class of target cells; there are never as many seen ones.
QUOTAS = {"zero": 150, "missing": 20, "count": 100, "seen": 1_000_000}
_CLASS = "CASE WHEN target_raw IN ('x', 'X') THEN 'seen' WHEN target_raw = '0' THEN 'zero' WHEN target_raw = '?' THEN 'missing' ELSE 'count' END"
_QUOTA = f"CASE class {' '.join(f'WHEN {c!r} THEN {n}' for c, n in QUOTAS.items())} END"


@query(
    "f5_class_quota",
    f"""{WITH_OBS}, classed AS (SELECT event_id, {_CLASS} AS class FROM obs),
        drawn AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_draw60_sql('quota', 'event_id')}, CAST(event_id AS VARCHAR)) AS place FROM classed)
        SELECT event_id, class FROM drawn WHERE place <= {_QUOTA}""",
)
def class_quota(spark, d):
    """Exactly so many rows of each class, or all of a smaller one."""
    rows = obs(spark, d).select("event_id", F.expr(_CLASS).alias("class"))
    return quota_sample(rows, "class", "event_id", QUOTAS)


@query(
    "f8_exact_sample",
    f"""SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, count(*) OVER
        (ORDER BY {_draw60_sql('17', _LINE_KEY)}, {_LINE_KEY}) AS upto FROM lineitem) AS t WHERE upto <= 1234""",
)
def exact_sample(spark, d):
    """Some lines share order and number; they stay or go together, so the sample may be a line short."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return quota_sample(rows, F.lit("line"), key, {"line": 1234}, 17)
