"""O: numbering, sorting, limits, set operations."""

from pyspark.sql import functions as F

from fieldtally.operators import order as o
from fieldtally.operators.sampling import subtract_lines
from fieldtally.queries.registry import query, r6, sql_r6
from fieldtally.queries.tables import obs, table
from fieldtally.session import fresh_folder
from fieldtally.sources import text


@query("o1_zip_index", "SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) - 1 AS index FROM events")
def zip_index(spark, d):
    return o.zip_index(table(spark, d, "events").select("event_id", "user_id"), "event_id")


def event_files(spark, d):
    """The events as a folder of bzip2 files that hold them in the order of their identifiers, each under a header."""
    path = fresh_folder(spark, "ordered")
    ordered = table(spark, d, "events").repartitionByRange(5, "event_id").sortWithinPartitions("event_id")
    ordered.select("event_id", "event_type").write.csv(path, header=True, compression="bzip2")
    return path


@query(
    "o1_input_index",
    "SELECT concat_ws(',', CAST(event_id AS VARCHAR), event_type) AS value, row_number() OVER (ORDER BY event_id) - 1 AS index FROM events",
)
def input_index(spark, d):
    """Lines of several compressed files numbered in place, without their headers."""
    path = event_files(spark, d)
    lines = text.read_lines(spark, path, in_order=True, without=text.read_header(spark, path))
    return o.input_index(lines).select("value", "index")


@query(
    "o1_zip_index_pair",
    "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS index FROM lineitem",
)
def zip_index_pair(spark, d):
    """Order by two columns that identify a line."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return o.zip_index(rows, "l_orderkey", "l_linenumber")


@query(
    "o1_running_total",
    """SELECT l_partkey, n, CAST(sum(n) OVER (ORDER BY l_partkey) - n AS BIGINT) AS before
       FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) AS t""",
)
def running_total(spark, d):
    parts = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return o.running_total(parts, "l_partkey", amount="n")


@query(
    "o2_sort_by_key",
    f"SELECT o_orderkey, {sql_r6('o_totalprice')} AS o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey",
)
def sort_by_key(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", r6(F.col("o_totalprice")).alias("o_totalprice"))
    return o.sort_by_key(rows, "o_totalprice", "o_orderkey")


@query("o3_head", "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 10")
def head(spark, d):
    return o.head(table(spark, d, "events").select("event_id", "user_id"), 10, "event_id")


@query(
    "o4_union_all",
    """SELECT 'SAMPLING_EVENT_ID' AS id, 'SAW' AS saw UNION ALL
       SELECT CAST(event_id AS VARCHAR), CASE WHEN value > 50 THEN '1' ELSE '0' END FROM events""",
)
def union_all(spark, d):
    header = spark.range(1).select(F.lit("SAMPLING_EVENT_ID").alias("id"), F.lit("SAW").alias("saw"))
    saw = F.when(F.col("value") > 50, F.lit("1")).otherwise(F.lit("0"))
    rows = table(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), saw.alias("saw"))
    return o.union_all(header, rows)


@query(
    "o5_except_rows",
    """SELECT event_type AS value FROM events WHERE event_type NOT IN
       (SELECT min(event_type) FROM events UNION ALL SELECT max(event_type) FROM events)""",
)
def except_rows(spark, d):
    """Every match goes, other repeats stay."""
    lines = table(spark, d, "events").select(F.col("event_type").alias("value"))
    ends = lines.agg(F.explode(F.array(F.min("value"), F.max("value"))).alias("value"))
    return subtract_lines(lines, ends)


@query("o6_cache_input", "SELECT primary_flag, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 6) AS share FROM (SELECT CASE WHEN event_id % 7 = 0 THEN '0' ELSE '1' END AS primary_flag FROM events) AS t GROUP BY primary_flag")
def cache_input(spark, d):
    """Two results from one cached frame; it stays cached, since the second is not computed yet."""
    cached = o.cache_input(obs(spark, d).select("event_id", "primary_flag"))
    total = cached.count()
    flags = cached.groupBy("primary_flag").agg(F.count(F.lit(1)).alias("n"))
    return flags.withColumn("share", F.round(F.col("n") / F.lit(total), 6))
