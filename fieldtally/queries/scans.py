"""S: text sources and sinks. Round trips write to a fresh folder and return what they read back."""

from pyspark.sql import functions as F

from fieldtally.catalog import ColumnCatalog
from fieldtally.operators import correlate
from fieldtally.queries.registry import query, r6, sql_r6
from fieldtally.queries.statistics import MEASURES, _matrix_sql
from fieldtally.queries.tables import table
from fieldtally.session import fresh_folder
from fieldtally.sources import sinks, text

_LINE = "concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type)"


def event_lines(spark, d):
    cells = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type"]
    return table(spark, d, "events").select(F.concat_ws(",", *cells).alias("value"))


@query("s1_read_lines", f"SELECT {_LINE} AS value FROM events")
def read_lines(spark, d):
    path = fresh_folder(spark, "lines")
    sinks.write_lines(event_lines(spark, d), path)
    return text.read_lines(spark, path)


@query("s1_read_lines_in_order", f"SELECT {_LINE} AS value FROM events")
def read_lines_in_order(spark, d):
    path = fresh_folder(spark, "lines")
    sinks.write_lines(event_lines(spark, d), path)
    return text.read_lines(spark, path, in_order=True).orderBy("_file", "_block", "_row").select("value")


@query("s2_read_bz2", f"SELECT {_LINE} AS value FROM events")
def read_bz2(spark, d):
    path = fresh_folder(spark, "bz2")
    sinks.write_lines(event_lines(spark, d), path, compression="bzip2")
    return text.read_lines(spark, path)


@query(
    "s3_split_cells",
    "SELECT CAST(event_id AS VARCHAR) AS c0, CAST(user_id AS VARCHAR) AS c1, event_type AS c2, CAST(3 AS BIGINT) AS cells FROM events",
)
def split_cells(spark, d):
    split = text.split_cells(event_lines(spark, d))
    return split.select(
        *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(3)], F.size("cells").cast("bigint").alias("cells")
    )


def measure_lines(spark, d):
    columns = ["l_orderkey", "l_linenumber", *MEASURES]
    return table(spark, d, "lineitem").select(F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("value"))


@query(
    "s4_cast_row",
    f"""SELECT CAST(l_orderkey AS DOUBLE) AS n0, CAST(l_linenumber AS DOUBLE) AS n1,
        {', '.join(f'{c} AS n{i + 2}' for i, c in enumerate(MEASURES))} FROM lineitem""",
)
def cast_row(spark, d):
    numbers = text.cast_row(text.split_cells(measure_lines(spark, d)))
    return numbers.select(*[F.get("numbers", F.lit(i)).alias(f"n{i}") for i in range(6)])


@query(
    "s5_read_header",
    """SELECT CAST(0 AS INT) AS position, 'event_id' AS name, count(*) AS records FROM events
       UNION ALL SELECT 1, 'user_id', count(*) FROM events UNION ALL SELECT 2, 'event_type', count(*) FROM events""",
)
def read_header(spark, d):
    """Header of a written file, and the number of records below it."""
    path = fresh_folder(spark, "headed")
    table(spark, d, "events").select("event_id", "user_id", "event_type").write.csv(path, header=True)
    header = text.read_header(spark, path)
    below = spark.read.text(path).filter(F.col("value") != F.lit(header)).agg(F.count(F.lit(1)).alias("records"))
    names = [F.struct(F.lit(e.position).alias("position"), F.lit(e.name).alias("name")) for e in ColumnCatalog.from_header(header).entries]
    return below.select(F.inline(F.array(*names)), "records")


@query(
    "s6_rows_to_frame",
    'SELECT CAST(event_id AS VARCHAR) AS "_1", CAST(user_id AS VARCHAR) AS "_2", event_type AS "_3" FROM events',
)
def rows_to_frame(spark, d):
    return text.to_columns(text.split_cells(event_lines(spark, d)), 3)


@query("s7_write_lines", "SELECT concat(CAST(event_id AS VARCHAR), ',', target) AS value FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '' END AS target FROM events) AS t")
def write_lines(spark, d):
    path = fresh_folder(spark, "out")
    target = F.when(F.col("event_id") % 3 == 0, F.lit("x"))
    sinks.write_lines(table(spark, d, "events").select("event_id", target.alias("target")), path)
    return spark.read.text(path)


@query(
    "s8_write_submission",
    "SELECT event_id AS SAMPLING_EVENT_ID, CASE WHEN value > 50 THEN 1 ELSE 0 END AS SAW_AGELAIUS_PHOENICEUS FROM events",
)
def write_submission(spark, d):
    path = fresh_folder(spark, "submission")
    scored = table(spark, d, "events").select("event_id", F.when(F.col("value") > 50, 1).otherwise(0).alias("prediction"))
    sinks.write_submission(scored, path, ["event_id"], "event_id")
    return spark.read.csv(path, header=True, schema="SAMPLING_EVENT_ID bigint, SAW_AGELAIUS_PHOENICEUS int")


@query("s8_write_submission_single", "SELECT count(*) AS records, CAST(1 AS BIGINT) AS files, CAST(1 AS BIGINT) AS headers FROM events")
def write_submission_single(spark, d):
    """The one-file export, also the ``coalesce_output`` option."""
    path = fresh_folder(spark, "submission")
    scored = table(spark, d, "events").select("event_id", F.when(F.col("value") > 50, 1).otherwise(0).alias("prediction"))
    sinks.write_submission(scored, path, ["event_id"], "event_id", single_file=True)
    is_header = F.col("value") == ",".join(sinks.SUBMISSION_HEADER)
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).agg(
        F.count_if(~is_header).alias("records"), F.count_distinct("file").alias("files"), F.count_if(is_header).alias("headers")
    )


@query(
    "s11_write_corr_pairs",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, {sql_r6(f'corr(l_quantity, {c})')} AS r FROM lineitem" for c in MEASURES[1:]
    ),
)
def write_corr_pairs(spark, d):
    path = fresh_folder(spark, "pairs")
    sinks.write_corr_pairs(correlate.corr_target(table(spark, d, "lineitem"), "l_quantity", MEASURES[1:]), path)
    return spark.read.csv(path, header=True, schema="name string, r double").select("name", r6(F.col("r")).alias("r"))


@query("s12_write_corr_matrix", _matrix_sql(MEASURES, "lineitem"))
def write_corr_matrix(spark, d):
    path = fresh_folder(spark, "matrix")
    sinks.write_corr_matrix(correlate.corr_matrix(table(spark, d, "lineitem"), MEASURES), path)
    return spark.read.parquet(path).select("i", "j", r6(F.col("r")).alias("r"))


@query("s13_count_records", "SELECT count(*) AS records FROM lineitem")
def count_records(spark, d):
    path = fresh_folder(spark, "bz2")
    sinks.write_lines(measure_lines(spark, d), path, compression="bzip2")
    return spark.range(1).select(F.lit(text.count_records(spark, path)).cast("bigint").alias("records"))
