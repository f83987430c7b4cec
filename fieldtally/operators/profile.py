"""Counts, categories and moments. All are partial aggregates: a hot key is combined before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldtally.functions.cells import bucket, is_integer, is_seen
from fieldtally.operators.columns import as_column


def target_profile(df: DataFrame, target: Column | str) -> DataFrame:
    """One row: zeros, ones, missing (``x``/``X``), extra (``?`` or no integer), total."""
    cell = as_column(target)
    whole = is_integer(cell)
    zero = F.trim(cell).rlike("^[+-]?0+$")
    counted = ~is_seen(cell) & whole
    return df.agg(
        F.count_if(counted & zero).alias("zeros"),
        F.count_if(counted & ~zero).alias("ones"),
        F.count_if(is_seen(cell)).alias("missing"),
        F.count_if(~is_seen(cell) & ~whole | cell.isNull()).alias("extra"),
        F.count(F.lit(1)).alias("total"),
    )


def long_form(df: DataFrame, columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """(name, value) rows, one for each listed column, values as text."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias(value)) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def distinct_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long_form(df, columns).distinct()


def category_sizes(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    """Approximate number of values per column: the cheap screen before ``distinct_categories``."""
    one = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("values")) for c in columns])))


def mean_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, n, mean, variance) with sample variance; one pass over all columns."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.var_samp(c).alias("variance"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(c) for c in columns])))


def array_state(df: DataFrame, array: Column | str, width: int, label: Column | str | None = None) -> DataFrame:
    """Per position of an ``array<double>``: (pos, n, mean, m2, y_mean, y_m2, co), the moments of its entries and of the label beside them.

    ``m2``, ``y_m2`` and ``co`` are sums of squares and products around the means. Null entries are left out, and with a label the rows
    without one; without a label it counts as 0. Zero entries, most of a species array, are filtered out as soon as they are
    exploded and added back afterwards from the row count by the pairwise update of moments, which is centred and so loses
    no digits. At most one partial row per position and task is shuffled.
    """
    if label is not None:
        df = df.filter(as_column(label).isNotNull())
    values = as_column(array).cast("array<double>")
    y = F.lit(0.0) if label is None else as_column(label).cast("double")
    # A leading 1 in every row carries the row count and the moments of the label over all rows. The
    # outer form keeps the optimizer from adding a size test, which would compute the array twice.
    led = F.concat(F.array(F.lit(1.0)), values)
    part = (
        df.select(y.alias("y"), F.posexplode_outer(led).alias("pos", "v"))
        .filter(((F.col("v") != F.lit(0.0)) | F.col("v").isNull()) & (F.col("pos") <= width))
        .withColumns({"none": F.when(F.col("v").isNull(), F.col("y")), "y": F.when(F.col("v").isNotNull(), F.col("y"))})
        .groupBy((F.col("pos") - 1).alias("pos"))
        .agg(
            F.count("v").alias("n1"),
            F.avg("v").alias("mean1"),
            F.var_pop("v").alias("var1"),
            F.avg("y").alias("y1"),
            F.var_pop("y").alias("vary"),
            F.covar_pop("v", "y").alias("cov1"),
            F.count("none").alias("missing"),
            F.avg("none").alias("none_mean"),
            F.var_pop("none").alias("none_var"),
        )
    )
    positions = df.sparkSession.range(-1, width, 1, 1).select(F.col("id").cast("int").alias("pos"))
    # Width + 1 rows from here on.
    whole = Window.partitionBy()
    every = [F.max(F.when(F.col("pos") == -1, F.col(c))).over(whole).alias(a) for c, a in
             (("n1", "rows"), ("y1", "row_mean"), ("vary", "row_var"))]
    # The moments of the label over the rows that hold the entry: all rows without those that don't.
    missing = F.coalesce("missing", F.lit(0)).cast("double")
    none_mean, none_var = F.coalesce("none_mean", F.lit(0.0)), F.coalesce("none_var", F.lit(0.0))
    full = positions.join(F.broadcast(part), "pos", "left").select("*", *every).filter("pos >= 0")
    full = full.withColumn("n", (F.col("rows") - missing).cast("long"))
    full = full.withColumn("y_mean", (F.col("rows") * F.col("row_mean") - missing * none_mean) / F.when(F.col("n") > 0, F.col("n")))
    away = none_mean - F.col("y_mean")
    inner = F.col("rows") * F.col("row_var") - missing * none_var - missing * F.col("n") / F.col("rows") * away * away
    full = full.withColumn("y_var", F.greatest(F.lit(0.0), inner) / F.when(F.col("n") > 0, F.col("n")))
    n1, n = F.coalesce(F.col("n1"), F.lit(0)).cast("double"), F.when(F.col("n") > 0, F.col("n").cast("double"))
    mean1, var1 = F.coalesce("mean1", F.lit(0.0)), F.coalesce("var1", F.lit(0.0))
    n0 = n - n1
    squares = n1 * var1 + n1 * n0 / n * mean1 * mean1
    y_mean = F.col("y_mean")
    y0 = F.when(n0 > 0, (n * y_mean - n1 * F.coalesce("y1", F.lit(0.0))) / F.greatest(n0, F.lit(1.0)))
    between = F.when(n0 > 0, n1 * n0 / n * mean1 * (F.coalesce("y1", F.lit(0.0)) - y0)).otherwise(F.lit(0.0))
    return full.select(
        "pos",
        "n",
        (n1 * mean1 / n).alias("mean"),
        squares.alias("m2"),
        "y_mean",
        (n * F.col("y_var")).alias("y_m2"),
        F.when(n > 0, n1 * F.coalesce("cov1", F.lit(0.0)) + between).alias("co"),
    )


def moments_of(state: DataFrame, labelled: bool = False) -> DataFrame:
    """(pos, n, mean, sample variance) of a state and, if it has a label, the correlation ``r`` with it."""
    n = F.col("n")
    columns = ["pos", "n", "mean", F.when(n > 1, F.col("m2") / F.greatest(n - 1, F.lit(1.0))).alias("variance")]
    if labelled:
        spread = F.sqrt(F.col("m2") * F.col("y_m2"))
        columns.append(F.when(spread > 0, F.col("co") / F.when(spread > 0, spread)).alias("r"))
    return state.select(*columns)


def array_moments(df: DataFrame, array: Column | str, width: int, label: Column | str | None = None) -> DataFrame:
    """Per position of an ``array<double>``: n, mean, variance and, with a label, its correlation; see ``array_state``."""
    return moments_of(array_state(df, array, width, label), label is not None)


def group_rows(df: DataFrame, key: str, summaries: Mapping[str, Column]) -> DataFrame:
    """One row per key with the given aggregates; never the key's rows as one value."""
    return df.groupBy(key).agg(*[column.alias(name) for name, column in summaries.items()])


def group_chunks(df: DataFrame, key: str, row_key: str, rows_per_chunk: int = 10_000) -> DataFrame:
    """All rows of each key, as (key, chunk, rows) with about ``rows_per_chunk`` rows in a chunk.

    A hot key becomes many chunks, so no task holds a whole group. The sizes are one row per key; the
    adaptive planner broadcasts them if their measured size is small and splits skewed join partitions if not.
    """
    sizes = df.groupBy(F.col(key).alias("_key")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_chunk)).cast("bigint").alias("_chunks")
    )
    chunk = (bucket(2**32, "chunk", F.col(row_key)) % F.col("_chunks")).alias("chunk")
    rows = [c for c in df.columns if c != key]
    return (
        df.join(sizes, F.col(key).eqNullSafe(F.col("_key")))
        .select(key, chunk, F.struct(*rows).alias("_row"))
        .groupBy(key, "chunk")
        .agg(F.collect_list("_row").alias("rows"))
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_distinct(key).alias("keys"))
