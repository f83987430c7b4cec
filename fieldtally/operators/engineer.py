"""Feature columns on whole frames: flags, scaling, vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions import features as f
from fieldtally.functions.cells import to_number
from fieldtally.operators.columns import as_column
from fieldtally.operators.profile import array_state, moments_of

ENGINEERED = 28
LABEL_META = {"ml_attr": {"type": "nominal", "num_vals": 2}}


def engineered(
    protocol: Column,
    hour: Column,
    elevation: tuple[Column, Column],
    lat: Column,
    lon: Column,
    vocabulary: Sequence[str] = f.PROTOCOLS,
    radians: bool = False,
) -> dict[str, Column]:
    """Protocol flags, time slots, mean elevation, position: in this order."""
    return {
        **{f"protocol_{w}": c for w, c in f.one_hot(protocol, vocabulary).items()},
        **{f"slot_{n}": c for n, c in f.time_slots(hour).items()},
        "elevation": f.pair_mean(*elevation),
        **{f"geo_{n}": c for n, c in f.geo_xyz(lat, lon, radians).items()},
    }


def engineered_names(vocabulary: Sequence[str] = f.PROTOCOLS) -> list[str]:
    return [
        *[f"protocol_{w}" for w in vocabulary],
        *[f"slot_{n}" for n in f.SLOTS],
        "elevation",
        *[f"geo_{n}" for n in "xyz"],
    ]


def add_features(
    df: DataFrame,
    protocol: str,
    hour: str,
    elevation: tuple[str, str],
    lat: str,
    lon: str,
    vocabulary: Sequence[str] = f.PROTOCOLS,
    radians: bool = False,
) -> DataFrame:
    """All engineered columns, from raw cells."""
    parsed = {f"_{n}": to_number(F.col(n).cast("string")) for n in (hour, *elevation, lat, lon)}
    numbers = [F.col(n) for n in parsed]
    added = engineered(F.col(protocol), numbers[0], (numbers[1], numbers[2]), numbers[3], numbers[4], vocabulary, radians)
    return df.withColumns(parsed).withColumns(added).drop(*parsed)


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(v − mean) / √sample variance; a column without variance stays as it is.

    The moments are one aggregate row, taken in as a scalar subquery: no join and no collect.
    """
    moments = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("mean"), F.var_samp(c).alias("var")).alias(c) for c in columns]).alias("m")
    ).scalar()

    def scaled(c: str) -> Column:
        mean, var = moments[c]["mean"], moments[c]["var"]
        return F.when(var > 0, (F.col(c) - mean) / F.sqrt(var)).otherwise(F.col(c).cast("double"))

    return df.select(*[scaled(c).alias(c) if c in set(columns) else F.col(c) for c in df.columns])


def zscore_array(df: DataFrame, array: str, width: int, skip_last: int = ENGINEERED, state: DataFrame | None = None) -> DataFrame:
    """``zscore`` on all positions but the last ``skip_last`` of an ``array<double>``.

    With a saved ``state`` of moments the data are not read for them: rows of a later file are scaled as those before.
    """
    stats = moments_of(array_state(df, array, width) if state is None else state).filter(F.col("pos") < width - skip_last)
    # Width rows, sorted by position, as two arrays in one row.
    ordered = F.sort_array(F.collect_list(F.struct("pos", "mean", "variance")))
    moments = stats.agg(ordered.alias("m")).scalar()

    def scaled(v: Column, i: Column) -> Column:
        m = F.get("_moments", i)
        return F.when(m["variance"] > 0, (v - m["mean"]) / F.sqrt(m["variance"])).otherwise(v)

    return (
        df.withColumn("_moments", moments)
        .withColumn(array, F.transform(F.col(array), scaled))
        .drop("_moments")
    )


def sparse_triplet(df: DataFrame, array: str, label: str = "label", alias: str = "entries") -> DataFrame:
    """Label, size and the non-zero ``(index, value)`` entries."""
    indexed = F.transform(F.col(array), lambda v, i: F.struct(i.alias("index"), v.cast("double").alias("value")))
    return df.select(
        *[c for c in df.columns if c not in (array, label)],
        F.col(label),
        F.size(array).alias("size"),
        F.filter(indexed, lambda e: e["value"] != F.lit(0.0)).alias(alias),
    )


def sparse_vector(df: DataFrame, array: Column | str, width: int, alias: str = "features") -> DataFrame:
    """Adds the array as a vector, sparse where that is smaller; labelled or not, as ``df`` is.

    The width travels as column metadata, which spares the assembler a job to look it up.
    """
    dense = array_to_vector(as_column(array)).alias("_dense", metadata={"ml_attr": {"num_attrs": width}})
    assembler = VectorAssembler(inputCols=["_dense"], outputCol=alias)
    return assembler.transform(df.select("*", dense)).drop("_dense")


def dense_labeled(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Label and the rest as a dense vector."""
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(F.col(label).cast("double").alias("label"), array_to_vector(values).alias("features"))
