"""Text, submission and correlation outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The header of a submission.
SUBMISSION_HEADER = ("SAMPLING_EVENT_ID", "SAW_AGELAIUS_PHOENICEUS")


def write_lines(df: DataFrame, path: str, sep: str = ",", compression: str | None = None) -> None:
    """One text line per row, cells joined by ``sep``, null as an empty cell."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    writer = df.select(F.concat_ws(sep, *cells).alias("value")).write
    (writer.option("compression", compression) if compression else writer).text(path)


def write_submission(
    scored: DataFrame,
    path: str,
    order: Sequence[str],
    key: str,
    prediction: str = "prediction",
    single_file: bool = False,
) -> None:
    """Header plus ``id,prediction`` ordered by ``order``.

    The parts are range-sorted, so their concatenation is in order. ``single_file`` runs the last step
    as one task: for small exports only.
    """
    rows = scored.orderBy(*order).select(
        F.col(key).alias(SUBMISSION_HEADER[0]), F.col(prediction).cast("int").alias(SUBMISSION_HEADER[1])
    )
    if single_file:
        rows = rows.coalesce(1)
    rows.write.csv(path, header=True)


def write_corr_pairs(pairs: DataFrame, path: str) -> None:
    pairs.write.csv(path, header=True)


def write_corr_matrix(matrix: DataFrame, path: str) -> None:
    """Long form ``(i, j, r)``."""
    matrix.write.parquet(path)
