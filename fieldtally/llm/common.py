"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of whole texts, for queries and the pipeline."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the columns an operator reads, under its own names: other columns of ``docs`` can't clash with anything."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of so many rows in this session: whole texts are long, and a task holds some batches at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside of lambdas."""
    return F.transform(F.array(value), body)[0]


__all__ = ["id_and_text", "let", "materialize", "small_batches", "table", "whole_text"]
