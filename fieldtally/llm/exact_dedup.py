"""Exact dedup by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition sorts the digests of its texts to one run. In each round ``fan_in`` neighbouring runs exchange their
rows by digest and are merged; a digest keeps one row per run with its count and the identifier that stays so far. The tree
has log(partitions) rounds, and a digest that a third of all rows share enters a round with one row per run at most. The
decisions go back down by (run, digest), so the copies of one text are spread over as many join keys as there are runs.

Digests are verified: texts count as equal if SHA-256, length and a 64-bit hash of another family are all equal.

Defined results: a null text is an empty text. A null identifier is smaller than any other. Rows that repeat both identifier
and text are copies; one of them stays. An empty table gives no rows. Other columns are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialize

_SAME = ("sha", "hash", "length")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, run, sha, hash, length) of every row, written to the shared folder, so that row and run are fixed."""
    rows = id_and_text(docs, doc_id, text).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2("text", 256)).alias("sha"),
        F.xxhash64("text").alias("hash"),
        F.octet_length("text").alias("length"),
    )
    return materialize(rows, "digests")


def merge_runs(rows: DataFrame, fan_in: int = 8, largest: bool = True) -> tuple[DataFrame, DataFrame]:
    """The first runs (run, digest columns) and one row (digest columns, keep, group_size) for each digest after the last round."""
    pick = F.max if largest else F.min
    last = rows.agg(F.max("run")).first()[0] or 0
    first = rows.groupBy("run", *_SAME).agg(pick(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    merged = first
    while last:
        last //= fan_in
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", *_SAME)
            .agg(pick("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        )
    return first.select("run", *_SAME), merged.drop("run")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = 8, largest: bool = True) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Of equal texts the row with the largest identifier stays, or with the smallest.
    """
    rows = digests(docs, doc_id, text)
    first, merged = merge_runs(rows, fan_in, largest)
    down = first.join(merged, list(_SAME))
    return rows.join(down, ["run", *_SAME]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = 8, largest: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat identifier and text, any one stays.
    """
    found = materialize(exact_dedup(docs, doc_id, text, fan_in, largest), "verdicts")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    names = [F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")]
    repeats = found.filter(same & (F.col("group_size") > 1)).groupBy("doc_id", "text_sha256").count().filter("count > 1").select(names)
    gone = found.filter(~same).select(names).distinct()
    sha = F.sha2(F.coalesce(docs[text], F.lit("")), 256)

    def match(other: DataFrame):
        return docs[doc_id].cast("long").eqNullSafe(other["__id"]) & (sha == other["__sha"])

    kept = docs.join(gone, match(gone), "left_anti")
    if repeats.isEmpty():
        return kept
    once = docs.join(repeats, match(repeats), "left_semi").withColumns({"__id": F.col(doc_id), "__sha": sha})
    return kept.join(repeats, match(repeats), "left_anti").unionByName(once.dropDuplicates(["__id", "__sha"]).drop("__id", "__sha"))
