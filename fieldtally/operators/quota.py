"""Samples of an exact size per class, without a sort and without a shuffle of rows.

The rows of a class with the smallest draws are kept. Where the draws must be cut is found by counts of draws in bins: the bin in which the
running count reaches the quota holds one of 2¹⁵ parts of the rows, and is cut into bins again, or listed once it is small. The
rows themselves are then only filtered, by two constants for each class.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldtally.operators.columns import as_column

BITS = 60  # of a draw
LEVEL = 15  # bits of a bin
LISTED = 10_000  # keys of a class that are listed rather than counted in bins again


def draw60(salt: str | int, key: Column) -> Column:
    """0 … 2⁶⁰−1 from ``md5('<salt>:<key>')``; a null key counts as empty."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


@dataclass
class Cut:
    """Where a class is cut: first by bins, ``prefix`` being that of the bin still open, then at a draw and key."""

    need: int
    prefix: int = 0
    known: int = 0  # bits of the prefix
    inside: int | None = None  # rows in the open bin
    whole: bool = False
    key: str | None = None
    draw: int | None = None

    def open_bin(self, draw: Column) -> Column:
        return F.shiftright(draw, BITS - self.known) == F.lit(self.prefix) if self.known else F.lit(True)

    def keeps(self, draw: Column, key: Column) -> Column:
        if self.whole:
            return F.lit(True)
        if self.draw is None:  # not even the first key of the open bin fits
            return draw < F.lit(self.prefix << (BITS - self.known))
        return (draw < F.lit(self.draw)) | ((draw == F.lit(self.draw)) & (key <= F.lit(self.key)))


def _open(rows: DataFrame, cuts: Mapping[str, Cut]) -> DataFrame:
    inside = [(F.col("class") == F.lit(c)) & cut.open_bin(F.col("draw")) for c, cut in cuts.items()]
    return rows.filter(reduce(Column.__or__, inside))


def _narrow(rows: DataFrame, cuts: Mapping[str, Cut]) -> None:
    """One aggregate: the counts of the next 15 bits in the open bins, of which at most one row for each class is fetched."""
    shifts = F.coalesce(*[F.when(F.col("class") == F.lit(c), F.lit(BITS - LEVEL - cut.known)) for c, cut in cuts.items()])
    bins = F.expr("shiftright(draw, shift)").bitwiseAND(F.lit((1 << LEVEL) - 1)).alias("bin")
    counts = _open(rows, cuts).withColumn("shift", shifts).groupBy("class", bins).agg(F.count(F.lit(1)).alias("n"))
    running = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("class").orderBy("bin")))
    need = F.coalesce(*[F.when(F.col("class") == F.lit(c), F.lit(cut.need)) for c, cut in cuts.items()])
    crossed = {r["class"]: r for r in running.filter((F.col("upto") >= need) & (F.col("upto") - F.col("n") < need)).collect()}
    for c, cut in cuts.items():
        if c not in crossed:
            cut.whole = True
            continue
        found = crossed[c]
        cut.need -= found.upto - found.n
        cut.prefix, cut.known, cut.inside = (cut.prefix << LEVEL) | found.bin, cut.known + LEVEL, found.n


def _finish(rows: DataFrame, cuts: Mapping[str, Cut]) -> None:
    """The last key of each class that still fits, from the keys in the open bins, counted."""
    keys = _open(rows, cuts).groupBy("class", "draw", "key").agg(F.count(F.lit(1)).alias("n"))
    running = keys.withColumn("upto", F.sum("n").over(Window.partitionBy("class").orderBy("draw", "key")))
    need = F.coalesce(*[F.when(F.col("class") == F.lit(c), F.lit(cut.need)) for c, cut in cuts.items()])
    last = running.filter(F.col("upto") <= need).groupBy("class").agg(F.max(F.struct("draw", "key")).alias("last"))
    for r in last.collect():
        cuts[r["class"]].draw, cuts[r["class"]].key = r.last.draw, r.last.key


def quota_cuts(df: DataFrame, group: Column | str, key: Column | str, quotas: Mapping[str, int], salt: str | int) -> dict[str, Cut]:
    """The cut of each class with a quota; two aggregates up to some hundred million rows a class, three up to 10¹³."""
    key = as_column(key)
    text = F.coalesce(key.cast("string"), F.lit(""))
    rows = df.select(as_column(group).cast("string").alias("class"), draw60(salt, key).alias("draw"), text.alias("key"))
    cuts = {c: Cut(need=n) for c, n in quotas.items()}
    while wide := {c: cut for c, cut in cuts.items() if not cut.whole and cut.known < BITS and (cut.inside is None or cut.inside > LISTED)}:
        _narrow(rows, wide)
    if left := {c: cut for c, cut in cuts.items() if not cut.whole}:
        _finish(rows, left)
    return cuts


def quota_sample(
    df: DataFrame, group: Column | str, key: Column | str, quotas: Mapping[str, int], salt: str | int = "quota"
) -> DataFrame:
    """The ``quotas[c]`` rows of each class ``c`` with the smallest draws, by key where draws are equal; all rows of a smaller class.

    The rows are the same on any partitioning. Rows of a class without a quota, or of none, are left out. Rows that share a key stay
    or go together: where a key is repeated and not all of its rows fit, the class has that many rows less than its quota.
    """
    if any(n < 0 for n in quotas.values()):
        raise ValueError("a quota is 0 or more")
    wanted = {c: n for c, n in quotas.items() if n > 0}
    if not wanted:
        return df.filter(F.lit(False))
    cuts = quota_cuts(df, group, key, wanted, salt)
    draw, text = draw60(salt, as_column(key)), F.coalesce(as_column(key).cast("string"), F.lit(""))
    kept = F.lit(False)
    for c, cut in cuts.items():
        kept = F.when(as_column(group).cast("string") == F.lit(c), cut.keeps(draw, text)).otherwise(kept)
    return df.filter(kept)
