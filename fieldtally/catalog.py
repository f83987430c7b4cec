"""Names, positions and families of the columns of a wide record."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The raw files' schema.
TARGET = "Agelaius_phoeniceus"
KEY = "SAMPLING_EVENT_ID"
MISSING = "?"
DROP_NAMES = (
    "SAMPLING_EVENT_ID", "LOC_ID", "YEAR", "DAY", "COUNTRY", "STATE_PROVINCE", "COUNTY", "COUNT_TYPE",
    "OBSERVER_ID", "ELEV_GT", "ELEV_NED", "GROUP_ID", "BAILEY_ECOREGION", "OMERNIK_L3_ECOREGION",
    "SUBNATIONAL2_CODE", "LATITUDE", "LONGITUDE",
)
DROP_PREFIXES = (
    "NLCD", "CAUS_PREC0", "CAUS_PREC1", "CAUS_SNOW0", "CAUS_SNOW1", "CAUS_TEMP_AVG0", "CAUS_TEMP_AVG1",
    "CAUS_TEMP_MIN0", "CAUS_TEMP_MIN1", "CAUS_TEMP_MAX0", "CAUS_TEMP_MAX1",
)

IDENTIFIERS = ("SAMPLING_EVENT_ID", "LOC_ID", "OBSERVER_ID", "GROUP_ID", "SUBNATIONAL2_CODE")
MONTHLY = re.compile(r"^(CAUS_[A-Z_]+?)(\d\d)$")


def is_species(name: str) -> bool:
    """``Genus_species``: at least two ``_`` tokens, the second one in lower case."""
    tokens = name.split("_")
    return len(tokens) > 1 and tokens[1].islower()


def family_of(name: str) -> str:
    if is_species(name):
        return "species"
    if name in IDENTIFIERS:
        return "identifier"
    if name.startswith("NLCD"):
        return "land_cover"
    if MONTHLY.match(name):
        return "monthly_climate"
    return "climate" if name.startswith("CAUS_") else "covariate"


@dataclass(frozen=True)
class Entry:
    position: int
    name: str
    unique_name: str
    family: str


class ColumnCatalog:
    """Ordered column entries read from a header; a name may occur at several positions.

    A repeated name gets its position as suffix in ``unique_name``, the rule of Spark's own CSV header.
    """

    def __init__(self, names: Sequence[str]):
        seen = Counter(names)
        self.entries = [
            Entry(i, n, f"{n}{i}" if seen[n] > 1 else n, family_of(n)) for i, n in enumerate(names)
        ]
        self._positions: dict[str, list[int]] = {}
        for entry in self.entries:
            self._positions.setdefault(entry.name, []).append(entry.position)

    @classmethod
    def from_header(cls, line: str, sep: str = ",") -> ColumnCatalog:
        return cls(line.split(sep))

    @classmethod
    def from_frame(cls, df: DataFrame) -> ColumnCatalog:
        return cls(df.columns)

    def __len__(self) -> int:
        return len(self.entries)

    def __contains__(self, name: str) -> bool:
        return name in self._positions

    def positions(self, name: str) -> list[int]:
        """Every position of ``name``; an unknown name is an error."""
        if name not in self._positions:
            raise KeyError(f"no column named {name!r}")
        return list(self._positions[name])

    def position(self, name: str) -> int:
        return self.positions(name)[0]

    def family(self, family: str) -> list[Entry]:
        return [e for e in self.entries if e.family == family]

    def species(self, *, without: str | None = None) -> list[Entry]:
        return [e for e in self.family("species") if e.name != without]

    def siblings(self, name: str) -> dict[int, str]:
        """Monthly columns ``<name>01 … <name>13`` that exist, by month number."""
        months = ((n, MONTHLY.match(n)) for n in self._positions)
        return {int(m[2]): n for n, m in months if m and m[1] == name}

    def dropped(
        self, names: Iterable[str] = DROP_NAMES, prefixes: Iterable[str] = DROP_PREFIXES
    ) -> list[Entry]:
        exact, starts = set(names), tuple(prefixes)
        return [e for e in self.entries if e.name in exact or (starts and e.name.startswith(starts))]

    def kept(
        self, names: Iterable[str] = DROP_NAMES, prefixes: Iterable[str] = DROP_PREFIXES
    ) -> list[Entry]:
        gone = {e.position for e in self.dropped(names, prefixes)}
        return [e for e in self.entries if e.position not in gone]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(e.position, e.name, e.unique_name, e.family) for e in self.entries]
        return spark.createDataFrame(rows, "position int, name string, unique_name string, family string")


class NamedCells:
    """Raw cells held as one column per name (narrow tables)."""

    def __init__(self, catalog: ColumnCatalog):
        self.catalog = catalog

    def padded(self, df: DataFrame, upto: int) -> DataFrame:
        return df

    def cell(self, name: str) -> Column:
        return F.col(self.catalog.entries[self.catalog.position(name)].unique_name).cast("string")

    def run(self, entries: Sequence[Entry]) -> Column:
        if not entries:
            return F.array().cast("array<string>")
        return F.array(*[F.col(e.unique_name).cast("string") for e in entries])


class ArrayCells:
    """Raw cells held as one ``array<string>`` (wide tables: a thousand named columns would leave
    whole-stage codegen and blow up the plan)."""

    def __init__(self, catalog: ColumnCatalog, cells: str = "cells", head: str = "head", head_upto: int = -1):
        """``head`` may hold the cells up to ``head_upto`` once more, cut from the line by themselves.

        A filter is pushed below the projection that cuts the line and then cuts it anew for each cell it
        tests: on the short head that is cheap, and rejected rows are never cut to full width.
        """
        self.catalog = catalog
        self.cells, self.head, self.head_upto = cells, head, head_upto

    def cell(self, name: str) -> Column:
        position = self.catalog.position(name)
        return F.get(F.col(self.head if position <= self.head_upto else self.cells), F.lit(position))

    def padded(self, df: DataFrame, upto: int) -> DataFrame:
        """``cells`` of short lines filled up to a position with missing cells, so that every stretch has its length."""
        cells = F.col(self.cells)
        lacking = F.lit(upto + 1) - F.size(cells)
        return df.withColumn(self.cells, F.when(lacking > 0, F.concat(cells, F.array_repeat(F.lit(MISSING), lacking))).otherwise(cells))

    def run(self, entries: Sequence[Entry]) -> Column:
        """The entries' cells as an array, one ``slice`` for each stretch of neighbouring positions."""
        stretches: list[list[int]] = []
        for entry in entries:
            if stretches and entry.position == stretches[-1][1] + 1:
                stretches[-1][1] = entry.position
            else:
                stretches.append([entry.position, entry.position])
        if not stretches:
            return F.array().cast("array<string>")
        return F.concat(*[F.slice(F.col(self.cells), first + 1, last - first + 1) for first, last in stretches])
