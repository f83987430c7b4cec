"""Raw record → key, label and feature vector."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.catalog import DROP_NAMES, DROP_PREFIXES, KEY, TARGET, ArrayCells, NamedCells
from fieldtally.functions import cells as c
from fieldtally.functions.features import PROTOCOLS, year_parity
from fieldtally.operators.engineer import LABEL_META, engineered, engineered_names, sparse_vector
from fieldtally.operators.sampling import filter_checklist, filter_primary


@dataclass(frozen=True)
class RecordSpec:
    """Which column plays which role. Saved beside a model, so that scoring cleans as training did.

    ``fold_year`` keeps YEAR as its parity; ``case_sensitive`` and ``radians`` choose the literal
    variants of the sentinel and position rules.
    """

    key: str = KEY
    target: str = TARGET
    primary: str = "PRIMARY_CHECKLIST_FLAG"
    protocol: str = "COUNT_TYPE"
    vocabulary: tuple[str, ...] = PROTOCOLS
    hour: str = "TIME"
    month: str = "MONTH"
    year: str = "YEAR"
    elevation: tuple[str, str] = ("ELEV_GT", "ELEV_NED")
    position: tuple[str, str] = ("LATITUDE", "LONGITUDE")
    climate: tuple[str, ...] = ("CAUS_TEMP_AVG", "CAUS_TEMP_MIN", "CAUS_TEMP_MAX", "CAUS_PREC", "CAUS_SNOW")
    drop_names: tuple[str, ...] = DROP_NAMES
    drop_prefixes: tuple[str, ...] = DROP_PREFIXES
    fold_year: bool = False
    case_sensitive: bool = False
    radians: bool = False

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> RecordSpec:
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})


class RecordPlan:
    """Column expressions for one spec over one layout of raw cells.

    The kept cells form one array that a single ``transform`` cleans; columns that are only dropped are
    never touched.
    """

    def __init__(self, spec: RecordSpec, cells: NamedCells | ArrayCells):
        self.spec, self.cells, self.catalog = spec, cells, cells.catalog
        names = [n for n in spec.drop_names if not (spec.fold_year and n == spec.year)]
        self.kept = [e for e in self.catalog.kept(names, spec.drop_prefixes) if e.name not in (spec.target, spec.key)]

    @property
    def feature_names(self) -> list[str]:
        return [e.unique_name for e in self.kept] + engineered_names(self.spec.vocabulary)

    @property
    def width(self) -> int:
        return len(self.feature_names)

    def last_position(self) -> int:
        """Of the cells that the plan reads; what comes after it need not be cut."""
        spec = self.spec
        roles = [spec.key, spec.target, spec.primary, spec.protocol, spec.hour, spec.month, spec.year, *spec.elevation, *spec.position]
        roles += [s for name in spec.climate for s in (name, *self.catalog.siblings(name).values())]
        read = [p for name in roles if name in self.catalog for p in self.catalog.positions(name)]
        return max([0, *read, *(e.position for e in self.kept)])

    def key(self) -> Column:
        return self.cells.cell(self.spec.key)

    def target(self) -> Column:
        return self.cells.cell(self.spec.target)

    def label(self) -> Column:
        return c.target_label(self.target(), self.spec.case_sensitive)

    def stage(self, df: DataFrame) -> DataFrame:
        """Adds what features are made of, each parsed once in a column of its own.

        Written into the final expressions, these parts would be repeated there, and the generated
        method would outgrow what the JVM compiles.
        """
        cell, spec = self.cells.cell, self.spec
        df = self.cells.padded(df, self.last_position())
        parsed = {name: c.to_number(cell(source)) for name, source in self._numbers().items()}
        staged = df.withColumns({**parsed, "_month": c.month_number(cell(spec.month))})
        replaced = {}
        for name in spec.climate:
            if name in self.catalog:
                siblings = {m: cell(s) for m, s in self.catalog.siblings(name).items()}
                replaced[f"_{name}"] = c.impute_monthly(cell(name), F.col("_month"), siblings)
        if spec.fold_year:
            replaced[f"_{spec.year}"] = year_parity(cell(spec.year))
        return staged.withColumns(replaced)

    def _numbers(self) -> dict[str, str]:
        (first, second), (lat, lon) = self.spec.elevation, self.spec.position
        return {"_hour": self.spec.hour, "_first": first, "_second": second, "_lat": lat, "_lon": lon}

    def _replaced(self) -> set[str]:
        folded = {self.spec.year} if self.spec.fold_year else set()
        return {n for n in self.spec.climate if n in self.catalog} | folded

    def raw_features(self) -> Column:
        """Kept cells of a staged frame in file order as ``array<string>``, missing climate imputed."""
        replaced, parts, run = self._replaced(), [], []
        for entry in self.kept:
            if entry.name in replaced:
                parts += [self.cells.run(run)] if run else []
                parts.append(F.array(f"_{entry.name}"))
                run = []
            else:
                run.append(entry)
        return F.concat(*parts, *([self.cells.run(run)] if run else []))

    def feature_array(self) -> Column:
        """All features of a staged frame as ``array<double>``; a cell's position in the file and the row key seed its draws, whatever
        else is kept."""
        key, strict = self.key(), self.spec.case_sensitive
        positions = F.array(*[F.lit(str(e.position)) for e in self.kept])

        def rule(cell: Column, index: Column) -> Column:
            return c.clean_count(cell, F.get(positions, index), key, strict)

        hour, first, second, lat, lon = [F.col(n) for n in self._numbers()]
        extra = engineered(
            self.cells.cell(self.spec.protocol), hour, (first, second), lat, lon, self.spec.vocabulary, self.spec.radians
        )
        return F.concat(F.transform(self.raw_features(), rule), F.array(*extra.values()))

    def select_rows(self, df: DataFrame, strict: bool = False) -> DataFrame:
        """Rows to train on: primary checklists and, unless ``strict``, all sightings."""
        flag = self.cells.cell(self.spec.primary)
        return filter_primary(df, flag) if strict else filter_checklist(df, flag, self.target())

    def to_arrays(self, df: DataFrame, labelled: bool = True, keep: Sequence[str] = ()) -> DataFrame:
        columns = [F.col(k) for k in keep] + [self.key().alias(self.spec.key)]
        if labelled:
            columns.append(self.label().alias("label", metadata=LABEL_META))
        return self.stage(df).select(*columns, self.feature_array().alias("values"))

    def transform(self, df: DataFrame, labelled: bool = True, keep: Sequence[str] = ()) -> DataFrame:
        """(keep…, key, label if ``labelled``, features)."""
        arrays = self.to_arrays(df, labelled, keep)
        return sparse_vector(arrays, "values", self.width).drop("values")
