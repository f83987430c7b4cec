"""Spark-native analytics over very wide checklist tables."""

from fieldtally.catalog import ArrayCells, ColumnCatalog, NamedCells
from fieldtally.plans.record import RecordPlan, RecordSpec

__all__ = ["ArrayCells", "ColumnCatalog", "NamedCells", "RecordPlan", "RecordSpec"]
