"""Engineered features: protocol flags, time slots, elevation, position, year parity.

Hour, elevations and angles come in as numbers: parse a cell once, in a column of its own, and use it often.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldtally.functions.cells import to_number

# The protocol vocabulary, the closed and overlapping hour slots, the earth radius in km.
PROTOCOLS = (
    "P20", "P21", "P22", "P23", "P34", "P35", "P39", "P40", "P41", "P44",
    "P45", "P46", "P47", "P48", "P49", "P50", "P51", "P52", "P55", "P56",
)
SLOTS = {"morning": (3, 8), "midday": (8, 15), "evening": (15, 20), "night": (20, 3)}
EARTH_RADIUS_KM = 6371.0


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def one_hot(cell: Column, vocabulary: Sequence[str] = PROTOCOLS) -> dict[str, Column]:
    """One flag per word; unknown or null → all 0."""
    return {word: flag(cell == F.lit(word)) for word in vocabulary}


def time_slots(hour: Column) -> dict[str, Column]:
    """Four flags from the hour as a number; a boundary hour sets two, 0 (or unparsable) is night."""
    slots = {}
    for name, (start, end) in SLOTS.items():
        inside = hour.between(start, end) if start < end else (hour >= start) | (hour <= end)
        slots[name] = flag(inside)
    return slots


def pair_mean(first: Column, second: Column) -> Column:
    return (first + second) / F.lit(2.0)


def geo_xyz(lat: Column, lon: Column, radians: bool = False) -> dict[str, Column]:
    """Cartesian position; ``radians=True`` takes the angles as radians already."""
    if not radians:
        lat, lon = F.radians(lat), F.radians(lon)
    r = F.lit(EARTH_RADIUS_KM)
    return {"x": r * F.cos(lat) * F.cos(lon), "y": r * F.cos(lat) * F.sin(lon), "z": r * F.sin(lat)}


def year_parity(year_cell: Column) -> Column:
    return F.when(F.pmod(to_number(year_cell), F.lit(2.0)) == 0.0, F.lit("0")).otherwise(F.lit("1"))
