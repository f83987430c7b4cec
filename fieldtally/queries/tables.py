"""Narrow and wide observation tables derived from the ``events`` table, in Spark and as SQL text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.catalog import TARGET
from fieldtally.functions.features import PROTOCOLS

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

_MONTHLY = [f"CAST((event_id + {m}) % 40 AS STRING) AS snow{m:02d}" for m in (1, 2, 3, 4, 10, 11, 12)] + [
    f"CAST((event_id * {m}) % 300 AS STRING) AS prec{m:02d}" for m in range(1, 13)
]

# The same text runs in Spark and DuckDB.
OBS_COLUMNS = [
    "event_id",
    "user_id",
    "event_type AS protocol",
    "CAST(2000 + event_id % 15 AS INT) AS year",
    "CAST(1 + event_id % 12 AS INT) AS month",
    "CASE WHEN event_id % 23 = 0 THEN '?' ELSE CAST(event_id % 24 AS STRING) END AS time_raw",
    "CASE WHEN event_id % 7 = 0 THEN '0' ELSE '1' END AS primary_flag",
    "CASE WHEN event_id % 29 = 0 THEN '?' WHEN event_id % 13 = 0 THEN 'x' WHEN event_id % 31 = 0 THEN 'X'"
    " WHEN event_id % 37 = 0 THEN 'n/a' WHEN event_id % 3 <> 0 THEN '0'"
    " ELSE CAST(1 + event_id % 9 AS STRING) END AS target_raw",
    "CASE WHEN event_id % 11 = 0 THEN '?' WHEN event_id % 17 = 0 THEN 'x'"
    " ELSE CAST(event_id % 5 AS STRING) END AS sp1_raw",
    "CASE WHEN event_id % 3 = 0 THEN '0' WHEN event_id % 19 = 0 THEN 'x'"
    " ELSE CAST(user_id % 4 AS STRING) END AS sp2_raw",
    "CASE WHEN event_id % 41 = 0 THEN '?' ELSE CAST(event_id % 2000 AS STRING) END AS elev_a_raw",
    "CASE WHEN event_id % 43 = 0 THEN '?' ELSE CAST((event_id * 3) % 2000 AS STRING) END AS elev_b_raw",
    "CAST((event_id * 37) % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(90 AS DOUBLE) AS lat",
    "CAST((event_id * 91) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon",
    "CASE WHEN event_id % 4 = 0 THEN '?' ELSE CAST(event_id % 30 AS STRING) END AS snow_raw",
    "CASE WHEN event_id % 6 = 0 THEN '?' ELSE CAST(event_id % 250 AS STRING) END AS prec_raw",
    *_MONTHLY,
    "CAST(user_id % 7 AS STRING) AS region_a",
    "CAST(event_id % 5 AS STRING) AS region_b",
    "value",
    "ts",
]
OBS_SQL = f"SELECT {', '.join(OBS_COLUMNS)} FROM events"
WITH_OBS = f"WITH obs AS ({OBS_SQL})"

SNOW = {m: f"snow{m:02d}" for m in (1, 2, 3, 4, 10, 11, 12)}
PREC = {m: f"prec{m:02d}" for m in range(1, 13)}

# The narrow table under raw-file names, so that the default roles and drop lists apply.
RAW_NAMES = {
    "event_id": "SAMPLING_EVENT_ID",
    "user_id": "OBSERVER_ID",
    "lat": "LATITUDE",
    "lon": "LONGITUDE",
    "year": "YEAR",
    "month": "MONTH",
    "time_raw": "TIME",
    "protocol": "COUNT_TYPE",
    "primary_flag": "PRIMARY_CHECKLIST_FLAG",
    "sp1_raw": "Zenaida_macroura",
    "target_raw": TARGET,
    "sp2_raw": "Turdus_migratorius",
    "elev_a_raw": "ELEV_GT",
    "elev_b_raw": "ELEV_NED",
    "region_a": "BAILEY_ECOREGION",
    "region_b": "BCR",
    "prec_raw": "CAUS_PREC",
    "snow_raw": "CAUS_SNOW",
    **{name: f"CAUS_PREC{m:02d}" for m, name in PREC.items()},
    **{name: f"CAUS_SNOW{m:02d}" for m, name in SNOW.items()},
}
WITH_CHECKLIST = (
    f"{WITH_OBS}, checklist AS (SELECT {', '.join(f'{a} AS {b}' for a, b in RAW_NAMES.items())} FROM obs)"
)


DEALT_ROWS = 1 << 18  # of the checklist in a partition, about 128 MB once cleaned


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*OBS_COLUMNS)


def checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).select(*[F.col(a).alias(b) for a, b in RAW_NAMES.items()])


def dealt_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``checklist`` dealt by its key over all cores, at most about ``DEALT_ROWS`` to a task.

    A few splits hold the small columns of very many events, and a row costs far more to clean than to read and deal.
    """
    events = table(spark, sf_dir, "events")
    partitions = max(spark.sparkContext.defaultParallelism, -(-events.count() // DEALT_ROWS))
    dealt = events.repartition(partitions, F.col("event_id").cast("string"))
    return dealt.selectExpr(*OBS_COLUMNS).select(*[F.col(a).alias(b) for a, b in RAW_NAMES.items()])


# --- The wide table: 1,657 cells per row ----------------------------------------------------------

WIDTH = 1657
WIDE_ROWS = 1 << 14  # in a partition of wide lines
SPECIES = range(19, 953)
LAND_COVER = (range(968, 1016), range(1084, 1090), range(1102, 1657))
# Schema names that the rules read.
_META = (
    "SAMPLING_EVENT_ID", "LOC_ID", "LATITUDE", "LONGITUDE", "YEAR", "MONTH", "DAY", "TIME", "COUNTRY",
    "STATE_PROVINCE", "COUNTY", "COUNT_TYPE", "EFFORT_HRS", "EFFORT_DISTANCE_KM", "EFFORT_AREA_HA", "OBSERVER_ID",
    "NUMBER_OBSERVERS", "GROUP_ID", "PRIMARY_CHECKLIST_FLAG",
)
_CORE = (
    "SAMPLING_EVENT_ID", "LOC_ID", "POP00_SQMI", "HOUSING_DENSITY", "HOUSING_PERCENT_VACANT", "ELEV_GT", "ELEV_NED",
    "BCR", "BAILEY_ECOREGION", "OMERNIK_L3_ECOREGION", "CAUS_TEMP_AVG", "CAUS_TEMP_MIN", "CAUS_TEMP_MAX", "CAUS_PREC",
    "CAUS_SNOW",
)


def wide_header() -> list[str]:
    """Names with the families and positions of the raw files. Species, land cover, dates and distances, of which no rule reads more
    than their kind, are numbered."""
    names = [f"NLCD_{p}" for p in range(WIDTH)]
    names[:19] = _META
    names[19:953] = [f"Genus_species{p}" for p in SPECIES]
    names[26] = TARGET
    names[953:968] = _CORE
    names[1016:1019] = ["SAMPLING_EVENT_ID", "LOC_ID", "SUBNATIONAL2_CODE"]
    monthly = [f"CAUS_{k}{m:02d}" for k in ("TEMP_AVG", "TEMP_MIN", "TEMP_MAX", "PREC") for m in range(1, 14)]
    names[1019:1078] = monthly + [f"CAUS_SNOW{m:02d}" for m in SNOW]
    names[1078:1084] = [f"CAUS_DATE_N{p}" for p in range(1078, 1084)]
    names[1090:1102] = [f"DIST_N{p}" for p in range(1090, 1102)]
    return names


_VOCABULARY = ", ".join(f"'{w}'" for w in (*PROTOCOLS, "P99"))
# One cell as text, from event ``e``, user ``u`` and position ``p``; species cells are mostly 0.
# ``{protocol}`` is each engine's array look-up.
META_CELLS = {
    0: "concat('S', CAST(e AS STRING))",
    1: "concat('L', CAST(u AS STRING))",
    2: "CAST((e * 37) % 180 - 90 AS STRING)",
    3: "CAST((e * 91) % 360 - 180 AS STRING)",
    4: "CAST(2000 + e % 15 AS STRING)",
    5: "CAST(1 + e % 12 AS STRING)",
    7: "CASE WHEN e % 23 = 0 THEN '?' ELSE CAST(e % 24 AS STRING) END",
    11: "{protocol}",
    18: "CASE WHEN e % 7 = 0 THEN '0' ELSE '1' END",
}
SPECIES_CELL = (
    "CASE WHEN (e + 7 * p) % 13 <> 0 AND (p <> 26 OR e % 3 <> 0) THEN '0'"
    " WHEN (e + p) % 29 = 0 THEN '?' WHEN (e + 3 * p) % 5 = 0 THEN 'x' ELSE CAST(1 + (e + p) % 9 AS STRING) END"
)
OTHER_CELL = "CASE WHEN (e + p) % 11 = 0 THEN '?' ELSE CAST((e * (p % 97) + p) % 250 AS STRING) END"
_CASES = " ".join(f"WHEN p = {p} THEN {cell}" for p, cell in META_CELLS.items())
DUCKDB_CELL = f"CASE {_CASES} WHEN p BETWEEN 19 AND 952 THEN {SPECIES_CELL} ELSE {OTHER_CELL} END".format(
    protocol=f"list_extract([{_VOCABULARY}], CAST(e % 21 + 1 AS BIGINT))"
)
# (e, cells): one row per event.
WITH_WIDE = (
    f"WITH wide AS (SELECT e, list_transform(range(0, {WIDTH}), lambda p: {DUCKDB_CELL}) AS cells"
    " FROM (SELECT event_id AS e, user_id AS u FROM events) AS t)"
)


def _written(vocabulary: tuple[str, ...], most: int = 256) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(e, u) → lines, by the rules above for all rows of a slice at once; missing cells are left out, as ``array_join`` does.

    A cell is looked up in a list of all short texts by its number. Functions made by a call travel to the tasks by value.
    """
    width, first, last = WIDTH, SPECIES.start, SPECIES.stop
    lowest, highest = -600, 2100
    missing, seen, protocol = highest - lowest, highest - lowest + 1, highest - lowest + 2
    texts = [*(str(v) for v in range(lowest, highest)), "?", "x", *vocabulary]
    others = np.array([p for p in range(width) if p not in SPECIES and p not in META_CELLS])

    def codes_of(e):
        codes = np.full((len(e), width), -lowest, dtype=np.int16)
        at = e[:, None]

        def counts(rows, places):
            sum_ = e[rows][:, None] + places
            held = np.where(np.fmod(sum_ + 2 * places, 5) == 0, seen, 1 + np.fmod(sum_, 9) - lowest)
            codes[rows[:, None], places] = np.where(np.fmod(sum_, 29) == 0, missing, held)

        species = np.arange(first, last)
        for rest in range(13):
            counts(np.flatnonzero(np.mod(e, 13) == rest), species[(rest + 7 * species) % 13 == 0])
        counts(np.flatnonzero(np.fmod(e, 3) == 0), np.array([26]))
        codes[:, others] = np.where(np.fmod(at + others, 11) == 0, missing, np.fmod(at * (others % 97) + others, 250) - lowest)
        for place, value in {2: np.fmod(e * 37, 180) - 90, 3: np.fmod(e * 91, 360) - 180, 4: 2000 + np.fmod(e, 15), 5: 1 + np.fmod(e, 12)}.items():
            codes[:, place] = value - lowest
        codes[:, 7] = np.where(np.fmod(e, 23) == 0, missing, np.fmod(e, 24) - lowest)
        codes[:, 11] = np.where(np.fmod(e, 21) < 0, -1, protocol + np.fmod(e, 21))
        codes[:, 18] = np.where(np.fmod(e, 7) == 0, 0, 1) - lowest
        return codes[:, 2:]

    def written(batches):
        listed = pa.array(texts)
        for whole in batches:
            for start in range(0, whole.num_rows, most):
                batch = whole.slice(start, most)
                e = pc.fill_null(batch["e"], 0).to_numpy(zero_copy_only=False)
                if len(e) and max(-int(e.min()), int(e.max())) > (2**63 - width) // 96:
                    raise ArithmeticError("an event_id too large for its cells")
                codes = codes_of(e)
                held = codes >= 0
                cuts = pa.array(np.concatenate(([0], np.cumsum(held.sum(axis=1)))).astype(np.int32))
                rest = pc.binary_join(pa.ListArray.from_arrays(cuts, listed.take(pa.array(codes[held]))), ",")
                rest = pc.if_else(batch["e"].is_null(), "1", rest)  # all that such a row's rules tell
                ids = [pc.binary_join_element_wise(letter, batch[c].cast(pa.string()), "") for letter, c in (("S", "e"), ("L", "u"))]
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(*ids, rest, ",", null_handling="skip")], names=["value"])

    return written


def wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one raw line of 1,657 cells, column ``value``."""
    events = table(spark, sf_dir, "events").selectExpr("event_id AS e", "user_id AS u")
    # A small file is one split, and each of its rows becomes 1,657 cells: spread the two numbers first, some thousand rows to a task.
    events = events.repartition(max(spark.sparkContext.defaultParallelism, -(-events.count() // WIDE_ROWS)))
    return events.selectExpr("CAST(e AS BIGINT) AS e", "CAST(u AS BIGINT) AS u").mapInArrow(_written((*PROTOCOLS, "P99")), "value string")
