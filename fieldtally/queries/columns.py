"""K: catalog, column families, projections and the whole record."""

from pyspark.sql import functions as F

from fieldtally.catalog import ArrayCells, ColumnCatalog, NamedCells
from fieldtally.functions.features import EARTH_RADIUS_KM, PROTOCOLS
from fieldtally.operators import columns as k
from fieldtally.plans.record import RecordPlan, RecordSpec
from fieldtally.queries.registry import query, r6, sql_clean, sql_label, sql_number, sql_r6
from fieldtally.queries.tables import (
    EVENT_TYPES,
    PREC,
    RAW_NAMES,
    SNOW,
    WITH_CHECKLIST,
    WITH_OBS,
    WITH_WIDE,
    checklist,
    obs,
    wide_header,
    wide_lines,
)
from fieldtally.sources.text import split_cells

NAMES = list(RAW_NAMES.values())
CATALOG = ColumnCatalog(NAMES)


# What the catalog and the drop rules must find in the narrow table, by position.
_FAMILIES = (
    ("identifier", (0, 1)),
    ("covariate", (2, 3, 4, 5, 6, 7, 8, 12, 13, 14, 15)),
    ("species", (9, 10, 11)),
    ("climate", (16, 17)),
    ("monthly_climate", range(18, 37)),
)
_SPECIES = ("Zenaida_macroura", "Agelaius_phoeniceus", "Turdus_migratorius")
_KEPT = {"MONTH": 5, "TIME": 6, "PRIMARY_CHECKLIST_FLAG": 8, "Zenaida_macroura": 9, "Agelaius_phoeniceus": 10, "Turdus_migratorius": 11,
         "BCR": 15, "CAUS_PREC": 16, "CAUS_SNOW": 17}


def _catalog_sql():
    values = ", ".join(f"({p}, '{NAMES[p]}', '{NAMES[p]}', '{family}')" for family, places in _FAMILIES for p in places)
    counts = " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(CASE WHEN CAST({n} AS VARCHAR) = '?' THEN 1 END) AS missing FROM checklist"
        for n in NAMES
    )
    return f"""{WITH_CHECKLIST}, entries(position, name, unique_name, family) AS (VALUES {values}), counts AS ({counts})
        SELECT position, name, unique_name, family, missing FROM entries JOIN counts USING (name)"""


@query("k1_column_catalog", _catalog_sql())
def column_catalog(spark, d):
    """The catalog with each column's missing cells, counted in one pass."""
    rows = checklist(spark, d)
    catalog = ColumnCatalog.from_frame(rows)
    counted = rows.agg(*[F.count_if(F.col(n).cast("string") == "?").alias(n) for n in rows.columns])
    counts = counted.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("missing")) for n in rows.columns])))
    return catalog.to_frame(spark).join(counts, "name").select("position", "name", "unique_name", "family", "missing")


@query(
    "k2_column_position",
    f"""{WITH_CHECKLIST} SELECT 6 AS position, \"TIME\" AS cell, count(*) AS n
        FROM checklist GROUP BY \"TIME\"""",
)
def column_position(spark, d):
    """Look a column up by name and read the cell at that position of an array."""
    rows = checklist(spark, d)
    catalog = ColumnCatalog.from_frame(rows)
    cells = rows.select(F.array(*[F.col(n).cast("string") for n in rows.columns]).alias("cells"))
    found = cells.select(
        F.lit(catalog.position("TIME")).alias("position"), ArrayCells(catalog).cell("TIME").alias("cell")
    )
    return found.groupBy("position", "cell").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k3_species_columns",
    f"{WITH_CHECKLIST} SELECT SAMPLING_EVENT_ID, {', '.join(_SPECIES)} FROM checklist",
)
def species_columns(spark, d):
    return k.species_columns(checklist(spark, d), keep=["SAMPLING_EVENT_ID"])


@query("k4_drop_columns", f"{WITH_CHECKLIST} SELECT {', '.join(_KEPT)} FROM checklist")
def drop_columns(spark, d):
    return k.drop_columns(checklist(spark, d))


@query("k5_label_first", f"{WITH_OBS} SELECT target_raw AS label, event_id, sp1_raw, sp2_raw FROM obs")
def label_first(spark, d):
    return k.label_first(obs(spark, d).select("event_id", "sp1_raw", "target_raw", "sp2_raw"), "target_raw")


@query("k6_drop_column_df", f"{WITH_OBS} SELECT event_id, sp2_raw FROM obs")
def drop_column_df(spark, d):
    return k.drop_column(obs(spark, d).select("event_id", "sp1_raw", "sp2_raw"), "sp1_raw")


@query("k6_filter_value_df", f"{WITH_OBS} SELECT event_id, time_raw FROM obs WHERE time_raw <> '?'")
def filter_value_df(spark, d):
    return k.filter_value(obs(spark, d).select("event_id", "time_raw"), "time_raw")


@query("k7_first_field", "SELECT CAST(event_id AS VARCHAR) AS field FROM events")
def first_field(spark, d):
    lines = obs(spark, d).select(F.concat_ws(",", F.col("event_id").cast("string"), "target_raw").alias("value"))
    return k.first_field(split_cells(lines))


def checklist_spec(**changes):
    return RecordSpec(vocabulary=EVENT_TYPES, climate=("CAUS_PREC", "CAUS_SNOW"), **changes)


def checklist_plan(**changes):
    return RecordPlan(checklist_spec(**changes), NamedCells(CATALOG))


def _imputed(column, siblings):
    branches = " ".join(f"WHEN MONTH = {m} THEN {s}" for m, s in siblings.items())
    return f"(CASE WHEN {column} <> '?' THEN {column} ELSE CASE {branches} ELSE '0' END END)"


def _record_sql(fold_year=False):
    """The record's features written out by hand, one column each."""
    raw = ({"YEAR": 4} if fold_year else {}) | {n: p for n, p in _KEPT.items() if n != "Agelaius_phoeniceus"}
    source = {n: f"CAST({n} AS VARCHAR)" for n in raw}
    source["CAUS_PREC"] = _imputed("CAUS_PREC", {m: f"CAUS_PREC{m:02d}" for m in PREC})
    source["CAUS_SNOW"] = _imputed("CAUS_SNOW", {m: f"CAUS_SNOW{m:02d}" for m in SNOW})
    if fold_year:
        source["YEAR"] = "CAST(YEAR % 2 AS VARCHAR)"
    out = [sql_clean(source[n], f"'{p}'", "SAMPLING_EVENT_ID") for n, p in raw.items()]
    out += [f"CASE WHEN COUNT_TYPE = '{w}' THEN 1 ELSE 0 END" for w in EVENT_TYPES]
    hour = sql_number("TIME")
    out += [
        f"CASE WHEN {hour} BETWEEN 3 AND 8 THEN 1 ELSE 0 END",
        f"CASE WHEN {hour} BETWEEN 8 AND 15 THEN 1 ELSE 0 END",
        f"CASE WHEN {hour} BETWEEN 15 AND 20 THEN 1 ELSE 0 END",
        f"CASE WHEN {hour} >= 20 OR {hour} <= 3 THEN 1 ELSE 0 END",
        f"({sql_number('ELEV_GT')} + {sql_number('ELEV_NED')}) / 2",
        f"{EARTH_RADIUS_KM} * cos(radians(LATITUDE)) * cos(radians(LONGITUDE))",
        f"{EARTH_RADIUS_KM} * cos(radians(LATITUDE)) * sin(radians(LONGITUDE))",
        f"{EARTH_RADIUS_KM} * sin(radians(LATITUDE))",
    ]
    features = ", ".join(
        f"{sql_r6(x) if i >= len(out) - 4 else f'CAST({x} AS DOUBLE)'} AS f{i}" for i, x in enumerate(out)
    )
    label = sql_label("Agelaius_phoeniceus")
    return f"""{WITH_CHECKLIST} SELECT CAST(SAMPLING_EVENT_ID AS VARCHAR) AS SAMPLING_EVENT_ID, {label} AS label,
        {features} FROM checklist"""


def _record(spark, d, **changes):
    plan = checklist_plan(**changes)
    arrays = plan.to_arrays(checklist(spark, d))
    values = [F.get("values", F.lit(i)) for i in range(plan.width)]
    # Elevation and position are the only features that are not whole numbers here.
    values = [(r6(v) if i >= plan.width - 4 else v).alias(f"f{i}") for i, v in enumerate(values)]
    return arrays.select("SAMPLING_EVENT_ID", F.col("label"), *values)


@query("k8_clean_record", _record_sql())
def clean_record(spark, d):
    return _record(spark, d)


@query("k8_clean_record_with_year", _record_sql(fold_year=True))
def clean_record_with_year(spark, d):
    return _record(spark, d, fold_year=True)


# Positions in the wide file: of the kept cells, of imputed climate cells with their monthly siblings, and of the two elevations.
_KEPT_AT = ((5, 5), (7, 7), (12, 14), (16, 16), (18, 25), (27, 952), (955, 957), (960, 960), (963, 967), (1078, 1083), (1090, 1101))
_MONTHLY_AT = {963 + k: {m: 1018 + 13 * k + m for m in range(1, 14)} for k in range(4)} | {967: {1: 1071, 2: 1072, 3: 1073, 4: 1074, 10: 1075, 11: 1076, 12: 1077}}
_ELEVATION_AT = (958, 959)


def _wide_sql():
    """Features of the 1,657-cell record as a long list of (key, index, value), then one row per key."""
    month = "greatest(1, CAST(cells[6] AS INT))"
    cases = []
    for place, siblings in _MONTHLY_AT.items():
        branches = " ".join(f"WHEN {m} THEN cells[{p + 1}]" for m, p in siblings.items())
        cases.append(f"WHEN p = {place} AND cells[p + 1] = '?' THEN CASE {month} {branches} ELSE '0' END")
    first_species, last_species = 19, 952
    offset = ", ".join(f"({p}, {i})" for i, p in enumerate(p for first, last in _KEPT_AT for p in range(first, last + 1)))
    return f"""{WITH_WIDE}, places(p, i) AS (VALUES {offset}),
        raw AS (SELECT e, i, p, CASE {' '.join(cases)} ELSE cells[p + 1] END AS cell FROM wide CROSS JOIN places),
        clean AS (SELECT e, i, p, {sql_clean('cell', 'p', "concat('S', e)")} AS v FROM raw),
        kept AS (SELECT e, count(*) AS n, sum(CASE WHEN v <> 0 THEN 1 ELSE 0 END) AS filled, sum(v) AS total,
            sum(CASE WHEN p BETWEEN {first_species} AND {last_species} THEN v ELSE 0 END) AS counted,
            sum(v * i) AS weighted FROM clean GROUP BY e),
        extra AS (SELECT e, cells[27] AS target, {sql_number('cells[8]')} AS hour, cells[12] AS protocol,
            ({sql_number(f'cells[{_ELEVATION_AT[0] + 1}]')} + {sql_number(f'cells[{_ELEVATION_AT[1] + 1}]')}) / 2 AS elevation
            FROM wide)
        SELECT concat('S', CAST(e AS VARCHAR)) AS SAMPLING_EVENT_ID, {sql_label('target')} AS label,
            CAST(n + 28 AS BIGINT) AS width, CAST(filled AS BIGINT) AS filled, {sql_r6('counted')} AS counted,
            {sql_r6('total')} AS total, {sql_r6('weighted')} AS weighted, {sql_r6('elevation')} AS elevation,
            CAST(CASE WHEN protocol <> 'P99' THEN 1 ELSE 0 END AS BIGINT) AS protocols,
            CAST((CASE WHEN hour BETWEEN 3 AND 8 THEN 1 ELSE 0 END) + (CASE WHEN hour BETWEEN 8 AND 15 THEN 1 ELSE 0 END)
              + (CASE WHEN hour BETWEEN 15 AND 20 THEN 1 ELSE 0 END)
              + (CASE WHEN hour >= 20 OR hour <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS slots
        FROM kept JOIN extra USING (e)"""


@query(
    "k8_clean_record_short_lines",
    f"""{WITH_WIDE} SELECT concat('S', CAST(e AS VARCHAR)) AS SAMPLING_EVENT_ID, CAST(995 AS BIGINT) AS width,
        CAST(CASE WHEN cells[12] <> 'P99' THEN 1 ELSE 0 END AS BIGINT) AS protocols FROM wide""",
)
def clean_record_short_lines(spark, d):
    """Lines cut after 30 or 1,000 cells still give all features, in their places."""
    plan = wide_plan()
    event = F.substring(F.substring_index("value", ",", 1), 2, 20).cast("long")
    cut = F.when(event % 3 == 0, F.substring_index("value", ",", 1000)).when(event % 3 == 1, F.substring_index("value", ",", 30))
    lines = wide_lines(spark, d).select(cut.otherwise(F.substring_index("value", ",", 1657)).alias("value"))
    arrays = plan.to_arrays(split_cells(lines, upto=plan.last_position()))
    first = plan.feature_names.index(next(n for n in plan.feature_names if n.startswith("protocol_")))
    flags = F.slice("values", first + 1, sum(n.startswith("protocol_") for n in plan.feature_names))
    counted = F.aggregate(flags, F.lit(0.0), lambda t, v: t + v).cast("long")
    return arrays.select("SAMPLING_EVENT_ID", F.size("values").cast("long").alias("width"), counted.alias("protocols"))


def wide_plan():
    return RecordPlan(RecordSpec(), ArrayCells(ColumnCatalog(wide_header())))


@query("k8_clean_record_wide", _wide_sql())
def clean_record_wide(spark, d):
    """Raw lines of 1,657 cells → 995 features, summed up per row for comparison."""
    plan = wide_plan()
    cells = split_cells(wide_lines(spark, d), upto=1101)
    arrays = plan.to_arrays(cells)
    kept, names = len(plan.kept), plan.feature_names
    species = [i for i, e in enumerate(plan.kept) if e.family == "species"]
    values = F.slice("values", 1, kept)
    zero = F.lit(0.0)

    def total(array):
        return F.aggregate(array, zero, lambda acc, v: acc + v)

    flags = F.slice("values", kept + 1, len(PROTOCOLS))
    slots = F.slice("values", kept + len(PROTOCOLS) + 1, 4)
    return arrays.select(
        "SAMPLING_EVENT_ID",
        F.col("label"),
        F.size("values").cast("bigint").alias("width"),
        F.size(F.filter(values, lambda v: v != zero)).cast("bigint").alias("filled"),
        r6(total(F.slice("values", species[0] + 1, len(species)))).alias("counted"),
        r6(total(values)).alias("total"),
        r6(total(F.transform(values, lambda v, i: v * i))).alias("weighted"),
        r6(F.get("values", F.lit(names.index("elevation")))).alias("elevation"),
        total(flags).cast("bigint").alias("protocols"),
        total(slots).cast("bigint").alias("slots"),
    )
