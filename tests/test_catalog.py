import pytest
from pyspark.sql import functions as F

from fieldtally.catalog import TARGET, ArrayCells, ColumnCatalog, NamedCells, family_of, is_species
from fieldtally.operators import columns as k
from fieldtally.plans.record import RecordPlan, RecordSpec
from fieldtally.queries.tables import wide_header


@pytest.fixture(scope="module")
def wide():
    return ColumnCatalog(wide_header())


def test_repeated_names_get_their_position():
    catalog = ColumnCatalog(["ID", "A", "ID", "B", "ID"])
    assert [e.unique_name for e in catalog.entries] == ["ID0", "A", "ID2", "B", "ID4"]
    assert catalog.positions("ID") == [0, 2, 4] and catalog.position("B") == 3


def test_repeated_names_as_spark_names_them(spark, tmp_path):
    (tmp_path / "t.csv").write_text("ID,A,ID,B,ID\n1,2,3,4,5\n")
    columns = spark.read.csv(str(tmp_path / "t.csv"), header=True).columns
    assert columns == [e.unique_name for e in ColumnCatalog(["ID", "A", "ID", "B", "ID"]).entries]


def test_unknown_name(wide):
    with pytest.raises(KeyError):
        wide.position("NO_SUCH")


def test_families(wide):
    assert len(wide) == 1657
    sizes = {name: len(wide.family(name)) for name in ("species", "land_cover", "monthly_climate")}
    assert sizes == {"species": 934, "land_cover": 609, "monthly_climate": 59}
    assert len(wide.species(without=TARGET)) == 933
    assert wide.position(TARGET) == 26 and wide.positions("LOC_ID") == [1, 954, 1017]
    assert is_species("Corvus_corax") and not is_species("BCR") and not is_species("CAUS_SNOW")
    assert family_of("CAUS_TEMP_AVG07") == "monthly_climate" and family_of("CAUS_SNOW") == "climate"


def test_drop_counts(wide):
    assert len(wide.dropped()) == 689
    assert len(wide.kept()) == 968
    assert sorted(wide.siblings("CAUS_SNOW")) == [1, 2, 3, 4, 10, 11, 12]
    assert sorted(wide.siblings("CAUS_PREC")) == list(range(1, 14))


def test_feature_width(wide):
    assert RecordPlan(RecordSpec(), ArrayCells(wide)).width == 995
    assert RecordPlan(RecordSpec(fold_year=True), ArrayCells(wide)).width == 996


def test_runs_equal_in_both_layouts(spark):
    catalog = ColumnCatalog(["a", "b", "c", "d", "e"])
    entries = [catalog.entries[i] for i in (0, 2, 3, 4)]
    rows = spark.createDataFrame([("0", "1", "2", "3", "4")], catalog_names(catalog))
    named = rows.select(NamedCells(catalog).run(entries).alias("r")).first().r
    cells = rows.select(F.array(*rows.columns).alias("cells")).select(ArrayCells(catalog).run(entries).alias("r")).first().r
    assert named == cells == ["0", "2", "3", "4"]


def catalog_names(catalog):
    return [e.unique_name for e in catalog.entries]


def test_short_rows_give_null(spark):
    catalog = ColumnCatalog(["a", "b", "c"])
    rows = spark.createDataFrame([(["0"],)], "cells array<string>")
    assert rows.select(ArrayCells(catalog).cell("c").alias("c")).first().c is None


def test_spec_survives_as_text():
    spec = RecordSpec(fold_year=True, vocabulary=("a", "b"))
    assert RecordSpec.from_json(spec.to_json()) == spec


def test_label_first(spark):
    assert k.label_first(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), "b").columns == ["label", "a", "c"]
