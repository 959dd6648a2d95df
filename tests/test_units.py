import pytest
from helpers import items, units, values
from pyspark.sql import functions as F

from tidegate.operators import units as u
from tidegate.operators.transform import transform_items
from tidegate.operators.units import UnknownUnit, resolve_code
from tidegate.sources import read_units_mapping

MAPPING = "source_code string, target_name string, category string, _pos int"


def mapping(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], MAPPING)


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, name string")


def test_mapping_keeps_the_last_row_of_a_code(spark):
    rows = mapping(
        spark, ("ea", "Units", "Unit"), (" EA ", " Pieces", "Unit "), ("", "Units", "Unit"),
        ("KG", " ", "Weight"), ("L", "L", "Volume"),
    )
    assert values(u.clean_mapping(rows, "_pos"), "code", "target_name", "category") == [
        ("EA", "Pieces", "Unit"), ("L", "L", "Volume"),
    ]


def test_target_keeps_the_first_id_of_a_name(spark):
    rows = targets(spark, (4, "kg"), (3, "kg"), (9, "L"))
    rows = rows.withColumn("_pos", F.monotonically_increasing_id())
    assert values(u.first_target_units(rows.coalesce(1), "_pos"), "id", "name") == [(4, "kg"), (9, "L")]


def test_build_lists_every_unresolved_code(spark):
    clean = u.clean_mapping(mapping(
        spark, ("EA", "Units", "Unit"), ("X", "Nope", "Unit"), ("Y", "None", "Unit")
    ), "_pos")
    with pytest.raises(ValueError, match=r"2 unit mapping.*X -> Nope, Y -> None") as raised:
        u.build_dimension(clean, targets(spark, (1, "Units")))
    assert raised.value.count == 2
    assert values(spark.read.parquet(raised.value.path), "code", "target_name") == [
        ("X", "Nope"), ("Y", "None")
    ]


def test_build(spark):
    clean = u.clean_mapping(mapping(spark, ("EA", "Units", "Unit"), ("CS", "Units", "Unit")), "_pos")
    built = u.build_dimension(clean, targets(spark, (1, "Units"), (2, "kg")))
    assert values(built, "code", "id", "name", "category") == [
        ("CS", 1, "Units", "Unit"), ("EA", 1, "Units", "Unit")
    ]
    assert [r.code for r in u.known_codes(built).collect()] == ["CS", "EA"]


def test_offline_ids_follow_first_appearance(spark):
    rows = mapping(spark, ("EA", "Units", "U"), ("KG", "kg", "W"), ("CS", " Units", "U"), ("L", "L", "V"))
    assert values(u.offline_target_units(rows, "_pos"), "id", "name") == [
        (1, "Units"), (2, "kg"), (3, "L")
    ]


def test_missing_mapping_column(spark):
    with pytest.raises(ValueError, match="category"):
        u.clean_mapping(mapping(spark).drop("category"), "_pos")


def test_mapping_file(spark, tmp_path):
    good = tmp_path / "units.csv"
    good.write_text("code,unit,kind\nEA,Units,Unit\nNA,,\n")
    rows = read_units_mapping(spark, str(good), ("code", "unit", "kind"))
    assert values(rows, "source_code", "target_name", "category") == [
        ("EA", "Units", "Unit"), ("NA", "", "")
    ]
    with pytest.raises(ValueError, match="source_code"):
        read_units_mapping(spark, str(good))


def test_unknown_codes(spark):
    rows = transform_items(items(spark, {"UOM1": "xx"}, {"UOM2": "YY"}, {"UOM1": None}))
    assert values(u.unknown_codes(rows, units(spark)), "code") == [("XX",), ("YY",)]


def test_resolve(spark):
    rows = transform_items(items(spark, {"UOM1": "kg"}, {"UOM1": "XX"}))
    assert values(u.resolve_units(rows, units(spark)), "uom_id", "_unit_id", "_unit_category") == [
        ("KG", 3, "Weight"), ("XX", None, None)
    ]


def test_strict_resolve(spark):
    dimension = units(spark)
    assert resolve_code(dimension, " ea ").id == 1
    for code in ("??", "", None):
        with pytest.raises(UnknownUnit, match="known: CS, DZ, EA"):
            resolve_code(dimension, code)
