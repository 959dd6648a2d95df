import pytest
from helpers import customers, items, units, values
from pyspark.sql import functions as F

from tidegate.operators import validate as v
from tidegate.operators.transform import transform_customers, transform_items


def customer_rule(spark, **change):
    return v.validate_customers(transform_customers(customers(spark, change))).first()._failed_rule


def item_rule(spark, **change):
    rows = v.validate_items(transform_items(items(spark, change)), units(spark))
    return rows.first()._failed_rule


@pytest.mark.parametrize("change, rule", [
    ({}, None),
    ({"AN8": None}, "RULE_01_AN8_REQUIRED"),
    ({"AN8": "x1"}, "RULE_01_AN8_REQUIRED"),
    ({"ALPH": "  "}, "RULE_03_NAME_REQUIRED"),
    ({"ALPH": None, "AT1": "X"}, "RULE_03_NAME_REQUIRED"),
    ({"AT1": "X"}, "RULE_04_INVALID_ADDRESS_TYPE"),
    ({"AT1": "c"}, "RULE_04_INVALID_ADDRESS_TYPE"),
    ({"AT1": None}, "RULE_04_INVALID_ADDRESS_TYPE"),
    ({"PH1": None}, "RULE_05_PHONE_MISSING"),
    ({"PH1": " - "}, "RULE_05_PHONE_MISSING"),
    ({"PH1": "12345"}, "RULE_05_PHONE_FORMAT"),
    ({"PH1": "09171234567"}, None),
    ({"PH1": "02-8525-4300"}, None),
    ({"PH1": "+63 2 8908 3000"}, None),
    ({"ADD1": None}, "RULE_06_ADDRESS_REQUIRED"),
    ({"CTY1": None}, "RULE_07_CITY_REQUIRED"),
    ({"ADDZ": "ABC123"}, "RULE_08_ZIP_FORMAT"),
    ({"ADDZ": None}, None),
])
def test_customer_rules(spark, change, rule):
    assert customer_rule(spark, **change) == rule


@pytest.mark.parametrize("change, rule", [
    ({}, None),
    ({"ITM": None}, "Rule01_ITMRequired"),
    ({"ITM": "0"}, "Rule01_ITMRequired"),
    ({"ITM": "-1"}, "Rule01_ITMRequired"),
    ({"DSC1": " "}, "Rule03_NameRequired"),
    ({"STKT": "Z"}, "Rule04_InvalidSTKT"),
    ({"STKT": "s"}, None),
    ({"UOM1": None}, "Rule05_UOM1Required"),
    ({"UOM1": "XX"}, "Rule05_UOM1Required"),
    ({"UOM2": "ZZ"}, "Rule06_UOM2Invalid"),
    ({"UOM2": None}, None),
    ({"UOM2": "KG"}, "Rule07_UOMCategoryMismatch"),
    ({"SRP1": "-0.01"}, "Rule08_NegativePrice"),
    ({"SRP1": "abc"}, None),
    ({"SRP1": "0.00"}, None),
    ({"STKT": "O", "UOM1": "KG", "UOM2": "KG"}, "Rule09_STKTUOMIncompatible"),
    ({"STKT": "O", "UOM1": "HR", "UOM2": "HR"}, None),
])
def test_item_rules(spark, change, rule):
    assert item_rule(spark, **change) == rule


def test_every_copy_of_a_key_fails_but_null_keys_are_no_copies(spark):
    raw = customers(spark, {"AN8": "1"}, {"AN8": " 1"}, {"AN8": "2"}, {"AN8": None}, {"AN8": None})
    rows = v.validate_customers(transform_customers(raw))
    assert values(rows, "_source_key", "_failed_rule") == [
        (1, "RULE_02_AN8_DUPLICATE"), (1, "RULE_02_AN8_DUPLICATE"), (2, None),
        (None, "RULE_01_AN8_REQUIRED"), (None, "RULE_01_AN8_REQUIRED"),
    ]


def test_phone_pattern_rejects_a_trailing_newline(spark):
    df = spark.createDataFrame([("09171234567\n",), ("09171234567",)], "p string")
    assert sorted(r[0] for r in df.select(v.phone_is_valid(F.col("p"))).collect()) == [False, True]


def test_valid_and_failed_split_the_batch(spark):
    raw = customers(spark, *[
        {"AN8": str(i % 17), "PH1": None if i % 5 == 0 else "09171234567"} for i in range(60)
    ], *[{"AN8": str(1000 + i)} for i in range(10)])
    rows = v.validate_customers(transform_customers(raw))
    assert v.valid_rows(rows).count() == 10
    assert v.failed_rows(rows).count() == 60


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_does_not_change_the_result(spark, parts):
    changes = [{"AN8": str(i % 40), "AT1": "CVEX"[i % 4]} for i in range(60)]
    raw = customers(spark, *changes).orderBy(F.rand(3)).repartition(parts)
    got = values(v.validate_customers(transform_customers(raw)), "_source_key", "_failed_rule")
    counts = [i % 40 for i in range(60)]
    want = sorted(((k, (
        "RULE_02_AN8_DUPLICATE" if counts.count(k) > 1
        else "RULE_04_INVALID_ADDRESS_TYPE" if i % 4 == 3 else None
    )) for i, k in enumerate(counts)), key=repr)
    assert got == want
