"""Small inputs in the raw shapes."""

from tidegate.schemas import RAW_ADDRESS, RAW_ITEM

GOOD_CUSTOMER = {
    "AN8": "4417", "ALPH": "Harbour Tools", "AT1": "C", "PH1": "+63 34 701 4412",
    "ADD1": "7 Quarry Lane", "ADD2": None, "CTY1": "Bacolod", "ADDS": "45", "ADDZ": "6100",
    "COUN": "PHL", "TAX": "730015512204", "PA8": "0", "UPMJ": "126041", "UPMT": "52217",
}
GOOD_ITEM = {
    "ITM": "8306", "DSC1": "Copper Kettle", "DSC2": None, "STKT": "S", "UOM1": "EA",
    "UOM2": "EA", "SRP1": "64.50", "UPMJ": "126033", "UPMT": "61103",
}
UNITS = [
    ("EA", 1, "Units", "Unit"), ("CS", 1, "Units", "Unit"), ("DZ", 2, "Dozens", "Unit"),
    ("KG", 3, "kg", "Weight"), ("LB", 4, "lb", "Weight"), ("L", 5, "L", "Volume"),
    ("HR", 6, "Hours", "Time"),
]


def _rows(spark, schema, base, changes):
    rows = [base | change for change in changes]
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def customers(spark, *changes):
    return _rows(spark, RAW_ADDRESS, GOOD_CUSTOMER, changes)


def items(spark, *changes):
    return _rows(spark, RAW_ITEM, GOOD_ITEM, changes)


def units(spark):
    return spark.createDataFrame(UNITS, "code string, id bigint, name string, category string")


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
