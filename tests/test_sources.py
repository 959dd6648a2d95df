import pytest
from helpers import customers, values

from tidegate.schemas import RAW_ADDRESS, RAW_ITEM
from tidegate.sinks.files import write_csv, write_preview
from tidegate.sources import bin_counter, jdbc_options, plan_ranges, read_csv
from tidegate.sources.ranges import sql_counter
from tidegate.sources.tables import TABLES, alias_columns, incremental_scan, source_table


def test_csv_is_text_with_null_tokens(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('AN8,ALPH,ADDZ,COUN,MORE\n0012,"Smith, ""J""",0900,NA,x\n7,nan,,PHL,y\n')
    rows = read_csv(spark, str(path), RAW_ADDRESS)
    assert rows.columns == RAW_ADDRESS.names
    assert values(rows, "AN8", "ALPH", "ADDZ", "COUN", "PH1") == [
        ("0012", 'Smith, "J"', "0900", None, None), ("7", None, None, "PHL", None),
    ]
    kept = read_csv(spark, str(path), RAW_ADDRESS, na_tokens=("",))
    assert values(kept, "COUN", "ALPH") == [("NA", 'Smith, "J"'), ("PHL", "nan")]


def test_item_file_without_second_description(spark, tmp_path):
    path = tmp_path / "i.csv"
    path.write_text("ITM,DSC1,STKT,UOM1,UOM2,SRP1,UPMJ,UPMT\n1,a,S,EA,EA,1.00,126001,5\n")
    row = read_csv(spark, str(path), RAW_ITEM).first()
    assert row.DSC2 is None and row.SRP1 == "1.00"


def test_csv_round_trip_keeps_blanks_and_quotes(spark, tmp_path):
    raw = customers(spark, {"ALPH": '  a "b", c\\ '}, {"ALPH": None})
    path = str(tmp_path / "out")
    write_csv(raw, path)
    assert values(read_csv(spark, path, RAW_ADDRESS), *RAW_ADDRESS.names) == values(
        raw, *RAW_ADDRESS.names
    )


def test_preview_of_nothing_is_not_written(spark, tmp_path):
    assert write_preview(customers(spark), str(tmp_path), "valid", "1", ["AN8"]) is None
    assert list(tmp_path.iterdir()) == []


def test_preview_is_never_overwritten(spark, tmp_path):
    rows = customers(spark, {})
    path = write_preview(rows, str(tmp_path), "valid", "1", ["AN8", "ABSENT"])
    assert spark.read.option("header", True).csv(path).first().asDict() == {
        "AN8": "4417", "ABSENT": None
    }
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_preview(rows, str(tmp_path), "valid", "1", ["AN8"])


def test_registry():
    assert len(TABLES["customers"].schema) == 14 and len(TABLES["items"].schema) == 9
    assert TABLES["customers"].column("AN8") == "ABAN8"
    assert TABLES["items"].column("UPMJ") == "IMUPMJ"
    with pytest.raises(ValueError, match="customers"):
        source_table("orders")


def database(spark):
    rows = [("1", 126072, 28800), ("2", 126072, 28801), ("3", 126073, None), ("4", None, 5)]
    df = spark.createDataFrame(rows, "IMITM string, IMUPMJ bigint, IMUPMT bigint")
    for name in ("DSC1", "DSC2", "STKT", "UOM1", "UOM2", "SRP1"):
        df = df.selectExpr("*", f"cast(null as string) as IM{name}")
    return df


def test_alias_scan(spark):
    rows = alias_columns(database(spark), "items")
    assert rows.columns == RAW_ITEM.names
    assert {t for _, t in rows.dtypes} == {"string"}
    assert values(incremental_scan(database(spark), "items", 126072, 28800), "ITM", "UPMJ") == [
        ("2", "126072"), ("3", "126073")
    ]
    assert incremental_scan(database(spark), "items").count() == 4


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "items") == {
        "url": "jdbc:x", "dbtable": "PRODDTA.F4101", "fetchsize": "1000"
    }
    ranged = jdbc_options("jdbc:x", "customers", "TESTDTA", 50, "ABAN8", 0, 100, 8)
    assert ranged["dbtable"] == "TESTDTA.F0101" and ranged["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "items", partition_column="IMITM")


def test_ranges_of_a_crowded_key(spark):
    # A third of the rows share one key, another third lies within a thousandth of the span.
    keys = [5_000_000] * 400 + list(range(900_000, 900_400)) + list(range(0, 10_000_000, 25_000)) + [None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    ranges = plan_ranges(bin_counter(df, "k"), 0, 9_975_000, 10)
    rows = [df.where(r.condition("k")).count() for r in ranges]
    assert sum(rows) == len(keys) and len(ranges) <= 20
    assert [r - (i == 0) for i, r in enumerate(rows)] == [r.rows for r in ranges]
    share = -(-(len(keys) - 1) // 10)
    assert all(n <= 2 * share or (r.low, n) == (5_000_000, 400) or n - 400 <= share for r, n in zip(ranges, rows, strict=True))
    assert ranges[0].predicate("k").endswith("OR k IS NULL)") and ranges[-1].high is None


def test_ranges_of_one_key_and_of_nothing(spark):
    one = spark.createDataFrame([(7,)] * 5, "k long")
    assert [r.predicate("k") for r in plan_ranges(bin_counter(one, "k"), 7, 7, 4)] == ["(1 = 1 OR k IS NULL)"]
    assert [r.rows for r in plan_ranges(bin_counter(one.limit(0), "k"), 1, 9, 4)] == [0]
    with pytest.raises(ValueError):
        plan_ranges(bin_counter(one, "k"), 7, 7, 0)


def test_counts_made_by_the_source(spark):
    spark.range(1000).selectExpr("id * id AS k").createOrReplaceTempView("squares")
    count = sql_counter(spark.sql, "squares", "k")
    assert count(0, 100, 25) == sorted(count(0, 100, 25)) or sorted(count(0, 100, 25)) == [(0, 5), (1, 3), (2, 1), (3, 1)]
    ranges = plan_ranges(count, 0, 999 * 999, 4)
    assert sum(r.rows for r in ranges) == 1000 and max(r.rows for r in ranges) <= 500
