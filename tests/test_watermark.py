from datetime import datetime

import pytest
from helpers import customers, values
from pyspark.sql import functions as F

from tidegate.operators import watermark as w
from tidegate.schemas import WATERMARK_STATE


def changes(spark, *pairs):
    return customers(spark, *[
        {"AN8": str(i), "UPMJ": d, "UPMT": t} for i, (d, t) in enumerate(pairs)
    ])


FOUR = [("126070", "28800"), ("126072", "28800"), ("126072", "36000"), ("126073", "14400")]


def kept(df, mark, **options):
    rows = w.after_watermark(w.with_change_time(df), *mark, **options)
    return [int(r.AN8) for r in rows.orderBy("AN8").collect()]


def test_strictly_after(spark):
    assert kept(changes(spark, *FOUR), (126072, 28800)) == [2, 3]


def test_full_read(spark):
    assert kept(changes(spark, *FOUR), (0, 0)) == [0, 1, 2, 3]


def test_unknown_change_time(spark):
    rows = changes(spark, (None, "1"), ("126090", None), ("", ""), ("soon", "1"), *FOUR)
    assert kept(rows, (126072, 28800)) == [0, 1, 2, 3, 6, 7]
    # A later date decides alone, so its missing time does not matter to SQL.
    assert kept(rows, (126072, 28800), keep_unknown=False) == [1, 6, 7]


def test_moment_filter_equals_two_part_filter(spark):
    times = [datetime(2026, 3, 13, 8, 0, s) for s in range(4)] + [datetime(2026, 3, 14), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t timestamp")
    assert values(w.after_watermark_moment(df, "t", 126072, 28801), "i") == [(2,), (3,), (4,), (5,)]
    assert values(w.after_watermark_moment(df, "t", 126072, 28801, False), "i") == [(2,), (3,), (4,)]


@pytest.mark.parametrize("pairs, current, expected", [
    (FOUR, (0, 0), (126073, 14400)),
    (FOUR, (126080, 5), (126080, 5)),
    ([("126072", None)], (0, 0), (126072, 0)),
    ([(None, "99")], (0, 0), (0, 99)),
    ([("126099", "noon"), ("soon", "5"), (" ", "5")], (1, 2), (1, 2)),
    ([], (3, 4), (3, 4)),
])
def test_latest_change(spark, pairs, current, expected):
    assert tuple(w.latest_change(changes(spark, *pairs), *current).first()) == expected


def test_state_latest_row_wins(spark):
    rows = [
        ("customers", 1, 2, datetime(2026, 1, 1), 5),
        ("customers", 1, 1, datetime(2026, 1, 2), 0),
        ("items", 9, 9, datetime(2026, 1, 1), 7),
    ]
    state = spark.createDataFrame(rows, WATERMARK_STATE)
    names = spark.createDataFrame([("customers",), ("never",)], "table_name string")
    got = w.current_watermark(state, names)
    assert values(got, "table_name", "last_upmj", "last_upmt", "records_synced") == [
        ("customers", 1, 1, 0), ("never", 0, 0, 0),
    ]
    assert got.where("table_name = 'never'").first().last_run_at is None
    assert values(w.latest_per_table(state), "table_name") == [("customers",), ("items",)]


def test_store(spark, store):
    assert store.watermark("customers") == (0, 0)
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    store.set_watermark("customers", 10, 20, 0, at)
    store.set_watermark("items", 1, 1, 1, at)
    store.set_watermark("customers", 5, 5, 3, F.lit("2026-01-02 00:00:00").cast("timestamp"))
    assert store.watermark("customers") == (5, 5)
    assert store.watermark("items") == (1, 1)


def test_first_changes(spark):
    rows = w.with_change_time(changes(spark, *FOUR, (None, "5")))
    first = w.first_changes(rows, ["_upmj", "_upmt", "AN8"], 2)
    assert [r.AN8 for r in first.collect()] == ["4", "0"]
    assert w.first_changes(rows, ["_upmj"], 0).count() == 5
