import random

import pytest
from helpers import values

from tidegate import runtime
from tidegate.operators import keys
from tidegate.operators.numbering import number_rows
from pyspark.sql import functions as F


def skewed(spark, n=3000):
    """A third of the rows share one key, a third have none."""
    pick = random.Random(5)
    rows = [
        (i, 7 if i % 3 == 0 else None if i % 3 == 1 else pick.randrange(200), "x" if i % 2 else None)
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "i int, k int, g string").repartition(6)


@pytest.mark.parametrize("hot_rows", [1, 6, 500])
def test_lookup_without_broadcast_matches_a_plain_join(spark, hot_rows):
    rows, left = skewed(spark)
    right_rows = {k: f"v{k}" if k % 5 else None for k in range(0, 150)}
    right = spark.createDataFrame(list(right_rows.items()), "k int, v string")
    got = keys.unique_lookup(left, right, ["k"], small=False, hot_rows=hot_rows)
    assert got.columns == ["i", "k", "g", "v"]
    assert values(got, "i", "k", "v") == sorted(
        ((i, k, right_rows.get(k)) for i, k, _ in rows), key=repr
    )


def test_lookup_of_a_composite_key(spark):
    rows, left = skewed(spark, 600)
    right = left.where("k is not null and g is not null").select("k", "g").distinct()
    right = right.withColumn("seen", F.lit(1))
    got = keys.unique_lookup(left, right, ["k", "g"], small=False, hot_rows=50)
    assert values(got, "i", "seen") == sorted(
        ((i, 1 if k is not None and g else None) for i, k, g in rows), key=repr
    )


def test_hot_and_null_rows_do_not_meet_in_one_partition(spark):
    _, left = skewed(spark, 30000)
    right = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v"))
    with_auto_broadcast_off = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(with_auto_broadcast_off)
    spark.conf.set(with_auto_broadcast_off, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = keys.unique_lookup(left, right, ["k"], small=False, hot_rows=1000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(with_auto_broadcast_off, old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 30000
    assert max(sizes) < 20000


def test_hot_answers_take_a_higher_bound_until_they_fit(spark, monkeypatch):
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 200)
    counts = spark.createDataFrame([(k, 2 ** k) for k in range(12)], "k int, n bigint")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 12, 2)], "k int, v string")
    got = keys.hot_answers(counts, right, ["k"], hot_rows=1)
    assert runtime.fits_broadcast(got) and 0 < got.count() < 11
    assert values(got.where("k >= 10").select("k", "_hot.v"), "k", "v") == [(10, "v10"), (11, None)]


def test_size_is_measured_in_bytes(spark):
    long = spark.createDataFrame([("x" * 1000, 1, None, [1])], "t string, i int, b binary, a array<int>")
    size = long.agg(F.sum(runtime.row_bytes(long))).first()[0]
    assert 1000 < size < 1100
    assert runtime.fits_broadcast(long.limit(0))


@pytest.mark.parametrize("small", [None, False])
def test_flag_duplicates(spark, small):
    rows, df = skewed(spark)
    counts = {}
    for _, k, _ in rows:
        counts[k] = counts.get(k, 0) + 1
    got = keys.flag_duplicates(df, ["k"], small=small)
    assert values(got, "i", "_duplicate") == sorted(
        ((i, k is not None and counts[k] > 1) for i, k, _ in rows), key=repr
    )


@pytest.mark.parametrize("parts", [1, 5])
def test_number_rows_follows_the_order(spark, parts):
    order = list(range(400))
    random.Random(1).shuffle(order)
    df = spark.createDataFrame([(k, None if k < 30 else k // 100) for k in order], "k int, d int")
    got = number_rows(df.repartition(parts), ["d", "k"], F.lit(1000), "id")
    assert values(got.orderBy("k"), "k", "id") == sorted(
        ((k, 1001 + k) for k in range(400)), key=repr
    )
