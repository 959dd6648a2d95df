"""Plans that a larger input must keep."""

import contextlib
import io
import re

import pytest
from helpers import customers, items, units
from pyspark.sql import functions as F

from tidegate.operators import keys, load, validate, watermark
from tidegate.operators.transform import transform_customers, transform_items
from tidegate.runtime import shared_dir
from tidegate.schemas import LOAD_LOG
from tidegate.sources import incremental_scan


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def pushed(df):
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", plan(df)))


@pytest.fixture
def database(spark, tmp_path):
    path = str(tmp_path / "db")
    names = ["DSC1", "DSC2", "STKT", "UOM1", "UOM2", "SRP1"]
    spark.range(100).select(
        F.col("id").alias("IMITM"), (F.col("id") + 126000).alias("IMUPMJ"),
        F.col("id").alias("IMUPMT"), *[F.lit("x").alias(f"IM{n}") for n in names],
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_watermark_reaches_the_scan(database):
    strict = pushed(incremental_scan(database, "items", 126050, 5))
    assert "GreaterThan(IMUPMJ,126050)" in strict and "GreaterThan(IMUPMT,5)" in strict
    lenient = pushed(watermark.after_watermark(database, 126050, 5, "IMUPMJ", "IMUPMT"))
    assert "IsNull(IMUPMJ)" in lenient and "GreaterThan(IMUPMJ,126050)" in lenient


def test_watermark_on_a_timestamp_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_seconds(id) as ts, id from range(10)").write.parquet(path)
    rows = watermark.after_watermark_moment(spark.read.parquet(path), "ts", 124020, 5)
    assert "GreaterThanOrEqual(ts" in pushed(rows)


def test_only_needed_columns_are_read(database):
    text = plan(incremental_scan(database, "items", 126050, 5).select("ITM"))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "IMDSC1" not in schema


def test_unit_lookups_broadcast(spark):
    text = plan(validate.validate_items(transform_items(items(spark, {})), units(spark)))
    assert text.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in text


def test_validation_shuffles_no_wide_rows(spark):
    text = plan(validate.validate_customers(transform_customers(customers(spark, {}, {}))))
    assert "Exchange hashpartitioning" not in text
    assert "Window" not in text


def test_load_plan_has_no_window_and_shares_one_shuffle(spark, monkeypatch):
    valid = transform_customers(customers(spark, {}))
    log = spark.createDataFrame([], LOAD_LOG)
    target = spark.createDataFrame([], "id bigint, ref string")
    monkeypatch.setattr(keys, "fits_broadcast", lambda _: False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(load.plan_load(
            valid, load.log_history(log, "customer"), load.target_ids(target, "ref")
        ))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Window" not in text and "CartesianProduct" not in text
    # The batch, the log and the target are each shuffled by entity id once.
    assert len(re.findall(r"hashpartitioning\((entity_id|ref|_groupingexpression)", text)) == 3


def test_load_plan_without_state_shuffles_nothing(spark):
    valid = transform_customers(customers(spark, {}))
    history = spark.createDataFrame(
        [], "entity_id string, was_loaded boolean, last_id bigint, attempts int"
    )
    existing = spark.createDataFrame([], "entity_id string, existing_id bigint")
    assert "hashpartitioning" not in plan(load.plan_load(valid, history, existing))


def test_duplicates_aggregate_before_the_shuffle(spark):
    text = plan(keys.duplicate_keys(transform_customers(customers(spark, {})), ["_source_key"]))
    # The formatted plan lists the scan first and the result last.
    assert text.index("partial_count") < text.index("Arguments: hashpartitioning")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rows_of_one_split_are_dealt_to_tasks_by_their_number(spark):
    from tidegate.runtime import spread

    rows = spark.range(0, 10, 1, 1)
    assert spread(rows, 10).rdd.getNumPartitions() == 1
    dealt = spread(rows, 3)
    assert dealt.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in dealt.collect()) == list(range(10))
