import random

import pytest
from helpers import customers, values
from pyspark.sql import functions as F

from tidegate.operators import load
from tidegate.operators.transform import transform_customers
from tidegate.schemas import LOAD_LOG

LOG_ROW = dict.fromkeys(LOAD_LOG.names) | {"entity_type": "customer", "attempt_number": 1}


def log_of(spark, *changes):
    rows = [LOG_ROW | c for c in changes]
    return spark.createDataFrame([tuple(r[n] for n in LOAD_LOG.names) for r in rows], LOAD_LOG)


def target_of(spark, rows):
    return spark.createDataFrame(rows, "id bigint, ref string")


def rejected(spark, keys):
    return spark.createDataFrame([(str(k), f"no {k}") for k in keys], "entity_id string, error string")


def planned(spark, valid, log, target, refused=None):
    return load.plan_load(
        valid, load.log_history(log, "customer"), load.target_ids(target, "ref"),
        None if refused is None else rejected(spark, refused),
    )


def sequential(rows, loaded, existing, refused):
    """One record after the other, as an ordered loader would do it."""
    stopped, out = False, []
    for upmj, upmt, key in sorted(rows, key=lambda r: (
        (r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or 0), r[2]
    )):
        if key in loaded:
            out.append((key, "SKIPPED", None))
        elif stopped:
            out.append((key, "NOT_PROCESSED", None))
        elif key in existing:
            out.append((key, "LOADED", existing[key]))
        elif key in refused:
            out.append((key, "FAILED", None))
            stopped = True
        else:
            out.append((key, "LOADED", None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_plan_equals_a_sequential_loader(spark, seed):
    pick = random.Random(seed)
    keys = list(range(1, 61))
    raw = [
        (pick.choice([None, 126001, 126002]), pick.choice([None, 0, 500, 900]), k) for k in keys
    ]
    loaded = set(pick.sample(keys, 15))
    existing = {k: 1000 + k for k in pick.sample(keys, 15)}
    refused = set(pick.sample(keys, 0 if seed == 3 else 6))
    valid = transform_customers(customers(spark, *[
        {"AN8": str(k), "UPMJ": d and str(d), "UPMT": t if t is None else str(t)} for d, t, k in raw
    ])).repartition(5)
    log = log_of(spark, *[{"entity_id": str(k), "status": "LOADED"} for k in loaded])
    target = target_of(spark, [(i, str(k)) for k, i in existing.items()])
    got = planned(spark, valid, log, target, refused)
    assert values(got, "_source_key", "status", "target_id") == sequential(
        raw, loaded, existing, refused
    )


def test_an_existing_row_after_the_stop_is_not_processed(spark):
    valid = transform_customers(customers(spark, *[{"AN8": str(k)} for k in (1, 2, 3)]))
    got = planned(spark, valid, log_of(spark), target_of(spark, [(9, "3")]), [1])
    assert values(got, "_source_key", "status", "error") == [
        (1, "FAILED", "no 1"), (2, "NOT_PROCESSED", None), (3, "NOT_PROCESSED", None),
    ]


def test_refusal_of_a_row_that_is_not_created_does_not_stop(spark):
    valid = transform_customers(customers(spark, *[{"AN8": str(k)} for k in (1, 2, 3)]))
    log = log_of(spark, {"entity_id": "1", "status": "LOADED"})
    got = planned(spark, valid, log, target_of(spark, [(9, "2")]), [1, 2])
    assert values(got, "_source_key", "status") == [(1, "SKIPPED"), (2, "LOADED"), (3, "LOADED")]


def test_an_item_with_the_same_number_does_not_mask_a_customer(spark):
    valid = transform_customers(customers(spark, {"AN8": "5"}))
    log = log_of(spark, {"entity_id": "5", "entity_type": "item", "status": "LOADED"})
    row = planned(spark, valid, log, target_of(spark, [])).first()
    assert (row.status, row.attempt_number) == ("LOADED", 1)


def test_history(spark):
    log = load.backfill_log(log_of(
        spark,
        {"log_id": 1, "entity_id": "1", "status": "FAILED", "attempt_number": 1},
        {"log_id": 2, "entity_id": "1", "status": "LOADED", "attempt_number": 2, "target_id": 10},
        {"log_id": 3, "entity_id": "1", "status": "LOADED", "attempt_number": 3, "target_id": 11},
        {"log_id": 4, "an8": 2, "entity_type": None, "status": "NOT_PROCESSED"},
        {"log_id": 5, "an8": 3, "status": "LOADED"},
    ))
    assert values(load.log_history(log, "customer"), "entity_id", "was_loaded", "last_id", "attempts") == [
        ("1", True, 11, 3), ("2", False, None, 1), ("3", True, None, 1),
    ]
    assert values(load.historical_ids(log, "customer"), "entity_id", "target_id") == [("1", 11)]


def test_lowest_target_id_wins(spark):
    target = target_of(spark, [(7, "1"), (3, "1"), (4, None), (5, "2")])
    assert values(load.target_ids(target, "ref"), "entity_id", "existing_id") == [("1", 3), ("2", 5)]


def test_created_ids_continue_the_target_in_processing_order(spark):
    valid = transform_customers(customers(
        spark, {"AN8": "1", "UPMJ": "126002"}, {"AN8": "2", "UPMJ": "126001"},
        {"AN8": "3", "UPMJ": None}, {"AN8": "4", "UPMJ": "126001"},
    ))
    target = target_of(spark, [(50, "99"), (7, "4")])
    created = load.assign_target_ids(planned(spark, valid, log_of(spark), target), target)
    assert values(created, "_source_key", "target_id") == [(1, 53), (2, 52), (3, 51)]


@pytest.mark.parametrize("counts, outcome, code", [
    ((3, 1, 0, 0), "FAILED", 1),
    ((2, 1, 3, 0), "PARTIAL", 1),
    ((2, 0, 0, 1), "SUCCESS_WITH_SKIPS", 0),
    ((0, 0, 0, 3), "SUCCESS_WITH_SKIPS", 0),
    ((3, 0, 0, 0), "SUCCESS", 0),
])
def test_run_outcome(spark, counts, outcome, code):
    df = spark.createDataFrame([counts], "loaded bigint, failed bigint, not_processed bigint, skipped bigint")
    row = load.run_outcome(df).first()
    assert (row.outcome, row.exit_code) == (outcome, code)


def test_parents(spark):
    rows = transform_customers(customers(
        spark, {"AN8": "1", "PA8": "0"}, {"AN8": "2", "PA8": "1"}, {"AN8": "3", "PA8": "x"},
        {"AN8": "4", "PA8": "77"},
    ))
    ids = spark.createDataFrame([("1", 100)], "entity_id string, target_id bigint")
    assert values(load.resolve_parents(rows, ids), "_source_key", "parent_target_id") == [
        (1, None), (2, 100), (3, None), (4, None),
    ]


def test_only_keys_keeps_the_state_of_the_batch(spark):
    log = log_of(spark, {"entity_id": "1"}, {"entity_id": "2"})
    keys = spark.createDataFrame([("2",), ("3",)], "entity_id string")
    assert values(load.only_keys(log, keys), "entity_id") == [("2",)]
    target = target_of(spark, [(1, "2"), (2, "9")])
    assert values(load.only_keys(target, keys, "ref"), "ref", "id") == [("2", 1)]


def test_status_column_is_null_free(spark):
    valid = transform_customers(customers(spark, *[{"AN8": str(k)} for k in range(1, 9)]))
    got = planned(spark, valid, log_of(spark), target_of(spark, []), [])
    assert got.where(F.col("status").isNull()).isEmpty()
