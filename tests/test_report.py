import pytest
from helpers import customers, values
from pyspark.sql import functions as F

from tidegate.operators import report
from tidegate.operators.transform import transform_customers
from tidegate.operators.validate import validate_customers

SUMMARY = "total bigint, loaded bigint, failed bigint, not_processed bigint, skipped bigint"


@pytest.mark.parametrize("counts, status", [
    ((0, 0, 0, 0, 0), "NO_OP"),
    ((6, 2, 1, 3, 0), "FAILED"),
    ((5, 2, 0, 3, 0), "PARTIAL"),
    ((3, 2, 0, 0, 1), "SUCCESS_WITH_SKIPS"),
    ((3, 3, 0, 0, 0), "SUCCESS"),
    ((3, 0, 0, 0, 3), "NO_OP"),
    ((3, 0, 0, 0, 0), "NO_OP"),
])
def test_status(spark, counts, status):
    row = report.classify_report(spark.createDataFrame([counts], SUMMARY)).first()
    assert row.report_status == status
    assert row.message


def batch(spark):
    return validate_customers(transform_customers(customers(
        spark, {"AN8": "1"}, {"AN8": "2"}, {"AN8": "3"}, {"AN8": "4", "ALPH": None}
    )))


def test_counts(spark):
    assert tuple(report.run_counts(batch(spark)).first()) == (4, 3, 1, 75.0)
    assert tuple(report.run_counts(batch(spark).limit(0)).first()) == (0, 0, 0, 0.0)
    assert values(report.failures_by_rule(batch(spark)), "failed_rule", "rows") == [
        ("RULE_03_NAME_REQUIRED", 1)
    ]


def test_summary(spark):
    summary = spark.createDataFrame([(3, 2, 0, 0, 1)], SUMMARY)
    live = report.summary_table(batch(spark), summary, "csv", "now").orderBy("position").collect()
    assert [(r.label, r.value) for r in live] == [
        ("Run mode", "LIVE"), ("Data source", "CSV"), ("Run time", "now"),
        ("Total extracted", "4"), ("Valid records", "3"), ("Failed records", "1"),
        ("Created", "2"), ("Rejected", "0"), ("Not processed", "0"), ("Skipped", "1"),
        ("Run status", "SUCCESS_WITH_SKIPS"), ("Run message", "Complete: loaded 2, already loaded 1"),
    ]
    dry = report.summary_table(batch(spark), None, "csv", "now", dry_run=True)
    assert dry.count() == 8
    assert dry.where("label = 'Run status'").first().value == "DRY_RUN"


def test_load_results(spark):
    valid = batch(spark).where(F.col("_failed_rule").isNull())
    outcomes = spark.createDataFrame(
        [("1", "LOADED", 11, None), ("2", "SKIPPED", None, None)],
        "entity_id string, status string, target_id bigint, error string",
    )
    history = spark.createDataFrame([("2", 22), ("3", 33)], "entity_id string, last_id bigint")
    got = report.load_results(valid, outcomes, history)
    assert values(got, "source_key", "status", "target_id", "reason") == [
        ("1", "LOADED", "11", "Created in the target, id 11"),
        ("2", "SKIPPED", "22", "Already loaded, not created again"),
        ("3", "UNKNOWN", "33", "No load result for this row"),
    ]
    dry = report.load_results(valid, None, history, dry_run=True)
    assert values(dry, "status", "target_id")[0] == ("DRY RUN", None)
