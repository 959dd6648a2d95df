"""Reconciliation tables: summary, validated, failed, load results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.schemas import FAILED, LOADED, NOT_PROCESSED, SKIPPED

# Report columns per entity, as (header, source column).
CUSTOMER_VALIDATED = [
    ("source_key", "_source_key"), ("name", "name"), ("phone", "phone"), ("street", "street"),
    ("street2", "street2"), ("city", "city"), ("zip", "zip"), ("state_code", "state_code"),
    ("country_code", "country_code"), ("tax_id", "vat"), ("customer_rank", "customer_rank"),
    ("is_company", "is_company"), ("parent_key", "parent_key"), ("comment", "comment"),
]
CUSTOMER_FAILED = [
    ("source_key", "_source_key"), ("name", "name"), ("phone", "phone"), ("street", "street"),
    ("city", "city"), ("tax_id", "vat"), ("failed_rule", "_failed_rule"),
    ("failure_reason", "_failure_reason"),
]
ITEM_VALIDATED = [
    ("source_key", "_source_key"), ("name", "name"), ("description", "description"),
    ("type", "type"), ("sale_ok", "sale_ok"), ("purchase_ok", "purchase_ok"),
    ("unit", "uom_id"), ("second_unit", "uom_po_id"), ("list_price", "list_price"),
    ("comment", "comment"),
]
ITEM_FAILED = [
    ("source_key", "_source_key"), ("name", "name"), ("stock_type", "_source_type"),
    ("unit", "_source_unit1"), ("second_unit", "_source_unit2"),
    ("failed_rule", "_failed_rule"), ("failure_reason", "_failure_reason"),
]
# Identifiers stay text, so that no reader turns them into numbers.
TEXT_COLUMNS = ["phone", "vat", "zip", "_source_key", "parent_key"]


def report_columns(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[
        (F.col(c).cast("string") if c in TEXT_COLUMNS else F.col(c)).alias(header)
        for header, c in columns
    ])


def status_reason(status: Column, target_id: Column) -> Column:
    created = F.concat(
        F.lit("Created in the target, id "), F.coalesce(target_id.cast("string"), F.lit("unknown"))
    )
    return (
        F.when(status == LOADED, created)
        .when(status == SKIPPED, "Already loaded, not created again")
        .when(status == FAILED, "Rejected by the target")
        .when(status == NOT_PROCESSED, "Batch stopped before this row")
        .when(status == "DRY RUN", "Dry run, nothing written")
        .otherwise("Unknown status")
    )


def load_results(
    valid: DataFrame, outcomes: DataFrame | None, history: DataFrame | None = None, dry_run: bool = False
) -> DataFrame:
    """What happened to each valid row.

    ``outcomes`` of a load plan cover every valid row and know its name and last id, so nothing is joined.  With
    ``history`` (entity_id, last_id), ``outcomes`` may be any (entity_id, status, target_id, error), each with one
    row per entity id, and valid rows without an outcome are reported as such.
    """
    if dry_run or outcomes is None:
        status = F.lit("DRY RUN")
        nothing = F.lit(None).cast("string")
        return valid.select(
            F.col("_source_key").cast("string").alias("source_key"), "name", status.alias("status"),
            nothing.alias("target_id"), status_reason(status, nothing).alias("reason"),
        )
    if history is None:
        joined = outcomes
    else:
        rows = valid.select(F.col("_source_key").cast("string").alias("entity_id"), "name")
        results = outcomes.select("entity_id", "status", "target_id", "error")
        joined = rows.join(results, "entity_id", "left").join(
            history.select("entity_id", "last_id"), "entity_id", "left"
        )
    known = F.col("status").isNotNull()
    target_id = F.coalesce("target_id", "last_id")
    reason = F.when(
        known, F.coalesce(F.nullif("error", F.lit("")), status_reason(F.col("status"), target_id))
    ).otherwise("No load result for this row")
    return joined.select(
        F.col("entity_id").alias("source_key"),
        "name",
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
        target_id.cast("string").alias("target_id"),
        reason.alias("reason"),
    )


def run_counts(validated: DataFrame) -> DataFrame:
    """One row: extracted, valid, failed and the valid percentage."""
    ok = F.count_if(F.col("_failed_rule").isNull())
    counts = validated.agg(F.count(F.lit(1)).alias("extracted"), ok.alias("valid"))
    return counts.select(
        "extracted",
        "valid",
        (F.col("extracted") - F.col("valid")).alias("failed"),
        F.when(F.col("extracted") > 0, F.col("valid") * 100.0 / F.col("extracted"))
        .otherwise(0.0).cast("double").alias("valid_percent"),
    )


def failures_by_rule(validated: DataFrame) -> DataFrame:
    return (
        validated.where(F.col("_failed_rule").isNotNull())
        .groupBy(F.col("_failed_rule").alias("failed_rule"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def report_status(summary: DataFrame | None, dry_run: bool = False) -> tuple[Column, Column]:
    """(status, message) columns over load counters.

    Differs on purpose from the run outcome: a rejection always reads FAILED here, and a
    batch in which everything was skipped reads NO_OP.
    """
    if dry_run or summary is None:
        return F.lit("DRY_RUN"), F.lit("Dry run, nothing written")
    n = {c: F.col(c) for c in ("total", "loaded", "failed", "not_processed", "skipped")}
    text = {c: n[c].cast("string") for c in n}
    cases = [
        (n["total"] == 0, "NO_OP", F.lit("Nothing to process")),
        (n["failed"] > 0, "FAILED",
         F.concat(F.lit("Stopped: rejected rows "), text["failed"])),
        (n["not_processed"] > 0, "PARTIAL",
         F.concat(F.lit("Stopped early: rows not processed "), text["not_processed"])),
        ((n["loaded"] > 0) & (n["skipped"] > 0), "SUCCESS_WITH_SKIPS",
         F.concat(F.lit("Complete: loaded "), text["loaded"],
                  F.lit(", already loaded "), text["skipped"])),
        (n["loaded"] > 0, "SUCCESS", F.concat(F.lit("Complete: loaded "), text["loaded"])),
        (n["skipped"] > 0, "NO_OP", F.lit("Everything was loaded before")),
    ]
    status, message = F, F
    for condition, label, words in cases:
        status, message = status.when(condition, label), message.when(condition, words)
    return status.otherwise("NO_OP"), message.otherwise("Nothing was processed")


def classify_report(summary: DataFrame) -> DataFrame:
    status, message = report_status(summary)
    return summary.select("*", status.alias("report_status"), message.alias("message"))


def summary_table(
    validated: DataFrame,
    summary: DataFrame | None,
    source: str,
    run_at: str,
    dry_run: bool = False,
) -> DataFrame:
    """(position, label, value) rows; load counters only for a live run.

    Both inputs shrink to one row each before they meet.
    """
    live = summary is not None and not dry_run
    counts = validated.agg(
        F.count(F.lit(1)).alias("extracted"),
        F.count_if(F.col("_failed_rule").isNull()).alias("valid"),
        F.count_if(F.col("_failed_rule").isNotNull()).alias("rejected"),
    ).select("*", F.lit(0).alias("_one"))
    status, message = report_status(summary, dry_run)
    entries = [
        ("Run mode", F.lit("LIVE" if live or not dry_run else "DRY RUN")),
        ("Data source", F.lit(source.upper())),
        ("Run time", F.lit(run_at)),
        ("Total extracted", F.col("extracted")),
        ("Valid records", F.col("valid")),
        ("Failed records", F.col("rejected")),
    ]
    row = counts
    if live:
        row = counts.join(summary.select("*", F.lit(0).alias("_one")), "_one")
        entries += [
            ("Created", F.col("loaded")),
            ("Rejected", F.col("failed")),
            ("Not processed", F.col("not_processed")),
            ("Skipped", F.col("skipped")),
        ]
    entries += [("Run status", status), ("Run message", message)]
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("label"),
                 value.cast("string").alias("value"))
        for i, (label, value) in enumerate(entries, start=1)
    ]
    return row.select(F.inline(F.array(*cells)))
