"""Idempotent load planning against a load log and a target table.

The decision order for a row is: already loaded in an earlier batch, then batch stopped
by an earlier rejection, then already in the target, then create (or rejection).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import parse_long
from tidegate.operators.keys import unique_lookup
from tidegate.operators.numbering import number_rows
from tidegate.operators.units import resolve_units
from tidegate.runtime import fits_broadcast, materialize
from tidegate.schemas import FAILED, LOADED, NOT_PROCESSED, SKIPPED

EXISTED = "Already in the target, not created again"

# Processing order of a batch.  Keys of valid rows are unique, so the order is total.
ORDER = ["_upmj", "_upmt", "_source_key"]


def backfill_log(log: DataFrame) -> DataFrame:
    """Log rows written before items existed get entity id and type from the old key."""
    return log.select(
        *[c for c in log.columns if c not in ("entity_id", "entity_type")],
        F.coalesce("entity_id", F.col("an8").cast("string")).alias("entity_id"),
        F.when(F.col("entity_id").isNull(), F.coalesce("entity_type", F.lit("customer")))
        .otherwise(F.col("entity_type")).alias("entity_type"),
    )


def log_history(log: DataFrame, entity: str) -> DataFrame:
    """One row per entity id: whether it was loaded, its latest target id, attempts.

    A single aggregation serves every question the planner and the report ask.
    """
    loaded = F.col("status") == LOADED
    with_id = loaded & F.col("target_id").isNotNull()
    return (
        log.where(F.col("entity_type") == entity)
        .groupBy("entity_id")
        .agg(
            F.coalesce(F.bool_or(loaded), F.lit(False)).alias("was_loaded"),
            F.max_by("target_id", F.when(with_id, F.struct("run_at", "log_id"))).alias("last_id"),
            F.max("attempt_number").alias("attempts"),
        )
    )


def historical_ids(log: DataFrame, entity: str) -> DataFrame:
    """Latest target id of each loaded entity."""
    return log_history(log, entity).where(F.col("last_id").isNotNull()).select(
        "entity_id", F.col("last_id").alias("target_id")
    )


def loaded_keys(log: DataFrame, entity: str) -> DataFrame:
    """Entity ids loaded by any earlier batch."""
    return log_history(log, entity).where("was_loaded").select("entity_id")


def with_entity_id(df: DataFrame, key: str = "_source_key") -> DataFrame:
    return df.select("*", F.col(key).cast("string").alias("entity_id"))


def skipped(valid: DataFrame, log: DataFrame, entity: str) -> DataFrame:
    """Rows an earlier batch already loaded."""
    return with_entity_id(valid).join(loaded_keys(log, entity), "entity_id", "left_semi")


def worklist(valid: DataFrame, log: DataFrame, entity: str) -> DataFrame:
    """Rows no earlier batch loaded."""
    return with_entity_id(valid).join(loaded_keys(log, entity), "entity_id", "left_anti")


def target_ids(target: DataFrame, ref: str) -> DataFrame:
    """Lowest target id of each business key."""
    return target.where(F.col(ref).isNotNull()).groupBy(F.col(ref).alias("entity_id")).agg(
        F.min("id").alias("existing_id")
    )


def existing_in_target(valid: DataFrame, target: DataFrame, ref: str) -> DataFrame:
    """Rows with ``existing_id`` of the target row that has the same business key."""
    return with_entity_id(valid).join(target_ids(target, ref), "entity_id", "left")


def attempt_numbers(valid: DataFrame, log: DataFrame, entity: str) -> DataFrame:
    """Rows with the number of their next load attempt."""
    tried = log_history(log, entity).select("entity_id", "attempts")
    return with_entity_id(valid).join(tried, "entity_id", "left").select(
        "*", (F.coalesce("attempts", F.lit(0)) + 1).cast("int").alias("attempt_number")
    ).drop("attempts")


def only_keys(state: DataFrame, keys: DataFrame, column: str = "entity_id") -> DataFrame:
    """State rows of the batch's keys.

    An incremental batch is tiny next to log and target: its keys are broadcast and
    neither is shuffled.  The keys of a larger batch are met in a shuffle.
    """
    wanted = keys.select(F.col("entity_id").alias(column))
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    return state.join(wanted, column, "left_semi")


def plan_load(
    valid: DataFrame,
    history: DataFrame,
    existing: DataFrame | None,
    rejections: DataFrame | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Outcome of every valid row, without side effects.

    ``history`` comes from ``log_history`` and ``existing`` from ``target_ids``; both hold
    an entity id once, and so does ``valid``.  Stored tables are best for both, since
    their size decides whether the wide rows have to be shuffled at all.  ``history`` may hold
    ``existing_id`` itself, and ``existing`` is None then: the rows meet their state once.  ``carried`` names
    columns of it that the outcomes keep.

    ``rejections`` (``entity_id``, ``error``) names rows the target would refuse.  The
    first refused row that reaches the create step fails, and later rows are not
    processed.  That row is found by an aggregate over the refused rows, not by an
    ordered scan, so the batch stays distributed.
    """
    rows = unique_lookup(with_entity_id(valid), history, ["entity_id"], left_is_unique=True)
    if existing is not None:
        rows = unique_lookup(rows, existing, ["entity_id"], left_is_unique=True)
    was_loaded = F.coalesce("was_loaded", F.lit(False))
    exists = F.col("existing_id").isNotNull()
    place = F.struct(*ORDER)

    if rejections is None:
        stopped = refused = F.lit(False)
        error = F.lit(None).cast("string")
    else:
        reasons = materialize(rejections.groupBy("entity_id").agg(  # else worked out again to be measured
            F.min("error").alias("_error"), F.lit(True).alias("_refused")), "reasons")
        # Stored with its state: the first refused row is found in it before the rest is decided.
        rows = materialize(unique_lookup(rows, reasons, ["entity_id"], left_is_unique=True), "refusals")
        first = rows.where(F.col("_refused") & ~was_loaded & ~exists).agg(F.min(
            F.struct(*ORDER, "_error")
        )).scalar()
        rows = rows.select("*", first.alias("_first"))
        stop = F.struct(*[F.col("_first")[c].alias(c) for c in ORDER])
        found = F.col("_first").isNotNull()
        stopped = found & (place > stop)
        refused = found & (place == stop)
        error = F.col("_first")["_error"]

    status = (
        F.when(was_loaded, SKIPPED)
        .when(stopped, NOT_PROCESSED)
        .when(exists, LOADED)
        .when(refused, FAILED)
        .otherwise(LOADED)
    )
    rows = rows.select("*", status.alias("status"))
    loaded = F.col("status") == LOADED
    return rows.select(
        *valid.columns,
        "entity_id",
        "status",
        F.when(loaded, F.col("existing_id")).alias("target_id"),
        F.when(loaded & exists, F.lit(EXISTED))
        .when(F.col("status") == FAILED, error).alias("error"),
        (loaded & ~exists).alias("created"),
        (F.coalesce("attempts", F.lit(0)) + 1).cast("int").alias("attempt_number"),
        "last_id",
        *carried,
    )


def assign_target_ids(outcomes: DataFrame, target: DataFrame) -> DataFrame:
    """Created rows with new target ids that continue the target's numbering.

    The greatest id is read here, once: rows appended to the target later do not move it.
    """
    return number_created(outcomes, target.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).first()[0])


def number_created(outcomes: DataFrame, greatest: int) -> DataFrame:
    """Created rows with target ids that follow ``greatest`` in processing order."""
    return number_rows(outcomes.where("created").drop("target_id"), ORDER, F.lit(greatest), "target_id")


def log_rows(
    outcomes: DataFrame, entity: str, batch_id: str, run_at: Column, greatest: int = 0, place: Column | None = None,
) -> DataFrame:
    """Load-log rows of a batch, with log ids that follow ``greatest`` in processing order, without gaps.

    Skipped rows are not logged again.  ``place`` is the place of each logged row in that order, from 1, if it is known.
    """
    needed = [*ORDER, "attempt_number", "entity_id", "status", "target_id", "error", "name"]
    logged = outcomes.where(F.col("status") != SKIPPED).select(*needed)  # only these are sorted
    if place is None:
        numbered = number_rows(logged, ORDER, F.lit(greatest), "_log_id")
    else:
        numbered = logged.select("*", (F.lit(greatest) + place).alias("_log_id"))
    return numbered.select(
        F.col("_log_id").cast("bigint").alias("log_id"),
        F.lit(batch_id).alias("batch_id"),
        "attempt_number",
        F.col("_source_key").alias("an8"),
        "entity_id",
        run_at.cast("timestamp").alias("run_at"),
        "status",
        "target_id",
        "error",
        F.col("name").alias("record_name"),
        F.lit(entity).alias("entity_type"),
    )


def load_summary(outcomes: DataFrame) -> DataFrame:
    """One row of counters."""
    def counted(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return outcomes.agg(
        F.count(F.lit(1)).alias("total"),
        counted(LOADED).alias("loaded"),
        counted(FAILED).alias("failed"),
        counted(NOT_PROCESSED).alias("not_processed"),
        counted(SKIPPED).alias("skipped"),
    )


def run_outcome(summary: DataFrame) -> DataFrame:
    """Outcome class and process exit code from load counters."""
    outcome = (
        F.when((F.col("failed") > 0) & (F.col("not_processed") > 0), "PARTIAL")
        .when(F.col("failed") > 0, "FAILED")
        .when(F.col("skipped") > 0, "SUCCESS_WITH_SKIPS")
        .otherwise("SUCCESS")
    )
    return summary.select("*", outcome.alias("outcome")).select(
        "*", F.when(F.col("outcome").isin("FAILED", "PARTIAL"), 1).otherwise(0).alias("exit_code")
    )


def partner_payload(customers: DataFrame, fields: list[str]) -> DataFrame:
    """Target fields of a partner plus ``ref``, the text of the source key."""
    return customers.select(*fields, F.col("_source_key").cast("string").alias("ref"))


def product_payload(items: DataFrame, units: DataFrame, fields: list[str]) -> DataFrame:
    """Target fields of a product plus ``default_code`` and the resolved unit id."""
    return resolve_units(items, units).select(
        *fields,
        F.col("_source_key").cast("string").alias("default_code"),
        F.col("_unit_id").alias("uom_id"),
    )


def resolve_parents(customers: DataFrame, ids: DataFrame) -> DataFrame:
    """Second pass: ``parent_target_id`` of each row's parent key, null if unknown.

    ``ids`` holds (entity_id, target_id) once per entity.  A parent may own any share of
    the rows, so the join goes through the skew-safe lookup.
    """
    keyed = customers.select("*", parse_long(F.col("parent_key")).cast("string").alias("_parent"))
    side = materialize(ids.select(
        F.col("entity_id").alias("_parent"), F.col("target_id").alias("parent_target_id")
    ), "parents")
    return unique_lookup(keyed, side, ["_parent"]).drop("_parent")


def may_advance(failed: Column) -> Column:
    """Whether the watermark may move: only when the target rejected nothing."""
    return failed == 0
