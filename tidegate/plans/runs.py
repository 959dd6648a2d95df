"""Batch runs.  Only counters and the watermark come to the driver, never rows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas as S
from tidegate.functions import content_hash
from tidegate.operators import conflict, load, report
from tidegate.operators.keys import key_counts, unique_lookup
from tidegate.operators.numbering import number_rows
from tidegate.operators.validate import failed_rows, valid_rows
from tidegate.operators.watermark import (
    after_watermark,
    changed_after,
    latest_change,
    nth_change_time,
    with_change_time,
)
from tidegate.plans.flows import TableFlow
from tidegate.runtime import FILE_ROWS, fits_broadcast, materialize
from tidegate.sinks import Commit, StateStore, write_preview, write_report
from tidegate.sinks.state import watermark_row

Mark = tuple[int, int]
Raw = DataFrame | Callable[[int, int], DataFrame]


@dataclass
class SyncResult:  # fixed values: names of the fields of a run
    table_name: str
    outcome: str = "NO_OP"
    records_extracted: int = 0
    records_valid: int = 0
    records_failed: int = 0
    records_loaded: int = 0
    records_skipped: int = 0
    load_failed: int = 0
    not_processed: int = 0
    watermark_before: Mark | None = None
    watermark_after: Mark | None = None
    duration_seconds: float = 0.0
    exit_code: int = 0
    message: str = ""
    report_path: str | None = None
    records_updated: int = 0
    records_kept: int = 0
    records_flagged: int = 0
    records_retried: int = 0


def new_run() -> tuple[str, str]:
    """Batch id and run time, fixed on the driver so that a retried task repeats them."""
    return str(uuid.uuid4()), datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def run_moment(run_at: str) -> Column:
    return F.lit(f"{run_at} UTC").cast("timestamp")


@dataclass(frozen=True)
class Extract:
    """A stored batch, the watermark it reaches, and the rows in it that this watermark does not cover."""

    batch: DataFrame
    reached: Mark
    seen: DataFrame | None = None


def past_watermark(raw: Raw, mark: Mark) -> DataFrame:
    """Rows changed after the watermark.

    ``raw`` is the source as text columns, or a function of the watermark that reads it,
    for a source that filters on typed columns itself.
    """
    if callable(raw):
        return with_change_time(raw(*mark))
    return after_watermark(with_change_time(raw), *mark)


def extract(raw: Raw, flow: TableFlow, mark: Mark, limit: int | None, seen: DataFrame | None = None) -> Extract:
    """Everything past the watermark, or the first ``limit`` rows of it in contract order.

    Rows without a change time come last.  ``seen`` are rows that earlier limited runs have read although the
    watermark has not passed them: those without a change time, those of a change time that the limit cut, and
    copies read ahead.  They are left out, so limited runs end whatever the limit is.

    Rows that share a key with one of these are read with them, whatever the limit: a repeated key is
    refused by the limited run that meets it, as it is by a run over everything.

    The source is read for counts of its change times and of its keys, and for the rows up to the one that the
    limit reaches, which are stored; the watermark is made from the stored rows alone.
    """
    changed = past_watermark(raw, mark)
    if not limit:
        batch = materialize(changed, "batch", FILE_ROWS)
        return Extract(batch, tuple(latest_change(batch, *mark).first()))

    columns = [f.name for f in flow.raw_schema]
    order = ["_upmj", "_upmt", flow.key, *[c for c in columns if c != flow.key]]
    row_hash = F.sha2(F.to_json(F.struct(*columns)), 256)
    skip = 0
    if seen is not None:
        seen = seen.where(F.coalesce(changed_after(F.col("upmj"), F.col("upmt"), *mark), F.lit(True)))
        skip = seen.count()
    if skip:
        known = seen.select(F.col("row_hash").alias("_raw_hash")).distinct()
        known = F.broadcast(known) if fits_broadcast(known) else known

    def unseen(rows: DataFrame) -> DataFrame:
        hashed = rows.select("*", row_hash.alias("_raw_hash"))
        return hashed.join(known, "_raw_hash", "left_anti") if skip else hashed

    bound = nth_change_time(changed, limit + skip)
    pool = materialize(unseen(changed if bound is None else changed.where(up_to(bound))), "pool", FILE_ROWS)

    last = nth_change_time(pool, limit)
    timed = F.col("_upmj").isNotNull() & F.col("_upmt").isNotNull()
    whole = pool.where(timed if last is None else changed_before(last))
    edge = pool.where(~timed if last is None else (F.col("_upmj") == last[0]) & (F.col("_upmt") == last[1]))
    room = limit - whole.count()
    cut = edge.count() > room
    if cut:  # only rows of one change time are ever sorted
        edge = number_rows(edge, order, F.lit(0), "_place").where(F.col("_place") <= room).drop("_place")
    batch = materialize(whole.unionByName(edge), "batch", FILE_ROWS)
    covered = batch.where(changed_before(last)) if cut and last is not None else batch
    reached = tuple(latest_change(covered, *mark).first())
    if cut or bound is not None:
        batch = with_copies(batch, changed, unseen, flow)
    beyond = ~timed if last is None or not cut else ~timed | ~changed_before(last)
    left = batch.where(beyond | changed_after(F.col("_upmj"), F.col("_upmt"), *reached))
    return Extract(
        batch.drop("_raw_hash"), reached,
        left.select(F.col("_raw_hash").alias("row_hash"), F.col("_upmj").alias("upmj"), F.col("_upmt").alias("upmt")))


def with_copies(
    batch: DataFrame, changed: DataFrame, unseen: Callable[[DataFrame], DataFrame], flow: TableFlow
) -> DataFrame:
    """The batch and all other unseen rows that share a key with one of its rows.

    Only keys and their counts are compared; rows move for the keys that have copies elsewhere.
    """
    key = flow.source_key(F.col(flow.key)).alias("_key")
    inside = key_counts(batch.select(key), ["_key"]).withColumnRenamed("n", "_inside")
    short = materialize(
        key_counts(changed.select(key), ["_key"]).join(inside, "_key").where("n > _inside").select("_key"), "short")
    if short.isEmpty():
        return batch
    wanted = F.broadcast(short) if fits_broadcast(short) else short
    rest = batch.select("*", key).join(wanted, "_key", "left_anti").drop("_key")
    copies = unseen(changed.select("*", key).join(wanted, "_key", "left_semi").drop("_key"))
    return materialize(rest.unionByName(copies), "batch", FILE_ROWS)


def changed_before(mark: Mark) -> Column:
    """Strictly before the change time; never for rows without one."""
    return F.coalesce(
        (F.col("_upmj") < mark[0]) | ((F.col("_upmj") == mark[0]) & (F.col("_upmt") < mark[1])), F.lit(False))


def up_to(mark: Mark) -> Column:
    return (F.col("_upmj") < mark[0]) | ((F.col("_upmj") == mark[0]) & (F.col("_upmt") <= mark[1]))


def load_batch(
    flow: TableFlow,
    valid: DataFrame,
    store: StateStore,
    batch_id: str,
    run_at: str,
    rejections: DataFrame | None = None,
    on_existing: str | None = None,
    reached: Mark | None = None,
    seen: DataFrame | None = None,
    also: Callable[[Commit, DataFrame], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load valid rows; return (outcomes, history before this batch).

    Without ``on_existing`` the load only inserts.  With a conflict strategy, rows whose
    key is in the target already are compared by content hash and updated, kept or
    flagged.  Each decision is kept in the store's ``conflicts`` table.

    Target rows, log, current state, decisions and, if the target rejects nothing, ``reached`` as the new
    watermark and the ``seen`` rows beyond it become visible together, with what ``also`` adds to the commit
    when given the outcomes.  A run that ends before that has changed nothing.
    """
    moment = run_moment(run_at)
    version = F.unix_micros(moment)
    keys = load.with_entity_id(valid).select("entity_id")
    commit = store.begin(batch_id)
    current = store.current(flow.entity, store.buckets_of(keys, "entity_id"), commit.at)
    known = materialize(load.only_keys(current, keys), "known")
    history = known.select("entity_id", "was_loaded", "last_id", "attempts")
    planned = load.plan_load(valid, known, None, rejections, ["existing_id", "attempts", "last_hash"])
    if on_existing is not None:
        present = F.col("status").isin(S.SKIPPED, S.LOADED)
        planned = planned.select(
            "*", F.when(present, content_hash(planned, flow.hash_fields)).alias("content_hash"))
        planned = planned.select("*", F.when(present, conflict.change_kind(planned)).alias("change"))
    # What the batch makes of each row's state is read off the plan.  Only logged rows need their last hash for that.
    planned = planned.withColumn("last_hash", F.when(F.col("status") != S.SKIPPED, F.col("last_hash")))
    planned = materialize(planned, "plan")
    target_table = f"target_{flow.entity}"
    created = load.number_created(planned, commit.high(target_table))
    # Both parts are stored; together they are not written once more.
    outcomes = planned.where(~F.col("created")).unionByName(created)

    fields = [f.name for f in flow.target_schema if f.name not in ("id", "version")]

    def target_rows(rows: DataFrame) -> DataFrame:
        payload = flow.payload(rows)
        return payload.select(*fields, F.col("target_id").alias("id"), version.alias("version"))

    counted = outcomes.agg(
        F.max(F.when(F.col("created"), F.col("target_id"))).alias("last_id"),
        F.count_if("created").alias("created"),
        F.count_if(F.col("status") != S.SKIPPED).alias("logged"),
        F.count_if(F.col("status") == S.FAILED).alias("failed"),
        F.count_if(F.col("status") == S.LOADED).alias("loaded"),
    ).first()
    written, hashes = F.col("created"), content_hash(outcomes, flow.hash_fields)

    if on_existing is not None:
        found = outcomes.where(~F.col("created") & present)
        # Only keys and hashes meet the state here; the plan has told already which rows have changed.
        compared = unique_lookup(
            found.select("entity_id", "content_hash"), known.select("entity_id", "existing_id", "last_hash"),
            ["entity_id"], left_is_unique=True)
        decided = materialize(conflict.decide(compared, on_existing).where("change != 'insert'"), "decided")
        commit.append("conflicts", decided.select(
            F.lit(batch_id).alias("batch_id"), F.lit(flow.entity).alias("entity_type"), "entity_id",
            F.col("existing_id").alias("target_id"), "change", "action", "reason", "strategy",
            "content_hash", "last_hash", moment.alias("run_at"),
        ), "entity_id", S.CONFLICTS)
        action = conflict.action_for(F.col("change"), F.lit(on_existing))
        # Rows that were not processed, or refused, are not compared: their change is null.
        written |= F.coalesce((F.col("change") == "changed") & (action == S.UPDATE), F.lit(False))
        hashes = F.col("content_hash")

    changed_rows = outcomes.where(written).withColumn("target_id", F.coalesce("target_id", "existing_id"))
    commit.append(target_table, target_rows(changed_rows), flow.ref, flow.target_schema, counted["last_id"])
    # If the created rows are all that is logged, as in a first load, they are in log order already.
    ordered = F.col("target_id") - commit.high(target_table) if counted["created"] == counted["logged"] else None
    logged = load.log_rows(outcomes, flow.entity, batch_id, moment, commit.high("load_log"), ordered)
    commit.append("load_log", logged, "entity_id", S.LOAD_LOG, commit.high("load_log") + counted["logged"])
    changed = current_rows(outcomes.select("*", F.when(written, hashes).alias("_hash")))
    commit.merge(f"current_{flow.entity}", materialize(changed, "current"), "entity_id", S.CURRENT_STATE)
    if reached is not None and counted["failed"] == 0:
        commit.append("watermarks", watermark_row(
            store.spark, flow.table_name, reached, F.lit(counted["loaded"]), moment), "table_name", S.WATERMARK_STATE)
        if seen is not None:
            commit.append(f"seen_{flow.table_name}", seen, "row_hash", S.SEEN_ROWS)
    if also is not None:
        also(commit, outcomes)
    commit.publish()
    return outcomes, history


def current_rows(hashed: DataFrame) -> DataFrame:
    """State of each entity that a batch logged or wrote, after the batch.

    ``hashed`` are outcomes with ``_hash`` of the rows created or updated.  They carry their state, so nothing is
    joined: a row that was loaded before is a skipped one, and its last hash matters only if it is not written.
    """
    logged, loaded = F.col("status") != S.SKIPPED, F.col("status") == S.LOADED
    return hashed.where(logged | F.col("_hash").isNotNull()).select(
        "entity_id",
        (loaded | ~logged).alias("was_loaded"),
        F.when(loaded & F.col("target_id").isNotNull(), F.col("target_id")).otherwise(F.col("last_id")).alias("last_id"),
        F.when(logged, F.col("attempt_number")).otherwise(F.col("attempts")).alias("attempts"),
        F.coalesce("existing_id", F.when(F.col("created"), F.col("target_id"))).alias("existing_id"),
        F.coalesce("_hash", "last_hash").alias("last_hash"),
    )


def report_tables(
    flow: TableFlow,
    validated: DataFrame,
    outcomes: DataFrame | None,
    source: str,
    run_at: str,
    dry_run: bool,
) -> dict[str, DataFrame]:
    """The four reconciliation tables of a run."""
    summary = None if outcomes is None else load.load_summary(outcomes)
    valid = valid_rows(validated)
    return {
        "summary": report.summary_table(validated, summary, source, run_at, dry_run),
        "validated": report.report_columns(valid, flow.validated_columns),
        "failed": report.report_columns(failed_rows(validated), flow.failed_columns),
        "load_results": report.load_results(valid, outcomes, dry_run=dry_run),
    }


def process_batch(
    flow: TableFlow,
    batch: DataFrame,
    store: StateStore,
    result: SyncResult,
    batch_id: str,
    run_at: str,
    dry_run: bool = False,
    rejections: DataFrame | None = None,
    on_existing: str | None = None,
    source: str = "sync",
    report_root: str | None = None,
    preview_root: str | None = None,
    reached: Mark | None = None,
    seen: DataFrame | None = None,
    retry: bool = False,
) -> SyncResult:
    """Transform, validate and load one non-empty raw batch, filling ``result``.

    ``reached`` is the watermark to store with the batch unless the target rejects a row.  With ``retry``, rows
    that the target refused or that were not processed stay in the store's queue, which changes with the
    batch's commit, and take part in the next batch in contract order.  A row of the batch itself,
    valid or not, takes the place of a waiting one with its key.
    """
    validated = materialize(flow.validate(flow.transform(batch)), "validated", FILE_ROWS)
    counts = report.run_counts(validated).first()
    result.records_extracted = counts["extracted"]
    result.records_valid = counts["valid"]
    result.records_failed = counts["failed"]

    if preview_root is not None:
        preview = flow.preview
        write_preview(valid_rows(validated), preview_root, "valid", batch_id, preview)
        write_preview(
            failed_rows(validated), preview_root, "failed", batch_id,
            [*preview, *S.FAILURE_COLUMNS],
        )

    valid, also = valid_rows(validated), None
    if retry and not dry_run:
        queue, shape = f"retry_{flow.table_name}", valid.schema
        arrived = validated.where("_source_key IS NOT NULL").select("_source_key")
        waiting = materialize(store.read(queue, shape).join(arrived, "_source_key", "left_anti"), "waiting")
        result.records_retried = waiting.count()
        valid = valid.unionByName(waiting)

        def also(commit: Commit, outcomes: DataFrame) -> None:
            left = outcomes.where(F.col("status").isin(S.FAILED, S.NOT_PROCESSED)).select(*shape.names)
            commit.replace(queue, left, "_source_key", shape, set(range(store.buckets)))

    outcomes = None
    if dry_run:
        result.outcome = "DRY_RUN"
        result.message = (
            f"Dry run: {result.records_valid} valid, {result.records_failed} failed, nothing written"
        )
    else:
        outcomes, _ = load_batch(
            flow, valid, store, batch_id, run_at, rejections, on_existing, reached, seen, also
        )
        counted = load.run_outcome(load.load_summary(outcomes)).first()
        result.outcome = counted["outcome"]
        result.exit_code = counted["exit_code"]
        result.records_loaded = counted["loaded"]
        result.records_skipped = counted["skipped"]
        result.load_failed = counted["failed"]
        result.not_processed = counted["not_processed"]
        if reached is not None and result.load_failed == 0:
            result.watermark_after = reached
        result.message = (
            f"{result.outcome}: extracted {result.records_extracted}, "
            f"valid {result.records_valid}, loaded {result.records_loaded}, "
            f"skipped {result.records_skipped}, rejected {result.records_failed}"
        )
        if on_existing is not None:
            decisions = store.conflicts().where(F.col("batch_id") == batch_id)
            changed = decisions.where("change = 'changed'").agg(*[
                F.count_if(F.col("action") == action).alias(action)
                for action in (S.UPDATE, S.SKIP, S.FLAG)
            ]).first()
            result.records_updated, result.records_kept, result.records_flagged = changed
            result.message += (
                f"; changed rows: {result.records_updated} updated, {result.records_kept} kept, "
                f"{result.records_flagged} flagged for review"
            )

    if report_root is not None:
        tables = report_tables(flow, validated, outcomes, source, run_at, dry_run)
        if not dry_run and on_existing is not None:
            tables["conflicts"] = decisions
        try:
            result.report_path = write_report(tables, report_root, batch_id)
        except Exception as error:  # a report never fails a run that has loaded its rows
            result.message += f"; report not written: {error}"
    return result


def run_sync(
    flow: TableFlow,
    raw: Raw,
    store: StateStore,
    dry_run: bool = False,
    limit: int | None = None,
    rejections: DataFrame | None = None,
    on_existing: str | None = None,
    report_root: str | None = None,
) -> SyncResult:
    """One incremental cycle over ``raw`` (see ``extract``).

    The watermark moves only when the target rejected nothing.  Rows that fail validation
    do not hold it, so they come back only when the source changes them; the failed
    report table is where they stay visible.
    """
    started = time.monotonic()
    batch_id, run_at = new_run()
    mark = store.watermark(flow.table_name)
    result = SyncResult(flow.table_name, watermark_before=mark)

    seen = store.read(f"seen_{flow.table_name}", S.SEEN_ROWS) if limit else None
    taken = extract(raw, flow, mark, limit, seen)
    if taken.batch.isEmpty():
        result.message = f"Nothing changed after ({mark[0]}, {mark[1]})"
    else:
        process_batch(
            flow, taken.batch, store, result, batch_id, run_at, dry_run, rejections, on_existing,
            report_root=None if dry_run else report_root,
            reached=None if dry_run else taken.reached, seen=taken.seen,
        )
    result.duration_seconds = time.monotonic() - started
    return result


def run_migration(
    flow: TableFlow,
    raw: Raw,
    store: StateStore,
    output_root: str,
    dry_run: bool = True,
    limit: int | None = None,
    source: str = "csv",
    rejections: DataFrame | None = None,
) -> SyncResult:
    """Full load without watermark.  A dry run writes previews and a report only."""
    started = time.monotonic()
    batch_id, run_at = new_run()
    result = SyncResult(flow.table_name)
    batch = extract(raw, flow, (0, 0), limit).batch
    process_batch(
        flow, batch, store, result, batch_id, run_at, dry_run, rejections, None,
        source=source, report_root=output_root, preview_root=output_root if dry_run else None,
    )
    result.duration_seconds = time.monotonic() - started
    return result
