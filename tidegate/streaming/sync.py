"""Micro-batch sync and streaming row validation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidegate.operators.validate import Rule, apply_rules
from tidegate.operators.watermark import latest_change, with_change_time
from tidegate.plans.flows import TableFlow
from tidegate.plans.runs import SyncResult, new_run, process_batch
from tidegate.runtime import FILE_ROWS, materialize
from tidegate.sinks import StateStore

Refusals = DataFrame | Callable[[int], DataFrame | None] | None


def validate_stream(transformed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Row rules on a streaming DataFrame.  Rules must not use ``_duplicate``, which
    needs the whole batch."""
    return apply_rules(transformed, rules)


def sync_epoch(
    flow: TableFlow,
    store: StateStore,
    rows: DataFrame,
    epoch: str,
    rejections: DataFrame | None = None,
    on_existing: str | None = None,
) -> SyncResult | None:
    """Load the raw rows of one epoch and the rows that wait from earlier ones; None for no rows.

    The epoch's name is the name of its commit.  An epoch that was committed is not loaded again, whatever
    rows come with it: its log, its target rows and its watermark are there already.
    """
    mark = store.watermark(flow.table_name)
    result = SyncResult(flow.table_name, watermark_before=mark)
    if store.published(epoch):
        result.outcome, result.message = "REPLAYED", f"{epoch} is committed already"
        return result
    batch = materialize(with_change_time(rows), "batch", FILE_ROWS)
    if batch.isEmpty():
        return None
    reached = tuple(latest_change(batch, *mark).first())
    return process_batch(
        flow, batch, store, result, epoch, new_run()[1], rejections=rejections, on_existing=on_existing,
        reached=reached, retry=True)


def start_sync(
    raw: DataFrame,
    flow: TableFlow,
    store: StateStore,
    checkpoint: str,
    on_existing: str | None = None,
    on_result: Callable[[SyncResult], None] | None = None,
    rejections: Refusals = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Run every micro-batch of ``raw`` (text columns) through the batch load.

    ``rejections`` (entity_id, error) are rows the target refuses, fixed or as a function of the epoch.  Refused
    rows, and rows not processed because of one, are tried again with each later micro-batch.  ``trigger`` holds
    the arguments of the stream's trigger; without it all that is there is read and the query ends.
    Duplicate keys are looked for within one micro-batch, as in a batch run.  The stored watermark runs along
    with the stream and never falls; an epoch repeated after a failure is recognised by its commit.
    """
    spark = raw.sparkSession
    identity: list[str] = []

    def handle(micro_batch: DataFrame, epoch: int) -> None:
        if not identity:  # the query's own id, kept in its checkpoint: a new checkpoint is a new stream
            saved = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()
            identity.append(saved[0])
        refused = rejections(epoch) if callable(rejections) else rejections
        result = sync_epoch(flow, store, micro_batch, f"{identity[0]}:{epoch}", refused, on_existing)
        if on_result is not None and result is not None:
            on_result(result)

    return (
        raw.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
