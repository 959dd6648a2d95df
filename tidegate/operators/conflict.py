"""What to do with a source row whose key already exists in the target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.schemas import FLAG, NONE, SKIP, SOURCE_WINS, TARGET_WINS, UPDATE

STRATEGIES = (SOURCE_WINS, TARGET_WINS, FLAG)


def _strategy_column(strategy: str | Column) -> Column:
    if isinstance(strategy, Column):
        return strategy
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown conflict strategy {strategy!r}; known: {STRATEGIES}")
    return F.lit(strategy)


def change_kind(df: DataFrame) -> Column:
    """insert, unchanged or changed, from existing_id, content_hash and last_hash.

    A null or empty last hash counts as changed.
    """
    same = (F.col("last_hash") != "") & (F.col("last_hash") == F.col("content_hash"))
    return (
        F.when(F.col("existing_id").isNull(), "insert")
        .when(F.coalesce(same, F.lit(False)), "unchanged")
        .otherwise("changed")
    )


def action_for(change: Column, chosen: Column) -> Column:
    """NONE (create), SKIP, UPDATE or FLAG."""
    return (
        F.when(change == "insert", NONE)
        .when(change == "unchanged", SKIP)
        .when(chosen == SOURCE_WINS, UPDATE)
        .when(chosen == TARGET_WINS, SKIP)
        .when(chosen == FLAG, FLAG)
    )


def conflict_inputs(hashed: DataFrame, existing: DataFrame, last_hashes: DataFrame) -> DataFrame:
    """Source rows (entity_id, content_hash, ...) with target id and last stored hash.

    ``existing`` is (entity_id, existing_id) and ``last_hashes`` (entity_id, last_hash),
    each with one row per entity id; the two joins share one partitioning.
    """
    return hashed.join(existing, "entity_id", "left").join(last_hashes, "entity_id", "left")


def decide(inputs: DataFrame, strategy: str | Column) -> DataFrame:
    """Add change, action (see ``action_for``), reason and strategy.

    The strategy, a literal or a column,
    only matters for a changed row; it is null for a row that is new to the target.
    """
    chosen = _strategy_column(strategy)
    rows = inputs.select("*", change_kind(inputs).alias("change"), chosen.alias("_chosen"))
    change, chosen = F.col("change"), F.col("_chosen")
    target = F.concat(F.lit("target row "), F.col("existing_id").cast("string"))
    reason = (
        F.when(change == "insert", "Not in the target yet")
        .when(change == "unchanged", "Same content as last loaded")
        .when(chosen == SOURCE_WINS, F.concat(target, F.lit(" is updated from the source")))
        .when(chosen == TARGET_WINS, F.concat(target, F.lit(" is kept, source change ignored")))
        .when(chosen == FLAG, F.concat(target, F.lit(" differs from the source, needs review")))
    )
    return rows.select(
        *inputs.columns,
        "change",
        action_for(change, chosen).alias("action"),
        reason.alias("reason"),
        F.when(change != "insert", chosen).alias("strategy"),
    )


def apply_decisions(decided: DataFrame, target: DataFrame, fields: list[str], ref: str) -> DataFrame:
    """New version of the target: (id, ref, fields).

    UPDATE takes the source values, every other target row is kept as it is, rows to be
    created have a null id.  ``decided`` has one row per entity id.
    """
    source = decided.where(F.col("action").isin(NONE, UPDATE)).select(
        F.col("entity_id").alias("_ref"),
        F.col("existing_id").alias("_id"),
        F.struct(*fields).alias("_new"),
    )
    kept = target.select(
        "id", F.col(ref).alias("_target_ref"), F.struct(*fields).alias("_old")
    )
    # A key may repeat in the target; only the row the decision names takes the update.
    same = (F.col("_target_ref") == F.col("_ref")) & (F.col("id") == F.col("_id"))
    merged = kept.join(source, same, "full_outer")
    value = F.coalesce("_new", "_old")
    return merged.select(
        "id",
        F.coalesce("_target_ref", "_ref").alias(ref),
        *[value[f].alias(f) for f in fields],
    )
