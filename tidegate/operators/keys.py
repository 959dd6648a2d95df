"""Duplicate keys, and left joins that survive hot and null keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.runtime import HOT_ROWS, fits_broadcast, materialize


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key over rows whose key is complete.

    Partial aggregation runs before the shuffle, so a key that holds a third of the
    table still sends one row per map task.
    """
    return df.where(_all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    return key_counts(df, keys).where("n > 1")


def hot_answers(
    counts: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and their ``right`` columns as ``_hot``, stored once.

    The bound doubles until the answers fit into a broadcast.  At most ``rows / bound`` keys
    exceed a bound, so a key left to the shuffled join holds a few rows more than
    one of hundreds of thousands of equal shares.
    """
    values = [c for c in right.columns if c not in keys]
    frequent = materialize(counts.where(F.col("n") > hot_rows).select(*keys, "n"), "frequent")
    found = right.join(frequent.select(*keys), list(keys), "left_semi")
    answers = materialize(
        frequent.join(found, list(keys), "left").select(*keys, "n", F.struct(*values).alias("_hot")), "hot"
    )
    while not fits_broadcast(answers):
        hot_rows *= 2
        answers = answers.where(F.col("n") > hot_rows)
    return answers.drop("n")


def unique_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    frequency: DataFrame | None = None,
    small: bool | None = None,
    hot_rows: int = HOT_ROWS,
    left_is_unique: bool = False,
) -> DataFrame:
    """Left join to ``right``, which holds each key once, whatever the key skew of ``left``.

    A small ``right`` (measured, not assumed) is broadcast and ``left`` is not shuffled.
    Otherwise the rows of every key with more than ``hot_rows`` rows are answered from a
    broadcast of just those keys, and only the remaining rows take part in a shuffled join.
    Rows with a null or hot key cannot match there, so they are spread by map task instead
    of meeting in the one partition their key hashes to.

    ``frequency`` may pass known row counts (keys plus ``n``) of ``left``, so that ``left``
    is not computed a second time to count them; ``small`` the outcome of a size check
    already made on ``right``.  With ``left_is_unique`` no key of ``left`` repeats, so there
    is nothing hot to set apart.
    """
    keys = list(keys)
    if small is None:
        small = fits_broadcast(right)
    if small:
        return left.join(F.broadcast(right), keys, "left")
    if left_is_unique:
        return left.join(right, keys, "left")

    values = [c for c in right.columns if c not in keys]
    counts = key_counts(left, keys) if frequency is None else frequency
    hot = hot_answers(counts, right, keys, hot_rows).withColumn("_is_hot", F.lit(True))
    staged = left.join(F.broadcast(hot), keys, "left")

    cold = _all_present(keys) & F.col("_is_hot").isNull()
    staged = staged.select(
        "*",
        *[F.when(cold, F.col(k)).alias(f"_cold_{k}") for k in keys],
        # The map task's number is the same when the task is retried, unlike a random one.
        # A constant on the other side would be folded out of the join keys, hence a hash.
        F.when(cold, F.xxhash64(*keys)).otherwise(F.spark_partition_id()).alias("_spread"),
    )
    cold_right = right.select(
        *[F.col(k).alias(f"_cold_{k}") for k in keys],
        F.struct(*values).alias("_found"),
        F.xxhash64(*keys).alias("_spread"),
    )
    joined = staged.join(cold_right, [*[f"_cold_{k}" for k in keys], "_spread"], "left")
    answer = F.coalesce("_hot", "_found")
    return joined.select(*left.columns, *[answer[v].alias(v) for v in values])


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    flag: str = "_duplicate",
    small: bool | None = None,
) -> DataFrame:
    """Add a boolean telling whether the row's key occurs more than once.

    The duplicate keys are computed once from the key columns alone.  When they are
    few, which is the normal case, the wide rows are never shuffled.
    """
    repeated = materialize(duplicate_keys(df, keys), "duplicates")
    marked = unique_lookup(
        df,
        repeated.withColumnRenamed("n", "_copies"),
        keys,
        frequency=repeated,
        small=small,
    )
    return marked.select(*df.columns, F.col("_copies").isNotNull().alias(flag))
