"""Consecutive numbers in a global order, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.runtime import materialize


def number_rows(df: DataFrame, order: list[str], start: Column, name: str) -> DataFrame:
    """Add consecutive numbers ``start + 1, start + 2, ...`` in the given order.

    The rows are range-sorted and stored with their position inside the sort partition;
    only the per-partition counts, one row per partition, are summed in a window.
    """
    ranked = df.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    stored = materialize(ranked.select("*", F.monotonically_increasing_id().alias("_row")), "sorted")
    part = F.shiftright("_row", 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")), "offsets")
    position = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.select("*", part.alias("_part"))
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (start + F.col("_offset") + position + 1).alias(name))
    )
