"""Key ranges of about equal depth, planned from counts.

A database is best read in ranges of its key, each through a connection of its own.  Ranges of equal
width leave one reader with most rows when keys crowd.  Here rows are counted in bins of the key, in the
source; only bins that hold more than a reader's share are counted again, in finer bins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 256  # counted at a time

# (bin, rows) of the keys in [low, high), where bin is (key - low) divided by width
Counter = Callable[[int, int, int], list[tuple[int, int]]]


@dataclass(frozen=True)
class KeyRange:
    """Keys from ``low`` up to ``high`` without it; None is no bound.  The first range has rows without a key."""

    low: int | None
    high: int | None
    rows: int

    def predicate(self, key: str) -> str:
        parts = [f"{key} >= {self.low}"] if self.low is not None else []
        parts += [f"{key} < {self.high}"] if self.high is not None else []
        inside = " AND ".join(parts) or "1 = 1"
        return inside if self.low is not None else f"({inside} OR {key} IS NULL)"

    def condition(self, key: str) -> Column:
        return F.expr(self.predicate(f"`{key}`"))


def bin_counter(df: DataFrame, key: str) -> Counter:
    """Counts by a partial aggregate over the key column alone."""
    def count(low: int, high: int, width: int) -> list[tuple[int, int]]:
        k = F.col(f"`{key}`")
        bins = df.where((k >= low) & (k < high)).groupBy(F.floor((k - low) / width).alias("bin"))
        return [tuple(r) for r in bins.agg(F.count(F.lit(1))).collect()]

    return count


def sql_counter(run: Callable[[str], DataFrame], table: str, key: str) -> Counter:
    """Counts that the database makes; ``run`` reads a query."""
    def count(low: int, high: int, width: int) -> list[tuple[int, int]]:
        place = f"FLOOR(({key} - {low}) / {width})"
        found = run(f"SELECT {place} AS bin, COUNT(*) AS n FROM {table} WHERE {key} >= {low} AND {key} < {high} GROUP BY {place}")
        return [(int(r[0]), int(r[1])) for r in found.collect()]

    return count


def plan_ranges(count: Counter, low: int, high: int, partitions: int) -> list[KeyRange]:
    """At most ``2 * partitions`` ranges over the whole numbers ``low`` to ``high`` (both occur).

    No range has more than twice a reader's share of the rows, except one of a single key: the rows of one key stay
    together.  Each round counts only bins above the share, at most ``partitions`` of them.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    counted: list[tuple[int, int, int]] = []
    share: int | None = None
    todo = [(low, high + 1)]
    while todo:
        start, stop = todo.pop()
        width = max(1, -(-(stop - start) // BINS))
        bins = sorted(count(start, stop, width))
        if share is None:
            share = max(1, -(-sum(n for _, n in bins) // partitions))
        for number, n in bins:
            at = start + number * width
            until = min(at + width, stop)
            if n > share and until - at > 1:
                todo.append((at, until))
            else:
                counted.append((at, until, n))
    ranges: list[list[int]] = []
    for at, _, n in sorted(counted):
        if ranges and ranges[-1][1] + n <= share:
            ranges[-1][1] += n
        else:
            ranges.append([at, n])
    starts = [None, *[at for at, _ in ranges[1:]]]
    return [
        KeyRange(start, end, n)
        for start, end, (_, n) in zip(starts, [*starts[1:], None], ranges or [[low, 0]], strict=True)]
