"""Mixing sources to target weights by Pfair scheduling of blocks.

A source of weight w gets block j (from 0) no earlier than slot floor(j / w) and before slot
ceil((j + 1) / w).  Earliest deadline first among the released blocks then keeps every source
within one block of its share at every slot.  A period has whole blocks of each source.  What
its weight has beyond whole blocks is carried on: the rests are scheduled in the same way, by
periods instead of slots.  So a source is within one block of its exact weight at the end of each
period and within two inside, however many periods there are, and periods are scheduled in parallel.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import materialize

BLOCK = 16  # documents
PERIOD = 1_000  # slots
MAX_SOURCES = 1_000


def period_schedule(shares: dict[int, int]) -> list[int]:
    """The source of each slot of a period of sum(shares) slots."""
    period = sum(shares.values())
    waiting = [(0, s) for s in shares if shares[s]]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []  # by deadline
    done = dict.fromkeys(shares, 0)
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[s] + 1) * period // shares[s]), s))
        s = heapq.heappop(ready)[1]
        out.append(s)
        done[s] += 1
        if done[s] < shares[s]:
            heapq.heappush(waiting, (done[s] * period // shares[s], s))
    return out


def whole_shares(weights: list[float], period: int) -> list[int]:
    """Blocks of a period by largest remainder, one at least."""
    total = sum(weights)
    spare = period - len(weights)
    exact = [w / total * spare for w in weights]
    shares = [1 + math.floor(x) for x in exact]
    by_rest = sorted(range(len(weights)), key=lambda i: (math.floor(exact[i]) - exact[i], i))
    for i in by_rest[: period - sum(shares)]:
        shares[i] += 1
    return shares


def exact_shares(weights: list[float]) -> list[int]:
    """Whole numbers in exact proportion to the weights."""
    exact = [Fraction(w) for w in weights]
    unit = math.lcm(*(x.denominator for x in exact))
    return [int(x * unit) for x in exact]


def _rests(shares: dict[int, int], period: int) -> tuple[int, dict[int, int], dict[int, int]]:
    """(total of the shares, whole blocks of a period, rest in parts of the total) by source."""
    total = sum(shares.values())
    return total, {s: w * period // total for s, w in shares.items()}, {s: w * period % total for s, w in shares.items()}


def phases(blocks: list[int], shares: list[int], period: int) -> list[dict]:
    """Stretches of whole periods, each until a source has no block left.

    Later stretches share the slots among the rest by the same weights.  A source that ends
    within the last period of a stretch leaves its remaining slots there empty.  ``extra`` are the
    blocks that the rests make in a stretch: the whole ones and, of those begun, the first
    released, as many as there are slots; for this choice a schedule exists that keeps all windows.
    """
    left, first, slot, out = dict(enumerate(blocks)), [0] * len(blocks), 0, []
    left = {s: n for s, n in left.items() if n}
    while left:
        total, whole, rest = _rests({s: shares[s] for s in left}, period)
        rounds = min(-(-n * total // (shares[s] * period)) for s, n in left.items())
        extra = {s: rest[s] * rounds // total for s in left}
        begun = sorted((s for s in left if rest[s] * rounds % total), key=lambda s: (extra[s] * total // rest[s], s))
        for s in begun[: sum(rest.values()) // total * rounds - sum(extra.values())]:
            extra[s] += 1
        taken = {s: min(n, whole[s] * rounds + extra[s]) for s, n in left.items()}
        out.append({
            "phase": slot, "rounds": rounds, "sources": list(left), "extra": list(extra.values()),
            "first": [first[s] for s in left], "stop": [first[s] + taken[s] for s in left],
        })
        for s, n in taken.items():
            first[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        slot += rounds * period
    return out


def period_shares(shares: dict[int, int], extra: dict[int, int], rounds: int, period: int):
    """The blocks of each source, for one period of a stretch after the other."""
    total, whole, rest = _rests(shares, period)
    room = sum(rest.values()) // total  # blocks of the rests in a period
    waiting = [(0, s) for s in shares if extra[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    done = dict.fromkeys(shares, 0)
    for at in range(rounds):
        now = dict(whole)
        for _ in range(room):
            while waiting and waiting[0][0] <= at:
                s = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (min(rounds, -(-(done[s] + 1) * total // rest[s])), s))
            s = heapq.heappop(ready)[1]
            now[s] += 1
            done[s] += 1
            if done[s] < extra[s]:
                heapq.heappush(waiting, (done[s] * total // rest[s], s))
        yield now


def _periods(shares: list[int], period: int):
    """A row for each period, from rows that are whole phases."""

    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                sources, first, stop = row.sources.tolist(), row.first.tolist(), row.stop.tolist()
                extra = dict(zip(sources, row.extra.tolist(), strict=True))
                rows, slot = [], row.phase
                for now in period_shares({s: shares[s] for s in sources}, extra, row.rounds, period):
                    own = list(now.values())
                    rows.append((slot, sources, own, first, stop))
                    first, slot = [a + n for a, n in zip(first, own, strict=True)], slot + period
                    if len(rows) == 100:
                        yield pd.DataFrame(rows, columns=["slot", "sources", "share", "first", "stop"])
                        rows = []
                yield pd.DataFrame(rows, columns=["slot", "sources", "share", "first", "stop"])

    return run


def _scheduled(names: list[str]):
    """(name, source_block, slot) of the blocks of each period."""

    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                sources = row.sources.tolist()
                at, stop = (dict(zip(sources, x.tolist(), strict=True)) for x in (row.first, row.stop))
                rows = []
                for slot, s in enumerate(period_schedule(dict(zip(sources, row.share.tolist(), strict=True))), row.slot):
                    if at[s] < stop[s]:
                        rows.append((names[s], at[s], slot))
                        at[s] += 1
                yield pd.DataFrame(rows, columns=["name", "source_block", "slot"])

    return run


def mix(
    df: DataFrame, weights: dict[str, float] | None = None, temperature: float = 2.0, block: int = BLOCK,
    period: int = PERIOD, seed: int = 7, id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """Give every row a slot and a place in it, so that sources are interleaved to weights.

    ``weights`` gives each source's weight; without it a source weighs its row count to the power
    1 / ``temperature``.  Sources missing from ``weights`` are an error, as are more than
    ``MAX_SOURCES`` sources.  A block holds ``block`` rows of a source, in order of a hash of the id
    (a shuffle within the source), the last one fewer.

    Returns id, source, source_block, slot and place, one row for each input row: none is dropped or
    repeated.  Reading by (slot, place), each source has, until one of them ends, a number
    of blocks within two (at the end of each ``period``, within one) of its weight's share of the
    slots; then the others go on by their weights in the same way.  A null source
    counts as the source ''.  Null and repeated ids keep one row each.  An empty table
    gives an empty result.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("name"))
    sorted_rows = rows.withColumn("h", F.xxhash64(F.lit(seed), F.col("id"))).repartitionByRange("name", "h", "id")
    placed = materialize(
        sorted_rows.sortWithinPartitions("name", "h", "id").withColumn("row", F.monotonically_increasing_id()), "mix")
    runs = placed.groupBy(F.shiftright("row", 33).alias("part"), "name").agg(
        F.min("row").alias("from"), F.count("*").alias("n"))
    counts = {r["name"]: r["n"] for r in runs.groupBy("name").agg(F.sum("n").alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is not None and (missing := sorted(set(counts) - set(weights))):
        raise ValueError(f"no weight for {missing}")
    names = sorted(counts)
    wanted = [weights[n] if weights is not None else counts[n] ** (1 / temperature) for n in names]
    if any(w <= 0 for w in wanted):
        raise ValueError("weights must be positive")
    kind = rows.schema["id"].dataType.simpleString()
    if not names:
        return spark.createDataFrame([], f"{id_col} {kind}, {source_col} string, source_block long, slot long, place int")
    shares = exact_shares(wanted)
    period = max(period, 10 * len(names))
    plan = phases([-(-counts[n] // block) for n in names], shares, period)
    # A row is a whole phase, then a whole period, with an entry for each source, so no batch splits one.
    columns = ["phase", "rounds", "sources", "extra", "first", "stop"]
    stretches = spark.createDataFrame(
        [tuple(p[c] for c in columns) for p in plan],
        "phase long, rounds long, sources array<long>, extra array<long>, first array<long>, stop array<long>")
    slots = stretches.repartition("phase").mapInPandas(
        _periods(shares, period),
        "slot long, sources array<long>, share array<long>, first array<long>, stop array<long>").repartition("slot").mapInPandas(
        _scheduled(names), "name string, source_block long, slot long")
    # One row for each source and sort partition.
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select(
        "part", "name", (F.col("before") - F.col("from")).alias("shift"))
    located = placed.withColumn("part", F.shiftright("row", 33)).join(offsets, ["part", "name"])
    nth = F.col("row") + F.col("shift")
    located = located.select(
        "id", "name", F.floor(nth / block).alias("source_block"), F.pmod(nth, F.lit(block)).cast("int").alias("place"))
    return located.join(slots, ["name", "source_block"]).select(
        F.col("id").alias(id_col), F.col("name").alias(source_col), "source_block", "slot", "place")
