"""Composite change-time watermark: filter, advance and state."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions import parse_long


def changed_after(date: Column, time: Column, last_upmj: int, last_upmt: int) -> Column:
    """Strictly later than the watermark; a row without a change time does not match."""
    return (date > last_upmj) | ((date == last_upmj) & (time > last_upmt))


def after_watermark(
    df: DataFrame,
    last_upmj: int,
    last_upmt: int,
    date: str = "_upmj",
    time: str = "_upmt",
    keep_unknown: bool = True,
) -> DataFrame:
    """Rows changed after the watermark; (0, 0) means a full read.

    ``keep_unknown`` keeps rows whose change time is null: processing a row twice is
    safer than missing it.  The condition is a plain OR over typed columns, which a
    Parquet or JDBC scan can take over.
    """
    if last_upmj == 0 and last_upmt == 0:
        return df
    d, t = F.col(date), F.col(time)
    wanted = changed_after(d, t, last_upmj, last_upmt)
    if keep_unknown:
        wanted = d.isNull() | t.isNull() | wanted
    return df.where(wanted)


def after_watermark_moment(
    df: DataFrame, moment: str, last_upmj: int, last_upmt: int, keep_unknown: bool = True
) -> DataFrame:
    """The same filter on a table that has one timestamp column.

    The watermark becomes a timestamp constant, so the comparison reaches the scan.
    """
    if last_upmj == 0 and last_upmt == 0:
        return df
    year, day = divmod(last_upmj, 1000)
    bound = datetime(year + 1900, 1, 1) + timedelta(days=day - 1, seconds=last_upmt + 1)
    column = F.col(moment)
    wanted = column >= F.lit(bound.isoformat(" ")).cast(df.schema[moment].dataType)
    return df.where(column.isNull() | wanted if keep_unknown else wanted)


def with_change_time(raw: DataFrame, date: str = "UPMJ", time: str = "UPMT") -> DataFrame:
    """Add typed ``_upmj`` and ``_upmt`` to raw text rows."""
    return raw.select(
        "*", parse_long(F.col(date)).alias("_upmj"), parse_long(F.col(time)).alias("_upmt")
    )


def _part_or_zero(raw: Column) -> Column:
    return F.when(raw.isNull() | (raw == ""), F.lit(0)).otherwise(parse_long(raw))


def latest_change(
    raw: DataFrame,
    last_upmj: int | Column = 0,
    last_upmt: int | Column = 0,
    date: str = "UPMJ",
    time: str = "UPMT",
) -> DataFrame:
    """One row with the greatest (date, time) of a raw batch, not below the watermark.

    A missing part counts as 0; a row with an unreadable part is ignored.  Rows that
    fail validation later still count.
    """
    d, t = F.col(date).cast("string"), F.col(time).cast("string")
    moment = F.struct(_part_or_zero(d).alias("upmj"), _part_or_zero(t).alias("upmt"))
    readable = moment["upmj"].isNotNull() & moment["upmt"].isNotNull()
    floor_upmj = last_upmj if isinstance(last_upmj, Column) else F.lit(last_upmj)
    floor_upmt = last_upmt if isinstance(last_upmt, Column) else F.lit(last_upmt)
    floor = F.struct(
        floor_upmj.cast("bigint").alias("upmj"), floor_upmt.cast("bigint").alias("upmt")
    )
    best = raw.agg(F.max(F.when(readable, moment)).alias("best"))
    return best.select(F.greatest(F.coalesce("best", floor), floor).alias("w")).select(
        F.col("w.upmj").alias("last_upmj"), F.col("w.upmt").alias("last_upmt")
    )


def latest_per_table(state: DataFrame) -> DataFrame:
    """Current watermark of each table: the row written last."""
    row = F.struct("last_run_at", "last_upmj", "last_upmt", "records_synced")
    return state.groupBy("table_name").agg(F.max(row).alias("_row")).select(
        "table_name", "_row.last_upmj", "_row.last_upmt", "_row.last_run_at", "_row.records_synced"
    )


def current_watermark(state: DataFrame, tables: DataFrame) -> DataFrame:
    """Watermark of every name in ``tables`` (one column ``table_name``); zeros and a
    null run time for a table that was never synced."""
    found = latest_per_table(state)
    return tables.join(found, "table_name", "left").select(
        "table_name",
        F.coalesce("last_upmj", F.lit(0)).alias("last_upmj"),
        F.coalesce("last_upmt", F.lit(0)).alias("last_upmt"),
        "last_run_at",
        F.coalesce("records_synced", F.lit(0)).alias("records_synced"),
    )


def nth_change_time(df: DataFrame, n: int, date: str = "_upmj", time: str = "_upmt") -> tuple[int, int] | None:
    """Change time of the n-th row in order of change time; None if fewer rows have one.

    Found from counts, first of days and then of the times of one day, so no row is moved or sorted.
    """
    place: list[int] = []
    rows, left = df.where(F.col(date).isNotNull() & F.col(time).isNotNull()), n
    for part in (date, time):
        so_far = F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, 0))
        counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
        found = counts.select(part, "_n", so_far.alias("_to")).where(F.col("_to") >= left).orderBy("_to").first()
        if found is None:
            return None
        place.append(found[part])
        left -= found["_to"] - found["_n"]
        rows = rows.where(F.col(part) == found[part])
    return place[0], place[1]


def first_changes(
    df: DataFrame, order: list[str], n: int | None, unknown_last: Column | None = None
) -> DataFrame:
    """First ``n`` rows in ``order``, nulls first; no limit when ``n`` is 0 or None.

    Rows for which ``unknown_last`` holds come after all others.
    """
    if not n:
        return df
    late = [] if unknown_last is None else [unknown_last.asc()]
    return df.orderBy(*late, *[F.col(c).asc_nulls_first() for c in order]).limit(n)
