"""CSV scan that may be cut anywhere: line breaks inside quotes, header by name per file, rejects apart.

Whether a line starts a record depends on every quote before it in its file.  A line is therefore folded to
what it does to the two states a line can start in, outside or inside quotes.  Running over the lines of a
split and then over the splits of a file, both from narrow columns, these give each line its start state.
Only the lines of records that span several are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidegate.operators.keys import unique_lookup
from tidegate.runtime import materialize

TOO_MANY = "more fields than the header"
AFTER_QUOTE = "text after a closing quote"
UNCLOSED = "quote is never closed"

_OUTSIDE, _INSIDE, _CLOSED = 0, 1, 2  # _CLOSED: directly after a quote that closes, or is the first of two


@dataclass(frozen=True)
class CsvScan:
    """``rows`` in the declared columns; ``rejects`` (file, record, reason), which no row holds."""

    rows: DataFrame
    rejects: DataFrame


def _walk(text: Column, start: int, delimiter: str) -> Column:
    """Where a text ends: state, fields begun, and whether text follows a closing quote.

    A quote opens a field only as its first character; anywhere else outside quotes it is a character.
    """
    pieces = F.split(text, '"', -1)

    def seen(piece: Column) -> Column:
        return (F.length(piece) - F.length(F.replace(piece, F.lit(delimiter), F.lit("")))).cast("int")

    def acc(state: Column, opens: Column, fields: Column, bad: Column) -> Column:
        return F.struct(
            state.cast("int").alias("state"), opens.alias("opens"), fields.cast("int").alias("fields"), bad.alias("bad"))

    head = F.get(pieces, F.lit(0))
    if start == _OUTSIDE:
        first = acc(F.lit(_OUTSIDE), (head == "") | head.endswith(delimiter), seen(head) + 1, F.lit(False))
    else:
        first = acc(F.lit(_INSIDE), F.lit(False), F.lit(1), F.lit(False))

    def step(so_far: Column, piece: Column) -> Column:
        """A quote, then the piece up to the next one."""
        opened = (so_far["state"] == _OUTSIDE) & so_far["opens"] | (so_far["state"] == _CLOSED)
        plain = (so_far["state"] == _OUTSIDE) & ~so_far["opens"]
        closed = so_far["state"] == _INSIDE
        ended = closed & (piece != "")
        outside = plain | ended
        return acc(
            F.when(opened, _INSIDE).when(outside, _OUTSIDE).otherwise(_CLOSED),
            outside & piece.endswith(delimiter),
            so_far["fields"] + F.when(outside, seen(piece)).otherwise(0),
            so_far["bad"] | ended & ~piece.startswith(delimiter),
        )

    return F.aggregate(F.slice(pieces, 2, F.size(pieces)), first, step)


def _running(df: DataFrame, group: Sequence[str], order: str, outside: str, inside: str) -> DataFrame:
    """Add ``known`` and ``value``: the effect of all rows of the group up to and with this one.

    ``outside`` and ``inside`` tell whether a row that starts in that state ends inside quotes.  A row for which
    both are equal settles the state; of the others only those that swap the two count.  Where ``known``, the
    state after the row is ``value``; otherwise it is the group's start state, swapped if ``value``.
    """
    so_far = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum((F.col(outside) & ~F.col(inside)).cast("int")).over(so_far)
    settled = F.when(F.col(outside) == F.col(inside), F.struct(F.col(outside).alias("v"), F.col("_swaps").alias("n")))
    return (
        df.select("*", swaps.alias("_swaps"))
        .select("*", F.last(settled, ignorenulls=True).over(so_far).alias("_settled"))
        .select(
            *df.columns,
            F.col("_settled").isNotNull().alias("known"),
            F.when(F.col("_settled").isNull(), F.col("_swaps") % 2 == 1).otherwise(
                F.col("_settled.v") != ((F.col("_swaps") - F.col("_settled.n")) % 2 == 1)).alias("value"),
        )
    )


def _state(start: Column) -> Column:
    return F.when(F.col("known"), F.col("value")).otherwise(start != F.col("value"))


def _spanning(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, record), (open)): lines of records that span several, with the id of the record's first line, and
    the first lines of records whose quotes are still open at the end of their file."""
    narrow = lines.select("file", "block", "id", "outside", "inside")
    after = _running(narrow, ["file", "block"], "id", "outside", "inside")
    # One row per split from here to the blocks' start states.
    blocks = after.groupBy("file", "block").agg(F.max_by(F.struct("known", "value"), "id").alias("_end")).select(
        "file", "block", "_end.*").select(
        "file", "block", F.col("value").alias("outside"), (F.col("known") == F.col("value")).alias("inside"))
    in_file = Window.partitionBy("file").orderBy("block")
    blocks = _running(blocks, ["file"], "block", "outside", "inside").select(
        "file", "block", _state(F.lit(False)).alias("_after"))
    blocks = materialize(blocks.select(
        "file", "block", F.coalesce(F.lag("_after").over(in_file), F.lit(False)).alias("start"), "_after"), "blocks")

    placed = unique_lookup(after, blocks.select("file", "block", "start"), ["file", "block"])
    ordered = Window.partitionBy("file", "block").orderBy("id")
    state = placed.select("file", "block", "id", "start", _state(F.col("start")).alias("open_after"))
    state = state.select(
        "file", "block", "id", "open_after",
        F.coalesce(F.lag("open_after").over(ordered), F.col("start")).alias("open_before"))
    first = F.when(~F.col("open_before"), F.col("id"))
    state = materialize(state.select(
        "*", F.last(first, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("record")
    ).where("open_before OR open_after"), "spanning")
    # A split that starts inside a record continues the last record that an earlier split started.
    begun = state.where("NOT open_before").groupBy("file", "block").agg(F.max("id").alias("last"))
    carried = blocks.join(begun, ["file", "block"], "left").select(
        "file", "block", "_after",
        F.last("last", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
        F.last("last", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, 0)).alias("latest"))
    found = unique_lookup(state, materialize(carried, "carried"), ["file", "block"]).select(
        "id", F.coalesce("record", "carried").alias("record"))
    ends = carried.groupBy("file").agg(F.max_by(F.struct("_after", "latest"), "block").alias("_end"))
    return found, ends.where("_end._after").select(F.col("_end.latest").alias("open"))


def _records(lines: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """((file, block, id, record), unclosed ones or None); block and id are those of the record's first line."""
    whole = lines.select("file", "block", "id", F.col("value").alias("record"))
    if lines.where("outside").isEmpty():
        return whole, None
    found, unclosed = _spanning(lines)
    unclosed = materialize(unclosed, "unclosed")
    spans = materialize(unique_lookup(
        found.withColumnRenamed("record", "open"), unclosed.select("open", F.lit(True).alias("never")), ["open"]), "spans")
    met = unique_lookup(whole, spans, ["id"], left_is_unique=True)
    single = met.where("open IS NULL").select("file", "block", "id", "record")
    parts = met.where("open IS NOT NULL AND never IS NULL").groupBy("file", "open").agg(
        F.sort_array(F.collect_list(F.struct("block", "id", "record"))).alias("_lines"))
    joined = parts.select(
        "file", F.get("_lines.block", F.lit(0)).alias("block"), F.col("open").alias("id"),
        F.array_join("_lines.record", "\n").alias("record"))
    return single.unionByName(joined), met.where("never AND id = open").select("file", "record")


def scan_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, delimiter: str = ",",
) -> CsvScan:
    """All-text scan of the declared columns by the header name of each file.

    Any file may be read in many tasks, whatever line breaks its quoted values hold.  Values are what the
    quotes enclose, with doubled quotes made single; empty values are null.  Each file names its own columns
    in its first record, in any order; columns it lacks are null, undeclared ones are dropped, and of a
    repeated name the first counts.  Records with fewer fields than the header end in nulls, blank lines are
    none.  Records end at LF or CRLF.  A record with more fields than its header, with text directly after a
    closing quote, or with a quote that the rest of its file never closes is kept in ``rejects`` as it is.

    The lines are stored once; memory holds one record at a time.
    """
    if len(delimiter) != 1 or delimiter in '"\n\r':
        raise ValueError(f"not a delimiter: {delimiter!r}")
    quoted = F.contains("value", F.lit('"'))
    lines = materialize(spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value",
    ).select(
        "*",
        F.when(quoted, _walk(F.col("value"), _OUTSIDE, delimiter)["state"] == _INSIDE).otherwise(False).alias("outside"),
        F.when(quoted, _walk(F.col("value"), _INSIDE, delimiter)["state"] == _INSIDE).otherwise(True).alias("inside"),
    ), "lines")
    records, unclosed = _records(lines)
    records = records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(
        ~F.col("record").rlike(r"\A[ \t]*\z"))
    firsts = records.groupBy("file").agg(F.min_by("record", F.struct("block", "id")).alias("header"), F.min(F.struct("block", "id")).alias("_at"))
    byte_order_mark = F.regexp_replace("header", "\\A\ufeff", "")
    firsts = materialize(firsts.select(
        "file", byte_order_mark.alias("header"), F.col("_at.id").alias("header_id"),
        _walk(byte_order_mark, _OUTSIDE, delimiter)["fields"].alias("width")), "headers")
    widest = firsts.agg(F.max("width")).first()[0] or 1

    columns = StructType([StructField(f"c{i}", StringType()) for i in range(widest)])
    options = {"sep": delimiter, "escape": '"', "quote": '"', "multiLine": "true", "mode": "PERMISSIVE"}

    def fields(record: Column) -> Column:
        parsed = F.from_csv(record, F.lit(columns.simpleString()), options)
        return F.array(*[parsed[c] for c in columns.names])

    positions = F.array(*[F.array_position("_names", F.lit(f.name)).cast("int") for f in schema])
    headers = firsts.select("file", "header_id", "width", fields(F.col("header")).alias("_names")).select(
        "file", "header_id", "width", positions.alias("positions"))
    met = unique_lookup(records, materialize(headers, "headers"), ["file"]).where("id != header_id")
    walked = F.when(F.contains("record", F.lit('"')), _walk(F.col("record"), _OUTSIDE, delimiter)).otherwise(F.struct(
        F.lit(_OUTSIDE).alias("state"), F.lit(False).alias("opens"),
        (F.length("record") - F.length(F.replace("record", F.lit(delimiter), F.lit(""))) + 1).cast("int").alias("fields"),
        F.lit(False).alias("bad")))
    judged = met.withColumn("_walk", walked).withColumn(
        "reason", F.when(F.col("_walk.bad"), AFTER_QUOTE).when(F.col("_walk.fields") > F.col("width"), TOO_MANY))
    good = judged.where("reason IS NULL").select(fields(F.col("record")).alias("_fields"), "positions")
    rows = good.select(*[
        F.when(F.get("positions", F.lit(i)) > 0, F.get("_fields", F.get("positions", F.lit(i)) - 1)).cast(f.dataType).alias(f.name)
        for i, f in enumerate(schema)
    ])
    rejects = judged.where("reason IS NOT NULL").select("file", "record", "reason")
    if unclosed is not None:
        rejects = rejects.unionByName(unclosed.select("file", "record", F.lit(UNCLOSED).alias("reason")))
    return CsvScan(rows, rejects)
