"""Relational sources: explicit columns, prefix-free names, change-time predicate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.operators.watermark import after_watermark
from tidegate.schemas import RAW_ADDRESS, RAW_ITEM
from tidegate.sources.ranges import plan_ranges, sql_counter

DEFAULT_SCHEMA = "PRODDTA"
FETCH_SIZE = 1000


@dataclass(frozen=True)
class SourceTable:
    """A raw table: its database name, column prefix and declared columns."""

    table: str
    prefix: str
    schema: StructType

    def column(self, name: str) -> str:
        return self.prefix + name


TABLES = {
    "customers": SourceTable("F0101", "AB", RAW_ADDRESS),
    "items": SourceTable("F4101", "IM", RAW_ITEM),
}


def source_table(name: str) -> SourceTable:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {sorted(TABLES)}")
    return TABLES[name]


def alias_columns(df: DataFrame, name: str) -> DataFrame:
    """Declared columns without their prefix, as text."""
    source = source_table(name)
    return df.select(*[
        F.col(source.column(f.name)).cast("string").alias(f.name) for f in source.schema
    ])


def incremental_scan(df: DataFrame, name: str, last_upmj: int = 0, last_upmt: int = 0) -> DataFrame:
    """Aliased rows changed after the watermark; rows without a change time are dropped.

    The predicate is on the stored typed columns, before the text cast, so the scan
    evaluates it.
    """
    source = source_table(name)
    changed = after_watermark(
        df, last_upmj, last_upmt, source.column("UPMJ"), source.column("UPMT"), keep_unknown=False
    )
    return alias_columns(changed, name)


def jdbc_options(
    url: str,
    name: str,
    schema: str = DEFAULT_SCHEMA,
    fetch_size: int = FETCH_SIZE,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan, read in ``partitions`` key ranges when those are given."""
    options = {
        "url": url,
        "dbtable": f"{schema}.{source_table(name).table}",
        "fetchsize": str(fetch_size),
    }
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partitioned read needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    last_upmj: int = 0,
    last_upmt: int = 0,
    properties: dict[str, str] | None = None,
    key: str | None = None,
    readers: int | None = None,
    **scan: object,
) -> DataFrame:
    """Aliased incremental scan of a database table.

    With ``key``, a whole-number column, and ``readers``, the table is read in about that many ranges of the
    key, through a connection each; the ranges come from counts that the database makes (``plan_ranges``).
    """
    if key is not None:
        options = jdbc_options(url, name, **scan)
        base = {"url": url, **(properties or {})}

        def run(query: str) -> DataFrame:
            return spark.read.format("jdbc").options(**base, query=query).load()

        ends = run(f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {options['dbtable']}").first()
        if ends["low"] is not None:
            ranges = plan_ranges(
                sql_counter(run, options["dbtable"], key), int(ends["low"]), int(ends["high"]), readers or 8)
            whole = spark.read.jdbc(
                url, options["dbtable"], predicates=[r.predicate(key) for r in ranges],
                properties={"fetchsize": options["fetchsize"], **(properties or {})})
            return incremental_scan(whole, name, last_upmj, last_upmt)
    reader = spark.read.format("jdbc").options(**jdbc_options(url, name, **scan))
    return incremental_scan(reader.options(**(properties or {})).load(), name, last_upmj, last_upmt)
