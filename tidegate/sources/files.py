"""CSV sources, read as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.schemas import UNIT_MAPPING, UNIT_MAPPING_COLUMNS
from tidegate.sources.csv import scan_csv

# Texts that pandas reads as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class MalformedRecords(ValueError):
    """A CSV source holds records that cannot be read as its header says."""


def align_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns: absent ones are null, undeclared ones dropped."""
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Null out every text that stands for a missing value."""
    return df.select(*[
        F.when(~F.col(c).isin(list(tokens)), F.col(c)).alias(c) for c in df.columns
    ])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """All-text CSV scan by header name (see ``scan_csv``) that refuses what it cannot parse.

    Pass ``na_tokens=("",)`` where a token is real data (country code NA).  Malformed records raise
    ``MalformedRecords``; use ``scan_csv`` and ``null_tokens`` to keep them aside instead.
    """
    scan = scan_csv(spark, path, schema)
    counts = [f"{r['n']} x {r['reason']}" for r in scan.rejects.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n")).orderBy("reason").collect()]
    if counts:
        raise MalformedRecords(f"{path}: {', '.join(counts)}")
    return null_tokens(scan.rows, na_tokens)


def read_units_mapping(
    spark: SparkSession, path: str, columns: Sequence[str] = UNIT_MAPPING_COLUMNS
) -> DataFrame:
    """Unit mapping CSV with its line order in ``_pos``; only "" is missing.

    ``columns`` names the file's code, target name and category columns.  A missing file
    raises Spark's path-not-found error, a missing column ``ValueError``.
    """
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    absent = [c for c in columns if c not in raw.columns]
    if absent:
        raise ValueError(f"unit mapping lacks column(s) {absent}; it has {raw.columns}")
    named = raw.select(*[F.col(c).alias(n) for c, n in zip(columns, UNIT_MAPPING_COLUMNS)])
    text = named.select(*[F.coalesce(f.name, F.lit("")).alias(f.name) for f in UNIT_MAPPING])
    # Within one file the id follows the line order.
    return text.withColumn("_pos", F.monotonically_increasing_id())
