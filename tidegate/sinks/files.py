"""CSV previews and report tables.  A run writes below its own id, never over another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """Header, doubled quotes, blanks kept."""
    df.write.mode("errorifexists").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_preview(df: DataFrame, root: str, label: str, run_id: str, columns: Sequence[str]) -> str | None:
    """Write the named columns as CSV; nothing is written for an empty input."""
    if df.isEmpty():
        return None
    path = f"{root}/{label}-{run_id}"
    shown = df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns
    ])
    write_csv(shown, path)
    return path


def write_report(tables: dict[str, DataFrame], root: str, run_id: str) -> str:
    """One Parquet folder per report table."""
    path = f"{root}/report-{run_id}"
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{path}/{name}")
    return path
