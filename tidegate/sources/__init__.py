"""Readers for raw tables, reference dimensions and state."""

from tidegate.sources.csv import CsvScan, scan_csv
from tidegate.sources.files import (
    NA_TOKENS,
    MalformedRecords,
    align_columns,
    null_tokens,
    read_csv,
    read_units_mapping,
)
from tidegate.sources.ranges import KeyRange, bin_counter, plan_ranges
from tidegate.sources.tables import TABLES, alias_columns, incremental_scan, jdbc_options, read_jdbc

__all__ = [
    "NA_TOKENS", "TABLES", "CsvScan", "KeyRange", "MalformedRecords", "alias_columns", "align_columns",
    "bin_counter", "plan_ranges",
    "incremental_scan", "jdbc_options", "null_tokens", "read_csv", "read_jdbc", "read_units_mapping",
    "scan_csv",
]
