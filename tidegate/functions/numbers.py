"""Text to number, with null for anything that is not one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import strip

# Decimal or exponent notation only: a plain cast would also take "5d" and "NaN".
NUMERIC = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def parse_long(c: Column) -> Column:
    """Whole number or null; "1001.0" is not a whole number here."""
    return strip(c).try_cast("bigint")


def parse_number(c: Column) -> Column:
    """Double or null.  Missing never becomes 0, and NaN or infinity are null."""
    text = strip(c)
    return F.when(text.rlike(NUMERIC), text.try_cast("double"))


def parse_decimal_key(c: Column) -> Column:
    """Whole number from decimal notation, truncated: "2002.0" and "2e3" parse."""
    return parse_number(c).try_cast("bigint")
