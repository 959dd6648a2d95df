"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the Unicode standard and Python treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace; ``trim`` alone removes spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_string(c: Column) -> Column:
    """Stripped text, with empty text as null."""
    return F.nullif(strip(c), F.lit(""))


def normalize_phone(c: Column) -> Column:
    """Drop whitespace and dashes, keep everything else; empty text is null."""
    return F.nullif(F.translate(c, WHITESPACE + "-", ""), F.lit(""))


def code_text(c: Column) -> Column:
    """Upper-cased, stripped code; null becomes the empty string."""
    return F.upper(strip(F.coalesce(c, F.lit(""))))
