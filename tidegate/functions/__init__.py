"""Scalar functions: Column in, Column out, all evaluated inside the JVM."""

from tidegate.functions.dates import date_to_julian, julian_to_date, seconds_of_day
from tidegate.functions.hashing import content_hash, json_body
from tidegate.functions.numbers import parse_decimal_key, parse_long, parse_number
from tidegate.functions.text import clean_string, code_text, normalize_phone, strip

__all__ = [
    "clean_string", "code_text", "content_hash", "date_to_julian", "json_body",
    "julian_to_date", "normalize_phone", "parse_decimal_key", "parse_long",
    "parse_number", "seconds_of_day", "strip",
]
