"""Content hash for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JSON's short escapes.
SHORT_ESCAPES = {
    '"': '\\"', "\\": "\\\\", "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t",
}

# Plain ranges: the negated form of this class scans ten times slower.
NEEDS_ESCAPE = r'[\x00-\x1f"\\\x7f-\x{10ffff}]'


def _hex_escape(unit: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(unit), 4, "0")))


def _escape_char(ch: Column) -> Column:
    point = F.ascii(ch)
    offset = point - 0x10000
    pair = F.concat(
        _hex_escape(F.shiftright(offset, 10) + 0xD800),
        _hex_escape(offset.bitwiseAND(F.lit(0x3FF)) + 0xDC00),
    )
    escape = F
    for raw, short in SHORT_ESCAPES.items():
        escape = escape.when(ch == raw, short)
    return (
        escape.when(point.between(0x20, 0x7E), ch)
        .when(point < 0x10000, _hex_escape(point))
        .otherwise(pair)
    )


def json_body(c: Column) -> Column:
    """``c`` as the inside of an ASCII-only JSON string.

    Only text with control or non-ASCII characters is taken apart into characters.
    """
    by_character = F.array_join(F.transform(F.split(c, ""), _escape_char), "")
    return (
        F.when(c.rlike(r"[^ -~]"), by_character)
        .when(c.rlike(r'["\\]'), F.regexp_replace(c, r'(["\\])', r"\\$1"))
        .otherwise(c)
    )


def _value_text(df: DataFrame, field: str) -> Column:
    if field not in df.columns:
        return F.lit("")
    value = F.col(field)
    if df.schema[field].dataType.typeName() == "boolean":
        text = F.when(value, "True").when(~value, "False")
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("None"))


def content_hash(df: DataFrame, fields: Sequence[str]) -> Column:
    """MD5 over the named fields as one JSON object with sorted keys.

    Only these fields count: keys, audit text and change time do not.  A row is escaped
    only if one of its values holds a character that JSON does not take as it is.
    """
    names = sorted(fields)
    values = [_value_text(df, f) for f in names]
    leads = ["{" + f'"{names[0]}": "'] + [f'", "{f}": "' for f in names[1:]]

    plain = F.concat(*[part for lead, v in zip(leads, values) for part in (F.lit(lead), v)])
    # One array expression keeps the rarely used branch out of the generated code.
    lead_texts = F.array(*[F.lit(lead) for lead in leads])
    escaped = F.array_join(
        F.transform(F.array(*values), lambda v, i: F.concat(lead_texts[i], json_body(v))), ""
    )
    document = F.when(F.concat(*values).rlike(NEEDS_ESCAPE), escaped).otherwise(plain)
    return F.md5(F.concat(document, F.lit('"}')))
