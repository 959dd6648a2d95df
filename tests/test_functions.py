import hashlib
import json
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate import functions as fn
from tidegate.schemas import PARTNER_HASH_FIELDS


def apply(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clean_string(spark):
    given = [None, "", "   ", "\t\n", " a b ", "　x\xa0", "x"]
    assert apply(spark, fn.clean_string, given) == [None, None, None, None, "a b", "x", "x"]


def test_strip_covers_every_python_whitespace(spark):
    blanks = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    assert set(apply(spark, fn.strip, [f"{b}a{b}b{b}" for b in blanks])) == {
        f"a{b}b" for b in blanks
    }


def test_parse_long(spark):
    given = [None, "", "1001", " 1001 ", "+5", "-5", "1001.0", "x1", "1e3", "99999999999999999999"]
    assert apply(spark, fn.parse_long, given) == [
        None, None, 1001, 1001, 5, -5, None, None, None, None
    ]


def test_parse_decimal_key(spark):
    given = [None, "", "2002", "2002.0", "2e3", "2002.7", "-1.9", "0", "nan", "inf", "5d", " 7 "]
    assert apply(spark, fn.parse_decimal_key, given) == [
        None, None, 2002, 2002, 2000, 2002, -1, 0, None, None, None, 7
    ]


def test_parse_number(spark):
    given = [None, "", " ", "199.00", "-100.00", "abc", "0.00", "5d", "NaN", "1e2", ".5", "5.", "."]
    assert apply(spark, fn.parse_number, given) == [
        None, None, None, 199.0, -100.0, None, 0.0, None, None, 100.0, 0.5, 5.0, None
    ]


def test_normalize_phone(spark):
    given = [None, "", " - ", "+63 34 701 4412", "02-8525-4300", "09171234567\n", "(02) 1"]
    assert apply(spark, fn.normalize_phone, given) == [
        None, None, None, "+63347014412", "0285254300", "09171234567", "(02)1"
    ]


def test_julian_to_date(spark):
    given = [None, 126072, 126000, 126400, 100001, -1, 0, 8099999, 10**15, -(10**15)]
    assert apply(spark, fn.julian_to_date, given, "bigint") == [
        None, date(2026, 3, 13), date(2025, 12, 31), date(2027, 2, 4), date(2000, 1, 1),
        date(1901, 9, 26), date(1899, 12, 31), None, None, None,
    ]


def test_date_to_julian_inverts(spark):
    moments = [datetime(2026, 3, 13, 8, 0, 1), datetime(1999, 12, 31, 23, 59, 59)]
    assert apply(spark, fn.date_to_julian, moments, "timestamp") == [126072, 99365]
    assert apply(spark, fn.seconds_of_day, moments, "timestamp") == [28801, 86399]


def expected_hash(row):
    text = {f: str(row.get(f, "")) for f in sorted(PARTNER_HASH_FIELDS)}
    return hashlib.md5(json.dumps(text, sort_keys=True).encode()).hexdigest()


HASH_SCHEMA = (
    "name string, phone string, street string, street2 string, city string, zip string, "
    "state_code string, country_code string, vat string, customer_rank int, "
    "is_company boolean, parent_key string, comment string"
)
BASE = {
    "name": "Acme", "phone": "0917", "street": "Main", "street2": None, "city": "Cebu",
    "zip": "9000", "state_code": "10", "country_code": "PHL", "vat": "1", "customer_rank": 1,
    "is_company": True, "parent_key": None, "comment": "c",
}


def hashes(spark, rows):
    names = [part.split()[0] for part in HASH_SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], HASH_SCHEMA)
    return [r.h for r in df.coalesce(1).select(fn.content_hash(df, PARTNER_HASH_FIELDS).alias("h")).collect()]


@pytest.mark.parametrize("name", [
    "plain", 'a "quoted" \\ name', "é", "tab\there\nline", "\x01\x7f", "日本", "😀 smile", "", None,
])
def test_content_hash_is_md5_of_json(spark, name):
    row = BASE | {"name": name}
    assert hashes(spark, [row]) == [expected_hash(row)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(
    st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=20
), min_size=1, max_size=30))
def test_content_hash_of_any_text(spark, names):
    rows = [BASE | {"street": n} for n in names]
    assert hashes(spark, rows) == [expected_hash(r) for r in rows]


def test_hash_ignores_comment_and_sees_phone(spark):
    one, comment, phone = hashes(spark, [BASE, BASE | {"comment": "x"}, BASE | {"phone": "1"}])
    assert one == comment != phone


def test_hash_of_absent_field_is_empty_text(spark):
    df = spark.createDataFrame([("a",)], "name string")
    row = df.select(fn.content_hash(df, PARTNER_HASH_FIELDS).alias("h")).first()
    assert row.h == expected_hash({"name": "a"})
