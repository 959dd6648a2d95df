"""The CSV scan against pandas, cut into splits of a few bytes."""

import csv
import io
import random

import pandas as pd
import pytest
from helpers import values

from tidegate.schemas import RAW_ADDRESS, RAW_ITEM, _strings
from tidegate.sources import MalformedRecords, read_csv, scan_csv
from tidegate.sources.csv import AFTER_QUOTE, TOO_MANY, UNCLOSED

SCHEMA = _strings("A", "B", "C", "D")
BITS = ["a", '"', "\n", ",", "é", " ", "b c", "\r\n", "\\", '""', "日"]


@pytest.fixture
def split_bytes(spark):
    def small(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield small
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [60, 400])
def test_equals_pandas(spark, tmp_path, split_bytes, size):
    pick = random.Random(size)
    wanted = []
    for f in range(4):
        names = pick.sample(["A", "B", "C", "X"], pick.randint(2, 4))
        rows = [["".join(pick.choice(BITS) for _ in range(pick.randint(0, 6))) for _ in names] for _ in range(pick.randint(0, 15))]
        out = io.StringIO(newline="")
        quoting = pick.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
        csv.writer(out, lineterminator=pick.choice(["\n", "\r\n"]), quoting=quoting).writerows([names, *rows])
        path = tmp_path / f"f{f}.csv"
        path.write_text(out.getvalue(), newline="")
        read = pd.read_csv(path, dtype=str, keep_default_na=False, na_values=[""])
        wanted += [
            tuple(None if c not in read.columns or pd.isna(r[c]) else r[c] for c in "ABCD") for _, r in read.iterrows()]
    split_bytes(size)
    scan = scan_csv(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, scan.rows.collect()), key=repr) == sorted(wanted, key=repr)
    assert scan.rejects.isEmpty()


def test_a_record_over_many_splits(spark, tmp_path, split_bytes):
    text = "\n".join(f"line {i}" for i in range(40))
    (tmp_path / "a.csv").write_text(f'A,B\n1,"{text}"\n2,x\n3,"{text}"\n')
    split_bytes(64)
    scan = scan_csv(spark, str(tmp_path), SCHEMA)
    assert values(scan.rows, "A", "B") == sorted([("1", text), ("2", "x"), ("3", text)], key=repr)


def test_rejects_are_kept_aside(spark, tmp_path, split_bytes):
    (tmp_path / "a.csv").write_text('﻿A,B\n1,x,extra\n"2"y,x\n3\n  \n4,5" pipe\n6,"open\nx,y\n7,z\n')
    (tmp_path / "b.csv").write_text('B,A,A\nb,a,again\n"q\n",\n')
    split_bytes(24)
    scan = scan_csv(spark, str(tmp_path), SCHEMA)
    assert values(scan.rows, "A", "B", "C") == sorted(
        [("3", None, None), ("4", '5" pipe', None), ("a", "b", None), (None, "q\n", None)], key=repr)
    assert values(scan.rejects, "record", "reason") == sorted(
        [("1,x,extra", TOO_MANY), ('"2"y,x', AFTER_QUOTE), ('6,"open', UNCLOSED)], key=repr)
    with pytest.raises(MalformedRecords, match="1 x quote is never closed"):
        read_csv(spark, str(tmp_path), SCHEMA)


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("ITM,DSC1\n")
    assert scan_csv(spark, str(tmp_path), RAW_ITEM).rows.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_csv(spark, str(tmp_path / "none.csv"), RAW_ADDRESS)
    with pytest.raises(ValueError, match="delimiter"):
        scan_csv(spark, str(tmp_path), RAW_ITEM, '"')


def test_other_delimiter_and_many_quotes(spark, tmp_path):
    long = '"' * 40_000
    (tmp_path / "a.csv").write_text('A;B\n"' + long + '";"x;y"\n')
    assert values(scan_csv(spark, str(tmp_path), SCHEMA, ";").rows, "A", "B") == [('"' * 20_000, "x;y")]
