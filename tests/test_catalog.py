"""Every registered query against its oracle SQL, on the smallest sample."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_file
from tidegate.catalog.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(comparable(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    got = entry_file.queries()[name](spark, SF_DIR)
    wanted = oracle.execute(entry_file.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(got.columns) == sorted(columns)
    rows = got.collect()
    assert rows
    assert table(got.columns, rows) == table(columns, wanted.fetchall())


def test_entry(spark):
    assert entry_file.entry(spark).columns == ["failed_rule", "rows"]
