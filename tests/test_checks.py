"""Every registered query against the SQL that states its result, on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from cohortweave import checks

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None else repr(value)


@pytest.mark.parametrize("name", sorted(checks.ORACLE))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = checks.QUERIES[name](spark, sf)
    found = [tuple(row) for row in df.collect()]
    result = duck.execute(checks.ORACLE[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {n: SPARK_TYPES[t] for n, t in df.dtypes} == types
    order = sorted(names)
    left = Counter(tuple(plain(row[df.columns.index(n)]) for n in order) for row in found)
    right = Counter(tuple(plain(row[names.index(n)]) for n in order) for row in expected)
    assert left == right
    assert found, "a query without rows checks nothing"


def test_all_queries_have_sql():
    assert set(checks.QUERIES) == set(checks.ORACLE) <= set(entry_points.queries())


def test_entry(spark):
    assert "participant_id" in entry_points.entry(spark).columns
