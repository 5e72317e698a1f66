"""Every registered query that has a SQL twin against it in DuckDB, on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if isinstance(value, decimal.Decimal) else value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cells, key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    ours = table_of(frame.columns, frame.collect())
    result = duck.execute(entry_points.oracle_sql()[name])
    theirs = table_of([c[0] for c in result.description], result.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
