"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def database(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def canonical(rows, columns):
    order = sorted(columns)
    return sorted((tuple(cell(row[columns.index(c)]) for c in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, database, name):
    df = QUERIES[name](spark, sf)
    cursor = database.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert not QUERIES[name](spark, sf).isEmpty()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
