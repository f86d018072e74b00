"""Every registered query against its SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from docquarry.checks import oracles
from docquarry.checks.queries import registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def comparable(value):
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(registered()) == set(oracles.SQL)
    assert set(oracles.SQL) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    result = driver.queries()[name](spark, sf_dir)
    names = sorted(result.columns)
    got = sorted(tuple(comparable(row[n]) for n in names) for row in result.collect())
    cursor = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    expected = sorted(tuple(comparable(row[columns.index(n)]) for n in names) for row in cursor.fetchall())
    assert got == expected


def test_flagship_query(spark):
    result = driver.entry(spark)
    assert result.columns == ["event_id", "ts", "user_id", "value", "props_k"]
    ids = [int(r.event_id) for r in result.collect()]
    assert ids and ids == sorted(ids)
