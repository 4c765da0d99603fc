"""Every registered query against its SQL, at the smallest scale."""

import datetime as dt
from pathlib import Path

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, dt.datetime):
        return value.date().isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return round(value, 9) if isinstance(value, float) else value


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    df = contract.queries()[name](spark, str(TABLES))
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    result = database.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_queries_without_sql_run(spark, name):
    assert not contract.queries()[name](spark, str(TABLES)).isEmpty()


def test_entry(spark):
    assert contract.entry(spark).columns[-3:] == ["valid_from", "valid_to", "is_current"]
