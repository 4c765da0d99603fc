"""Registered queries of the operators against their SQL."""

from pathlib import Path

import pytest

from ledgerline.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, str(TABLES))
    result = connection.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    want = result.fetchall()
    assert want
    assert sorted(map(repr, df.select(*names).collect())) == sorted(f"Row({', '.join(f'{n}={v!r}' for n, v in zip(names, r))})" for r in want)
