"""Every registered query at the smallest scale, against DuckDB where it has SQL."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as driver  # noqa: E402
from sheafline.catalog import all_queries, all_sql  # noqa: E402

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark", "conversations")
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries()) and set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in rows) == sorted(
        repr([r[i] for i in order]) for r in result.fetchall())
