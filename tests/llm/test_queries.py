"""The registered queries at the smallest scale, against DuckDB where they have SQL."""

import duckdb
import pytest

import __spark_entry__ as driver
from sheafline.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_all_are_registered():
    names = set(driver.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(
        repr([r[i] for i in order]) for r in result.fetchall())
