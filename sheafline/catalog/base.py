"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.sources.filings import spread

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the same result as DuckDB computes it."""
    def register(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = fn
        if sql is not None:
            _sql[name] = sql
        return fn
    return register


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def all_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """The documents, spread over the cores for work that is bound by CPU."""
    return spread(table(spark, sf_dir, name))


def r6(value: Column | str) -> Column:
    """Six decimals, without a negative zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, 6) + F.lit(0.0)
