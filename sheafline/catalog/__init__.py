"""Every operator as a named query over the given tables, with SQL to check it."""

from sheafline.catalog import answers, chunks, filings, maps, retrieval  # noqa: F401
from sheafline.catalog.base import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
