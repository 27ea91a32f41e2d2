"""Counts for reporting, taken while the real job runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Attach counters; read them with ``observation.get`` after the next action."""
    observation = Observation(name)
    return df.observe(observation, *(m.alias(n) for n, m in measures.items())), observation


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
