"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longer texts are not used for fitting; every text is used for everything else.
LONGEST_SAMPLE_TEXT = 20_000
_SCALE = 1 << 30


def remainder(column: Column | str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string") if isinstance(column, str)
                          else column.cast("string")), F.lit(divisor))


def per_label(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """About ``most`` rows in all, as many of each label as there are, up to its share.

    Rows are chosen by a hash of ``key``, so the choice does not depend on partitions,
    and rows with equal keys count once.
    """
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(
        F.approx_count_distinct(key).alias("n")).collect()}
    if not counts:
        return rows.limit(0)
    share = max(1, most // len(counts))
    limit = F.lit(0)
    for value, n in counts.items():
        limit = F.when(F.col(label) == F.lit(value),
                       F.lit(min(_SCALE, int(_SCALE * share / max(1, n))))).otherwise(limit)
    chosen = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(_SCALE))
    return rows.where(chosen < limit).dropDuplicates([label, key])
