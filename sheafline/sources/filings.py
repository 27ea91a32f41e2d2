"""Scans over filings: one wide row per filing with ``section_*`` text columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_filings(spark: SparkSession, path: str, years: Sequence[str] | None = None,
                 split: str | None = "train", schema: StructType | None = None) -> DataFrame:
    """Scan a Parquet dataset, normally partitioned by ``year`` and ``split``.

    Both conditions are plain column predicates, so they prune partitions where
    the columns are directories and reach the Parquet reader where they are not.
    ``schema`` fixes the column types (schema on read).
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    filings = reader.parquet(path)
    if years is not None and "year" not in filings.columns:
        raise ValueError("years were given, but the table has no year column")
    if "year" in filings.columns:
        filings = filings.withColumn("year", F.col("year").cast("string"))
        if years is not None:
            filings = in_years(filings, years)
    if split is not None and "split" in filings.columns:
        filings = filings.where(F.col("split") == split).drop("split")
    return filings


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a scan with fewer splits than cores one task per core.

    Chunking and encoding are bound by CPU, and one large Parquet row group is one
    task. Tables with enough splits, so all large ones, are returned as they are.
    """
    wanted = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def in_years(filings: DataFrame, years: Sequence[str]) -> DataFrame:
    """Rows of the given years, each once, in a single scan."""
    return filings.where(F.col("year").isin([str(y) for y in years]))


def union_years(read_year: Callable[[str], DataFrame], years: Sequence[str]) -> DataFrame:
    """UNION ALL of one scan per listed year; a year listed twice counts twice."""
    if not years:
        raise ValueError("name at least one year")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [read_year(str(y)) for y in years]
    )


def filing_digest(filings: DataFrame) -> Column:
    """A digest of company, year and all sections of a row; null differs from ''."""
    parts = ["cik", "year", *(c for c in filings.columns if c.startswith("section_"))]
    return F.md5(F.concat_ws("|", *(F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-"))
                                    for c in parts if c in filings.columns)))


def with_company(filings: DataFrame) -> DataFrame:
    """Filings whose company id is known."""
    return filings.where(F.col("cik").isNotNull())


def of_company(filings: DataFrame, cik: str) -> DataFrame:
    """Filings of one company, by exact id."""
    return filings.where(F.col("cik") == F.lit(cik))


def first_filings(filings: DataFrame, n: int = 10, by: Sequence[str | Column] = ("cik", "year")) -> DataFrame:
    """The first ``n`` filings in the order ``by``, then by a digest of their content.

    A table has no source order, so the order is explicit and total; Spark runs this as
    one top-n per partition and a merge, without a full sort. Fewer rows are no error.
    """
    return filings.orderBy(*by, filing_digest(filings)).limit(n)


def filings_view(documents: DataFrame) -> DataFrame:
    """View a plain document table as filings with three sections.

    Company = source (unknown for every eleventh document), year from the document
    number; the first line, the second line and the rest of the text are the sections.
    """
    lines = F.split("text", "\n")
    return documents.select(
        "doc_id",
        F.when(F.col("doc_id") % 11 != 0, F.col("source")).alias("cik"),
        (F.lit(2018) + F.col("doc_id") % 3).cast("string").alias("year"),
        lines.alias("lines"),
    ).select(
        "doc_id", "cik", "year",
        F.get("lines", F.lit(0)).alias("section_1"),
        F.get("lines", F.lit(1)).alias("section_1A"),
        F.array_join(F.slice("lines", 3, F.greatest(F.array_size("lines") - 2, F.lit(0))), "\n").alias("section_7"),
    )


def sections_view(documents: DataFrame) -> DataFrame:
    """View each document as one long section named after its source."""
    return documents.select(
        "doc_id",
        (F.lit(2018) + F.col("doc_id") % 3).cast("string").alias("year"),
        F.col("source").alias("section_number"),
        F.col("text").alias("section_text"),
    )
