"""Parquet tables that grow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Stored keys that are broadcast at most, in bytes.
MAX_BROADCAST_BYTES = 64 * 2**20


class PartitionedStore:
    """A table with one directory per value of its ``partition`` columns, which are strings.

    Both ways of growing can be repeated: a job that died, or one that is run again, leaves
    the same table. There may be one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, partition: Sequence[str] = ("year",),
                 schema: StructType | None = None) -> None:
        self.spark, self.path, self.partition, self.schema = spark, path, list(partition), schema

    def exists(self) -> bool:
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(context._jsc.hadoopConfiguration()).exists(where)

    def read(self) -> DataFrame:
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        rows = reader.parquet(self.path)
        return rows.withColumns({c: F.col(c).cast("string") for c in self.partition})

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of the partitions they belong to; other partitions stay.

        Nothing that is stored is read, and no row is shuffled. Spark stages the new
        partitions and swaps them in when the job commits.
        """
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition).parquet(self.path))

    def add(self, rows: DataFrame, key: str, within: Column | None = None) -> None:
        """Append the rows whose ``key`` is not stored yet. Keys are unique in ``rows``.

        Only the stored keys are read; ``within``, a condition on partition columns that
        holds for all of ``rows``, spares the other partitions. While the keys are few they
        are broadcast and ``rows`` stay where they are; more are joined by shuffle.
        """
        if self.exists():
            known = self.read()
            keys = (known if within is None else known.where(within)).select(key)
            size = keys.agg(F.sum(F.octet_length(F.col(key).cast("string")) + 16)).first()[0] or 0
            rows = rows.join(F.broadcast(keys) if size <= MAX_BROADCAST_BYTES else keys, key, "left_anti")
        rows.write.mode("append").partitionBy(*self.partition).parquet(self.path)
