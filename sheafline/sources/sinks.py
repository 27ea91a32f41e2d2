"""CSV, JSON and vector-table sinks; every one is a distributed write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheafline.session import without_old_shuffles

# Bytes of contents that are joined to results in one turn, before compression.
TURN_BYTES = 2**29


def write_plot_csv(points: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The plot table as CSV with a header: PC1, PC2, Cluster, Is_Outlier, Section."""
    (points.select("PC1", "PC2", "Cluster", "Is_Outlier", "Section")
     .write.mode(mode).option("header", True).option("escape", '"').csv(path))


def read_plot_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = "PC1 double, PC2 double, Cluster int, Is_Outlier int, Section string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_vector_table(chunks: DataFrame, path: str, mode: str = "errorifexists",
                       rebalance: bool = False) -> None:
    """Chunks and their vectors as Parquet, one directory per year.

    ``rebalance`` adds a shuffle by year that splits large years over many tasks
    (unlike ``repartition("year")``); use it when one task holds many years.
    """
    out = chunks.hint("rebalance", "year") if rebalance else chunks
    out.write.mode(mode).partitionBy("year").parquet(path)


def read_vector_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a vector table back; ``year`` stays a string."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    table = reader.parquet(path)
    return table.withColumn("year", F.col("year").cast("string"))


def result_records(results: DataFrame, with_score: bool = False) -> DataFrame:
    """Shape results for saving: query, answer and the chunks behind the answer.

    ``chunks`` holds metadata, content and, when asked for, the distance as score.
    """
    def record(c):
        metadata = F.struct(
            c["chunk_number"].alias("chunk_number"),
            c["section_number"].alias("section_number"),
            c["year"].alias("year"),
        )
        score = c["distance"] if with_score else F.lit(None).cast("double")
        return F.struct(metadata.alias("metadata"), c["content"].alias("content"), score.alias("score"))

    return results.select(
        "query", "answer", *(["error"] if "error" in results.columns else []),
        F.transform("chunks", record).alias("chunks"),
    )


def write_results_json(records: DataFrame, path: str, mode: str = "errorifexists",
                       compression: str | None = None) -> None:
    """One JSON object per line and query; null fields (no score) are left out."""
    (records.write.mode(mode).option("ignoreNullFields", True).option("zlib.compress.level", "BEST_SPEED")
     .json(path, compression=compression))


def write_answers_json(answered: DataFrame, path: str, content_bytes: int, query_id: str = "query_id") -> None:
    """Save all results that hold a large part of the chunk table each, as compressed lines.

    ``content_bytes`` are about those of all contents in all results. They are joined to the
    results in turns, some queries at a time, so that no more than TURN_BYTES of them are
    shuffled at once."""
    turns = -(-content_bytes // TURN_BYTES) or 1
    with without_old_shuffles(answered.sparkSession):
        for turn in range(turns):
            mine = answered.where(F.pmod(F.xxhash64(query_id), F.lit(turns)) == turn)
            write_results_json(result_records(mine), path, "append" if turn else "errorifexists", "gzip")


RESULT_SCHEMA = (
    "query string, answer string, error string, chunks array<struct<"
    "metadata struct<chunk_number int, section_number string, year string>, "
    "content string, score double>>"
)


def read_results_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULT_SCHEMA).json(path)
