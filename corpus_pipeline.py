"""Training-data pipeline over ``documents``; each stage applies one operator.

A stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but
the last return the columns of ``documents``; the last adds where in the mix a row stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm.common import small_or_shuffled
from sheafline.llm.decontaminate import contamination
from sheafline.llm.language import fit_languages, identify
from sheafline.llm.lines import without_repeated_lines
from sheafline.llm.minhash import near_duplicates
from sheafline.llm.mixing import mix
from sheafline.session import clean, ensure_folder, mark, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language rejects; those without a letter, or far from every
    centroid of the labelled documents, go. If no document has a language, all stay."""
    model = fit_languages(docs)
    if not model.languages:
        return docs
    rows = docs.withColumn("row", F.struct(*(c for c in docs.columns if c != "text")))
    kept = identify(rows, model, ["row", "text"]).where("not rejected")
    return kept.select(*("text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one; n_chars follows. A document that
    had words and keeps no line with any goes; others stay."""
    own = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = docs.select(F.struct(*own).alias("own"), "doc_id", "text")
    left = without_repeated_lines(rows, ["own"]).where(
        "n_removed = 0 or trim(replace(kept_text, '\n', '')) <> ''")
    named = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return left.select(*(named[c].alias(c) if c in named else F.col("own")[c].alias(c)
                         for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.
    Rows that repeat its doc_id go too; rows without doc_id stay. Texts are shuffled only
    where doc_ids repeat, or the ids to drop are too many to be broadcast."""
    dropped = stored(near_duplicates(docs).where("not kept").select("doc_id").distinct(), "dropped")
    left = docs.join(small_or_shuffled(dropped, 16), "doc_id", "left_anti").select(docs.columns)
    ids = docs.where("doc_id is not null").groupBy("doc_id").count()
    repeated = stored(ids.where("count > 1").select("doc_id"), "repeated_ids")
    if repeated.isEmpty():
        return left
    repeated = small_or_shuffled(repeated, 16)
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of an item of ``benchmark``."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    return contamination(rows, benchmark, keep=["row"]).where("not contaminated").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as are left, drawn from flattened sources."""
    return mix(docs, docs.columns)


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontaminate", decontaminate), ("mix_sources", mix_sources),
]

#: A classifier and two joins on edit distance and sketches are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored before the next one reads it, and what
    it stored on the way, and its predecessor's rows, are deleted then."""
    ensure_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = mark()
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
            clean(spark, start, mark() - 1)
    return docs
