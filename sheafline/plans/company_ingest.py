"""Prepare the filings of a company for questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.operators.chunk_plan import (
    attach_plan, chunk_plan, merged_token_stats, section_token_state, section_token_stats,
)
from sheafline.operators.encode import HashingEncoder
from sheafline.operators.recursive import split_sections
from sheafline.operators.sections import section_columns, unpivot_sections
from sheafline.session import stored
from sheafline.sources.filings import filing_digest, in_years, of_company
from sheafline.sources.stores import PartitionedStore


def plan_and_split(sections: DataFrame, limit: int = 512, ratio: float = 0.1,
                   max_sections: int | None = None, ids: tuple[str, ...] = ("year", "section_number")) -> DataFrame:
    """Section rows -> token statistics -> chunk plan -> chunks of the planned sizes."""
    plan = chunk_plan(section_token_stats(sections), limit, ratio)
    return split_sections(attach_plan(sections, plan, max_sections=max_sections), ids=ids)


def with_chunk_key(chunks: DataFrame, ids: Sequence[str]) -> DataFrame:
    """A key built from the chunk's own columns, so that it is the same on every run.

    It is their JSON array: a null and a separator inside a part stay apart from
    everything else, so different ids give different keys.
    """
    parts = [F.col(c).cast("string") for c in (*ids, "chunk_number")]
    return chunks.withColumn("chunk_key", F.to_json(F.array(*parts)))


def company_sections(filings: DataFrame, years: Sequence[str], company: str,
                     filing_id: str | None = None) -> tuple[DataFrame, tuple[str, ...]]:
    """Section rows of one company's filings over the given years, empty sections included,
    and the columns that identify a section.

    ``filing_id`` names a column that tells filings of one year apart. Without it a digest
    of the filing's content does, in a column ``filing``; filings that are equal in every
    section count as one.
    """
    chosen = of_company(in_years(filings, years), company)
    if filing_id is None:
        filing_id = "filing"
        chosen = chosen.withColumn(filing_id, filing_digest(filings)).dropDuplicates([filing_id])
    sections = unpivot_sections(chosen, (filing_id, "year"), drop_empty=False, short_names=True,
                                name_col="section_number")
    return sections, (filing_id, "year", "section_number")


def company_chunks(filings: DataFrame, years: Sequence[str], company: str, limit: int = 512,
                   ratio: float = 0.1, filing_id: str | None = None) -> DataFrame:
    """Chunks of one company's sections over the given years, as planned from these years."""
    sections, ids = company_sections(filings, years, company, filing_id)
    chunks = plan_and_split(sections, limit, ratio, len(section_columns(filings)), ids)
    return with_chunk_key(chunks, ids)


def _flags(state: DataFrame, limit: int, ratio: float) -> dict[str, bool]:
    """Which sections are cut; one entry for each section column of the filings."""
    plan = chunk_plan(merged_token_stats(state), limit, ratio)
    return {r["section_number"]: r["requires_chunking"] for r in plan.collect()}


def company_ingest(filings: DataFrame, years: Sequence[str], company: str, path: str, *,
                   limit: int = 512, ratio: float = 0.1, encoder=None,
                   filing_id: str | None = None) -> tuple[DataFrame, object]:
    """Put the given years of a company into its vector table at ``path``; returns the whole
    table, vectors included, with the encoder fitted on it.

    Ingesting year after year, in any order and repeatedly, gives the table that all years
    at once give. Chunks are written once, with what the encoder makes of their texts
    (sparse word counts, or a model's vectors), and a year replaces its own directory.
    Rarity weights are applied when the table is read, since they follow all chunks. The
    token statistics of each section and year are kept beside the chunks; if merging the
    new ones changes which sections are cut, the stored years are cut anew as well, for
    which ``filings`` has to hold them. The statistics are written last, so that a job that
    died before is found out and repeated.
    """
    spark, years = filings.sparkSession, [str(y) for y in years]
    encoder = encoder or HashingEncoder()
    chunk_store = PartitionedStore(spark, f"{path}/chunks")
    state_store = PartitionedStore(spark, f"{path}/token_state")
    sections, ids = company_sections(filings, years, company, filing_id)
    settings = {"limit": F.lit(limit), "ratio": F.lit(float(ratio))}
    state = stored(section_token_state(sections).withColumns(settings), "token-state")
    merged, state_store.schema = state, state.schema
    if state_store.exists():
        before = state_store.read()
        if before.where((F.col("limit") != limit) | (F.col("ratio") != ratio)).limit(1).count():
            raise ValueError("the table was made with another limit or ratio")
        merged = stored(before.where(~F.col("year").isin(years)).unionByName(state), "token-state")
        old, new = _flags(before, limit, ratio), _flags(merged, limit, ratio)
        if any(old[s] != new.get(s, old[s]) for s in old):
            kept = [r["year"] for r in before.select("year").distinct().collect()]
            sections, ids = company_sections(filings, sorted({*years, *kept}), company, filing_id)
    plan = chunk_plan(merged_token_stats(merged), limit, ratio)
    planned = attach_plan(sections, plan, max_sections=len(section_columns(filings)))
    chunks = with_chunk_key(split_sections(planned, ids=ids), ids)
    prepared = encoder.prepare(chunks, "text")
    chunk_store.replace(prepared)
    state_store.replace(state)
    chunk_store.schema = prepared.schema
    table = chunk_store.read()
    fitted = encoder.fit_prepared(table)
    return fitted.finish(table), fitted
