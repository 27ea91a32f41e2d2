"""From ranked chunks to the chunk list and the context of every query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.operators.encode import HashingEncoder
from sheafline.operators.neighbors import nearest
from sheafline.session import stored

# Hits that are broadcast at most, in bytes.
MAX_BROADCAST_BYTES = 64 * 2**20
METADATA = ("year", "section_number", "chunk_number")


def build_vector_table(chunks: DataFrame, encoder=None, text_col: str = "text",
                       out_col: str = "embeddings") -> tuple[DataFrame, object]:
    """Chunks with their vectors, and the fitted encoder the questions need."""
    return (encoder or HashingEncoder()).embed(chunks, text_col, out_col)


def broadcast_if_small(rows: DataFrame) -> DataFrame:
    """Hint a broadcast for a stored table of hits whose values were measured to be small."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in rows.columns),
                F.lit(16))
    measured = rows.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(rows) if measured <= MAX_BROADCAST_BYTES else rows


def attach_chunks(ranked: DataFrame, chunks: DataFrame, chunk_key: str = "chunk_key") -> DataFrame:
    """Add columns of the chunk table to ranked hits.

    The hits are broadcast while they are few, so that the chunk table is read where
    it lies; otherwise it is a shuffle join. Pass a stored ``ranked``.
    """
    return chunks.join(broadcast_if_small(ranked), chunk_key)


def chunks_found(ranked: DataFrame, chunks: DataFrame, chunk_key: str = "chunk_key") -> DataFrame:
    """The rows of the chunk table that any query has found, each once."""
    keys = broadcast_if_small(ranked.select(chunk_key).distinct())
    return chunks.join(keys, chunk_key, "left_semi")


def in_year(hits: DataFrame, year: str | int, column: str = "year") -> DataFrame:
    """Keep hits of one year. Apply it after the ranking: fewer than k hits may
    remain, or none, and ranks keep their gaps."""
    return hits.where(F.col(column) == F.lit(str(year)))


def digest(content: Column) -> Column:
    """Stands for a content in comparisons."""
    return F.sha2(content, 256)


def first_by_content(rows: DataFrame, group: Sequence[str], same: Column, order: Sequence[str]) -> DataFrame:
    """One row per group and content: the first in ``order``. ``same`` is the digest.

    A minimum per (group, content digest), combined before the shuffle, so that a
    content that fills a third of the table reaches the reducers once per task.
    """
    rest = [c for c in rows.columns if c not in group and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("__first")
    return (rows.groupBy(*group, same.alias("__digest")).agg(first)
            .select(*group, *(F.col(f"__first.{c}").alias(c) for c in [*order, *rest]))
            .select(*rows.columns))


def collect_chunks(hits: DataFrame, query_id: str = "query_id", content: str = "text",
                   metadata: Sequence[str] = METADATA, extra: Sequence[str] = ("chunk_key",),
                   per_row: int | None = None) -> DataFrame:
    """Hits of each query as one array ordered by rank; at most k entries each. With
    ``per_row`` a query has a row for each so many ranks, numbered by ``part``."""
    entry = F.struct("rank", "distance", F.col(content).alias("content"), *metadata, *extra)
    own = [F.col(query_id)]
    if per_row is not None:
        own.append(F.floor((F.col("rank") - 1) / per_row).cast("int").alias("part"))
    return hits.groupBy(*own).agg(F.array_sort(F.collect_list(entry)).alias("chunks"))


def with_chunks(queries: DataFrame, collected: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Every query with its chunks; an empty array, as part 0, where nothing was found."""
    entry_type = collected.schema["chunks"].dataType.simpleString()
    found = queries.join(collected, query_id, "left").withColumn(
        "chunks", F.coalesce("chunks", F.array().cast(entry_type)))
    return found.withColumn("part", F.coalesce("part", F.lit(0))) if "part" in collected.columns else found


def with_chunk_rows(queries: DataFrame, collected: DataFrame, hits: DataFrame,
                    query_id: str = "query_id") -> DataFrame:
    """What :func:`with_chunks` gives, for ``collected`` rows that hold far more than the
    queries: those are broadcast while they are few, so that no content is shuffled again.
    ``queries`` and ``hits`` are stored."""
    entry_type = collected.schema["chunks"].dataType.simpleString()
    columns = [*queries.columns, "chunks", "part"]
    found = collected.join(broadcast_if_small(queries), query_id).select(*columns)
    nothing = queries.join(hits.select(query_id).distinct(), query_id, "left_anti").withColumns(
        {"chunks": F.array().cast(entry_type), "part": F.lit(0)})
    return found.unionByName(nothing.select(*columns))


def find_hits(queries: DataFrame, chunks: DataFrame, k: int = 200, year: str | int | None = None, *,
              query_id: str = "query_id", query_vector: str = "embeddings", chunk_key: str = "chunk_key",
              chunk_vector: str = "embeddings", content: str = "text",
              metadata: Sequence[str] = METADATA, find=nearest, **find_options) -> tuple[DataFrame, DataFrame]:
    """The hits of :func:`retrieve` without texts, and the chunks that any query found."""
    ranked = find(queries, chunks, k, query_id=query_id, query_vector=query_vector,
                  chunk_key=chunk_key, chunk_vector=chunk_vector, **find_options)
    columns = [c for c in dict.fromkeys([*metadata, content]) if c != chunk_key]
    shown = chunks.select(chunk_key, *columns)
    # The ranks are fixed by now, so the year may be applied to the chunk side, and hits of
    # another year need not be stored.
    if year is not None:
        shown = in_year(shown, year)
        ranked = ranked.join(broadcast_if_small(shown.select(chunk_key)), chunk_key, "left_semi")
    ranked = stored(ranked, "ranked")
    found = stored(chunks_found(ranked, shown, chunk_key).withColumn(
        "__same", digest(F.col(content))), "found-chunks")
    if found.groupBy(chunk_key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{chunk_key} is not unique in the chunk table")
    unique = first_by_content(attach_chunks(ranked, found.select(chunk_key, "__same"), chunk_key),
                              [query_id], F.col("__same"), ["rank"])
    return unique.drop("__same"), found.drop("__same")


def retrieve(queries: DataFrame, chunks: DataFrame, k: int = 200, year: str | int | None = None, *,
             query_id: str = "query_id", query_vector: str = "embeddings", chunk_key: str = "chunk_key",
             content: str = "text", metadata: Sequence[str] = METADATA, **options) -> DataFrame:
    """All queries at once: top k, then the year, then one hit per content.

    Returns the queries with an array ``chunks`` of hits in rank order. ``find`` is
    the search, :func:`nearest` or :func:`nearest_by_hash`. Chunk keys must be unique; a
    key that two of the chunks found share is an error.

    The text of the chunk table is read once, for the chunks that any query found;
    duplicates are removed on keys and digests, before the texts are joined.
    """
    hits, found = find_hits(queries, chunks, k, year, query_id=query_id, query_vector=query_vector,
                            chunk_key=chunk_key, content=content, metadata=metadata, **options)
    collected = collect_chunks(hits.join(found, chunk_key), query_id, content, metadata, (chunk_key,))
    return with_chunks(queries.drop(query_vector), collected, query_id)


def best_hits(hits: DataFrame, best: int, query_id: str = "query_id") -> DataFrame:
    """The ``best`` first hits of each query."""
    first = Window.partitionBy(query_id).orderBy("rank")
    return hits.withColumn("__nth", F.row_number().over(first)).where(F.col("__nth") <= best).drop("__nth")


def context_text(chunks: Column, best: int = 1, metadata: Sequence[str] = METADATA) -> Column:
    """The ``best`` first chunks as text, one after the other; '' without chunks."""
    def shown(c: Column) -> Column:
        record = F.to_json(F.struct(*(c[m].alias(m) for m in metadata)))
        # Fixed format of one chunk within the context.
        return F.concat(F.lit("Chunk Metadata: "), record, F.lit(" \nContent: "), c["content"])
    return F.array_join(F.transform(F.slice(chunks, 1, best), shown), "\n")


def with_context(retrieved: DataFrame, best: int = 1, metadata: Sequence[str] = METADATA) -> DataFrame:
    return retrieved.withColumn("context", context_text(F.col("chunks"), best, metadata))
