"""Answer a table of questions over a vector table in one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.operators.answering import (
    DEFAULT_TEMPLATE, apply_generator, last_per_query, render_prompts, with_answers,
)
from sheafline.operators.retrieval import (
    best_hits, collect_chunks, find_hits, retrieve, with_chunk_rows, with_chunks, with_context,
)
from sheafline.session import stored
from sheafline.sources.filings import spread


def ask(questions: DataFrame, chunks: DataFrame, encoder, year: str | int | None = None,
        generate: Callable[..., Sequence[str]] | None = None, *, k: int = 200, best: int = 1,
        template: str = DEFAULT_TEMPLATE, load: Callable[[], Callable[..., Sequence[str]]] | None = None,
        within: Sequence[str] = (), per_row: int | None = None, **retrieve_options) -> DataFrame:
    """Questions (query_id, query) -> query, position, query_id, answer, error, chunks.

    With ``year`` the k nearest chunks are searched and those of another year dropped. With
    ``within``, say ("cik", "year"), the questions have these columns themselves, one batch
    may span companies and years, and each is answered from the chunks that equal it there;
    its prompt names its own year.

    ``encoder`` is the fitted encoder of the chunk table; ``generate`` produces one
    text per prompt. The last of several equal questions gives the result, so only
    that one is searched and answered. Generation is spread over all cores, since the
    prompts themselves are one small file; ``load`` keeps a model in the workers. Prompts and answers are stored: a lost executor
    or a second action repeats neither the search nor the generation.

    With ``per_row`` a result is a row for each so many ranks, numbered by ``part``, so that
    no row grows with ``k``: use it where k is large, up to all chunks. The texts are joined
    when the result is read then; the prompts are made from the ``best`` hits alone.
    """
    if (year is None) == (not within):
        raise ValueError("pass either year or within")
    asked = last_per_query(questions, within=within)
    vectors = encoder.transform(asked, "query", "embeddings")
    if within:
        retrieve_options["within"] = within
    shown = F.col("year") if year is None and "year" in within else year if year is not None else ""
    if per_row is None:
        retrieved = retrieve(vectors, chunks, k, year, **retrieve_options)
    else:
        slim, texts = find_hits(vectors, chunks, k, year, **retrieve_options)
        slim = stored(slim, "hits")
        key = retrieve_options.get("chunk_key", "chunk_key")
        shape = {n: retrieve_options[n] for n in ("content", "metadata") if n in retrieve_options} | {"extra": (key,)}
        retrieved = with_chunks(vectors.drop("embeddings"), collect_chunks(
            best_hits(slim, best).join(texts, key), **shape))
    prompted = stored(render_prompts(with_context(retrieved, best), shown, template), "prompts")
    answers = stored(apply_generator(spread(prompted.select("query_id", "prompt")), generate, load=load),
                     "answers")
    found = answers.select("query_id", "answer", "error").join(
        prompted.drop("prompt", "context"), "query_id")
    if per_row is not None:
        collected = collect_chunks(slim.join(texts, key), **shape, per_row=per_row)
        found = with_chunk_rows(stored(found.drop("chunks"), "answered"), collected, slim)
    return with_answers(found)
