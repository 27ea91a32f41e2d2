"""Map a collection of filings to two dimensions and flag outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sheafline.operators.encode import embed_text
from sheafline.operators.mapping import MapModels, map_points
from sheafline.operators.sections import section_columns, unpivot_sections
from sheafline.operators.word_windows import word_chunks
from sheafline.session import stored
from sheafline.sources.filings import first_filings, with_company


def document_map(filings: DataFrame, *, max_filings: int | None = None, limit: int = 512,
                 ratio: float = 0.1, encoder=None, n_components: int = 2, n_clusters: int = 5,
                 keep_text: bool = False, keep_vectors: bool = False,
                 ids: Sequence[str] | None = None,
                 order: Sequence[str] = ("cik", "year")) -> tuple[DataFrame, MapModels]:
    """Filings with a company -> sections -> word chunks -> vectors -> map.

    One row per chunk with ``ids`` (by default all columns of the filings that are no
    sections), its section, components, cluster, distance and outlier flag.
    ``max_filings`` keeps the first filings by ``order`` and then by content. Texts are read
    once, for their sparse counts; the vectors made from these are stored, because three
    fits and the result read them. Texts are not written again unless ``keep_text`` asks.
    ``keep_vectors`` adds the vectors to the result.
    """
    filings = with_company(filings)
    if max_filings is not None:
        filings = first_filings(filings, max_filings, order)
    sections = set(section_columns(filings))
    ids = [c for c in filings.columns if c not in sections] if ids is None else list(ids)
    chunks = word_chunks(unpivot_sections(filings, ids), limit=limit, ratio=ratio)
    embedded = embed_text(chunks, "chunk_text", encoder, keep_text=keep_text)
    return map_points(stored(embedded, "embedded-chunks"), n_components, n_clusters,
                      keep_vectors=keep_vectors)
