"""Overlapping word windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import word_slice, words
from sheafline.operators.chunk_plan import check_window


def window_count(n: Column, step: int) -> Column:
    """Windows needed so that every start below ``n`` in steps of ``step`` occurs."""
    return F.ceil(n / F.lit(step)).cast("int")


def word_chunks(df: DataFrame, text_col: str = "section_text", limit: int = 512, ratio: float = 0.1,
                chunk_col: str = "chunk_text", id_col: str = "chunk_id") -> DataFrame:
    """Cut a text into windows of ``limit`` words that overlap by ``limit * ratio``.

    Texts within the limit stay untouched, blanks included. Windows are numbered
    from 0 within their text. A narrow operation: no shuffle, no Python, and one
    split per text. Rows without a text give no chunk.
    """
    step = limit - check_window(limit, ratio)
    kept = [c for c in df.columns if c != text_col]
    split = df.select(*kept, text_col, words(F.col(text_col)).alias("__words"))
    n = F.array_size("__words")
    windows = F.transform(
        F.sequence(F.lit(0), window_count(n, step) - 1),
        lambda i: word_slice(F.col("__words"), i * step, F.lit(limit)),
    )
    chunks = F.when(n <= limit, F.array(F.col(text_col))).otherwise(windows)
    return split.select(*kept, F.posexplode(chunks).alias(id_col, chunk_col))
