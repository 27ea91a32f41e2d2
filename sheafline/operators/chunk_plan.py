"""Token statistics per section and the chunk plan derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import token_count
from sheafline.session import stored

# A plan that is broadcast has at most so many bytes: its section names, and the numbers
# of each row.
MAX_BROADCAST_BYTES = 32 * 2**20
ROW_BYTES = 128


def section_token_stats(sections: DataFrame, section_col: str = "section_number",
                        text_col: str = "section_text") -> DataFrame:
    """Largest, mean and sample deviation of the token count per section.

    Three numeric buffers per section are combined before the shuffle, so a section
    that holds a third of all rows costs no more than any other. A section with one
    row has no deviation; it is reported as 0.
    """
    counted = sections.select(F.col(section_col), token_count(F.col(text_col)).alias("tokens"))
    return counted.groupBy(section_col).agg(
        F.max("tokens").alias("max_tokens"),
        F.avg("tokens").alias("mean_tokens"),
        F.coalesce(F.stddev("tokens"), F.lit(0.0)).alias("std_dev_tokens"),
    )


def section_token_state(sections: DataFrame, by: Sequence[str] = ("year",), section_col: str = "section_number",
                        text_col: str = "section_text") -> DataFrame:
    """What the statistics of a section are made of, per section and value of ``by``: number
    of texts, sum and sum of squares of their token counts, and the largest.

    All are whole numbers, so that states of several years can be kept and merged in any
    order without a difference in the last digit.
    """
    counted = sections.select(section_col, *by, token_count(F.col(text_col)).cast("long").alias("tokens"))
    return counted.groupBy(section_col, *by).agg(
        F.count("tokens").alias("n_texts"), F.sum("tokens").alias("tokens"),
        F.sum((F.col("tokens") * F.col("tokens")).cast("decimal(38,0)")).alias("squares"),
        F.max("tokens").cast("int").alias("max_tokens"))


def merged_token_stats(state: DataFrame, section_col: str = "section_number") -> DataFrame:
    """The statistics of :func:`section_token_stats` from the states of any years."""
    whole = state.groupBy(section_col).agg(
        F.max("max_tokens").alias("max_tokens"), F.sum("n_texts").alias("n"),
        F.sum("tokens").alias("tokens"), F.sum("squares").cast("decimal(38,0)").alias("squares"))
    n = F.col("n").cast("decimal(19,0)")
    apart = (n * F.col("squares")).cast("decimal(38,0)") - (
        F.col("tokens").cast("decimal(19,0)") * F.col("tokens").cast("decimal(19,0)"))
    pairs = F.col("n").cast("double") * (F.col("n") - 1)
    return whole.select(
        section_col, "max_tokens",
        F.try_divide(F.col("tokens").cast("double"), F.col("n")).alias("mean_tokens"),
        F.when(pairs > 0, F.sqrt(apart.cast("double") / pairs)).otherwise(F.lit(0.0)).alias("std_dev_tokens"))


def check_window(limit: int, ratio: float) -> int:
    """Overlap in units of the limit; refuses values that never move forward."""
    if limit < 1 or not 0 <= ratio < 1:
        raise ValueError("need limit >= 1 and 0 <= overlap ratio < 1")
    return int(limit * ratio)


def chunk_plan(stats: DataFrame, limit: int = 512, ratio: float = 0.1) -> DataFrame:
    """Decide per section whether and how to cut it.

    A section is cut when its longest text exceeds ``limit`` tokens. The number of
    chunks is a float floor division, written with the remainder: ``floor(m / s)``
    differs from it at exact multiples of the step.
    """
    overlap = check_window(limit, ratio)
    step = F.lit(limit * (1 - ratio))
    longest = F.col("max_tokens").cast("double")
    cut = F.coalesce(F.col("max_tokens") > limit, F.lit(False))
    return stats.select(
        "*",
        cut.alias("requires_chunking"),
        F.when(cut, F.lit(limit)).alias("suggested_chunk_size"),
        F.when(cut, F.lit(overlap)).alias("overlap"),
        F.when(cut, F.round((longest - longest % step) / step) + 1).alias("chunks_needed"),
    )


def attach_plan(sections: DataFrame, plan: DataFrame, section_col: str = "section_number",
                max_sections: int | None = None) -> DataFrame:
    """Left join of section rows with their plan row.

    ``max_sections`` is a bound the caller can prove, such as the number of section
    columns of a wide table; with it the plan is broadcast and nothing runs here.
    Without it the plan is computed once, stored, and measured: small plans are
    broadcast so that the texts are not shuffled, others use a shuffle join, whose
    hot sections adaptive execution splits.
    """
    if max_sections is None:
        plan = stored(plan, "chunk-plan")
        names = F.sum(F.coalesce(F.octet_length(F.col(section_col).cast("string")), F.lit(0)))
        rows, names = plan.agg(F.count(F.lit(1)), names.cast("long")).first()
        size = rows * ROW_BYTES + (names or 0)
    else:
        size = max_sections * ROW_BYTES
    if size <= MAX_BROADCAST_BYTES:
        plan = F.broadcast(plan)
    return sections.join(plan, section_col, "left")
