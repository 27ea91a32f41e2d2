"""Prompts, answers and their errors."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sheafline.functions.answers import extract_answer

DEFAULT_TEMPLATE = (
    "Answer one question about annual reports of {year}.\n"
    "Use only the passage below; if it does not hold the answer, say so.\n"
    'Reply with a JSON object of the form {{"answer": "..."}} and nothing else.\n\n'
    "Passage:\n{context}\n\nQuestion: {query}\n"
)

# The settings every generation is called with.
GENERATION_OPTIONS = {"temperature": 0.3, "max_new_tokens": 200}


def render(template: str, fields: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders; ``{{`` and ``}}`` stand for braces.

    The template is cut at its placeholders when the plan is built and the parts are
    concatenated, so braces inside a query or a context are plain text.
    """
    parts: list[Column] = []
    for piece in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        if piece in ("{{", "}}"):
            parts.append(F.lit(piece[0]))
        elif piece.startswith("{") and piece.endswith("}"):
            if piece[1:-1] not in fields:
                raise ValueError(f"template names an unknown field {piece}")
            parts.append(F.coalesce(fields[piece[1:-1]], F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def render_prompts(df: DataFrame, year: str | int | Column, template: str = DEFAULT_TEMPLATE,
                   query_col: str = "query", context_col: str = "context",
                   out_col: str = "prompt") -> DataFrame:
    """Add the prompt; ``year`` is one for all, or a column with the year of each question."""
    shown = year.cast("string") if isinstance(year, Column) else F.lit(str(year))
    fields = {"year": shown, "query": F.col(query_col), "context": F.col(context_col)}
    return df.withColumn(out_col, render(template, fields))


def apply_generator(prompts: DataFrame, generate: Callable[..., Sequence[str]] | None = None,
                    prompt_col: str = "prompt", options: dict | None = None, batch_size: int = 32, *,
                    load: Callable[[], Callable[..., Sequence[str]]] | None = None) -> DataFrame:
    """Add ``answer`` and ``error`` from ``generate(prompts, **options)``.

    ``generate`` gets a list of prompts and returns as many texts. With ``load`` instead,
    only the recipe travels: it is called once in each Python worker, which keeps the
    function it returns, a model with its weights say, for all later tasks. A batch that
    raises is repeated prompt by prompt, so an error marks its own row only, and so does
    an answer that is no text; a model that cannot be loaded fails the job. A null prompt
    is an empty one.
    """
    if (generate is None) == (load is None):
        raise ValueError("pass either generate or load")
    settings = dict(GENERATION_OPTIONS if options is None else options)

    def ready() -> Callable[[np.ndarray], dict[str, np.ndarray]]:
        model = load() if load is not None else generate

        def checked(answer) -> tuple[str | None, str | None]:
            if answer is None or isinstance(answer, str):
                return answer, None
            return None, f"Error: a {type(answer).__name__} is no text"

        def one(prompt: str) -> tuple[str | None, str | None]:
            try:
                return checked(list(model([prompt], **settings))[0])
            except Exception as problem:  # recorded with the row
                return None, f"Error: {problem}"

        def several(texts: np.ndarray) -> dict[str, np.ndarray]:
            texts = [str(t) for t in texts]
            try:
                answers = list(model(texts, **settings))
                done = [checked(a) for a in answers] if len(answers) == len(texts) else None
            except Exception:  # found again row by row
                done = None
            done = done or [one(t) for t in texts]
            return {"answer": np.array([a for a, _ in done], dtype=object),
                    "error": np.array([e for _, e in done], dtype=object)}
        return several

    schema = StructType([StructField("answer", StringType()), StructField("error", StringType())])
    answered = predict_batch_udf(ready, return_type=schema, batch_size=batch_size)
    return prompts.withColumn("__answered", answered(F.coalesce(F.col(prompt_col), F.lit("")))).select(
        *prompts.columns, "__answered.answer", "__answered.error")


def last_per_query(results: DataFrame, query_col: str = "query", order: str = "query_id",
                   within: Sequence[str] = ()) -> DataFrame:
    """One row per query text (and ``within``, such as its year): the last one by ``order``,
    at the position of the first.

    The maximum is combined before the shuffle, so a text asked very often is cheap.
    """
    own = [query_col, *within]
    rest = [c for c in results.columns if c not in (*own, order)]
    last = F.max_by(F.struct(order, *rest), F.col(order)).alias("__last")
    return results.groupBy(*own).agg(F.min(order).alias("position"), last).select(
        *own, "position", *(F.col(f"__last.{c}").alias(c) for c in [order, *rest]))


def with_answers(results: DataFrame, raw_col: str = "answer", key: str = "answer") -> DataFrame:
    """Replace generated text by the answer found in it."""
    return results.withColumn(raw_col, extract_answer(F.col(raw_col), key))
