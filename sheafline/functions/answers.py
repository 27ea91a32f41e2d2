"""Reading an answer out of generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract_answer(raw: Column, key: str = "answer") -> Column:
    """The ``key`` of a JSON answer.

    Text that is not JSON is returned as it is; JSON without the key (or JSON
    that is no object) gives ``''``; an explicit JSON null gives NULL.
    """
    parsed = F.try_parse_json(raw)
    value = F.try_variant_get(parsed, f"$.{key}", "string")
    is_null = F.is_variant_null(F.try_variant_get(parsed, f"$.{key}", "variant"))
    return (
        F.when(parsed.isNull(), raw)
        .when(is_null, F.lit(None).cast("string"))
        .otherwise(F.coalesce(value, F.lit("")))
    )
