"""Vector column functions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_array(df: DataFrame, column: str, dtype: str = "float64") -> Column:
    """``column`` as an array, whether it holds ML vectors or arrays already."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(F.col(column), dtype)
    return F.col(column).cast("array<double>" if dtype == "float64" else "array<float>")


def euclidean(a: Column, b: Column) -> Column:
    """Norm of the difference of two arrays, in double precision."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))


def components(vector: Column, names: list[str]) -> list[Column]:
    """The leading entries of an array as named double columns."""
    return [F.get(vector, F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]
