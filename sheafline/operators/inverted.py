"""An inverted file: chunk vectors in directories by coarse centre, with byte codes.

``build_index`` finds coarse centres, gives every vector the directory of its nearest one
and writes it together with a code of one byte per dimension, a quarter of a float vector.
``search_index`` compares a query with the codes of its nearest directories, all of them by
default, and then measures exactly the few vectors that the codes put first. Vectors that
form clusters need few directories; others are found by the codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions.vectors import as_array, euclidean
from sheafline.operators.mapping import lloyd
from sheafline.operators.neighbors import as_matrix, keep_best, nearest
from sheafline.operators.retrieval import broadcast_if_small
from sheafline.session import stored
from sheafline.sources.stores import PartitionedStore

# Vectors that the coarse centres are fitted on at most, drawn by a hash of their key.
# Every vector is indexed.
FIT_ROWS = 50_000
LEVELS = 256


@dataclass(frozen=True)
class InvertedFile:
    """Where the index lies, its centres, and the range of codes in each dimension."""

    path: str
    key: str
    centers: tuple[tuple[float, ...], ...]
    low: tuple[float, ...]
    step: tuple[float, ...]

    def store(self, spark: SparkSession, schema=None) -> PartitionedStore:
        return PartitionedStore(spark, self.path, ("cell",), schema)

    def add(self, vectors: DataFrame, vector_col: str = "embeddings") -> None:
        """Index the vectors whose key is not there yet, by the centres and codes there are."""
        self.store(vectors.sparkSession).add(self.placed(vectors, vector_col), self.key)

    def placed(self, vectors: DataFrame, vector_col: str) -> DataFrame:
        """Key, vector, code and directory of every vector that is not null."""
        cell = F.get(_nearest_centers(np.array(self.centers), 1)(F.col("vector")), F.lit(0))
        slim = vectors.select(self.key, as_array(vectors, vector_col).alias("vector"))
        return slim.where("vector is not null").select(
            self.key, "vector", self.encode(F.col("vector")).alias("code"), cell.cast("string").alias("cell"))

    def encode(self, vector: Column) -> Column:
        low, step = np.array(self.low), np.array(self.step)

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for v in batches:
                x = as_matrix(v)
                codes = np.clip(np.floor((x - low) / step), 0, LEVELS - 1).astype(np.uint8) if len(v) else x
                yield pa.array([c.tobytes() for c in codes], pa.binary())
        return F.arrow_udf(run, "binary")(vector)

    def decode(self, code: Column) -> Column:
        low, step = np.array(self.low), np.array(self.step)

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for c in batches:
                x = np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), len(low))
                out = (low + (x + 0.5) * step).astype(np.float32)
                ends = np.arange(len(c) + 1, dtype=np.int32) * len(low)
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
        return F.arrow_udf(run, "array<float>")(code)


def _nearest_centers(centers: np.ndarray, n: int):
    """The ``n`` nearest centres of each vector, nearest first."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            x = as_matrix(v)
            gaps = (centers * centers).sum(axis=1) - 2 * x @ centers.T if len(v) else np.empty((0, len(centers)))
            found = np.argsort(gaps, axis=1, kind="stable")[:, :n].astype(np.int32)
            ends = np.arange(len(v) + 1, dtype=np.int32) * found.shape[1]
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
    return F.arrow_udf(run, "array<int>")


def build_index(vectors: DataFrame, path: str, cells: int | None = None, key: str = "chunk_key",
                vector_col: str = "embeddings") -> InvertedFile:
    """Write an index of ``vectors`` (a unique key and vectors of one length) to ``path``.

    By default there are as many cells as the root of the number of vectors, 4,096 at most.
    Centres start at sampled vectors and are moved by Lloyd steps over the sample; the range
    of the codes is four deviations around the mean of all vectors, and what lies outside
    gets the nearest code.
    """
    slim = vectors.select(key, as_array(vectors, vector_col).alias("vector")).where("vector is not null")
    n, width = slim.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        raise ValueError("no vectors to index")
    cells = min(cells or max(1, min(4096, round(n ** 0.5))), n)
    order = F.xxhash64(F.col(key).cast("string"))
    part = F.lit(min(1.0, FIT_ROWS / n) * 2.0 ** 63)
    sample = stored(slim.where(F.abs(order.cast("double")) <= part).select(
        F.col("vector").alias("v"), order.alias("nth")), "sample")
    start = as_matrix(sample.orderBy("nth").limit(cells).select("v").toArrow()["v"])
    centers = lloyd(sample.select("v"), start, steps=10, tolerance=1e-4)
    moments = slim.agg(*(f(F.get("vector", F.lit(i))) for i in range(width) for f in (F.avg, F.stddev_pop))).first()
    mean, deviation = np.array(moments[::2]), np.maximum(np.array(moments[1::2]), 1e-12)
    index = InvertedFile(path, key, tuple(map(tuple, centers.tolist())),
                         tuple((mean - 4 * deviation).tolist()), tuple((8 * deviation / LEVELS).tolist()))
    index.store(vectors.sparkSession).replace(index.placed(vectors, vector_col))
    return index


def search_index(queries: DataFrame, index: InvertedFile, k: int = 200, *, probes: int | None = None,
                 refine: int = 4, query_id: str = "query_id", query_vector: str = "embeddings") -> DataFrame:
    """About the ``k`` nearest vectors of every query: query, key, distance, rank.

    ``probes`` is the number of directories whose codes a query is compared with; without it
    all are. The ``refine`` * k best by code are measured exactly, on the full vectors, and
    ranked by distance and key; there are k rows wherever the probed directories hold k.
    """
    spark = queries.sparkSession
    rows = index.store(spark).read()
    codes = rows.select(index.key, "cell", index.decode(F.col("code")).alias("__decoded"))
    asked = queries.select(query_id, as_array(queries, query_vector).alias("__query"))
    options = {"query_id": query_id, "query_vector": "__query", "chunk_key": index.key,
               "chunk_vector": "__decoded"}
    if probes is not None and probes < len(index.centers):
        cells = _nearest_centers(np.array(index.centers), probes)(F.col("__query"))
        near = asked.where("__query is not null").select("*", F.explode(cells.cast("array<string>")).alias("cell"))
        found = nearest(near, codes, refine * k, within=["cell"], **options)
    else:
        found = nearest(asked, codes, refine * k, **options)
    shortlist = stored(found.select(query_id, index.key), "shortlist")
    # Only the shortlist meets the full vectors.
    full = rows.select(index.key, "vector").join(broadcast_if_small(shortlist), index.key)
    measured = full.join(broadcast_if_small(stored(asked, "asked")), query_id).select(
        query_id, index.key, euclidean(F.col("vector"), F.col("__query")).alias("distance"))
    return keep_best(measured, k, query_id, index.key)
