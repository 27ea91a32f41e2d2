"""Text to vectors.

Two encoders with one interface. ``embed(df, text_col, out_col)`` adds vectors to a corpus
and returns them with a fitted encoder, whose ``transform`` does the same for questions.
``prepare`` is the part that reads the texts: what it adds can be kept in a table, and
``finish`` turns it into vectors without the texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from sheafline.session import stored

TERMS = "struct<ids: array<int>, counts: array<int>>"
# Texts, or vectors, that a worker handles at a time within a batch.
TEXTS_AT_ONCE, VECTORS_AT_ONCE = 256, 2048
# Distinct words whose bucket a worker remembers; further ones are hashed again.
REMEMBERED_WORDS = 300_000


class WordBuckets(dict):
    """The bucket of each word: the first eight hexadecimal digits of its MD5."""

    def __init__(self, dimensions: int) -> None:
        super().__init__()
        self.dimensions = dimensions

    def __missing__(self, word: str) -> int:
        digest = hashlib.md5(word.encode(), usedforsecurity=False).digest()
        bucket = int.from_bytes(digest[:4], "big") % self.dimensions
        if len(self) < REMEMBERED_WORDS:
            self[word] = bucket
        return bucket


def count_words(text: str, buckets: WordBuckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the lower-cased words of ``text`` and how often each occurs."""
    words = text.lower().split()
    return np.unique(np.fromiter(map(buckets.__getitem__, words), np.int32, len(words)),
                     return_counts=True)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _in_slices(rows: pa.Array, at_once: int, fn: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``fn`` of each slice of ``rows``, as one array; an empty array is one slice."""
    starts = range(0, len(rows), at_once) or [0]
    return pa.concat_arrays([fn(rows.slice(s, at_once)) for s in starts])


def _sparse_counts(dimensions: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        buckets = WordBuckets(dimensions)

        def count(texts: pa.Array) -> pa.Array:
            counted = [count_words(t or "", buckets) for t in texts.to_pylist()]
            return pa.StructArray.from_arrays(
                [_lists([ids for ids, _ in counted]), _lists([n for _, n in counted])], ["ids", "counts"])

        for texts in batches:
            yield _in_slices(texts, TEXTS_AT_ONCE, count)
    return F.arrow_udf(run, TERMS)


def _weighted(idf: np.ndarray):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for terms in batches:
            yield _in_slices(terms, VECTORS_AT_ONCE, weigh)

    def weigh(terms: pa.Array) -> pa.Array:
        ids, counts = terms.field("ids"), terms.field("counts")
        rows = np.repeat(np.arange(len(terms)), np.diff(ids.offsets.to_numpy()))
        at = ids.flatten().to_numpy(zero_copy_only=False)
        dense = np.zeros((len(terms), len(idf)))
        dense[rows, at] = counts.flatten().to_numpy(zero_copy_only=False) * idf[at]
        norms = np.sqrt((dense * dense).sum(axis=1, keepdims=True))
        np.divide(dense, norms, out=dense, where=norms > 0)
        offsets = np.arange(len(terms) + 1, dtype=np.int32) * len(idf)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(dense.ravel()))
    return F.arrow_udf(run, "array<double>")


@dataclass(frozen=True)
class HashingEncoder:
    """Lexical vectors: hashed word counts, weighted by rarity, of unit length.

    A text is read once, by ``prepare``; the document frequencies, ``dimensions`` of them,
    are added up over the sparse counts, and so are the vectors made.
    """

    dimensions: int = 256

    def prepare(self, df: DataFrame, text_col: str, out_col: str = "terms") -> DataFrame:
        """Add the buckets and counts of the words of each text; null is an empty text."""
        return df.withColumn(out_col, _sparse_counts(self.dimensions)(F.col(text_col)))

    def fit_prepared(self, prepared: DataFrame, terms_col: str = "terms") -> FittedHashingEncoder:
        """Weigh a bucket by log((n + 1) / (texts with it + 1))."""
        at = prepared.select(F.explode(f"{terms_col}.ids").alias("id"))
        seen = {r["id"]: r["n"] for r in at.groupBy("id").agg(F.count("*").alias("n")).collect()}
        total = prepared.count()
        return FittedHashingEncoder(tuple(
            math.log((total + 1) / (seen.get(i, 0) + 1)) for i in range(self.dimensions)))

    def fit(self, df: DataFrame, text_col: str) -> FittedHashingEncoder:
        return self.fit_prepared(stored(self.prepare(df, text_col).select("terms"), "terms"))

    def embed(self, df: DataFrame, text_col: str, out_col: str = "embeddings",
              keep_text: bool = True) -> tuple[DataFrame, FittedHashingEncoder]:
        prepared = self.prepare(df, text_col, "__terms")
        prepared = stored(prepared if keep_text else prepared.drop(text_col), "terms")
        fitted = self.fit_prepared(prepared, "__terms")
        return fitted.finish(prepared, out_col, "__terms"), fitted


@dataclass(frozen=True)
class FittedHashingEncoder:
    idf: tuple[float, ...]

    def prepare(self, df: DataFrame, text_col: str, out_col: str = "terms") -> DataFrame:
        return HashingEncoder(len(self.idf)).prepare(df, text_col, out_col)

    def finish(self, prepared: DataFrame, out_col: str = "embeddings", terms_col: str = "terms") -> DataFrame:
        """Vectors in place of the counts."""
        vector = array_to_vector(_weighted(np.array(self.idf))(F.col(terms_col)))
        return prepared.withColumn(out_col, vector).drop(terms_col)

    def transform(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        return self.finish(self.prepare(df, text_col, "__terms"), out_col, "__terms")


@dataclass(frozen=True)
class BatchEncoder:
    """Vectors from a model: ``load`` runs once per Python worker and returns a
    function from an array of texts to an array of vectors (one row per text)."""

    load: Callable[[], Callable[[np.ndarray], np.ndarray]]
    batch_size: int = 32

    def prepare(self, df: DataFrame, text_col: str, out_col: str = "terms") -> DataFrame:
        encode = predict_batch_udf(self.load, return_type=ArrayType(FloatType()), batch_size=self.batch_size)
        return df.withColumn(out_col, encode(F.coalesce(F.col(text_col), F.lit(""))))

    def fit_prepared(self, prepared: DataFrame, terms_col: str = "terms") -> BatchEncoder:
        return self

    def fit(self, df: DataFrame, text_col: str) -> BatchEncoder:
        return self

    def finish(self, prepared: DataFrame, out_col: str = "embeddings", terms_col: str = "terms") -> DataFrame:
        return prepared.withColumn(out_col, array_to_vector(F.col(terms_col))).drop(terms_col)

    def transform(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        return self.finish(self.prepare(df, text_col, "__terms"), out_col, "__terms")

    def embed(self, df: DataFrame, text_col: str, out_col: str = "embeddings",
              keep_text: bool = True) -> tuple[DataFrame, BatchEncoder]:
        """The vectors are stored, so that no later pass runs the model again."""
        prepared = self.prepare(df, text_col, "__terms")
        prepared = stored(prepared if keep_text else prepared.drop(text_col), "model-vectors")
        return self.finish(prepared, out_col, "__terms"), self


def embed_text(df: DataFrame, text_col: str = "chunk_text", encoder=None,
               out_col: str = "embeddings", keep_text: bool = True) -> DataFrame:
    """Add the vector of each text, with an encoder fitted on these texts; without
    ``keep_text`` the texts are left out of what is stored."""
    return (encoder or HashingEncoder()).embed(df, text_col, out_col, keep_text)[0]
