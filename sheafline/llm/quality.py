"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of hashed terms: its words, the shapes of its words (case, digits
and symbols, runs shortened) and graded facts about its form (how often words and lines
repeat, shares of capitals, symbols and digits). Counts are damped, weighted by inverse
document frequency, scaled to length 1 and projected on the leading singular vectors of a
bounded labelled sample. The labelled vectors are sent to all tasks; every document meets
all of them in blocked matrix products, and its nearest neighbours by cosine vote with
their similarity.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.sampling import LONGEST_SAMPLE_TEXT, per_label

DIMENSIONS = 1 << 12
LATENT = 48
#: Labelled texts, both labels together; their vectors are what is broadcast, at most
#: SAMPLE_ROWS * LATENT floats.
SAMPLE_ROWS = 4000
NEIGHBOURS = 15
#: Documents of one matrix product.
BLOCK = 256
#: Steps of a graded fact, and how much one counts beside words.
GRADES = 12
FACT_COUNT = 60
_SHAPE = bytes(ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57
               else ord("a") if 97 <= c <= 122 or c >= 128 else c for c in range(256))
_RUNS = re.compile(rb"([^\n])\1+")


def _facts(raw: bytes, shaped: bytes, words: Counter, total: int) -> list[tuple[str, float]]:
    size = max(1, len(raw))
    lines = raw.split(b"\n")
    small = shaped.count(b"a")
    capitals, digits = shaped.count(b"A"), shaped.count(b"0")
    blanks = raw.count(b" ") + len(lines) - 1
    return [
        ("words", len(words) / total), ("top", words.most_common(1)[0][1] / total),
        ("lines", len(set(lines)) / len(lines)), ("capitals", capitals / size),
        ("digits", digits / size), ("symbols", (size - small - capitals - digits - blanks) / size),
        ("blanks", blanks / size)]


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the terms of a text, and counts; a text without words has one term."""
    raw = (text or "").encode()
    found = raw.split()
    if not found:
        return np.array([0]), np.array([1.0])
    words = Counter(found)
    shaped = raw.translate(_SHAPE)
    counts: Counter = Counter()
    for word, n in words.items():
        counts[zlib.crc32(word) % (DIMENSIONS // 2)] += n
    for shape, n in Counter(_RUNS.sub(rb"\1", shaped).split()).items():
        counts[DIMENSIONS // 2 + zlib.crc32(shape) % (DIMENSIONS // 4)] += n
    for name, value in _facts(raw, shaped, words, len(found)):
        grade = round(GRADES * min(1.0, max(0.0, value)) ** 0.5)
        for near in (grade - 1, grade, grade + 1):
            key = zlib.crc32(f"{name} {near}".encode()) % (DIMENSIONS // 4)
            counts[3 * DIMENSIONS // 4 + key] += FACT_COUNT if near == grade else FACT_COUNT // 8
    return np.fromiter(counts, np.int64), np.fromiter(counts.values(), float)


@dataclass
class QualityModel:
    weights: np.ndarray     # inverse document frequency of each term
    projection: np.ndarray  # DIMENSIONS x LATENT
    vectors: np.ndarray     # labelled vectors, length 1
    labels: np.ndarray

    def tfidf(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        buckets, counts = terms(text)
        values = np.log1p(counts) * self.weights[buckets]
        return buckets, values / np.linalg.norm(values)

    def latent(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), self.projection.shape[1]), np.float32)
        for row, text in zip(out, texts):
            buckets, values = self.tfidf(text)
            row[:] = values @ self.projection[buckets]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[str | None]) -> list[float]:
        """Share of the neighbours' similarity that votes for label 1; 0.5 for every text
        if nothing was learned."""
        if not len(self.labels):
            return [0.5] * len(texts)
        out = []
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(texts), BLOCK):
            cosines = self.latent(texts[i:i + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6) ** 4
            share = (vote * self.labels[near]).sum(axis=1) / vote.sum(axis=1)
            out += np.clip(share, 0.0, 1.0).tolist()
        return out


def learn(texts: list[str], labels: list[int], seed: int = 5) -> QualityModel:
    """Term weights, singular vectors (randomised range finder) and labelled vectors."""
    found = [terms(t) for t in texts]
    seen = np.zeros(DIMENSIONS)
    for buckets, _ in found:
        seen[buckets] += 1
    model = QualityModel(np.log((len(texts) + 1) / (seen + 1)) + 1, np.zeros((DIMENSIONS, LATENT)),
                         np.zeros((0, LATENT), np.float32), np.array(labels, float))
    if not texts:
        return model
    dense = np.zeros((len(texts), DIMENSIONS), np.float32)
    for row, text in zip(dense, texts):
        buckets, values = model.tfidf(text)
        row[buckets] = values
    basis = np.random.default_rng(seed).normal(size=(DIMENSIONS, LATENT + 10)).astype(np.float32)
    for _ in range(4):
        basis = np.linalg.qr(dense.T @ (dense @ basis))[0]
    small = dense @ basis
    turn = np.linalg.svd(small, full_matrices=False)[2][:LATENT].T
    model.projection = (basis @ turn).astype(np.float32)
    latent = dense @ model.projection
    model.vectors = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return model


def fit_quality(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """A model from ``labelled (text, quality)``, rows with a null in either left out; the
    sample holds at most about ``sample_rows`` different texts of at most
    LONGEST_SAMPLE_TEXT characters."""
    rows = labelled.select("text", "quality").where("text is not null and quality is not null")
    sample = per_label(rows.where(F.length("text") <= LONGEST_SAMPLE_TEXT), "quality", "text",
                       sample_rows).toArrow()
    pairs = sorted(zip(sample["text"].to_pylist(), sample["quality"].to_pylist()))
    return learn([t for t, _ in pairs], [int(y == 1) for _, y in pairs])


def score_quality(rows: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``rows (text, …)`` with score (0 to 1, higher: label 1 is
    likelier). Null, empty and blank texts are all one text without words. A kept column
    named score is replaced. Only the texts pass through Python."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.scores(texts.to_pylist()), pa.float64())

    return rows.select(*(c for c in keep if c != "score"),
                       F.arrow_udf(run, "double")(F.col("text")).alias("score"))
