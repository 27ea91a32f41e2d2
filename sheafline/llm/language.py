"""Language identification by nearest centroid.

A text becomes counts of hashed letter n-grams (1 to 3 letters, word edges included),
damped by a logarithm, weighted by inverse document frequency and scaled to length 1.
Each language of a bounded sample of labelled texts is clustered into a few centroids on
the unit sphere, none of them for a handful of odd texts; a text gets the language of the
centroid with the largest cosine, and is rejected if it lies much farther from it than
texts of the sample, short or long as it is, lie from the others of their centroid.
Document frequencies are counted over all labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.sampling import LONGEST_SAMPLE_TEXT, per_label

#: Buckets of hashed n-grams.
DIMENSIONS = 1 << 14
#: Labelled texts that centroids are fitted on, all languages together.
SAMPLE_ROWS = 4000
CLUSTERS = 3
#: Least share of the texts of its language that a centroid stands for.
LEAST_SHARE = 0.02
#: A text is rejected below this share of the cosine that all but one in a thousand texts
#: of the sample reach, among those of fewer letters than SHORT, or of as many and more.
REJECT_SHARE = 0.65
SHORT = 160
#: And below this cosine in any case.
LEAST_COSINE = 0.15
_SEED = 7
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_ORDERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def letter_grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and counts of the n-grams of a text; None if it has no letter."""
    plain = " ".join(_LETTERS.findall(text.lower())) if text else ""
    if not any(map(str.isalpha, set(plain))):
        return None
    codes = np.frombuffer(f" {plain} ".encode("utf-32-le"), np.uint32)
    counts = np.zeros(DIMENSIONS, np.int64)
    for i in range(0, len(codes), 1 << 16):
        run = codes[max(0, i - 2):i + (1 << 16)]
        new = min(i, 2)
        key = np.zeros(len(run), np.uint32)
        for order, factor in enumerate(_ORDERS):
            # Row j holds the gram that ends at letter j.
            key = np.concatenate([key[:1], key[:-1]]) * np.uint32(31) + run * factor if order \
                else run * factor
            spread = (key ^ (key >> np.uint32(15))) * np.uint32(2654435761)
            spread = spread[max(new, order):] >> np.uint32(32 - 14)
            counts += np.bincount(spread, minlength=DIMENSIONS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


@dataclass
class LanguageModel:
    languages: list[str]
    owner: np.ndarray      # language number of each centroid
    centroids: np.ndarray  # DIMENSIONS x number of centroids
    least: tuple[float, float]  # smallest cosines of short and long texts not rejected
    weights: np.ndarray    # inverse document frequency

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Buckets, weights and number of letters."""
        grams = letter_grams(text)
        if grams is None:
            return None
        values = np.log1p(grams[1]) * self.weights[grams[0]]
        return grams[0], (values / np.linalg.norm(values)).astype(np.float32), int(grams[1].sum()) // 3

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is rejected."""
        found = self.vector(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0, True
        cosines = found[1] @ self.centroids[found[0]]
        best = int(cosines.argmax())
        cosine = min(1.0, max(0.0, float(cosines[best])))
        return self.languages[self.owner[best]], cosine, cosine < self.least[found[2] >= SHORT]


def _frequencies(batches):
    total, rows = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if (grams := letter_grams(text)) is not None:
                total[grams[0]] += 1
                rows += 1
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)),
                                      pa.array(np.append(total[used], rows))], names=["bucket", "n"])


def _clustered(rows: np.ndarray) -> np.ndarray:
    """Centroids on the unit sphere. They start at seeded draws, weighted by distance from
    those drawn before; one with too few texts starts again within the largest."""
    rng = np.random.default_rng(_SEED)
    centers = rows[rng.integers(len(rows))][None]
    while len(centers) < CLUSTERS:
        apart = np.maximum(1 - (rows @ centers.T).max(axis=1), 0) ** 2
        if not apart.sum() > 0:
            break
        centers = np.concatenate([centers, rows[rng.choice(len(rows), p=apart / apart.sum())][None]])
    few = max(2, LEAST_SHARE * len(rows)) if len(rows) > CLUSTERS else 1
    for step in range(16):
        owner = (rows @ centers.T).argmax(axis=1)
        counts = np.bincount(owner, minlength=len(centers))
        if step == 15:
            owner = (rows @ centers[counts >= few].T).argmax(axis=1) if (counts >= few).any() else 0 * owner
            counts = np.bincount(owner)
            few = 1
        largest = np.flatnonzero(owner == counts.argmax())
        centers = np.stack([rows[owner == k].mean(axis=0) if n >= few else rows[rng.choice(largest)]
                            for k, n in enumerate(counts)])
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    return centers


def _cosines_to_others(rows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Cosine of each text to the sum of the other texts of its centroid; NaN if there is
    none."""
    out = np.full(len(rows), np.nan)
    for k in np.unique(owner):
        own = np.flatnonzero(owner == k)
        if len(own) > 1:
            total = rows[own].sum(axis=0, dtype=float)
            along = rows[own] @ total
            rest = np.maximum(total @ total - 2 * along + 1, 1e-12)
            out[own] = (along - 1) / np.sqrt(rest)
    return out


def fit_languages(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model from ``labelled (text, lang)``; rows with a null in either, or without a
    letter, teach nothing. The sample holds at most about ``sample_rows`` different texts
    of at most LONGEST_SAMPLE_TEXT characters."""
    labelled = labelled.select("text", "lang").where("text is not null and lang is not null")
    counted = {r["bucket"]: r["n"] for r in labelled.select("text").mapInArrow(
        _frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    rows = counted.pop(-1, 0)
    weights = np.full(DIMENSIONS, np.log(rows + 1.0) + 1)
    for bucket, n in counted.items():
        weights[bucket] = np.log((rows + 1.0) / (n + 1)) + 1
    sample = per_label(labelled.where(F.length("text") <= LONGEST_SAMPLE_TEXT), "lang", "text",
                       sample_rows).toArrow()
    model = LanguageModel([], np.empty(0, int), np.empty((DIMENSIONS, 0)), (0.0, 0.0), weights)
    owner, centers, near = [], [], []
    order = sorted(zip(sample["lang"].to_pylist(), sample["text"].to_pylist()))
    for lang in sorted({x for x, _ in order}):
        vectors = [v for x, t in order if x == lang and (v := model.vector(t)) is not None]
        if not vectors:
            continue
        dense = np.zeros((len(vectors), DIMENSIONS), np.float32)
        for row, (buckets, values, _) in zip(dense, vectors):
            row[buckets] = values
        found = _clustered(dense)
        others = _cosines_to_others(dense, (dense @ found.T).argmax(axis=1))
        near += [(v[2] >= SHORT, c) for v, c in zip(vectors, others) if not np.isnan(c)]
        owner += [len(model.languages)] * len(found)
        centers += list(found)
        model.languages.append(lang)
    if centers:
        every = [c for _, c in near]
        model.least = tuple(max(LEAST_COSINE, REJECT_SHARE * float(np.quantile(own, 0.001))) if own
                            else LEAST_COSINE for long in (False, True)
                            for own in [[c for is_long, c in near if is_long == long] or every])
        model.owner = np.array(owner)
        model.centroids = np.ascontiguousarray(np.stack(centers).T.astype(np.float32))
    return model


def identify(rows: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``rows (text, …)`` with lang_pred, score (cosine, 0 to 1)
    and rejected. A text that is null or has no letter is `und`, 0 and rejected; any other
    gets a learned language, rejected or not. A model that has learned nothing calls
    everything `und`. Columns in ``keep`` are replaced if they are named like the new
    ones. Only the texts pass through Python, and once."""
    new = {"lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_()}

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            # A few texts at a time are Python strings.
            for i in range(0, len(texts), 256):
                found = [model.predict(t) for t in texts.slice(i, 256).to_pylist()]
                parts.append(pa.StructArray.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*found), new.values())], list(new)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct(list(new.items())))

    predict = F.arrow_udf(run, "lang_pred string, score double, rejected boolean")
    own = [c for c in keep if c not in new]
    return rows.select(*own, predict(F.col("text")).alias("_found")).select(
        *own, *(F.col("_found")[c].alias(c) for c in new))
