"""Toxicity by subword-bag embeddings and a linear softmax.

A word is a bag of hashed character n-grams with its edges marked, so a misspelling that
was never seen shares most n-gram vectors with what was. The vectors of WINDOW words in a
row are averaged and go into a linear softmax; a text is as toxic as its worst window, so
a few words count in a long text too. Vectors and softmax are trained together in numpy,
on a bounded sample of labelled texts, with the gradient going to the worst windows.

To score, the two linear maps are folded into one number per n-gram.
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

BUCKETS = 1 << 16
DIMENSIONS = 8
SHORTEST, LONGEST = 2, 5
WINDOW = 8
#: Labelled texts that the model is trained on, both labels together.
SAMPLE_ROWS = 3000
EPOCHS = 80
RATE = 0.05
#: What the n-gram vectors keep of themselves in each epoch.
SHRINK = 0.998
REMEMBERED_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, one word after the other, and the word number
    of each. A word is at least one n-gram."""
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    grams, owner = [], []
    key = np.zeros(len(codes), np.uint32)
    for size in range(1, LONGEST + 1):
        after = np.zeros(len(codes), np.uint32)
        after[:max(0, len(codes) - size + 1)] = codes[size - 1:]
        key = (key ^ (key >> np.uint32(13))) * np.uint32(0x9E3779B1) + after
        if size >= SHORTEST:
            here = left >= size
            mixed = (key[here] ^ (key[here] >> np.uint32(16))) * np.uint32(0x85EBCA6B)
            grams.append((mixed >> np.uint32(16)).astype(np.int32))
            owner.append(word[here])
    grams, owner = np.concatenate(grams), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return grams[order], owner[order]


def window_means(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each of several runs of words, the first word of its window with the largest
    mean. A run shorter than a window is one window."""
    sums = np.concatenate([[0.0], np.cumsum(values)])
    out = np.empty(len(first), np.int64)
    for i, (a, n) in enumerate(zip(first.tolist(), count.tolist())):
        width = min(n, WINDOW)
        out[i] = a + (sums[a + width:a + n + 1] - sums[a:a + n - width + 1]).argmax()
    return out


@dataclass
class ToxicityModel:
    weights: np.ndarray  # of each n-gram
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        grams, owner = word_grams(words)
        return np.bincount(owner, self.weights[grams], len(words)) / np.bincount(
            owner, minlength=len(words))

    def scores(self, texts: list[str | None], known: dict[str, float]) -> list[float]:
        """Probability that each text is toxic; ``known`` remembers words between calls."""
        split = [words_of(t) for t in texts]
        new = list(dict.fromkeys(w for words in split for w in words if w not in known))
        if len(known) + len(new) > REMEMBERED_WORDS:
            known.clear()
            new = list(dict.fromkeys(w for words in split for w in words))
        for i in range(0, len(new), 50_000):
            some = new[i:i + 50_000]
            known.update(zip(some, self.word_scores(some).tolist()))
        out = []
        for words in split:
            worst = 0.0
            if words:
                values = np.fromiter(map(known.__getitem__, words), float, len(words))
                width = min(len(words), WINDOW)
                sums = np.concatenate([[0.0], np.cumsum(values)])
                worst = (sums[width:] - sums[:-width]).max() / width
            out.append(float(1 / (1 + np.exp(-np.clip(worst + self.bias, -40, 40)))))
        return out


def train(texts: list[str], toxic: list[int]) -> ToxicityModel:
    """Fit n-gram vectors and softmax together by Adam; both labels weigh the same."""
    vocabulary: dict[str, int] = {}
    tokens, labels = [], []
    for text, label in zip(texts, toxic):
        if words := words_of(text):
            tokens.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words),
                                      np.int32, len(words)))
            labels.append(label)
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(np.zeros(BUCKETS), 20.0 if len(y) and y[0] else -20.0)
    count = np.array([len(t) for t in tokens])
    first = np.cumsum(count) - count
    tokens = np.concatenate(tokens)
    names = list(vocabulary)
    parts = [word_grams(names[i:i + 20_000]) for i in range(0, len(names), 20_000)]
    grams = np.concatenate([g for g, _ in parts])
    size = np.concatenate([np.bincount(o) for _, o in parts])
    start = np.cumsum(size) - size
    width = np.minimum(count, WINDOW)
    balance = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    rng = np.random.default_rng(11)
    values = [rng.normal(0, 0.01, (BUCKETS, DIMENSIONS)), rng.normal(0, 1, (DIMENSIONS, 2)),
              np.zeros(2)]
    speed = [np.zeros_like(v) for v in values]
    scale = [0.0, 0.0, 0.0]
    for epoch in range(1, EPOCHS + 1):
        vectors, softmax, bias = values
        folded = vectors @ (softmax[:, 1] - softmax[:, 0])
        word_score = np.add.reduceat(folded[grams], start) / size
        worst = window_means(word_score[tokens], first, count)
        at = np.repeat(worst - (np.cumsum(width) - width), width) + np.arange(width.sum())
        doc = np.repeat(np.arange(len(y)), width)
        word = tokens[at]
        each = np.repeat(1 / (width[doc] * size[word]), size[word])
        text = np.repeat(doc, size[word])
        here = np.repeat(start[word] - (np.cumsum(size[word]) - size[word]), size[word])
        used = grams[here + np.arange(len(here))]
        mean = np.stack([np.bincount(text, vectors[used, k] * each, len(y))
                         for k in range(DIMENSIONS)], axis=1)
        logits = mean @ softmax + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - np.stack([1 - y, y], axis=1)) * balance[:, None]
        back = error @ softmax.T
        grad = np.stack([np.bincount(used, back[text, k] * each, BUCKETS)
                         for k in range(DIMENSIONS)], axis=1)
        for i, g in enumerate((grad, mean.T @ error, error.sum(axis=0))):
            # One scale for a whole array: an n-gram of few texts moves little.
            scale[i] = 0.9 * scale[i] + 0.1 * np.abs(g).max() ** 2
            speed[i] = 0.9 * speed[i] + 0.1 * g
            step = speed[i] / (np.sqrt(scale[i] / (1 - 0.9 ** epoch)) + 1e-12)
            values[i] = (values[i] - (RATE if i else 10 * RATE) * step) * (1 if i else SHRINK)
    vectors, softmax, bias = values
    return ToxicityModel(vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


def fit_toxicity(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from ``labelled (text, toxic)``, rows with a null in either left out; the
    sample holds at most about ``sample_rows`` different texts of at most
    LONGEST_SAMPLE_TEXT characters. Without both labels the model always says the one
    there is, or not toxic."""
    rows = labelled.select("text", "toxic").where("text is not null and toxic is not null")
    sample = per_label(rows.where(F.length("text") <= LONGEST_SAMPLE_TEXT), "toxic", "text",
                       sample_rows).toArrow()
    pairs = sorted(zip(sample["text"].to_pylist(), sample["toxic"].to_pylist()))
    return train([t for t, _ in pairs], [int(y == 1) for _, y in pairs])


def score_toxicity(rows: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``rows (text, …)`` with score, the probability (0 to 1)
    that the text is toxic. Null, empty and wordless texts get the score of no signal. A
    kept column named score is replaced. Only the texts pass through Python."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, float] = {}
        for texts in batches:
            scores = [x for i in range(0, len(texts), 500)
                      for x in model.scores(texts.slice(i, 500).to_pylist(), known)]
            yield pa.array(scores, pa.float64())

    return rows.select(*(c for c in keep if c != "score"),
                       F.arrow_udf(run, "double")(F.col("text")).alias("score"))
