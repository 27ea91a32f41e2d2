"""Exponents are found without a join: each broadcast would hold a page of every executor."""

import math

from sheafline.llm import mixing


def test_exponents_are_found_without_a_broadcast(spark, monkeypatch):
    def refused(df):
        raise AssertionError("a broadcast")

    monkeypatch.setattr(mixing.F, "broadcast", refused)
    tokens = [5, 40, 300, 7000]
    sources = spark.createDataFrame(list(enumerate(tokens)), "source long, tokens long")
    total = sum(tokens)

    def weights(a):
        powers = [(t / total) ** a for t in tokens]
        return [p / sum(powers) for p in powers]

    grid = [i / 1000 for i in range(1001)]
    for budget, share, most in ((total, 0.92, 1e9), (total, 0.5, 1e9), (total, 0.92, 4.0)):
        entropy = max(a for a in grid if -sum(w * math.log(w) for w in weights(a)) >= share * math.log(4))
        limit = min(a for a in grid if max(budget * w / t for w, t in zip(weights(a), tokens)) <= most)
        found = mixing.exponent(sources, total, budget, share, most)
        assert abs(found - max(entropy, limit)) <= 0.001
