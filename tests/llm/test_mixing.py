import math

import pytest
from pyspark.sql import functions as F

from sheafline.llm import mixing
from sheafline.llm.mixing import exponent, mix

SCHEMA = "doc_id long, text string, source string, slot string"


def rows_of(sizes, start=0):
    """``sizes``: source -> word counts of its documents."""
    out = []
    for source, counts in sizes.items():
        for n in counts:
            out.append((start + len(out), "w " * n, source, "s"))
    return out


def weights(tokens, a):
    p = [t / sum(tokens) for t in tokens]
    return [x ** a / sum(y ** a for y in p) for x in p]


@pytest.mark.parametrize("tokens", [[1000, 100, 100, 10], [50, 50], [700, 1], [9]])
def test_exponent(spark, tokens):
    sources = spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)], "source string, tokens long")
    total = sum(tokens)
    a = exponent(sources, total, total, 0.92, 4.0)
    entropy = lambda x: -sum(w * math.log(w) for w in weights(tokens, x))
    most = lambda x: max(total * w / t for w, t in zip(weights(tokens, x), tokens))
    assert 0 <= a <= 1
    if a < 1:
        assert most(a) <= 4.001
        tight = abs(entropy(a) - 0.92 * math.log(len(tokens))) < 1e-4
        assert tight or abs(most(a) - 4) < 1e-3


def test_quotas_and_passes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS", 8)
    sizes = {"big": [7] * 60, "small": [3, 4, 5] * 4, None: [2] * 9}
    docs = spark.createDataFrame(rows_of(sizes), SCHEMA)
    got = mix(docs, ["doc_id", "text", "source"]).collect()
    tokens = {k: sum(v) for k, v in sizes.items()}
    drawn = {k: sum(r.n_tokens for r in got if r.source == k) for k in sizes}
    share = dict(zip(sizes, weights(list(tokens.values()), 0)))
    assert drawn["big"] < tokens["big"] and drawn["small"] >= tokens["small"]
    assert sum(drawn.values()) <= sum(tokens.values()) and share
    for key in sizes:
        own = [r for r in got if r.source == key]
        last = max(r["pass"] for r in own)
        for turn in range(last):
            assert len([r for r in own if r["pass"] == turn]) == len(sizes[key])
        assert len({(r.doc_id, r["pass"]) for r in own}) == len(own)
        assert all(0 <= r.slot <= 1 and 0 <= r.block < mixing.BLOCKS for r in own)
    again = mix(docs.repartition(5), ["doc_id", "text", "source"]).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_edge_rows(spark):
    rows = [(1, None, "a", ""), (2, "", "a", ""), (None, "x y", "a", ""), (3, "z " * 50_000, None, ""),
            (4, "x", "", ""), (4, "x", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix(docs, ["doc_id", "slot"]).collect()
    assert {r.doc_id for r in got} <= {None, 3, 4}
    assert all(isinstance(r.slot, float) for r in got)
    assert mix(docs.limit(0), ["doc_id"]).collect() == []
    assert mix(docs.where("doc_id = 1"), ["doc_id"]).collect() == []
    cut = mix(docs, ["doc_id"], budget=10**9, repetitions=2.0)
    assert cut.agg(F.sum("n_tokens")).first()[0] <= 2 * 50_004
