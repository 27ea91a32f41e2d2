"""Memory of the search and of the encoders does not follow the size of the tables."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sheafline.operators import neighbors
from sheafline.operators.neighbors import BestChunks, nearest

RNG = np.random.default_rng(3)


def test_many_equal_distances_take_little_memory():
    """All chunks lie at the distance of the k-th."""
    keys = np.array([f"k{i:05d}" for i in range(10_000)], dtype=object)
    chunks = np.ones((10_000, 256))
    tracemalloc.start()
    best = BestChunks(np.zeros((200, 256)), 60, "l2")
    best.add(chunks, keys)
    found = best.table(pa.array(range(200)), pa.schema([("q", pa.int64()), ("c", pa.string()), ("d", pa.float64())]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 200 * 60 and set(found["c"].to_pylist()) == set(keys[:60])
    assert peak < 120e6


@pytest.mark.parametrize("k", [7, 50, 1000])
def test_hits_sent_on_early_change_nothing(spark, monkeypatch, k):
    vectors = RNG.integers(0, 4, (300, 4)).astype(float)
    queries = RNG.integers(0, 4, (9, 4)).astype(float)
    for name, value in (("HELD_BYTES", 24 * 400), ("HELD_PER_QUERY", 5), ("SLICE_ROWS", 16), ("PAIRS_AT_ONCE", 64)):
        monkeypatch.setattr(neighbors, name, value)
    # Half of the rule in tasks, which do not see the patch, is met here.
    best, rows, early = BestChunks(queries, k, "l2"), [], 0
    schema = pa.schema([("q", pa.int64()), ("c", pa.string()), ("d", pa.float64())])
    keys = np.array([f"k{i:03d}" for i in range(300)], dtype=object)
    for s in range(0, 300, 16):
        best.add(vectors[s:s + 16], keys[s:s + 16])
        if best.full():
            early += 1
            rows += [r for b in best.batches(pa.array(range(9)), schema) for r in b.to_pylist()]
            assert best.rows is None and not best.full()
    rows += [r for b in best.batches(pa.array(range(9)), schema) for r in b.to_pylist()]
    expected = {q: sorted((float(np.linalg.norm(v - w)), key) for key, w in zip(keys, vectors))[:k]
                for q, v in enumerate(queries)}
    for q, own in expected.items():
        assert sorted((r["d"], r["c"]) for r in rows if r["q"] == q)[:k] == own
    assert (early > 0) == (k > 7)
    found = nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, embeddings array<double>"),
                    spark.createDataFrame([(key, w.tolist()) for key, w in zip(keys, vectors)], "chunk_key string, embeddings array<double>"), k)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.chunk_key))
    assert {q: [r[1:] for r in sorted(v)] for q, v in got.items()} == expected
