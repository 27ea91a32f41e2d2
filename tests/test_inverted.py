import numpy as np
import pytest

from sheafline.operators.inverted import build_index, search_index

RNG = np.random.default_rng(23)


def frame(spark, key, m, first=0):
    rows = [(i + first, [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, f"{key} bigint, embeddings array<float>")


def true_ranks(q, x, k):
    q, x = np.float32(q).astype(float), np.float32(x).astype(float)
    d = np.sqrt(((q[:, None] - x) ** 2).sum(2))
    return {(i, int(j), r + 1) for i, row in enumerate(d) for r, j in enumerate(np.lexsort((np.arange(len(x)), row))[:k])}


def ranks(found):
    return {(r.query_id, r.chunk_key, r["rank"]) for r in found.collect()}


@pytest.mark.parametrize("probes", [None, 3])
def test_clusters_need_few_directories(spark, tmp_path, probes):
    centers = RNG.normal(size=(12, 16)) * 8
    x = np.concatenate([c + RNG.normal(size=(50, 16)) for c in centers])
    x[100:180] = x[7]  # copies
    q = centers[:6] + RNG.normal(size=(6, 16))
    vectors = frame(spark, "chunk_key", x)
    index = build_index(vectors.where("chunk_key % 4 > 0"), str(tmp_path / "i"), cells=12)
    index.add(vectors)
    index.add(vectors)
    assert index.store(spark).read().count() == len(x)
    assert len(list((tmp_path / "i").glob("cell=*"))) > 3
    found, expected = ranks(search_index(frame(spark, "query_id", q), index, 10, probes=probes)), true_ranks(q, x, 10)
    assert len(found) == 60 and len({f[:2] for f in found} & {e[:2] for e in expected}) >= 57


def test_refining_all_is_exact(spark, tmp_path):
    x, q = RNG.normal(size=(90, 5)) * [1, 10, 100, 0, 1], RNG.normal(size=(4, 5))
    index = build_index(frame(spark, "chunk_key", x), str(tmp_path / "i"))
    assert ranks(search_index(frame(spark, "query_id", q), index, 7, refine=20)) == true_ranks(q, x, 7)


def test_null_vectors_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, 4.0])], "chunk_key bigint, embeddings array<double>")
    index = build_index(rows, str(tmp_path / "i"), cells=5)
    asked = spark.createDataFrame([(1, None), (2, [3.0, 4.0])], "query_id bigint, embeddings array<double>")
    assert ranks(search_index(asked, index, 5)) == {(2, 3, 1), (2, 1, 2)}
    with pytest.raises(ValueError):
        build_index(rows.where("chunk_key = 2"), str(tmp_path / "none"))
