import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafline.operators import neighbors, retrieval
from sheafline.operators.neighbors import nearest, nearest_by_hash
from sheafline.operators.retrieval import (
    attach_chunks, digest, first_by_content, in_year, retrieve, with_context,
)

RNG = np.random.default_rng(5)
DIM = 8


def frame(spark, key, vectors, keys=None, key_type="bigint"):
    keys = keys or range(len(vectors))
    rows = [(k, [float(x) for x in v]) for k, v in zip(keys, vectors)]
    return spark.createDataFrame(rows, f"{key} {key_type}, embeddings array<float>")


def by_hand(queries, chunks, k, metric="l2", keys=None):
    queries, chunks = np.float32(queries).astype(float), np.float32(chunks).astype(float)
    keys = keys or list(range(len(chunks)))
    out = set()
    for qi, q in enumerate(queries):
        if metric == "l2":
            d = np.sqrt(((chunks - q) ** 2).sum(1))
        else:
            unit = chunks / np.linalg.norm(chunks, axis=1, keepdims=True)
            d = 1 - unit @ (q / np.linalg.norm(q))
        best = sorted((round(x, 9), keys[i]) for i, x in enumerate(d))[:k]
        out |= {(qi, key, rank + 1) for rank, (_, key) in enumerate(best)}
    return out


def ranks(found):
    return {(r.query_id, r.chunk_key, r["rank"]) for r in found.collect()}


@pytest.fixture(scope="module")
def vectors():
    chunks = RNG.normal(size=(400, DIM))
    chunks[100:230] = chunks[7]  # a third of all chunks are copies
    return RNG.normal(size=(15, DIM)), chunks


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("k", [1, 20, 500])
def test_nearest_equals_brute_force(spark, vectors, metric, k):
    q, c = vectors
    queries, chunks = frame(spark, "query_id", q), frame(spark, "chunk_key", c).repartition(5)
    expected = by_hand(q, c, k, metric)
    assert ranks(nearest(queries, chunks, k, metric=metric)) == expected
    assert ranks(nearest(queries, chunks, k, metric=metric, query_rows=4)) == expected


@pytest.mark.parametrize("seed", range(12))
def test_kernel_with_ties_in_small_slices(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(neighbors, "SLICE_ROWS", int(rng.integers(3, 60)))
    monkeypatch.setattr(neighbors, "PAIRS_AT_ONCE", int(rng.integers(5, 200)))
    chunks = rng.integers(0, 3, size=(300, 4)) if seed % 2 else rng.normal(size=(300, 4))
    chunks[50:150] = chunks[3]
    queries, k = chunks[rng.integers(0, 300, size=7)].astype(float), int(rng.integers(1, 120))
    keys = rng.permutation(300) if seed % 3 else np.array([f"k{x:03d}" for x in rng.permutation(300)], dtype=object)
    best = neighbors.BestChunks(queries, k, "l2")
    best.add(chunks.astype(np.float32), keys)
    best._merge()
    exact = ((np.float32(chunks).astype(float)[None] - queries[:, None]) ** 2).sum(2)
    expected = [(i, keys[j]) for i, d in enumerate(exact)
                for j in sorted(range(300), key=lambda j: (round(d[j], 12), keys[j]))[:k]]
    assert list(zip(*best.rows[:2])) == expected


def test_nearest_with_query_among_copies_and_text_keys(spark, vectors):
    _, c = vectors
    names = [f"k{i:03d}" for i in range(len(c))]
    queries, chunks = frame(spark, "query_id", c[[7, 8]]), frame(spark, "chunk_key", c, names, "string")
    assert ranks(nearest(queries, chunks, 50)) == by_hand(c[[7, 8]], c, 50, keys=names)


def test_nearest_skips_missing_vectors_and_checks_lengths(spark):
    queries = frame(spark, "query_id", [[1.0, 0.0]])
    chunks = spark.createDataFrame([(1, None), (2, [1.0, 0.0])], "chunk_key bigint, embeddings array<float>")
    assert ranks(nearest(queries, chunks, 5)) == {(0, 2, 1)}
    assert ranks(nearest(queries.where("false"), chunks, 5)) == set()
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 0.0])], "chunk_key bigint, embeddings array<float>")
    with pytest.raises(Exception, match="length"):
        nearest(queries, uneven.coalesce(1), 5).collect()
    with pytest.raises(ValueError):
        nearest(queries, chunks, 0)


def test_hash_mode_distances_are_exact_and_blocks_do_not_matter(spark, vectors):
    q, c = vectors
    queries, chunks = frame(spark, "query_id", q), frame(spark, "chunk_key", c)
    whole = nearest_by_hash(queries, chunks, 400, bucket_length=2.0, projections=2)
    rows = whole.collect()
    for r in rows:
        gap = np.linalg.norm(np.float32(q[r.query_id]).astype(float) - np.float32(c[r.chunk_key]))
        assert r.distance == pytest.approx(gap)
    assert len({(r.query_id, r.chunk_key) for r in rows}) == len(rows)
    cut = nearest_by_hash(queries, chunks, 400, bucket_length=2.0, projections=2, block_rows=20)
    assert {tuple(r) for r in cut.collect()} == {tuple(r) for r in rows}
    wide = nearest_by_hash(queries, chunks, 20, bucket_length=1000.0, tables=8, projections=1)
    assert ranks(wide) == by_hand(q, c, 20)


@pytest.fixture
def library(spark):
    """Chunks on a line; the query sits at 0."""
    rows = [(1, 0.1, "same", "2019"), (2, 0.2, "same", "2020"), (3, 0.3, "same", "2020"),
            (4, 0.4, "other", "2020"), (5, 0.5, "far", "2020")]
    chunks = spark.createDataFrame(
        [(k, [x, 0.0], t, y, "1", 1) for k, x, t, y in rows],
        "chunk_key bigint, embeddings array<float>, text string, year string, section_number string, chunk_number int")
    queries = spark.createDataFrame([(0, "q", [0.0, 0.0])], "query_id bigint, query string, embeddings array<float>")
    return queries, chunks


def shown(retrieved):
    return [[(c["rank"], c.chunk_key) for c in r.chunks] for r in retrieved.collect()]


def test_year_is_applied_after_the_top_k(library):
    queries, chunks = library
    assert shown(retrieve(queries, chunks, 4, 2020)) == [[(2, 2), (4, 4)]]
    assert shown(retrieve(queries, chunks, 1, "2020")) == [[]]
    assert shown(retrieve(queries, chunks, 4)) == [[(1, 1), (4, 4)]]


def test_retrieve_by_shuffle(library, monkeypatch):
    monkeypatch.setattr(retrieval, "MAX_BROADCAST_BYTES", 0)
    queries, chunks = library
    assert shown(retrieve(queries, chunks, 4, 2020)) == [[(2, 2), (4, 4)]]


def test_retrieve_by_hash(library):
    queries, chunks = library
    found = retrieve(queries, chunks, 4, 2020, find=nearest_by_hash, bucket_length=100.0, tables=8, projections=1)
    assert shown(found) == [[(2, 2), (4, 4)]]


def test_attach_then_filter_gives_the_same(library):
    queries, chunks = library
    hits = in_year(attach_chunks(nearest(queries, chunks, 4), chunks.select("chunk_key", "year")), 2020)
    assert {(r.chunk_key, r["rank"]) for r in hits.collect()} == {(2, 2), (3, 3), (4, 4)}


def test_context(library):
    queries, chunks = library
    one = with_context(retrieve(queries, chunks, 5, 2020)).collect()[0].context
    assert one == 'Chunk Metadata: {"year":"2020","section_number":"1","chunk_number":1} \nContent: same'
    two = with_context(retrieve(queries, chunks, 5, 2020), best=2).collect()[0].context
    assert two.split("\nChunk")[0] == one and two.endswith("Content: other")
    assert with_context(retrieve(queries, chunks, 5, 1999)).collect()[0].context == ""


def test_first_by_content_of_a_hot_group(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 2).alias("g"), F.col("id").alias("o"),
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("t")).repartition(7)
    got = first_by_content(rows, ["g"], digest(F.col("t")), ["o"])
    assert got.columns == ["g", "o", "t"]
    assert sorted(r.o for r in got.where("t = 'copy'").collect()) == [0, 3]
    assert got.count() == 2000 + 2


def test_doubles_are_compared_as_doubles(spark):
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "query_id bigint, embeddings array<double>")
    chunks = spark.createDataFrame([(1, [1 + 2e-9, 0.0]), (2, [1 + 1e-9, 0.0])],
                                   "chunk_key bigint, embeddings array<double>")
    assert ranks(nearest(queries, chunks, 2)) == {(0, 2, 1), (0, 1, 2)}


def test_hash_mode_finds_most_and_compares_few(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(40, 16)) * 4
    c = centers[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16)) * 0.2
    q = c[rng.integers(0, 3000, 60)]
    queries, chunks = frame(spark, "query_id", q), frame(spark, "chunk_key", c)
    exact = {r[:2] for r in ranks(nearest(queries, chunks, 10))}
    near = nearest_by_hash(queries, chunks, 3000, complete=False)
    compared = near.count()
    assert compared <= 0.1 * len(q) * len(c)
    found = {(r.query_id, r.chunk_key) for r in near.where("rank <= 10").collect()}
    assert len(found & exact) >= 0.9 * len(exact)


def test_chunk_keys_have_to_be_unique(spark):
    rows = [("a", [0.1], "x"), ("a", [0.2], "y"), ("b", [0.3], "z")]
    chunks = spark.createDataFrame([(k, v, t, "2020", "1", 1) for k, v, t in rows],
                                   "chunk_key string, embeddings array<float>, text string, year string, "
                                   "section_number string, chunk_number int")
    queries = spark.createDataFrame([(1, [0.0], "q")], "query_id bigint, embeddings array<float>, query string")
    with pytest.raises(ValueError, match="unique"):
        retrieve(queries, chunks, 2)
