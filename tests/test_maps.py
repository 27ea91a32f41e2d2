import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from sheafline.functions.vectors import as_array
from sheafline.operators import mapping
from sheafline.operators.encode import BatchEncoder, HashingEncoder, embed_text
from sheafline.operators.mapping import (
    cluster, count_outliers, distance_to_center, flag_outliers, map_points, plot_table, project,
    scatter_bins, standardize,
)

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def points(spark):
    data = RNG.normal(size=(200, 6)) * [1, 2, 3, 1, 1, 0] + [0, 1, 5, 0, 0, 4]
    rows = [(i, [float(x) for x in v], f"section_{i % 3}") for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "i int, embeddings array<double>, section string").cache()


def matrix(df, column):
    return np.array([r[0] for r in df.orderBy("i").select(vector_to_array(column)).collect()])


def test_standardize(points):
    raw = np.array([r.embeddings for r in points.orderBy("i").collect()])
    scaled = matrix(standardize(points)[0], "scaled_embeddings")
    live = raw[:, :5]
    assert np.allclose(scaled[:, :5], (live - live.mean(0)) / live.std(0, ddof=1))
    assert np.all(scaled[:, 5] == 0)


def test_project(points):
    scaled, _ = standardize(points)
    projected, model = project(scaled, 3)
    loadings = model.pc.toArray()
    scores = matrix(projected, "pca_features")
    assert np.allclose(loadings.T @ loadings, np.eye(3))
    assert np.allclose(scores.mean(0), 0)
    variance = scores.var(0, ddof=1)
    assert np.all(np.diff(variance) <= 1e-12)
    values = np.linalg.eigvalsh(np.cov(matrix(scaled, "scaled_embeddings").T))[::-1]
    assert np.allclose(variance, values[:3])


def test_cluster_is_repeatable_and_nearest(points):
    projected, _ = project(standardize(points)[0])
    clustered, model = cluster(projected, 5)
    labels = [r.cluster for r in clustered.orderBy("i").collect()]
    assert labels == [r.cluster for r in cluster(projected, 5)[0].orderBy("i").collect()]
    gaps = np.linalg.norm(matrix(projected, "pca_features")[:, None] - np.array(model.clusterCenters())[None], axis=2)
    assert np.allclose(gaps[np.arange(len(labels)), labels], gaps.min(1))


def test_map_points_has_one_distance_per_row(points):
    mapped, models = map_points(points)
    rows = mapped.orderBy("i").collect()
    assert len(rows) == 200
    centers = np.array(models.kmeans.clusterCenters())
    d = np.array([np.linalg.norm(r.pca_features.toArray() - centers[r.cluster]) for r in rows])
    assert np.allclose(d, [r.distance_to_center for r in rows])
    assert [int(x) for x in d > d.mean() + 2 * d.std()] == [r.is_outlier for r in rows]
    full, _ = map_points(points, keep_vectors=True)
    assert {"embeddings", "scaled_embeddings"} <= set(full.columns) - set(mapped.columns)
    flags = lambda df: {(r.i, r.is_outlier) for r in df.collect()}
    assert flags(full) == flags(mapped)
    table = plot_table(mapped)
    assert table.columns == ["PC1", "PC2", "Cluster", "Is_Outlier", "Section"]
    assert {r.Section for r in table.select("Section").distinct().collect()} == {"0", "1", "2"}


def test_distance_by_broadcast_and_by_shuffle(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0, [3.0, 4.0]), (2, 1, [1.0, 1.0])], "i int, cluster int, v array<double>")
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0])], "cluster int, center array<double>")
    for bound in (1000, 1):
        monkeypatch.setattr(mapping, "MAX_BROADCAST_BYTES", bound)
        got = {r.i: r.distance_to_center for r in distance_to_center(rows, centers, "v").collect()}
        assert got == {1: 5.0, 2: 0.0}


def test_outlier_flag_is_strict(spark):
    same = spark.createDataFrame([(1.0,)] * 5, "distance_to_center double")
    assert count_outliers(flag_outliers(same)).collect()[0] == (0, 5)
    one = spark.createDataFrame([(1.0,)] * 9 + [(50.0,)], "distance_to_center double")
    assert count_outliers(flag_outliers(one)).collect()[0] == (1, 10)


def test_scatter_bins_count_every_point(spark):
    rows = spark.createDataFrame([(-0.1, 0.2, 1), (0.1, 0.2, 1), (0.4, 0.4, 2), (None, 1.0, 2)],
                                 "PC1 double, PC2 double, Cluster int")
    got = {(r.bin_x, r.bin_y, r.hue): r.n_points for r in scatter_bins(rows, "Cluster", 0.5).collect()}
    assert got == {(-1, 0, "1"): 1, (0, 0, "1"): 1, (0, 0, "2"): 1, (None, 2, "2"): 1}
    assert sum(r.n_points for r in scatter_bins(rows).collect()) == 4


def test_hashing_encoder(spark):
    rows = spark.createDataFrame([(0, "Cash and debt"), (1, "cash　AND debt"), (2, "people work here"), (3, None), (4, "")],
                                 "i int, chunk_text string")
    out = embed_text(rows, encoder=HashingEncoder(64))
    assert out.columns == ["i", "chunk_text", "embeddings"]
    v = matrix(out, "embeddings")
    assert v.shape == (5, 64) and np.allclose(v[0], v[1]) and math.isclose(np.linalg.norm(v[0]), 1)
    assert not v[3].any() and not v[4].any()
    fitted = HashingEncoder(64).fit(rows, "chunk_text")
    asked = spark.createDataFrame([(0, "debt and cash")], "i int, q string")
    assert np.allclose(matrix(fitted.transform(asked, "q", "v"), "v")[0], v[0])


def test_batch_encoder_gets_batches(spark):
    def load():
        def encode(texts):
            assert len(texts) <= 4
            return np.array([[len(t), float(len(texts) <= 4)] for t in texts], dtype=np.float32)
        return encode

    rows = spark.createDataFrame([(i, "x" * i) for i in range(10)], "i int, chunk_text string")
    out = embed_text(rows, encoder=BatchEncoder(load, 4))
    assert matrix(out, "embeddings").tolist() == [[i, 1.0] for i in range(10)]
    assert out.select(as_array(out, "embeddings").alias("a")).schema["a"].dataType.simpleString() == "array<double>"


def test_the_map_does_not_depend_on_partitions(points):
    results = []
    for n in (1, 3, 8):
        mapped, _ = map_points(points.repartition(n))
        results.append(sorted((r.i, r.cluster, r.is_outlier) for r in mapped.collect()))
    assert results[0] == results[1] == results[2]


def test_scatter_bins_are_bounded(spark):
    rows = spark.range(5000).selectExpr("double(id) * 1e9 as PC1", "double(-id % 7) as PC2")
    bins = scatter_bins(rows, bins=20)
    got = bins.collect()
    assert len(got) <= 400 and sum(r.n_points for r in got) == 5000
    assert {r.bin_x for r in got} == set(range(20))
    same = spark.range(3).selectExpr("double(4) as PC1", "double(id) as PC2")
    assert {r.bin_x for r in scatter_bins(same, bins=5).collect()} == {0}


def test_directions_have_a_fixed_sign_and_need_no_covariance(spark, points, monkeypatch):
    scaled, _ = standardize(points)
    projected, model = project(scaled, 2)
    loadings = model.pc.toArray()
    assert (loadings[np.abs(loadings).argmax(axis=0), [0, 1]] > 0).all()
    rng = np.random.default_rng(11)
    data = rng.normal(size=(120, 6)) @ (rng.normal(size=(6, 90)) * [[9], [7], [5], [1], [1], [1]])
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)],
                                 "i int, scaled_embeddings array<double>").repartition(4)
    narrow, exact = project(rows, 3)
    monkeypatch.setattr(mapping, "WIDE", 50)
    wide, found = project(rows, 3)
    assert np.allclose(found.pc.toArray(), exact.pc.toArray(), atol=1e-8)
    assert np.allclose(matrix(wide, "pca_features"), matrix(narrow, "pca_features"), atol=1e-6)


def test_lloyd_steps_by_hand(spark):
    data = np.vstack([RNG.normal(size=(60, 3)) + c for c in ([0, 0, 0], [6, 0, 1], [0, 7, 2])])
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "i int, pca_features array<double>")
    clustered, model = cluster(rows.repartition(5), 4)
    centers = mapping.spread_start(data.mean(0), data.std(0), 4)
    for _ in range(100):
        label = ((data[:, None] - centers) ** 2).sum(2).argmin(1)
        centers = np.array([data[label == c].mean(0) if (label == c).any() else centers[c] for c in range(4)])
    assert np.allclose(model.clusterCenters(), centers)
    assert [r.cluster for r in clustered.orderBy("i").collect()] == label.tolist()
    none, model = cluster(rows.where("i < 0"), 4)
    assert none.count() == 0 and len(model.clusterCenters()) == 4
