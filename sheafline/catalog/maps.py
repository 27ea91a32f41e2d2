"""Vectors, the document map and its outliers."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from sheafline.catalog.base import documents_table, query, r6, table
from sheafline.catalog.chunks import SECTION_CHUNKS_SQL, word_chunks_sql
from sheafline.catalog.filings import filings
from sheafline.functions.text import section_number
from sheafline.functions.vectors import as_array, components, euclidean
from sheafline.operators.encode import BatchEncoder, HashingEncoder, embed_text
from sheafline.operators.mapping import (
    SCATTER_VIEWS, Projection, cluster, count_outliers, distance_to_center, flag_outliers, map_points,
    plot_table, project, scatter_bins, standardize, wide_components, with_vector,
)
from sheafline.operators.word_windows import word_chunks
from sheafline.plans.document_map import document_map
from sheafline.session import scratch_path, stored
from sheafline.sources.sinks import read_plot_csv, write_plot_csv

DOC_CHUNKS_SQL = word_chunks_sql("SELECT * FROM documents", "doc_id", "text")


def embedded_documents(spark, sf_dir, dimensions=256):
    chunks = word_chunks(documents_table(spark, sf_dir).select("doc_id", "text"), "text")
    return embed_text(chunks, "chunk_text", HashingEncoder(dimensions))


def _vectors(spark, sf_dir):
    return with_vector(table(spark, sf_dir, "embeddings"), "embedding")


def _scaled(spark, sf_dir):
    return standardize(_vectors(spark, sf_dir), "embedding")[0]


def weights_sql(chunks: str, ids: str, text: str, dimensions: int) -> str:
    """Bucket weights of the words of every chunk: counts times rarity, of unit length.
    ``chunks`` has the columns ``ids`` and ``text``; chunks without words have no rows."""
    return rf"""
WITH chunks AS ({chunks}),
words AS (
  SELECT {ids}, unnest(list_filter(string_split_regex(lower({text}), '\s+'), lambda w: w <> '')) AS word
  FROM chunks),
counts AS (
  SELECT {ids}, CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % {dimensions} AS bucket, count(*) AS n
  FROM words GROUP BY ALL),
rarity AS (
  SELECT bucket, ln((any_value(total) + 1) / (count(*) + 1)) AS idf
  FROM counts, (SELECT count(*) AS total FROM chunks) GROUP BY bucket),
weights AS (SELECT {ids}, bucket, n * idf AS w FROM counts JOIN rarity USING (bucket)),
lengths AS (SELECT {ids}, sqrt(sum(w * w)) AS length FROM weights GROUP BY ALL)
SELECT {ids}, bucket, CASE WHEN length > 0 THEN w / length ELSE 0 END AS w
FROM weights JOIN lengths USING ({ids})"""


@query("embed_text", f"""
SELECT doc_id, chunk_id, CAST(bucket AS INTEGER) AS bucket, round(w, 6) AS weight
FROM ({weights_sql(DOC_CHUNKS_SQL, "doc_id, chunk_id", "chunk_text", 256)}) WHERE round(w, 6) > 0""")
def _embed_text(spark, sf_dir):
    """The buckets of every chunk that weigh something."""
    cells = embedded_documents(spark, sf_dir).select(
        "doc_id", "chunk_id", F.posexplode(vector_to_array("embeddings")).alias("bucket", "w"))
    return cells.withColumn("weight", r6("w")).where("weight > 0").drop("w")


@query("embed_text_norms", f"""
SELECT doc_id, chunk_id, 256 AS n_dimensions, 1.0::DOUBLE AS norm FROM ({DOC_CHUNKS_SQL})""")
def _embed_text_norms(spark, sf_dir):
    """Every chunk keeps its row and gets one unit vector."""
    embedded = embedded_documents(spark, sf_dir)
    vector = as_array(embedded, "embeddings")
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
    return embedded.select("doc_id", "chunk_id", F.size(vector).alias("n_dimensions"), r6(norm).alias("norm"))


def letter_model():
    """A stand-in for an embedding model: how often five letters occur, and the length."""
    def encode(texts):
        return np.array([[*(t.count(c) for c in "aeinr"), len(t)] for t in texts], np.float32)
    return encode


@query("embed_by_model", f"""
SELECT doc_id, chunk_id, n_chars, CAST(generate_subscripts(counts, 1) AS INTEGER) AS dim,
       CAST(unnest(counts) AS BIGINT) AS n
FROM (SELECT doc_id, chunk_id, length(chunk_text) AS n_chars, list_transform(['a', 'e', 'i', 'n', 'r'],
        lambda c: length(chunk_text) - length(replace(chunk_text, c, ''))) AS counts
      FROM ({DOC_CHUNKS_SQL}))""")
def _embed_by_model(spark, sf_dir):
    """Vectors of a model that each worker loads once."""
    chunks = word_chunks(documents_table(spark, sf_dir).select("doc_id", "text"), "text")
    vector = vector_to_array("embeddings")
    return embed_text(chunks, "chunk_text", BatchEncoder(letter_model, 64), keep_text=False).select(
        "doc_id", "chunk_id", F.get(vector, F.lit(5)).cast("long").alias("n_chars"),
        F.posexplode(F.slice(vector, 1, 5)).alias("pos", "x"),
    ).select("doc_id", "chunk_id", "n_chars", (F.col("pos") + 1).alias("dim"),
             F.col("x").cast("long").alias("n"))


@query("standard_scale", """
WITH cells AS (
  SELECT vec_id, unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS x,
         generate_subscripts(embedding, 1) AS dim FROM embeddings),
moments AS (SELECT dim, avg(x) AS mu, stddev_samp(x) AS sd FROM cells GROUP BY dim)
SELECT vec_id, CAST(dim AS INTEGER) AS dim,
       round(CASE WHEN sd > 0 THEN (x - mu) / sd ELSE 0 END, 6) + 0.0 AS scaled
FROM cells JOIN moments USING (dim)""")
def _standard_scale(spark, sf_dir):
    cells = _scaled(spark, sf_dir).select(
        "vec_id", F.posexplode(vector_to_array("scaled_embeddings")).alias("pos", "x"))
    return cells.select("vec_id", (F.col("pos") + 1).alias("dim"), r6("x").alias("scaled"))


CELLS_SQL = """
SELECT vec_id, unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS x,
       generate_subscripts(embedding, 1) AS dim FROM embeddings"""


def _times(matrix: str, column: str) -> str:
    return f"list_transform({matrix}, lambda r: list_dot_product(r, {column}))"


def _direction_sql(name: str, matrix: str, start: int) -> str:
    """The eigenvector of the largest eigenvalue: steps with the eighth power of the matrix,
    kept in scale, then turned so that its largest entry is positive."""
    squared = "list_transform({0}, lambda r: list_transform({0}, lambda s: list_dot_product(r, s) / {1}))"
    size = "list_sum(list_transform({0}, lambda r, i: r[i]))"
    return f"""
{name}_2 AS MATERIALIZED (SELECT {squared.format("m", size.format("m"))} AS m FROM {matrix}),
{name}_4 AS MATERIALIZED (SELECT {squared.format("m", size.format("m"))} AS m FROM {name}_2),
{name}_8 AS MATERIALIZED (SELECT {squared.format("m", size.format("m"))} AS m FROM {name}_4),
{name}_steps AS (
  SELECT 0 AS step, list_transform(m, lambda r: 1.0 + r[{start}]) AS v FROM {matrix}
  UNION ALL
  SELECT step + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT step, {_times("m", "v")} AS w FROM {name}_steps, {name}_8) WHERE step < 600),
{name} AS MATERIALIZED (
  SELECT list_transform(v, lambda x: x * CASE WHEN
           v[list_position(list_transform(v, lambda y: abs(y)), list_max(list_transform(v, lambda y: abs(y))))]
           < 0 THEN -1 ELSE 1 END) AS v
  FROM {name}_steps WHERE step = 600)"""


def pca_sql(cells: str, ids: str) -> str:
    """WITH clauses up to ``points`` (ids, pc1, pc2) from ``cells`` (ids, dim, x)."""
    return f"""
WITH RECURSIVE cells AS MATERIALIZED ({cells}),
moments AS (SELECT dim, avg(x) AS mu, stddev_samp(x) AS sd FROM cells GROUP BY dim),
scaled AS MATERIALIZED (
  SELECT {ids}, dim, CASE WHEN sd > 0 THEN (x - mu) / sd ELSE 0 END AS z
  FROM cells JOIN moments USING (dim)),
columns AS MATERIALIZED (SELECT dim, list(z ORDER BY {ids}) AS zs FROM scaled GROUP BY dim),
matrix AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (
  SELECT a.dim AS i, list(list_dot_product(a.zs, b.zs) / (len(a.zs) - 1) ORDER BY b.dim) AS r
  FROM columns a, columns b GROUP BY a.dim)),
{_direction_sql("first", "matrix", 1)},
variance AS MATERIALIZED (SELECT list_dot_product(v, {_times("m", "v")}) AS l FROM first, matrix),
rest AS MATERIALIZED (
  SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - l * v[i] * v[j])) AS m
  FROM matrix, first, variance),
{_direction_sql("second", "rest", 2)},
points AS MATERIALIZED (
  SELECT {ids}, sum(z * first.v[dim]) AS pc1, sum(z * second.v[dim]) AS pc2
  FROM scaled, first, second GROUP BY ALL)"""


def map_sql(cells: str, ids: str) -> str:
    """``clustered`` (ids, pc1, pc2, cluster, d) in addition: Lloyd steps on the points."""
    nearest = """list_transform(cs, lambda c: (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y))"""
    return f"""{pca_sql(cells, ids)},
held AS MATERIALIZED (
  SELECT list({{'x': pc1, 'y': pc2}} ORDER BY {ids}) AS ps, avg(pc1) AS mx, avg(pc2) AS my,
         stddev_pop(pc1) AS sx, stddev_pop(pc2) AS sy FROM points),
lloyd AS (
  SELECT 0 AS step, list_transform(range(1, 6), lambda i: {{
    'x': mx + 1.5 * sx * (2 * ((i * 0.75487766624669276) % 1) - 1),
    'y': my + 1.5 * sy * (2 * ((i * 0.56984029099805326) % 1) - 1)}}) AS cs FROM held
  UNION ALL
  SELECT step + 1, list_transform(cs, lambda c, i: CASE
    WHEN len(list_filter(a, lambda q: q.c = i)) = 0 THEN c ELSE {{
      'x': list_avg(list_transform(list_filter(a, lambda q: q.c = i), lambda q: q.x)),
      'y': list_avg(list_transform(list_filter(a, lambda q: q.c = i), lambda q: q.y))}} END)
  FROM (SELECT step, cs, list_transform(ps, lambda p: {{'x': p.x, 'y': p.y,
          'c': list_position({nearest}, list_min({nearest}))}}) AS a FROM lloyd, held)
  WHERE step < 100),
clustered AS MATERIALIZED (
  SELECT {ids}, pc1, pc2, CAST(list_position(gaps, list_min(gaps)) - 1 AS INTEGER) AS cluster,
         sqrt(list_min(gaps)) AS d
  FROM (SELECT *, {nearest.replace("p.x", "pc1").replace("p.y", "pc2")} AS gaps
        FROM points, lloyd WHERE step = 100))"""


FLAG_SQL = "CAST(d > (SELECT avg(d) + 2 * stddev_pop(d) FROM clustered) AS INTEGER)"


def r4(value):
    """Four decimals, without a negative zero."""
    return F.round(value, 4) + F.lit(0.0)


def _pcs():
    return [r4(c).alias(n) for n, c in zip(("PC1", "PC2"), components(
        vector_to_array("pca_features"), ["PC1", "PC2"]))]


@query("pca_project", f"""{pca_sql(CELLS_SQL, "vec_id")}
SELECT vec_id, round(pc1, 4) + 0.0 AS "PC1", round(pc2, 4) + 0.0 AS "PC2" FROM points""")
def _pca_project(spark, sf_dir):
    projected, _ = project(_scaled(spark, sf_dir))
    return projected.select("vec_id", *_pcs())


@query("pca_project_wide", f"""{pca_sql(CELLS_SQL, "vec_id")}
SELECT vec_id, round(pc1, 3) + 0.0 AS "PC1", round(pc2, 3) + 0.0 AS "PC2" FROM points""")
def _pca_project_wide(spark, sf_dir):
    """The form for vectors whose covariance does not fit the driver."""
    scaled = stored(_scaled(spark, sf_dir).select("vec_id", "scaled_embeddings"), "scaled")
    loadings = wide_components(scaled, 2, "scaled_embeddings", extra=30, tolerance=1e-13)
    model = Projection(DenseMatrix(*loadings.shape, loadings.ravel("F")), "scaled_embeddings", "pca_features")
    return model.transform(scaled).select("vec_id", *(
        (F.round(c, 3) + F.lit(0.0)).alias(n) for n, c in zip(("PC1", "PC2"), components(
            vector_to_array("pca_features"), ["PC1", "PC2"]))))


@query("pca_eigen_residuals", """
SELECT CAST(dim AS INTEGER) AS dim, count(*) AS n_points, 0.0::DOUBLE AS residual_1,
       0.0::DOUBLE AS residual_2, true AS ordered
FROM (SELECT generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY dim""")
def _pca_eigen_residuals(spark, sf_dir):
    """The components are eigenvectors: cov(dimension, PC) = variance(PC) * loading."""
    projected, model = project(_scaled(spark, sf_dir))
    loadings = [(i + 1, *map(float, row)) for i, row in enumerate(model.pc.toArray())]
    loading_rows = spark.createDataFrame(loadings, "dim int, l1 double, l2 double")
    pcs = components(vector_to_array("pca_features"), ["pc1", "pc2"])
    cells = projected.select(*pcs, F.posexplode(vector_to_array("scaled_embeddings")).alias("pos", "x"))
    moments = cells.groupBy((F.col("pos") + 1).alias("dim")).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.covar_samp("x", "pc1").alias("c1"), F.covar_samp("x", "pc2").alias("c2"),
        F.var_samp("pc1").alias("v1"), F.var_samp("pc2").alias("v2"))
    # One loading row per vector dimension, fixed by the schema of the vectors.
    return moments.join(F.broadcast(loading_rows), "dim").select(
        "dim", "n_points", r6(F.abs(F.col("c1") - F.col("v1") * F.col("l1"))).alias("residual_1"),
        r6(F.abs(F.col("c2") - F.col("v2") * F.col("l2"))).alias("residual_2"),
        (F.col("v1") >= F.col("v2")).alias("ordered"))


# The two largest eigenvalues of the correlation matrix by power iteration; the second
# after the first was taken out.
@query("pca_largest_variances", """
WITH RECURSIVE cells AS (
  SELECT vec_id, unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS x,
         generate_subscripts(embedding, 1) AS dim FROM embeddings),
moments AS (SELECT dim, avg(x) AS mu, stddev_samp(x) AS sd FROM cells GROUP BY dim),
scaled AS (SELECT vec_id, dim, CASE WHEN sd > 0 THEN (x - mu) / sd ELSE 0 END AS z
           FROM cells JOIN moments USING (dim)),
pairs AS (SELECT a.dim AS i, b.dim AS j, sum(a.z * b.z) / (count(*) - 1) AS c
          FROM scaled a JOIN scaled b USING (vec_id) GROUP BY a.dim, b.dim),
matrix AS (SELECT list(r ORDER BY i) AS m FROM (
  SELECT i, list(c ORDER BY j) AS r FROM pairs GROUP BY i)),
first AS (
  SELECT 0 AS step, list_transform(m, lambda r: 1.0 + r[1]) AS v FROM matrix
  UNION ALL
  SELECT step + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT step, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM first, matrix)
  WHERE step < 1500),
top AS (SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS l
        FROM first, matrix WHERE step = 1500),
rest AS (SELECT l, list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1),
                lambda j: m[i][j] - l * v[i] * v[j])) AS m FROM matrix, top),
second AS (
  SELECT 0 AS step, list_transform(m, lambda r: 1.0 + r[2]) AS v FROM rest
  UNION ALL
  SELECT step + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT step, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM second, rest)
  WHERE step < 1500)
SELECT 1 AS component, round(l, 4) AS variance FROM top
UNION ALL
SELECT 2, round(list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))), 4)
FROM second, rest WHERE step = 1500""")
def _pca_largest_variances(spark, sf_dir):
    """The components are those of the largest variances."""
    projected, _ = project(_scaled(spark, sf_dir))
    parts = projected.select(F.posexplode(vector_to_array("pca_features")).alias("pos", "x"))
    return parts.groupBy((F.col("pos") + 1).alias("component")).agg(
        F.round(F.var_samp("x"), 4).alias("variance"))


def _clustered(spark, sf_dir):
    projected, _ = project(_scaled(spark, sf_dir))
    return cluster(stored(projected.select("vec_id", "pca_features"), "projected"))


@query("kmeans_cluster", f"""{map_sql(CELLS_SQL, "vec_id")}
SELECT vec_id, round(pc1, 4) + 0.0 AS "PC1", round(pc2, 4) + 0.0 AS "PC2", cluster FROM clustered""")
def _kmeans_cluster(spark, sf_dir):
    points, _ = _clustered(spark, sf_dir)
    return points.select("vec_id", *_pcs(), "cluster")


@query("kmeans_nearest_center", """
SELECT count(*) AS n_points, count(*) AS n_at_nearest, 5::BIGINT AS n_clusters FROM embeddings""")
def _kmeans_nearest_center(spark, sf_dir):
    """Every point belongs to the centre nearest to it."""
    points, model = _clustered(spark, sf_dir)
    v = vector_to_array("pca_features")
    gaps = [euclidean(v, F.array(*(F.lit(float(x)) for x in c))) for c in model.clusterCenters()]
    measured = points.select("cluster", F.array(*gaps).alias("gaps"))
    own = F.get("gaps", F.col("cluster"))
    return measured.agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count_if(own <= F.array_min("gaps") + 1e-9).alias("n_at_nearest"),
        F.count_distinct("cluster").alias("n_clusters"))


DISTANCE_SQL = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
means AS (
  SELECT label, list(m ORDER BY dim) AS center FROM (
    SELECT label, dim, avg(x) AS m
    FROM (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS dim FROM v) GROUP BY label, dim)
  GROUP BY label)
SELECT vec_id, label, e, list_distance(e, center) AS d FROM v JOIN means USING (label)"""

FLAGS_SQL = f"""
SELECT *, CAST(d > (SELECT avg(d) + 2 * stddev_pop(d) FROM ({DISTANCE_SQL})) AS INTEGER) AS is_outlier
FROM ({DISTANCE_SQL})"""


def _labelled_distances(spark, sf_dir):
    """Distances to the mean of the given label; labels stand for clusters."""
    points = _vectors(spark, sf_dir)
    means = points.groupBy("label").agg(Summarizer.mean(F.col("embedding")).alias("m"))
    centers = stored(means.select("label", vector_to_array("m").alias("center")), "centers")
    return distance_to_center(points, centers, "embedding", "label")


@query("distance_to_center", f"""
SELECT vec_id, label, round(d, 6) AS distance_to_center FROM ({DISTANCE_SQL})""")
def _distance_to_center(spark, sf_dir):
    return _labelled_distances(spark, sf_dir).select(
        "vec_id", "label", r6("distance_to_center").alias("distance_to_center"))


def _flagged(spark, sf_dir):
    return flag_outliers(_labelled_distances(spark, sf_dir))


@query("outlier_flags", f"SELECT vec_id, label, is_outlier FROM ({FLAGS_SQL})")
def _outlier_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select("vec_id", "label", "is_outlier")


@query("outlier_counts", f"""
SELECT CAST(sum(is_outlier) AS BIGINT) AS n_outliers, count(*) AS n_points FROM ({FLAGS_SQL})""")
def _outlier_counts(spark, sf_dir):
    return count_outliers(_flagged(spark, sf_dir))


PLOT_SQL = f"""
SELECT CAST(e[1] AS DOUBLE) AS "PC1", CAST(e[2] AS DOUBLE) AS "PC2", label AS "Cluster",
       is_outlier AS "Is_Outlier", CAST(vec_id % 3 AS VARCHAR) AS "Section" FROM ({FLAGS_SQL})"""


def _plot_points(spark, sf_dir):
    """The first two dimensions stand for the components, the label for the cluster."""
    section = F.concat(F.lit("section_"), (F.col("vec_id") % 3).cast("string"))
    points = _flagged(spark, sf_dir).withColumn("section", section)
    return plot_table(points, "embedding", "label", "is_outlier", "section")


@query("plot_table", PLOT_SQL)
def _plot_table(spark, sf_dir):
    return _plot_points(spark, sf_dir)


@query("scatter_bins", "\nUNION ALL\n".join(f"""
SELECT '{view}' AS "view", CAST(floor("PC1" / 0.1) AS INTEGER) AS bin_x,
       CAST(floor("PC2" / 0.1) AS INTEGER) AS bin_y, {f'CAST("{hue}" AS VARCHAR)' if hue else "'all'"} AS hue,
       count(*) AS n_points
FROM ({PLOT_SQL}) GROUP BY ALL""" for view, hue in SCATTER_VIEWS.items()))
def _scatter_bins(spark, sf_dir):
    points = stored(_plot_points(spark, sf_dir), "plot")
    views = [scatter_bins(points, hue, 0.1).withColumn("view", F.lit(view)) for view, hue in SCATTER_VIEWS.items()]
    first, *others = views
    for view in others:
        first = first.unionByName(view)
    return first


def _square_sql(c: str) -> str:
    return f"""CAST(least(floor((({c} - (SELECT min({c}) FROM p)) / (SELECT max({c}) - min({c}) FROM p)) * 200), 199)
       AS BIGINT)"""


@query("scatter_bins_bounded", f"""
WITH p AS ({PLOT_SQL})
SELECT {_square_sql('"PC1"')} AS bin_x, {_square_sql('"PC2"')} AS bin_y, CAST("Cluster" AS VARCHAR) AS hue,
       count(*) AS n_points FROM p GROUP BY ALL""")
def _scatter_bins_bounded(spark, sf_dir):
    """At most 200 squares between the ends of each axis, whatever their range."""
    return scatter_bins(stored(_plot_points(spark, sf_dir), "plot"), "Cluster")


@query("csv_roundtrip", PLOT_SQL)
def _csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "plot-csv")
    write_plot_csv(_plot_points(spark, sf_dir), path)
    return read_plot_csv(spark, path)


@query("process_embeddings", f"""{map_sql(CELLS_SQL, "vec_id")}
SELECT vec_id, round(pc1, 4) + 0.0 AS "PC1", round(pc2, 4) + 0.0 AS "PC2", cluster,
       round(d, 4) + 0.0 AS distance_to_center, {FLAG_SQL} AS is_outlier FROM clustered""")
def _process_embeddings(spark, sf_dir):
    points, _ = map_points(_vectors(spark, sf_dir).withColumnRenamed("embedding", "embeddings"))
    return points.select("vec_id", *_pcs(), "cluster", r4("distance_to_center").alias("distance_to_center"),
                         "is_outlier")


# Every bucket of every chunk, 0 where the chunk has no word of it.
MAP_CELLS_SQL = f"""
SELECT doc_id, section, chunk_id, dim, coalesce(w, 0) AS x
FROM (SELECT doc_id, section, chunk_id, unnest(range(1, 257)) AS dim
      FROM ({SECTION_CHUNKS_SQL}) WHERE cik IS NOT NULL)
LEFT JOIN (SELECT doc_id, section, chunk_id, bucket + 1 AS dim, w FROM ({weights_sql(
    f"SELECT * FROM ({SECTION_CHUNKS_SQL}) WHERE cik IS NOT NULL",
    "doc_id, section, chunk_id", "chunk_text", 256)})) USING (doc_id, section, chunk_id, dim)"""


@query("document_map", f"""{map_sql(MAP_CELLS_SQL, "doc_id, section, chunk_id")}
SELECT doc_id, chunk_id, round(pc1, 4) + 0.0 AS "PC1", round(pc2, 4) + 0.0 AS "PC2", cluster AS "Cluster",
       {FLAG_SQL} AS "Is_Outlier", replace(section, 'section_', '') AS "Section" FROM clustered""")
def _document_map(spark, sf_dir):
    points, _ = document_map(filings(spark, sf_dir, heavy=True))
    return points.select(
        "doc_id", "chunk_id", *_pcs(), F.col("cluster").alias("Cluster"),
        F.col("is_outlier").alias("Is_Outlier"), section_number(F.col("section")).alias("Section"))


@query("document_map_sections", f"""
SELECT replace(section, 'section_', '') AS "Section", count(*) AS n_points,
       count(*) AS n_placed FROM ({SECTION_CHUNKS_SQL}) WHERE cik IS NOT NULL GROUP BY section""")
def _document_map_sections(spark, sf_dir):
    """Every chunk of a company's filing is on the map once, with all its values."""
    points, _ = document_map(filings(spark, sf_dir, heavy=True))
    placed = F.col("PC1").isNotNull() & F.col("PC2").isNotNull() & F.col("Cluster").between(0, 4) & F.col(
        "Is_Outlier").isin(0, 1)
    return plot_table(points).groupBy("Section").agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if(placed).alias("n_placed"))
