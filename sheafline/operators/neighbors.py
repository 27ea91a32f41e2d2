"""Nearest chunks of many queries, exactly or by hashing.

Pairs of query and chunk are never emitted as rows: a task compares a block of chunk
vectors with a block of queries as matrices and keeps the k best chunks per query.
Only those survivors are shuffled. Ties are broken by the chunk key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from sheafline.functions.vectors import as_array
from sheafline.operators.mapping import with_vector
from sheafline.session import stored

# Bytes of one block of queries, which all tasks of a pass hold, and of each side of a
# comparison within a bucket.
BLOCK_BYTES = 64 * 2**20
# Bytes of a list of bucket parts that is broadcast at most; a longer one is joined by shuffle.
MAX_BROADCAST_BYTES = 32 * 2**20
# Bytes of the hits that a task holds; more are sent on before the scan has ended.
HELD_BYTES = 16 * 2**20
# Hits per query that a task holds; with a larger k it may send some on early.
HELD_PER_QUERY = 2048
# Rows of chunks, cells of a matrix of rough distances, and bytes of the vectors measured
# exactly, at a time: what a task needs besides its hits, whatever the tables' size.
SLICE_ROWS = 4096
CELLS_AT_ONCE = 2**20
EXACT_BYTES = 4 * 2**20
MERGE_GROUPS = 64
PAIRS_AT_ONCE = 65_536


def as_matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrow lists of equal length as a matrix, without a copy."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.empty((0, 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = len(flat) // len(vectors)
    if not np.all(np.diff(vectors.offsets.to_numpy()) == width):
        raise ValueError("vectors differ in length")
    return flat.reshape(len(vectors), width)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


class BestChunks:
    """The k best chunks per query among the chunks added so far."""

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        self.k, self.metric = k, metric
        queries = queries.astype(np.float64)
        self.q = _unit_rows(queries) if metric == "cosine" else queries
        self.q_sq = (self.q * self.q).sum(axis=1)
        self.bound = np.full(len(queries), np.inf)
        self.rows: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def _exact(self, qi: np.ndarray, x: np.ndarray, xi: np.ndarray) -> np.ndarray:
        """Distance pair by pair, so equal vectors get equal distances."""
        out = np.empty(len(qi))
        step = max(1, EXACT_BYTES // (8 * max(1, x.shape[1])))
        for s in range(0, len(qi), step):
            e = s + step
            a, b = self.q[qi[s:e]], x[xi[s:e]]
            out[s:e] = 1 - (a * b).sum(axis=1) if self.metric == "cosine" else ((a - b) ** 2).sum(axis=1)
        return out

    def add(self, x: np.ndarray, keys: np.ndarray) -> None:
        """Compare with a block of chunks, a slice at a time."""
        for s in range(0, len(x), SLICE_ROWS):
            self._add_slice(x[s:s + SLICE_ROWS].astype(np.float64), keys[s:s + SLICE_ROWS])

    def _add_slice(self, x: np.ndarray, keys: np.ndarray) -> None:
        """One slice.

        The matrix product is only a filter: everything within its rounding error of
        the k-th best is measured again exactly.
        """
        if len(self.q) == 0:
            return
        if self.metric == "cosine":
            x = _unit_rows(x)
        x_sq = (x * x).sum(axis=1)
        scale = self.q_sq.max(initial=0) + x_sq.max(initial=0)
        slack = 8 * (x.shape[1] + 4) * np.finfo(np.float64).eps * max(scale, 1e-300)
        step = max(1, CELLS_AT_ONCE // len(x))
        for s in range(0, len(self.q), step):
            q = self.q[s:s + step]
            if self.metric == "cosine":
                rough = 1 - q @ x.T
            else:
                rough = self.q_sq[s:s + step, None] + x_sq[None, :] - 2 * (q @ x.T)
            limit = self.bound[s:s + step]
            if len(x) > self.k:
                limit = np.minimum(limit, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
            qi, xi = np.nonzero(rough <= (limit + 2 * slack)[:, None])
            if len(qi):
                rows = qi + s, keys[xi], self._exact(qi + s, x, xi)
                if len(qi) > PAIRS_AT_ONCE:  # many copies at the distance of the k-th
                    rows, _ = self._ranked(*rows)
                self.waiting.append(rows)
                self.n_waiting += len(rows[0])
                if self.n_waiting > max(PAIRS_AT_ONCE, 0 if self.rows is None else len(self.rows[0]) // 2):
                    self._merge()
        if self.rows is None:
            self._merge()

    def _ranked(self, qi: np.ndarray, ki: np.ndarray, d: np.ndarray):
        """The k best rows per query, in order, and their places."""
        order = ki if ki.dtype != object else np.unique(ki, return_inverse=True)[1]
        by_rank = np.lexsort((order, d, qi))
        qi, ki, d = qi[by_rank], ki[by_rank], d[by_rank]
        first = np.r_[0, np.flatnonzero(np.diff(qi)) + 1]
        place = np.arange(len(qi)) - np.repeat(first, np.diff(np.r_[first, len(qi)]))
        keep = place < self.k
        return (qi[keep], ki[keep], d[keep]), place[keep]

    def _merge(self) -> None:
        """Rank what is waiting together with the best so far. Done when enough is
        waiting to be worth a sort of all rows."""
        if not self.waiting:
            return
        kept = [] if self.rows is None else [self.rows]
        self.rows, place = self._ranked(*(np.concatenate(p) for p in zip(*kept, *self.waiting)))
        self.waiting, self.n_waiting = [], 0
        last = place == self.k - 1
        at = self.rows[0][last]
        self.bound[at] = np.minimum(self.bound[at], self.rows[2][last])

    def full(self) -> bool:
        """Whether the hits held are more than HELD_BYTES. Those may be sent on then, and
        their bounds still hold: whoever merges gets more hits than needed, none less."""
        held = 0 if self.rows is None else len(self.rows[0])
        return 24 * (held + self.n_waiting) > HELD_BYTES

    def batches(self, query_ids: pa.Array, schema: pa.Schema) -> list[pa.RecordBatch]:
        """The hits held, which are let go."""
        found = self.table(query_ids, schema).to_batches(max_chunksize=PAIRS_AT_ONCE)
        self.rows = None
        return found

    def table(self, query_ids: pa.Array, schema: pa.Schema) -> pa.Table:
        self._merge()
        if self.rows is None:
            return schema.empty_table()
        qi, ki, d = self.rows
        distance = d if self.metric == "cosine" else np.sqrt(d)
        return pa.table([query_ids.take(pa.array(qi)), pa.array(ki, schema.field(1).type),
                         pa.array(distance)], schema=schema)


def _slices(batch: pa.RecordBatch, chunk_key: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors and keys of a batch, SLICE_ROWS at a time."""
    for s in range(0, len(batch), SLICE_ROWS):
        part = batch.slice(s, SLICE_ROWS)
        yield as_matrix(part.column("__vector")), part.column(chunk_key).to_numpy(zero_copy_only=False)


def _flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _result_schema(queries: DataFrame, chunks: DataFrame, query_id: str, chunk_key: str) -> StructType:
    return StructType([
        StructField(query_id, queries.schema[query_id].dataType),
        StructField(chunk_key, chunks.schema[chunk_key].dataType),
        StructField("distance", DoubleType()),
    ])


def _arrow_schema(schema: StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])


def _vectors_only(df: DataFrame, key: str, vector: str, within: Sequence[str] = ()) -> DataFrame:
    """Key, vector and the columns of the scope; nothing else is read for the comparison.
    Floats stay floats and doubles doubles."""
    kind = df.schema[vector].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    slim = df.select(key, as_array(df, vector, "float32" if single else "float64").alias("__vector"), *within)
    return slim.where(F.col("__vector").isNotNull())


def _compare_with_all(chunks: DataFrame, query_rows: pa.Table, schema: StructType, k: int,
                      metric: str) -> DataFrame:
    """One pass over the chunks; every task holds all queries."""
    query_id, chunk_key = schema.names[:2]
    held = chunks.sparkSession.sparkContext.broadcast(
        (_flat(query_rows[query_id]), as_matrix(query_rows["__vector"])))
    arrow = _arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = held.value
        best = BestChunks(matrix, k, metric)
        for b in batches:
            for x, keys in _slices(b, chunk_key):
                best.add(x, keys)
                if best.full():
                    yield from best.batches(ids, arrow)
        yield from best.batches(ids, arrow)

    return chunks.mapInArrow(scan, schema)


def _scope(within: Sequence[str]) -> Column:
    """The values of the scope as one text; null if any of them is."""
    return F.when(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in within)),
                  F.to_json(F.array(*(F.col(c).cast("string") for c in within)))).alias("__scope")


def _compare_within(chunks: DataFrame, queries: DataFrame, within: Sequence[str], schema: StructType,
                    k: int, metric: str) -> DataFrame:
    """One pass over the chunks of the scopes that the queries name, which every task holds.

    The chunk vectors are not shuffled. Where the columns of the scope are directories, the
    join with the queries' scopes, fewer rows than the queries that are sent out anyway,
    prunes the scan while it runs.
    """
    query_id, chunk_key = schema.names[:2]
    # True of all but nulls; Spark prunes by a side that some comparison has filtered.
    asked = queries.select(*within).where(reduce(
        lambda a, b: a & b, (F.length(F.col(c).cast("string")) >= 0 for c in within))).distinct()
    rows = queries.select(query_id, "__vector", _scope(within)).where("__scope is not null").toArrow()
    scopes = np.array(rows["__scope"].to_pylist(), dtype=object)
    ids, matrix = _flat(rows[query_id]), as_matrix(rows["__vector"])
    own = {s: np.flatnonzero(scopes == s) for s in set(scopes)}
    held = queries.sparkSession.sparkContext.broadcast(
        {s: (ids.take(pa.array(at)), matrix[at]) for s, at in own.items()})
    arrow = _arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, BestChunks] = {}
        for b in batches:
            for at in range(0, len(b), SLICE_ROWS):
                part = b.slice(at, SLICE_ROWS)
                x, keys = next(_slices(part, chunk_key))
                scope = np.array(part.column("__scope").to_pylist(), dtype=object)
                for s in set(scope) & held.value.keys():
                    if s not in best:
                        best[s] = BestChunks(held.value[s][1], k, metric)
                    best[s].add(x[scope == s], keys[scope == s])
                    if best[s].full():
                        yield from best[s].batches(held.value[s][0], arrow)
        for s, found in best.items():
            yield from found.batches(held.value[s][0], arrow)

    mine = chunks.join(F.broadcast(asked), list(within), "left_semi")
    return mine.select(chunk_key, "__vector", _scope(within)).mapInArrow(scan, schema)


def _salted(df: DataFrame, block: list[str], key: str, mine: str, other: str,
            my_parts: DataFrame, other_parts: DataFrame) -> DataFrame:
    """Put a row into its own part of its block, and copy it to each part that the
    other side's block is cut into."""
    def few(parts: DataFrame) -> DataFrame:
        width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in parts.columns), F.lit(16))
        size = parts.agg(F.sum(width.cast("long"))).first()[0] or 0
        return F.broadcast(parts) if size <= MAX_BROADCAST_BYTES else parts

    rows = df.join(few(my_parts), block, "left").join(few(other_parts), block, "left")
    return rows.withColumn(
        mine, F.pmod(F.xxhash64(key), F.coalesce(f"n_{mine}", F.lit(1))).cast("int")
    ).withColumn(
        other, F.explode(F.sequence(F.lit(0), (F.coalesce(f"n_{other}", F.lit(1)) - 1).cast("int")))
    ).drop(f"n_{mine}", f"n_{other}")


def _hot_parts(df: DataFrame, block: list[str], name: str, rows: int) -> DataFrame:
    """Blocks over ``rows`` rows and the number of parts to cut each into."""
    parts = F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int")
    return stored(df.groupBy(*block).agg(parts.alias(f"n_{name}")).where(F.col(f"n_{name}") > 1), name)


def _compare_by_block(chunks: DataFrame, queries: DataFrame, block: list[str], schema: StructType,
                      k: int, metric: str, block_rows: int | None = None) -> DataFrame:
    """Compare queries with the chunks of the same block.

    A block of many rows on either side is cut into parts by key, and every pair of
    parts meets in one task, so no task holds more than two parts of a block however
    hot the block is. The hot blocks are a counted minority: at most rows / part size.
    """
    query_id, chunk_key = schema.names[:2]
    c_rows = q_rows = block_rows
    if block_rows is None:
        width = (queries.select(F.size("__vector")).first() or [1])[0]
        # A chunk is its numbers; a query those and k results of 24 bytes.
        c_rows = max(1, BLOCK_BYTES // (8 * max(1, width)))
        q_rows = max(1, BLOCK_BYTES // (8 * width + 24 * k))
    c_parts = _hot_parts(chunks, block, "c_part", c_rows)
    q_parts = _hot_parts(queries, block, "q_part", q_rows)
    left = _salted(chunks, block, chunk_key, "c_part", "q_part", c_parts, q_parts)
    right = _salted(queries, block, query_id, "q_part", "c_part", q_parts, c_parts)
    arrow = _arrow_schema(schema)
    cell = [*block, "c_part", "q_part"]

    def compare(chunk_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        best = BestChunks(as_matrix(query_rows["__vector"]), k, metric)
        if chunk_rows.num_rows and query_rows.num_rows:
            best.add(as_matrix(chunk_rows["__vector"]),
                     _flat(chunk_rows[chunk_key]).to_numpy(zero_copy_only=False))
        return best.table(_flat(query_rows[query_id]), arrow)

    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(compare, schema)


def keep_best(found: DataFrame, k: int, query_id: str, chunk_key: str, every: bool = False) -> DataFrame:
    """Merge local results: rank 1..k per query by distance, then chunk key.

    Two steps, because one query has up to k rows from every task: first within a
    fixed number of groups per query, then over the groups. Where ``every`` row is among
    the k best, the first step would drop none and is left out.
    """
    order = ["distance", chunk_key]
    if every:
        ranks = Window.partitionBy(query_id).orderBy(*order)
        return found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    grouped = found.withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    local = Window.partitionBy(query_id, "__group").orderBy(*order)
    final = Window.partitionBy(query_id).orderBy(*order)
    return (grouped.withColumn("__local", F.row_number().over(local)).where(F.col("__local") <= k)
            .drop("__group", "__local")
            .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k))


def nearest(queries: DataFrame, chunks: DataFrame, k: int = 200, *, query_id: str = "query_id",
            query_vector: str = "embeddings", chunk_key: str = "chunk_key",
            chunk_vector: str = "embeddings", metric: str = "l2",
            query_rows: int | None = None, within: Sequence[str] = ()) -> DataFrame:
    """The ``k`` nearest chunks of every query, exactly: query, chunk, distance, rank.

    ``within`` names columns of both tables, such as company and year: a query is then
    compared with the chunks that equal it in all of them, and no others are read where
    they are directories of the chunk table. A query with a null there finds nothing.

    The queries are stored and cut into blocks of bounded bytes (or of ``query_rows``).
    Each block goes to every task of one pass over the chunk vectors, which stay where
    they lie and are never shuffled; only the k best of each task are, and a task that finds
    more than it may hold sends some on before it has ended. Several blocks are several
    passes, each stored before the next block is read. A ``k`` of all chunks is no more
    passes than a small one.
    """
    if k < 1 or metric not in ("l2", "cosine"):
        raise ValueError("need k >= 1 and metric l2 or cosine")
    schema = _result_schema(queries, chunks, query_id, chunk_key)
    q = _vectors_only(queries, query_id, query_vector, within)
    c = _vectors_only(chunks, chunk_key, chunk_vector, within)
    q = stored(q, "queries")
    n, width = q.agg(F.count("*"), F.max(F.size("__vector"))).first()
    most = query_rows or max(1, min(BLOCK_BYTES // (8 * (width or 1)),
                                    HELD_BYTES // (24 * min(k, HELD_PER_QUERY))))
    blocks = -(-n // most) or 1
    every = k > HELD_PER_QUERY and k >= chunks.count()

    def compared(some: DataFrame) -> DataFrame:
        found = (_compare_within(c, some, within, schema, k, metric) if within
                 else _compare_with_all(c, some.toArrow(), schema, k, metric))
        return keep_best(found, k, query_id, chunk_key, every)

    if blocks == 1:
        return compared(q)
    parts = []
    for block in range(blocks):
        mine = q.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block)
        parts.append(stored(compared(mine), "nearest"))
    return reduce(DataFrame.unionByName, parts)


def nearest_by_hash(queries: DataFrame, chunks: DataFrame, k: int = 200, *, query_id: str = "query_id",
                    query_vector: str = "embeddings", chunk_key: str = "chunk_key",
                    chunk_vector: str = "embeddings", bucket_length: float | None = None,
                    tables: int = 8, projections: int = 4, seed: int = 7,
                    block_rows: int | None = None, complete: bool = True) -> DataFrame:
    """Approximate mode for query tables too large to compare with every chunk.

    Only chunks that share a bucket with the query, in at least one hash table, are
    compared; within those the distances and the ranking are exact. A query whose buckets
    hold fewer than ``k`` chunks is searched exactly instead, so every query gets ``k``
    wherever there are as many; without ``complete`` it keeps what its buckets hold. A bucket is a cell of
    ``projections`` random projections together. ``bucket_length`` is by default the
    deviation of a projection, estimated from all chunks, so that it follows the scale of
    the vectors. Larger buckets and more ``tables`` find more; more
    ``projections`` compare less. Vectors without cluster structure in many dimensions
    have no cells that help: use :func:`nearest` there.
    """
    if k < 1:
        raise ValueError("need k >= 1")
    schema = _result_schema(queries, chunks, query_id, chunk_key)
    q = with_vector(_vectors_only(queries, query_id, query_vector), "__vector")
    c = with_vector(_vectors_only(chunks, chunk_key, chunk_vector), "__vector")
    if bucket_length is None:
        spread = c.select(Summarizer.variance(F.col("__vector")).alias("v")).first()["v"]
        mean = float(np.nanmean(spread.toArray())) if spread is not None and len(spread) else 0.0
        bucket_length = max(mean, 1e-12) ** 0.5
    lsh = BucketedRandomProjectionLSH(inputCol="__vector", outputCol="__hashes", seed=seed,
                                      bucketLength=bucket_length, numHashTables=tables * projections).fit(c)

    def hashed(df: DataFrame, key: str) -> DataFrame:
        joined = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.array_join(
            F.slice("__cells", t * projections + 1, F.lit(projections)).cast("array<string>"), ","))
        return lsh.transform(df).select(
            key, vector_to_array("__vector").alias("__vector"),
            F.array(*(F.get(vector_to_array(F.get("__hashes", F.lit(i))), F.lit(0)).cast("long")
                      for i in range(tables * projections))).alias("__cells"),
        ).select(key, "__vector", F.posexplode(joined).alias("__table", "__bucket"))

    # Stored, because the bucket counts and the comparison both read them.
    found = _compare_by_block(stored(hashed(c, chunk_key), "hashed-chunks"),
                              stored(hashed(q, query_id), "hashed-queries"),
                              ["__table", "__bucket"], schema, k, "l2", block_rows)
    once = found.groupBy(query_id, chunk_key).agg(F.min("distance").alias("distance"))
    ranked = stored(keep_best(once, k, query_id, chunk_key), "ranked-by-hash")
    if not complete:
        return ranked
    full = ranked.groupBy(query_id).count().where(F.col("count") >= k).select(query_id)
    lacking = stored(queries.select(query_id, query_vector).join(full, query_id, "left_anti"), "lacking")
    if lacking.isEmpty():
        return ranked
    exact = nearest(lacking, chunks, k, query_id=query_id, query_vector=query_vector,
                    chunk_key=chunk_key, chunk_vector=chunk_vector)
    return ranked.join(full, query_id, "left_semi").unionByName(exact)
