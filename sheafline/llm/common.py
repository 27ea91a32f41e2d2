"""Spark helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.session import stored

#: Largest table, in bytes, that is sent to every executor.
BROADCAST_BYTES = 8 << 20


def small_or_shuffled(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a stored table for broadcast if its counted rows fit in BROADCAST_BYTES;
    a larger one is joined by shuffle. The rows of the join are the same either way."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def keyed_groups(batches: Iterable[pa.RecordBatch],
                 keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with equal keys in a stream that is sorted by them: the key and the
    columns as Python lists. Holds one run and one batch at a time."""
    key, run = None, {}
    for batch in batches:
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        rows = list(zip(*(columns[k] for k in keys)))
        start = 0
        while start < len(rows):
            end = start + 1
            while end < len(rows) and rows[end] == rows[start]:
                end += 1
            if rows[start] != key:
                if key is not None:
                    yield key, run
                key, run = rows[start], {n: [] for n in columns}
            for n, values in columns.items():
                run[n] += values[start:end]
            start = end
    if key is not None:
        yield key, run


def by_key(df: DataFrame, keys: list[str], fn: Callable, schema: str,
           order: list[str] | None = None) -> DataFrame:
    """Apply ``fn(key, columns) -> dict of lists`` to every group of rows with equal
    keys, sorted by ``order``. Unlike applyInPandas, small groups cost no pandas frame each. The caller
    bounds the groups."""
    def run(batches):
        names = None
        held: dict[str, list] = {}
        for key, columns in keyed_groups(batches, keys):
            rows = fn(key, columns)
            names = names or list(rows)
            for n in names:
                held.setdefault(n, []).extend(rows[n])
            if len(held[names[0]]) >= 4096:
                yield pa.RecordBatch.from_pydict(held, _arrow_schema(schema))
                held = {}
        if held and held[names[0]]:
            yield pa.RecordBatch.from_pydict(held, _arrow_schema(schema))
    return df.repartition(*keys).sortWithinPartitions(*keys, *(order or [])).mapInArrow(run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
             "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(n, kinds[k]) for n, k in (f.strip().split(" ", 1) for f in ddl.split(","))])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a long, b long)``: one row (node, component) per
    node of an edge, component being its smallest reachable node.

    Alternates large-star and small-star steps. Minima are aggregated before the shuffle,
    so a node with very many neighbours is no hot task; each round is stored, so a lost
    executor repeats one round at most.
    """
    pairs = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (now := _fingerprint(pairs)) != before:
        before = now
        both = pairs.union(pairs.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        pairs = stored(moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .union(low.select("a", "m")).distinct(), "edges")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select("b", "b").distinct())


def _fingerprint(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())
