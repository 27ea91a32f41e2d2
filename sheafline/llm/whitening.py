"""Embedding whitening with multiplicities.

1. Entries become integers x = floor(1024 c) + 100000. Equal x vectors are one row with a
   count, added up before the shuffle, so copies cost nothing afterwards.
2. Workers add up the weighted sums, then the weighted products of the vectors centred by
   the rounded mean, as whole numbers: matrix products of integers below 2^53 are exact in
   doubles, larger ones use Python's integers. Spark adds the partial sums. The fraction
   that rounding left is taken out exactly, so the covariance does not depend on how rows
   are dealt.
3. The driver decomposes one d x d matrix and sends its first directions to the workers,
   which whiten each distinct vector once.
4. Rows get the result of their vector back through a 128-bit digest of x. The distinct side
   is stored, so that adaptive execution can split the rows of a hot vector.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.session import stored

SCALE, SHIFT = 1024, 100_000
#: Larger entries, times SCALE, are no 64-bit integers.
LARGEST = 9.0e15
#: Directions with less than this share of the variance have none.
LEAST_SHARE = 1e-12
_TOTAL = pa.decimal128(38, 0)


def _vectors(batch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, x matrix, weights) for each vector length in a batch (x, weight, …)."""
    x, weight = batch.column(0), np.array(batch.column(1).to_pylist(), np.int64)
    flat = x.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(x.offsets.to_numpy())
    first = np.cumsum(lengths) - lengths
    out = []
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        out.append((rows, flat[first[rows, None] + np.arange(d)].astype(np.int64), weight[rows]))
    return out


def exact_products(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum over rows of weight * outer(a, b), as Python integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most * int(weight.sum()) < 1 << 53:
        return ((a * weight[:, None]).astype(float).T @ b.astype(float)).astype(np.int64).astype(object)
    return (a.astype(object) * weight.astype(object)[:, None]).T @ b.astype(object)


def _summed(of):
    """Partial sums of ``of(d, x, weight) -> matrix`` for each vector length, one row for
    each entry of the matrix on or above its diagonal, if it is square."""
    def run(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for _, x, weight in _vectors(batch):
                d = x.shape[1]
                n, matrix = total.get(d, (0, 0))
                total[d] = [n + int(weight.sum()), matrix + of(d, x, weight)]
        for d, (n, matrix) in total.items():
            i, j = (np.triu_indices(d) if matrix.shape[0] == d > 1
                    else (np.zeros(d, int), np.arange(d)))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i) + 1, d, np.int32)),
                pa.array(np.append(i, -1).astype(np.int32)),
                pa.array(np.append(j, -1).astype(np.int32)),
                pa.array([Decimal(int(v)) for v in [*matrix[i, j], n]], _TOTAL)],
                names=["d", "i", "j", "total"])
    return run


def _totals(distinct: DataFrame, of) -> dict[int, dict[tuple[int, int], int]]:
    """The sums of all rows: for each length, entries of the matrix, and at (-1, -1) the
    summed weights."""
    out: dict[int, dict[tuple[int, int], int]] = {}
    sums = distinct.select("x", "weight").mapInArrow(
        _summed(of), "d int, i int, j int, total decimal(38,0)")
    for r in sums.groupBy("d", "i", "j").agg(F.sum("total").alias("total")).collect():
        out.setdefault(r["d"], {})[r["i"], r["j"]] = int(r["total"])
    return out


class Whitener:
    """Directions of the vectors of one length, by falling variance."""

    def __init__(self, n: int, sums: list[int], centre: list[int], products, components: int):
        self.n, self.sums, self.centre = n, sums, np.array(centre, np.int64)
        d = len(sums)
        rest = [s - n * c for s, c in zip(sums, centre)]
        v = np.zeros((d, d))
        for (i, j), p in products.items():
            if i >= 0:
                v[i, j] = v[j, i] = (n * p - rest[i] * rest[j]) / n**2
        self.fraction = np.array([r / n for r in rest])
        values, vectors = np.linalg.eigh(v)
        keep = np.argsort(-values, kind="stable")[:components]
        self.trace = float(np.trace(v))
        self.values = values[keep]
        varied = self.values > LEAST_SHARE * self.trace
        self.varied = int(varied.sum())
        self.explained = [float(e) / self.trace if self.trace > 0 else 0.0 for e in self.values]
        self.directions = vectors[:, keep] * np.where(
            varied, 1 / np.sqrt(np.where(varied, self.values, 1)), 0)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - self.fraction) @ self.directions

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over entries of (n x - sums)^2, exact."""
        if self.n * int(np.abs(x).max(initial=0)) < 1 << 61 and max(
                map(abs, self.sums), default=0) < 1 << 61:
            apart = self.n * x - np.array(self.sums, np.int64)
            if int(np.abs(apart).max(initial=0)) ** 2 * max(1, x.shape[1]) < 1 << 63:
                return (apart * apart).sum(axis=1).tolist()
        apart = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(v) for v in (apart * apart).sum(axis=1)]


def _apply(models: dict[int, Whitener]):
    schema = pa.schema([("key", pa.binary()), ("weight", pa.int64()), ("d", pa.int32()),
                        ("deviation", _TOTAL), ("whitened", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for rows, x, weight in _vectors(batch):
                model = models[x.shape[1]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(2).take(pa.array(rows)), pa.array(weight),
                    pa.array(np.full(len(rows), x.shape[1], np.int32)),
                    pa.array([Decimal(v) for v in model.deviation(x)], _TOTAL),
                    pa.array(list(model.whiten(x)), pa.list_(pa.float64()))], schema=schema)
    return run


def _spread(means: dict[int, np.ndarray] | None):
    """Partial weighted sums of whitened vectors, or of their products when centred."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            d = batch.column(0).to_numpy()
            weight = batch.column(1).to_numpy()
            for length in np.unique(d):
                rows = np.flatnonzero(d == length)
                z = np.array(batch.column(2).take(pa.array(rows)).to_pylist(), float)
                w = weight[rows, None]
                if means is None:
                    part = np.vstack([(z * w).sum(axis=0)])
                else:
                    z = z - means[length]
                    part = (z * w).T @ z
                total[length] = total.get(length, 0) + part
        for length, matrix in total.items():
            i, j = (a.ravel() for a in np.indices(matrix.shape))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), length, np.int32)), pa.array(i.astype(np.int32)),
                pa.array(j.astype(np.int32)), pa.array(matrix.ravel())],
                names=["d", "i", "j", "total"])
    return run


def _identity_errors(white: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """Largest entry of the covariance of whitened vectors minus the identity, over the
    components that vary; the vectors are read back as they were stored."""
    def total(means):
        sums = white.select("d", "weight", "whitened").mapInArrow(
            _spread(means), "d int, i int, j int, total double")
        rows = sums.groupBy("d", "i", "j").agg(F.sum("total").alias("total")).collect()
        out: dict[int, np.ndarray] = {}
        for r in rows:
            k = len(models[r["d"]].values)
            out.setdefault(r["d"], np.zeros((1 if means is None else k, k)))[r["i"], r["j"]] = r["total"]
        return out

    means = {d: m[0] / models[d].n for d, m in total(None).items()}
    return {d: float(np.abs(m / models[d].n - np.eye(len(m)))[:models[d].varied, :models[d].varied]
                     .max(initial=0)) for d, m in total(means).items()}


def whitened(rows: DataFrame, components: int = 8, weights: str = "counts") -> DataFrame:
    """One row per row of ``rows (vec_id, embedding, …)`` and component: vec_id, component,
    n, deviation (decimal), whitened, explained, identity_error.

    Rows with a null or empty vector, or one with a null or non-finite entry or one of 9e15
    and more, have no result. Vectors of each length are whitened among themselves. The fit takes
    distinct vectors with their ``weights``: ``counts``, or ``one`` each; n is the sum of
    weights. Components are numbered from 1 by falling variance, up to ``components`` and the
    length; a component without variance has 0 for whitened (and for explained, if the table
    has no variance at all) and does not count in identity_error. A null or repeated vec_id
    is kept as it is; other columns are ignored.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    usable = F.forall("embedding", lambda c: F.coalesce(
        F.abs(c.cast("double")) < F.lit(LARGEST), F.lit(False)))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    keyed = (
        rows.where((F.size("embedding") > 0) & usable)
        .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .withColumn("key", F.unhex(F.substring(F.sha2(F.array_join(
            F.col("x").cast("array<string>"), ","), 256), 1, 32))))
    distinct = stored(
        keyed.groupBy("key", "x").agg(F.count("*").alias("times")).select(
            "x", (F.col("times") if weights == "counts" else F.lit(1).cast("long")).alias("weight"),
            "key"), "distinct")
    first = _totals(distinct, lambda d, x, w: exact_products(np.ones((len(x), 1), np.int64), x, w))
    sums = {d: [t[0, j] for j in range(d)] for d, t in first.items()}
    count = {d: t[-1, -1] for d, t in first.items()}
    centre = {d: [(2 * s + count[d]) // (2 * count[d]) for s in sums[d]] for d in sums}

    def centred(d, x, w):
        y = x - np.array(centre[d], np.int64)
        return exact_products(y, y, w)

    products = _totals(distinct, centred)
    models = {d: Whitener(count[d], sums[d], centre[d], products[d], components) for d in sums}
    white = stored(distinct.mapInArrow(
        _apply(models), "key binary, weight long, d int, deviation decimal(38,0), "
        "whitened array<double>"), "whitened")
    errors = _identity_errors(white, models)
    facts = rows.sparkSession.createDataFrame(
        [(d, m.n, m.explained, errors.get(d, 0.0)) for d, m in models.items()],
        "d int, n long, explained array<double>, identity_error double")
    return (
        keyed.select("vec_id", "key").join(white.drop("weight"), "key")
        .join(F.broadcast(facts), "d")
        .select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened"))
        .select("vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation",
                F.col("col").alias("whitened"), F.get("explained", F.col("pos")).alias("explained"),
                "identity_error"))
