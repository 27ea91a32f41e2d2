import math
import random

import numpy as np
import pytest

from sheafline.llm.whitening import Whitener, exact_products, whitened

SCHEMA = "vec_id long, embedding array<float>, label int, key string, d int"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, components, distinct=False):
    """{vec_id: [(component, n, deviation, |whitened|, explained)]} for vectors of one length."""
    kept = [(r[0], [math.floor(1024 * float(np.float32(c))) + 100_000 for c in r[1]])
            for r in rows if usable(r[1])]
    fit = sorted({tuple(x) for _, x in kept}) if distinct else [x for _, x in kept]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[x * n - s for x, s in zip(v, sums)] for v in fit], float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = {}
    for vec_id, x in kept:
        apart = [n * a - s for a, s in zip(x, sums)]
        z = np.array(apart) / n @ vectors[:, order] / np.sqrt(values[order])
        out[vec_id] = [(i + 1, n, sum(a * a for a in apart), abs(z[i]),
                        values[order[i]] / values.sum()) for i in range(len(order))]
    return out


def compare(spark, rows, components=8, weights="counts"):
    got = whitened(spark.createDataFrame(rows, SCHEMA), components, weights).collect()
    expected = brute(rows, components, weights == "one")
    found = {}
    for r in sorted(got, key=lambda r: (r["vec_id"], r["component"])):
        assert 0 <= r["identity_error"] < 1e-9
        found.setdefault(r["vec_id"], []).append(r)
    assert found.keys() == expected.keys()
    for vec_id, rows_of in found.items():
        assert len(rows_of) == len(expected[vec_id])
        for r, e in zip(rows_of, expected[vec_id]):
            assert (r["component"], r["n"], int(r["deviation"])) == e[:3]
            assert abs(r["whitened"]) == pytest.approx(e[3], abs=1e-7)
            assert r["explained"] == pytest.approx(e[4], rel=1e-9)


def table(n, d, seed):
    rng = random.Random(seed)
    spread = [rng.uniform(0.05, 1) for _ in range(d)]
    rows = [(i, [rng.gauss(0.1, s) for s in spread], 0, "", 0) for i in range(n)]
    return rows + [(n + i, rows[0][1], 1, "", 0) for i in range(n // 3)]


def test_equals_numpy_with_copies(spark):
    compare(spark, table(90, 12, 1))
    compare(spark, table(90, 12, 1), 3, "one")


def test_rows_without_result_and_fewer_dimensions(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(30, 3, 2) + [(900, None, 0, "", 0), (901, [1.0, None, 2.0], 0, "", 0),
                              (902, [1.0, nan, 2.0], 0, "", 0), (903, [1.0, 2.0, -inf], 0, "", 0)]
    compare(spark, rows)


def test_edges(spark):
    def run(rows):
        got = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
        return sorted((tuple(r) for r in got), key=repr)

    assert run([]) == [] and run([(1, None, 0, "", 0), (2, [], 0, "", 0)]) == []
    one = run([(None, [0.5, 0.25], None, None, None)] * 2)
    assert one == [(None, c, 2, 0, 0.0, 0.0, 0.0) for c in (1, 1, 2, 2)]
    flat = run([(i, [float(i), 7.0], 0, "", 0) for i in range(4)])
    assert [r[4] for r in flat if r[1] == 2] == [0.0] * 4
    assert sorted(abs(r[4]) for r in flat if r[1] == 1) == pytest.approx(
        [0.4472135955, 0.4472135955, 1.3416407865, 1.3416407865])
    mixed = run([(1, [1.0], 0, "", 0), (2, [3.0], 0, "", 0), (3, [1e15, 1.0], 0, "", 0),
                 (4, [-1e15, 1.0], 0, "", 0)])
    assert {(r[0], r[2]) for r in mixed} == {(1, 2), (2, 2), (3, 2), (4, 2)}


def test_exact_beyond_doubles():
    a = np.array([[2**40 + 1, -3], [5, 2**41]], np.int64)
    w = np.array([7, 2**20], np.int64)
    expected = sum(int(n) * np.outer(r.astype(object), r.astype(object)) for r, n in zip(a, w))
    assert (exact_products(a, a, w) == expected).all()
    n = 10**9
    model = Whitener(n, [0, 0], [0, 0], {(0, 0): n, (0, 1): 0, (1, 1): n}, 2)
    assert model.deviation(np.array([[10**6, 3]])) == [n * n * (10**12 + 9)]
