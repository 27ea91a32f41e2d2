import itertools
import random

from sheafline.llm import minhash
from sheafline.llm.minhash import near_duplicates

SCHEMA = "doc_id long, text string, kept string, band int"


def brute(rows, width, percent):
    """(doc_id, set size, component) by comparing all pairs."""
    def shingles(text):
        words = (text or "").encode().lower().split()
        if not words:
            return set()
        if len(words) < width:
            return {tuple(words)}
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return sorted((i, len(s), root(i)) for i, s in sets)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 120))] for _ in range(n // 6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i * 7 % 1009, " ".join(words).title(), "x", 1))
    return rows


def found(spark, rows, **options):
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got),
                  key=lambda r: (r[0] is None, r))


def test_equals_brute_force(spark):
    rows = corpus(3, 240)
    assert found(spark, rows, width=4) == brute(rows, 4, 80)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    rows = corpus(5, 150)
    assert found(spark, rows) == brute(rows, 5, 80)


def test_edge_rows(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [(1, None, None, None), (2, "", "x", 1), (3, " \n\t ", "x", 1), (4, "a b", "x", 1),
            (5, "A  B", "x", 1), (6, "a b c", "x", 1), (None, "a b", "x", 1), (7, long, "x", 1),
            (8, long + " end", "x", 1), (8, long + " end", "x", 1), (9, "a b", "x", 1)]
    assert found(spark, rows) == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 59996, 7),
        (8, 59997, 7), (8, 59997, 7), (9, 1, 9), (None, 1, None)]
    assert found(spark, []) == []


def test_rows_of_one_id_are_one_document(spark):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = [(1, a, "", 0), (3, b, "", 0), (3, a, "", 0), (2, b, "", 0)]
    assert {(i, c) for i, _, c in found(spark, rows)} == {(1, 1), (2, 1), (3, 1)}


def test_repeated_ids_without_words(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "", 0), (2, text + " x", "", 0), (1, None, "", 0), (2, "", "", 0), (3, " ", "", 0)]
    assert {(i, c) for i, _, c in found(spark, rows)} == {(1, 1), (2, 1), (3, 3)}


def test_estimate_is_close():
    rng = random.Random(0)
    import numpy as np
    shared = [rng.getrandbits(64) for _ in range(800)]
    one, two = ([rng.getrandbits(64) for _ in range(100)] for _ in range(2))
    sets = [np.array(sorted(shared + own), np.uint64) for own in (one, two)]
    a, b = (minhash.packed(minhash.minima(s)) for s in sets)
    assert abs(minhash.estimates(a, b[None])[0] - 0.8) < 0.1
