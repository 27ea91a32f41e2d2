import collections
import hashlib
import random

from sheafline.llm import substrings
from sheafline.llm.substrings import without_repeats

SCHEMA = "doc_id long, text string, gram string, start int"


def brute(rows, window=35):
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    seen = collections.Counter(tuple(w[i:i + window]) for _, w in texts
                               for i in range(len(w) - window + 1))
    out = []
    for doc_id, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


def found(spark, rows):
    got = without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted((tuple(r) for r in got), key=repr)


def corpus(seed, n, vocabulary):
    rng = random.Random(seed)
    text = lambda k: [f"w{rng.randrange(vocabulary)}" for _ in range(k)]
    shared = [text(rng.randint(30, 90)) for _ in range(5)]
    rows = []
    for i in range(n):
        words = text(rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            part = list(rng.choice(shared))
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = "changed"
            words += part + text(rng.randint(0, 20))
        rows.append((i, " ".join(words), "", 0))
    return rows + rows[:2]


def test_equals_brute_force(spark):
    rows = corpus(1, 120, 3000)
    expected = brute(rows)
    assert sum(r[2] for r in expected) > 1000
    assert found(spark, rows) == expected


def test_periodic_texts_and_several_shards(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_PIECES", 3)
    rows = corpus(2, 60, 3000) + [(900, "a b " * 60, "", 0), (901, "c " * 35, "", 0),
                                  (902, "c " * 36, "", 0), (903, "d " * 36, "", 0)]
    assert found(spark, rows) == brute(rows)


def test_edge_rows(spark):
    run = " ".join(f"n{i}" for i in range(50_000))
    tail = " ".join(f"n{i}" for i in range(100, 140))
    rows = [(1, None, None, None), (2, "", "", 0), (3, " \n", "", 0), (4, run, "", 0),
            (None, "x y " + tail, "", 0), (5, tail.upper(), "", 0), (6, "one", "", 0),
            (6, "one", "", 0), (7, tail, "", 0), (7, tail, "", 0)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_copies_of_a_window_do_not_meet_as_rows(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_PIECES", 10)
    largest, by_key = [], substrings.by_key

    def watched(df, keys, *rest):
        largest.extend(r["count"] for r in df.groupBy(*keys).count().collect())
        return by_key(df, keys, *rest)

    monkeypatch.setattr(substrings, "by_key", watched)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"a{i}_{j}" for j in range(40)) + f" {passage} "
             + " ".join(f"b{i}_{j}" for j in range(40)), "", 0) for i in range(80)]
    rows += corpus(4, 20, 3000)
    assert found(spark, rows) == brute(rows)
    assert largest and max(largest) <= 10
