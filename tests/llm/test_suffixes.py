import collections
import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sheafline.llm import suffixes
from sheafline.llm.suffixes import Shard, merged, repeated_windows, without_repeated_bytes

SCHEMA = "doc_id long, text string, gram string, text_id int, spans int"


def brute(rows, window=200):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = collections.Counter(t[i:i + window] for _, t in texts
                               for i in range(len(t) - window + 1))
    out = []
    for doc_id, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


def found(spark, rows, window=200):
    got = without_repeated_bytes(spark.createDataFrame(rows, SCHEMA), window).collect()
    return sorted(
        ((*tuple(r)[:5], bytes(r[5])) for r in got), key=repr)


def text(rng, n, letters="abcdefghijkl mnopé\n"):
    return "".join(rng.choice(letters) for _ in range(n))


def corpus(seed, n):
    rng = random.Random(seed)
    shared = [text(rng, rng.randint(150, 500)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = text(rng, rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(shared)
            cut = rng.randint(0, 60)
            t += part[cut:] + text(rng, rng.randint(0, 150))
        rows.append((i, t, "", 0, 0))
    return rows + rows[:3]


def test_equals_brute_force(spark):
    rows = corpus(1, 80)
    expected = brute(rows)
    assert sum(r[2] for r in expected) > 5000
    assert found(spark, rows) == expected


def test_small_window(spark):
    rows = corpus(3, 40)
    assert found(spark, rows, 40) == brute(rows, 40)


def test_grams_beyond_a_run_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "RUN_BYTES", 3000)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 600)
    rows = corpus(2, 80)
    assert found(spark, rows) == brute(rows)


def test_periodic_and_long_texts(spark):
    rng = random.Random(5)
    rows = [(1, "a" * 200, "", 0, 0), (2, "b" * 201, "", 0, 0), (3, "xyz" * 400, "", 0, 0),
            (4, "\0" * 150 + "q", "", 0, 0), (5, "\0" * 230, "", 0, 0),
            (6, text(rng, 60) * 7, "", 0, 0), (7, "c" * 199, "", 0, 0), (8, "c" * 199, "", 0, 0)]
    long = text(rng, 150_000)
    rows += [(9, long, "", 0, 0), (10, "-" + long[70_000:70_300] + "-", "", 0, 0)]
    assert found(spark, rows) == brute(rows)


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 1000)
    data = np.frombuffer(text(random.Random(1), 5000).encode(), np.uint8)
    begin, many, _, _ = suffixes.segments(data, 200, 48)
    assert begin[0] == 0 and (begin[1:] == (begin + many)[:-1]).all()
    assert begin[-1] + many[-1] == len(data) - 199


def test_edge_rows(spark):
    tail = text(random.Random(9), 260)
    rows = [(1, None, None, None, None), (2, "", "", 0, 0), (None, "x" + tail, "", 0, 0),
            (5, tail.upper(), "", 0, 0), (6, "one", "", 0, 0), (6, "one", "", 0, 0),
            (7, tail, "", 0, 0), (7, tail, "", 0, 0)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, None, None, None, None)]) == brute([(1, None)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=20, max_size=90), min_size=1, max_size=6),
       st.integers(1, 80))
def test_merged_orders(parts, shard_bytes):
    window, bodies = 20, [bytes(p) for p in parts]
    texts = [b"".join(bodies[:len(bodies) // 2]), b"".join(bodies[len(bodies) // 2:])]
    shards = [Shard(np.frombuffer(t, np.uint8), window) for t in texts if t]
    order, border = merged(shards, window)
    whole = [t[i:i + window].ljust(window, b"\0") for t in texts for i in range(len(t))]
    in_order = [whole[i] for i in order]
    assert in_order == sorted(in_order)
    assert [a != b for a, b in zip(in_order, in_order[1:])] == border[1:].tolist()
    seen = collections.Counter(b[i:i + window] for b in bodies for i in range(len(b) - window + 1))
    suffixes.SHARD_BYTES, before = shard_bytes, suffixes.SHARD_BYTES
    try:
        got = repeated_windows(bodies, [1] * len(bodies), window)
    finally:
        suffixes.SHARD_BYTES = before
    for body, bounds in zip(bodies, got):
        starts = {i for lo, hi in zip(bounds[::2], bounds[1::2]) for i in range(lo, hi)}
        assert starts == {i for i in range(len(body) - window + 1) if seen[body[i:i + window]] > 1}
