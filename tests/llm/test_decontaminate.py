import hashlib
import random
import re

from sheafline.llm import common
from sheafline.llm.decontaminate import contamination

DOCS = "doc_id long, text string, item_id string, window int"
ITEMS = "item_id long, text string, doc_id string"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window=10):
    wins = set()
    for item_id, text, _ in items:
        w = words(text)
        wins |= {(item_id, tuple(w[i:i + window])) for i in range(max(1, len(w) - window + 1)) if w}
    rows = []
    for doc_id, text, *_ in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, win in wins:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    ids |= {item_id} - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        rows.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(rows, key=repr)


def found(spark, docs, items):
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def data(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("ab Cd É é x1 the of,".split()) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 10, 14, 30])), "") for i in range(12)]
    docs = []
    for i in range(60):
        parts = [text(rng.choice([0, 3, 70, 150]))]
        if i % 2:
            parts.append(rng.choice(items)[1].upper() if i % 4 == 1 else rng.choice(items)[1])
        docs.append((i, " ".join([*parts, text(rng.choice([0, 64]))]), "", 1))
    return docs, items


def test_equals_brute_force(spark):
    docs, items = data(1)
    assert found(spark, docs, items) == brute(docs, items)


def test_windows_too_many_to_send(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    docs, items = data(2)
    assert found(spark, docs, items) == brute(docs, items)


def test_edge_rows(spark):
    run = " ".join(f"v{i}" for i in range(12))
    items = [(1, None, None), (2, "", ""), (3, " .. ", ""), (4, run, ""), (4, run, ""),
             (None, "lone words", ""), (10, "É", "")]
    long = " ".join(f"n{i}" for i in range(30_000))
    docs = [(1, None, None, None), (2, "", "", 0), (3, "..", "", 0), (4, f"{run}-{run}", "", 0),
            (5, "Lone  Words", "", 0), (6, f"{long} {run.upper()}!", "", 0), (None, run, "", 0),
            (4, run, "", 0), (4, run, "", 0), (7, "é É", "", 0)]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == brute(docs, [])
