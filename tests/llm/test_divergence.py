import collections
import random
import re

import numpy as np

from sheafline.llm import divergence
from sheafline.llm.divergence import price, source_divergence

SCHEMA = "text string, lang string, source string, term string, v int, block int"


def brute(rows, least=3, top=200):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(r[1] or "", r[2] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+",
                                                 (r[0] or "").translate(lower))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for d in mine for t in set(d[2]))
        kept = [t for t in seen if seen[t] >= least]
        count = collections.defaultdict(collections.Counter)
        for _, source, terms in mine:
            count[source].update(t for t in terms if seen[t] >= least)
        total = sum(count.values(), collections.Counter())
        prices = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
                            for t in kept}
        f = lambda p, q: (p - q) ** 2 // q
        whole = prices(total)
        p = {s: prices(c) for s, c in count.items()}
        for s in p:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            term = [(f(p[s][t], whole[t]), t) for t in kept
                    if count[s][t] > 0 and p[s][t] > whole[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(items[:most], 1)]
    return sorted(out)


def found(spark, rows, **more):
    got = source_divergence(spark.createDataFrame(rows, SCHEMA), **more)
    return sorted(tuple(r) for r in got.select(
        "lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, n, sources):
    rng = random.Random(seed)
    words = [rng.choice("aBcdéz") + rng.choice("xYz") + rng.choice("ñ'-0 ") + rng.choice("pQr")
             for _ in range(60)]
    return [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de"]),
             f"s{min(rng.randrange(sources), rng.randrange(sources))}", "", 0, 0) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = corpus(1, 150, 8)
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, top=5, least_documents=2) == brute(rows, 2, 5)


def test_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "TILE_SOURCES", 2)
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    rows = corpus(2, 120, 7)
    assert found(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [(None, None, None, None, None, None), ("", "", "s", "", 0, 0), ("1 2 3", "en", "a", "", 0, 0),
            ("one", "en", "b", "", 0, 0), ("x " * 40_000, "de", "a", "", 0, 0),
            ("X x", "de", "b", "", 0, 0), ("X x", "de", "b", "", 0, 0), ("y", "de", None, "", 0, 0),
            ("é" * 3000 + " [x]", "de", "", "", 0, 0)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_prices_of_large_counts():
    counts = [0, 1, 7, 10**13, 3 * 10**13]
    total = 10**14 + 7
    assert price(np.array(counts), total).tolist() == [
        1 + 10**9 * (c + 1) // total for c in counts]
