import hashlib
import itertools
import random

from sheafline.llm import lines
from sheafline.llm.lines import edits_allowed, index_keys, probe_keys, within, without_repeated_lines

SCHEMA = "doc_id long, text string, line string, id int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars) + 1)
        how = rng.random()
        if how < 0.4:
            chars.insert(at, rng.choice("abcé"))
        elif chars and at < len(chars):
            if how < 0.7:
                del chars[at]
            else:
                chars[at] = rng.choice("abcé")
    return "".join(chars)


def test_within_equals_the_distance():
    rng = random.Random(2)
    for _ in range(6000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        b = changed(rng, a, rng.randint(0, 5)) if rng.random() < 0.8 else a[::-1]
        for k in (0, 1, 2, 3):
            assert within(a, b, k) == (distance(a, b) <= k), (a, b, k)


def test_near_lines_share_a_key():
    rng = random.Random(3)
    for _ in range(3000):
        a = "".join(rng.choice("ab ") for _ in range(rng.randint(20, 90)))
        b = changed(rng, a, rng.randint(0, 2))
        short, long = sorted((a, b), key=len)
        if distance(a, b) <= edits_allowed(len(short)) and edits_allowed(len(short)):
            assert set(index_keys(short)) & probe_keys(long)


def brute(rows):
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "", r[1] is None) for r in rows})
    occurrences = [(line, (d, i)) for d in docs for i, line in enumerate(d[2].split("\n"))
                   if line.strip(" ")]
    texts = sorted({x for x, _ in occurrences})
    parent = {t: t for t in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(texts, 2):
        k = edits_allowed(min(len(a), len(b)))
        if abs(len(a) - len(b)) <= k and distance(a, b) <= k:
            parent[root(a)] = root(b)
    firsts, gone = set(), set()
    for line, at in occurrences:
        if root(line) in firsts:
            gone.add(at)
        firsts.add(root(line))
    out = []
    for doc_id, text, *_ in rows:
        if text is None:
            out.append((doc_id, 0, 0, None, None))
            continue
        d = (doc_id is None, doc_id or 0, text, False)
        split = text.split("\n")
        left = "\n".join(x for i, x in enumerate(split) if (d, i) not in gone)
        out.append((doc_id, len(split), sum((d, i) in gone for i in range(len(split))),
                    hashlib.sha256(left.encode()).hexdigest(), left))
    return sorted(out, key=repr)


def found(spark, rows):
    got = without_repeated_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted((tuple(r) for r in got), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcd efg") for _ in range(rng.choice([3, 20, 25, 50, 90])))
            for _ in range(30)]
    return [(i, "\n".join(changed(rng, rng.choice(pool), rng.choice([0, 0, 1, 2, 3]))
                          for _ in range(rng.randint(1, 6))), "", 0) for i in range(n)]


def test_equals_brute_force(spark):
    rows = corpus(1, 60)
    assert found(spark, rows) == brute(rows)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK_LINES", 4)
    rows = corpus(2, 50)
    assert found(spark, rows) == brute(rows)


def test_edge_rows(spark):
    long = "word " * 20_000
    rows = [(1, None, None, None), (2, "", "", 0), (3, " \n\n ", "", 0), (4, "a\na\na", "", 0),
            (5, "a", "", 0), (5, "a", "", 0), (None, "a\nb", "", 0), (6, "b", "", 0),
            (7, long, "", 0), (8, long + "x\nlast", "", 0), (9, None, "", 0)]
    got = found(spark, rows)
    assert {(r[0], r[1], r[2]) for r in got} == {
        (1, 0, 0), (2, 1, 0), (3, 3, 0), (4, 3, 2), (5, 1, 1), (None, 2, 2), (6, 1, 0),
        (7, 1, 0), (8, 2, 1), (9, 0, 0)}
    assert len(got) == len(rows) and found(spark, []) == []
    kept = without_repeated_lines(spark.createDataFrame(rows, SCHEMA), ["line", "text"])
    assert kept.columns[-2:] == ["line", "text"] and kept.count() == len(rows)
