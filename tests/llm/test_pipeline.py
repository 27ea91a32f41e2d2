"""The pipeline against brute force, stage by stage, and on rows at the edges."""

import random

import corpus_pipeline
from sheafline.llm.mixing import token_count

from . import test_decontaminate, test_lines, test_minhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(seed, n):
    rng = random.Random(seed)
    words = {"aa": "ba bebi bo bubu beb".split(), "bb": "kra kre kri kro kru".split()}
    line = lambda lang, k: " ".join(rng.choice(words[lang]) + rng.choice("abei") for _ in range(k))
    shared = [line("aa", 12) for _ in range(4)]
    rows = []
    for i in range(n):
        lang = rng.choice(["aa", "bb"])
        lines = [line(lang, rng.randint(3, 30)) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:
            lines.insert(0, test_lines.changed(rng, rng.choice(shared), rng.randint(0, 2)))
        if rows and rng.random() < 0.25:
            lines = rng.choice(rows)[1].replace(" ", "  ", 3).split("\n") + lines[:1]
        rows.append((i, "\n".join(lines), lang, f"s{min(3, i % 9)}", None))
    items = [(1, " ".join(rows[5][1].split()[:14])), (2, "nowhere to be found"), (3, None)]
    return rows, items


def written(spark, folder, rows, items):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = documents(1, 90)
    sf_dir = written(spark, tmp_path, rows + [(900, "12 34", "aa", None, 5)], items)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}

    first = stages["language_id"](spark, docs, sf_dir)
    assert texts(first) == {r[0]: r[1] for r in rows}

    second = stages["line_dedup"](spark, first, sf_dir)
    expected = {r[0]: r[4] for r in test_lines.brute(rows) if r[4].strip()}
    assert texts(second) == expected and second.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in second.collect())

    third = stages["near_dedup"](spark, second, sf_dir)
    groups = test_minhash.brute([(i, t) for i, t in expected.items()], 5, 80)
    expected = {i: expected[i] for i, _, c in groups if i == c}
    assert texts(third) == expected

    fourth = stages["decontaminate"](spark, third, sf_dir)
    marked = test_decontaminate.brute(list(expected.items()), [(*x, "") for x in items])
    expected = {r[0]: expected[r[0]] for r in marked if not r[5]}
    assert texts(fourth) == expected and len(expected) < len(rows)

    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.columns == [*docs.columns, "pass", "slot", "block", "n_tokens"]
    drawn = whole.collect()
    assert {r.doc_id for r in drawn} <= set(expected)
    assert all(r.text == expected[r.doc_id] and 0 <= r.slot <= 1 for r in drawn)
    budget = sum(len(t.split()) for t in expected.values())
    assert 0.7 * budget < sum(r.n_tokens for r in drawn) <= budget


def test_edge_rows(spark, tmp_path):
    rows = [(None, "ba be bi", "aa", None, 1), (1, None, None, None, None), (2, "", "aa", "x", 0),
            (3, "kra kre kri\nkra kre kri", "bb", "x", 9), (3, "kra kre kri\nkra kre kri", "bb", "x", 9),
            (4, "ba be bi", None, "y", 3), (5, "kra " * 30_000, "bb", "y", 9)]
    sf_dir = written(spark, tmp_path, rows, [])
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} <= {None, 3, 4, 5} and got
    empty = written(spark, tmp_path / "none", [], [])
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_token_count(spark):
    rows = [(None, 0), ("", 0), (" a\tb\n", 2), ("é x", 2), ("a\x0bb\x85c", 2)]
    got = spark.createDataFrame(rows, "text string, n int").select("n", token_count("text")).collect()
    assert all(a == b for a, b in got)
