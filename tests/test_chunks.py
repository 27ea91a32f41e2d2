import math
import random
import statistics

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sheafline.operators import chunk_plan as plans
from sheafline.operators.chunk_plan import attach_plan, chunk_plan, section_token_stats
from sheafline.operators.recursive import chunk_records, recursive_chunks, split_sections, with_recursive_chunks
from sheafline.operators.word_windows import word_chunks


def windows_by_hand(text, limit, overlap):
    tokens = text.split()
    if len(tokens) <= limit:
        return [text]
    step = limit - overlap
    return [" ".join(tokens[k * step:k * step + limit]) for k in range(math.ceil(len(tokens) / step))]


@pytest.mark.parametrize("limit,ratio", [(512, 0.1), (10, 0.0), (7, 0.5)])
def test_word_chunks(spark, limit, ratio):
    sizes = [0, 1, 6, 7, 8, 14, 511, 512, 513, 922, 923, 973, 974, 5000]
    texts = ["  ".join(f"w{i}" for i in range(n)) for n in sizes] + ["   ", " a  b "]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, section_text string")
    got = {}
    for r in word_chunks(rows, limit=limit, ratio=ratio).orderBy("i", "chunk_id").collect():
        got.setdefault(r.i, []).append((r.chunk_id, r.chunk_text))
    for i, text in enumerate(texts):
        assert got[i] == list(enumerate(windows_by_hand(text, limit, int(limit * ratio))))


def test_word_chunks_without_text_and_bad_overlap(spark):
    rows = spark.createDataFrame([(1, None)], "i int, section_text string")
    assert word_chunks(rows).count() == 0
    for limit, ratio in ((512, 1.0), (512, -0.1), (0, 0.1)):
        with pytest.raises(ValueError):
            word_chunks(rows, limit=limit, ratio=ratio)


def test_token_stats(spark):
    texts = [("a", "x y z"), ("a", "x"), ("a", None), ("b", "one two")]
    got = {r.section_number: r for r in section_token_stats(
        spark.createDataFrame(texts, "section_number string, section_text string")).collect()}
    assert (got["a"].max_tokens, got["a"].mean_tokens) == (3, 2.0)
    assert got["a"].std_dev_tokens == pytest.approx(statistics.stdev([3, 1]))
    assert (got["b"].max_tokens, got["b"].std_dev_tokens) == (2, 0.0)


def test_chunk_plan_uses_float_floor_division(spark):
    longest = [*range(500, 3000), 4608, 23040, 39999]
    stats = spark.createDataFrame([(str(m), m) for m in longest], "section_number string, max_tokens int")
    for r in chunk_plan(stats).collect():
        cut = r.max_tokens > 512
        assert r.requires_chunking == cut
        assert r.chunks_needed == (r.max_tokens // (512 * (1 - 0.1)) + 1 if cut else None)
        assert (r.suggested_chunk_size, r.overlap) == ((512, 51) if cut else (None, None))


def test_attach_plan_by_broadcast_and_by_shuffle(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "section_number string, x int")
    plan = spark.createDataFrame([("a", True), ("b", False)], "section_number string, requires_chunking boolean")
    expected = {("a", 1, True), ("b", 2, False), ("c", 3, None)}
    assert {tuple(r) for r in attach_plan(rows, plan, max_sections=2).collect()} == expected
    assert {tuple(r) for r in attach_plan(rows, plan).collect()} == expected
    monkeypatch.setattr(plans, "MAX_BROADCAST_BYTES", 1)
    assert {tuple(r) for r in attach_plan(rows, plan).collect()} == expected


def pack_by_hand(text, size, overlap):
    """The contract of the chunker written as plain loops."""
    chunks = []

    def pack(pieces):
        window = []
        for piece in pieces:
            if window and sum(map(len, window)) + len(piece) > size:
                chunks.append("".join(window))
                while window and (sum(map(len, window)) > overlap or sum(map(len, window)) + len(piece) > size):
                    window.pop(0)
            window.append(piece)
        if window:
            chunks.append("".join(window))

    def cut(part, separators):
        if not separators:
            start = 0
            while True:
                chunks.append(part[start:start + size])
                if start + size >= len(part):
                    return
                start += size - overlap
        first, *rest = part.split(separators[0])
        pending = []
        for piece in [first, *(separators[0] + p for p in rest)]:
            if len(piece) > size:
                pack(pending)
                pending = []
                cut(piece, separators[1:])
            elif piece:
                pending.append(piece)
        pack(pending)

    cut(text, ["\n\n", "\n", " "])
    return [c for c in (c.strip() for c in chunks) if c]


def recursive(spark, texts, size, overlap):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, section_text string")
    got = {i: [] for i in range(len(texts))}
    for r in recursive_chunks(rows, size=size, overlap=overlap).orderBy("i", "chunk_number").collect():
        got[r.i].append(r.text)
        assert r.chunk_number == len(got[r.i])
    return [got[i] for i in range(len(texts))]


def random_text(rng, n):
    return "".join(rng.choice(["a", "bc", "défg", " ", " ", "\n", "\n\n", "\n\n\n", "x" * 30, "  "]) for _ in range(n))


@pytest.mark.parametrize("size,overlap", [(20, 5), (12, 0), (50, 10), (8, 7)])
def test_recursive_chunks_equal_plain_loops(spark, size, overlap):
    rng = random.Random(size)
    texts = ["", " ", "\n\n", "a", "x" * 200, "x" * size, "x" * (size + 1), "a b " * 30, "\n\n\n\nab\n\n\n" * 5]
    texts += [random_text(rng, rng.randint(1, 80)) for _ in range(150)]
    texts += [random_text(rng, 4000), "a b " * 1500]  # several segments of the fold
    got = recursive(spark, texts, size, overlap)
    for text, chunks in zip(texts, got):
        assert chunks == pack_by_hand(text, size, overlap), text
        assert all(len(c) <= size for c in chunks)


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab \n　é"), max_size=120), min_size=1, max_size=20))
def test_recursive_chunks_lossless(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    whole = with_recursive_chunks(rows, "t", 10, 0, trim=False).select("i", F.array_join("chunks", "").alias("j"))
    assert {r.i: r.j for r in whole.collect()} == dict(enumerate(texts))


def test_long_word_windows_share_the_overlap(spark):
    word = "".join(chr(97 + i % 26) for i in range(2000))
    (chunks,) = recursive(spark, [word], 512, 51)
    assert [len(c) for c in chunks] == [512, 512, 512, 512, 156]
    assert all(a[-51:] == b[:51] for a, b in zip(chunks, chunks[1:]))


def test_unflagged_sections_pass_untouched(spark):
    rows = spark.createDataFrame(
        [("2020", "1", "  a b  ", False), ("2020", "2", "", False), ("2020", "3", "", True),
         ("2020", "4", " c ", None), ("2020", "5", " d e", True)],
        "year string, section_number string, section_text string, requires_chunking boolean")
    got = {tuple(r) for r in split_sections(rows, 3, 0).collect()}
    assert got == {("2020", "1", 1, "  a b  "), ("2020", "2", 1, ""), ("2020", "4", 1, " c "),
                   ("2020", "5", 1, "d"), ("2020", "5", 2, "e")}
    record = chunk_records(split_sections(rows, 3, 0)).where("metadata.section_number = '4'").collect()
    assert record[0].metadata.chunk_number == 1 and record[0].metadata.year == "2020"
    with pytest.raises(ValueError):
        split_sections(rows, 10, 10)
