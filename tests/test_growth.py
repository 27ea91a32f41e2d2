"""Tables that grow, merged statistics, and how often texts are read."""

import pytest
from pyspark.sql import functions as F

from sheafline.operators import encode
from sheafline.operators.chunk_plan import merged_token_stats, section_token_state, section_token_stats
from sheafline.operators.encode import BatchEncoder, HashingEncoder, embed_text
from sheafline.plans.company_ingest import company_ingest
from sheafline.plans.document_map import document_map
from sheafline.sources.stores import PartitionedStore

SCHEMA = "key string, year string, x int"


def content(df):
    return sorted(tuple(r) for r in df.select("key", "year", "x").collect())


def test_replace_swaps_partitions_only(spark, tmp_path):
    store = PartitionedStore(spark, str(tmp_path / "t"))
    assert not store.exists()
    rows = lambda *r: spark.createDataFrame(r, SCHEMA)
    store.replace(rows(("a", "2018", 1), ("b", "2019", 2)))
    for _ in range(2):
        store.replace(rows(("c", "2019", 3), ("d", "2020", 4)))
        assert content(store.read()) == [("a", "2018", 1), ("c", "2019", 3), ("d", "2020", 4)]
    store.replace(rows(("z", "2018", 0)).where("x > 0"))
    assert len(content(store.read())) == 3


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_add_is_idempotent(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr("sheafline.sources.stores.MAX_BROADCAST_BYTES", bound)
    store = PartitionedStore(spark, str(tmp_path / f"t{bound}"))
    rows = [(f"k{i}", str(2018 + i % 3), i) for i in range(30)]
    for some in (rows[:12], rows[5:25], rows, rows):
        store.add(spark.createDataFrame(some, SCHEMA), "key")
    store.add(spark.createDataFrame(rows, SCHEMA).where("year = '2019'"), "key", F.col("year") == "2019")
    assert content(store.read()) == sorted(rows)


def filings(spark, long_years=("2019",)):
    long = " ".join(f"word{i % 97}" for i in range(700))
    rows = [(i, "1", y, f"item {i} of report", long if y in long_years and i % 2 else "short text\n\nmore", "" if i % 5 else None)
            for i in range(12) for y in [str(2018 + i % 3)]]
    return spark.createDataFrame(rows, "id int, cik string, year string, section_1 string, section_1A string, section_7 string")


def table_of(df):
    return sorted((r.chunk_key, r.text, r.year, [round(x, 9) for x in r.embeddings]) for r in df.collect())


@pytest.mark.parametrize("encoder", [HashingEncoder(32), BatchEncoder(
    lambda: lambda texts: __import__("numpy").array([[len(t), 1.0] for t in texts], "float32"))])
def test_growing_equals_one_ingest(spark, tmp_path, encoder):
    source = filings(spark)
    grow = lambda years, path: company_ingest(
        source, years, "1", str(tmp_path / path), encoder=encoder, filing_id="id")
    whole, fitted = grow(["2018", "2019", "2020"], "whole")
    # The second year is the first with a section to cut, so 2018 and 2020 are cut anew.
    for year in ("2020", "2018", "2019", "2018"):
        table, again = grow([year], "grown")
    assert table_of(table) == table_of(whole) and again == fitted
    assert any(r.chunk_number > 1 for r in table.collect())
    with pytest.raises(ValueError):
        company_ingest(source, ["2018"], "1", str(tmp_path / "grown"), encoder=encoder, filing_id="id", limit=100)


def test_a_company_without_filings(spark, tmp_path):
    table, _ = company_ingest(filings(spark), ["2018"], "none", str(tmp_path / "t"), filing_id="id")
    assert table.count() == 0
    table, _ = company_ingest(filings(spark), ["2018"], "none", str(tmp_path / "t"), filing_id="id")
    assert table.count() == 0


def test_states_merge_to_the_same_statistics(spark):
    rows = [(s, y, "w " * n if n is not None else None) for s, y, n in [
        ("1", "2018", 3), ("1", "2018", 9), ("1", "2019", 1), ("1", "2020", None), ("2", "2018", 5),
        ("3", "2019", None), ("2", None, 7), (None, "2018", 2)]]
    sections = spark.createDataFrame(rows, "section_number string, year string, section_text string")
    parts = [section_token_state(sections.where(c)) for c in ("year = '2018'", "year = '2019'", "year = '2020'", "year is null")]
    state = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    rounded = lambda df: sorted(
        (repr(r.section_number), r.max_tokens, r.mean_tokens, round(r.std_dev_tokens, 12)) for r in df.collect())
    assert rounded(merged_token_stats(state)) == rounded(section_token_stats(sections))


def test_texts_are_read_once(spark, monkeypatch, tmp_path):
    read = spark.sparkContext.accumulator(0)
    real = encode.count_words

    def counted(text, buckets):
        read.add(1)
        return real(text, buckets)

    monkeypatch.setattr(encode, "count_words", counted)
    source = filings(spark)
    texts = spark.createDataFrame([(i, f"t{i} x") for i in range(40)], "i int, chunk_text string")
    embedded = embed_text(texts, encoder=HashingEncoder(16))
    assert embedded.count() == 40 and len(embedded.collect()) == 40 and read.value == 40
    read.value = 0
    points, _ = document_map(source, encoder=HashingEncoder(16))
    assert read.value == points.count() == len(points.collect())
    read.value = 0
    table, _ = company_ingest(source, ["2018", "2019", "2020"], "1", str(tmp_path / "v"), filing_id="id")
    assert read.value == table.count() == len(table.collect())
