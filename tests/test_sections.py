import pytest
from pyspark.sql import functions as F

from sheafline.functions.text import (
    BLANKS, section_name, section_number, strip_left, strip_right, token_count, words,
)
from sheafline.operators.sections import section_columns, unpivot_sections
from sheafline.sources.filings import (
    first_filings, in_years, of_company, read_filings, spread, union_years, with_company,
)


def test_words_break_at_every_blank(spark):
    texts = [f"a{c}b" for c in BLANKS] + ["", "   ", " a  b ", "one", BLANKS + "x" + BLANKS, "a​b", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r for r in rows.select("i", words(F.col("t")).alias("w"), token_count(F.col("t")).alias("n")).collect()}
    for i, text in enumerate(texts):
        if text is None:
            assert got[i].w is None and got[i].n is None
        else:
            assert got[i].w == text.split() and got[i].n == len(text.split())


def test_strip_equals_python(spark):
    texts = ["", " ", " a ", "　a b\x1c", "a\xa0", "\na \t", "a", BLANKS]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(strip_right(strip_left(F.col("t")))).collect()] == [t.strip() for t in texts]


def test_section_names(spark):
    row = spark.createDataFrame([("section_1A",), ("x_section_",)], "s string").select(
        section_number(F.col("s")).alias("n"), section_name(F.lit("7")).alias("s")).collect()
    assert [r.n for r in row] == ["1A", "x_section_"] and row[0].s == "section_7"


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(
        [("1", "2020", "text", None, ""), ("2", "2019", "  ", "b", None)],
        "cik string, year string, section_1 string, section_1A string, section_7 string")


def test_unpivot_keeps_what_it_should(wide):
    assert section_columns(wide) == ["section_1", "section_1A", "section_7"]
    strict = {tuple(r) for r in unpivot_sections(wide).collect()}
    assert strict == {("1", "2020", "section_1", "text"), ("2", "2019", "section_1", "  "),
                      ("2", "2019", "section_1A", "b")}
    loose = {tuple(r) for r in unpivot_sections(wide, ("year",), drop_empty=False, short_names=True,
                                                name_col="section_number").collect()}
    assert loose == {("2020", "1", "text"), ("2020", "7", ""), ("2019", "1", "  "), ("2019", "1A", "b")}


def test_unpivot_casts_and_needs_sections(spark):
    numbers = spark.createDataFrame([("1", 5)], "cik string, section_2 int")
    assert unpivot_sections(numbers, ("cik",)).collect()[0].section_text == "5"
    with pytest.raises(ValueError):
        unpivot_sections(spark.createDataFrame([("1",)], "cik string"), ("cik",))


def test_partitioned_scan_prunes_years_and_split(spark, tmp_path):
    path = str(tmp_path / "filings")
    spark.createDataFrame(
        [("1", "2018", "train", "a"), ("1", "2019", "train", "b"), ("1", "2019", "test", "c"), ("2", "2020", "train", "d")],
        "cik string, year string, split string, section_1 string").write.partitionBy("year", "split").parquet(path)
    schema = "cik string, section_1 string, year string, split string"
    found = read_filings(spark, path, years=["2019", "2020"], schema=schema)
    assert {(r.cik, r.year, r.section_1) for r in found.collect()} == {("1", "2019", "b"), ("2", "2020", "d")}
    pruned = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("], Pushed")[0]
    assert "year#" in pruned and "split#" in pruned
    twice = union_years(lambda y: read_filings(spark, path, years=[y], schema=schema), ["2019", "2018", "2019"])
    assert sorted(r.section_1 for r in twice.collect()) == ["a", "b", "b"]
    with pytest.raises(ValueError):
        union_years(lambda y: None, [])


def test_company_filters_and_first(spark):
    rows = spark.createDataFrame([("10", "2018"), ("1", "2019"), (None, "2018"), ("1", "2018")], "cik string, year string")
    assert of_company(rows, "1").count() == 2
    assert with_company(rows).count() == 3
    assert in_years(rows, [2018]).count() == 3
    assert [tuple(r) for r in first_filings(with_company(rows), 2).collect()] == [("1", "2018"), ("1", "2019")]
    assert first_filings(rows, 10).count() == 4


def test_spread_only_adds_tasks(spark):
    one = spark.range(0, 100, 1, 1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    assert spread(spark.range(0, 100, 1, 6), 4).rdd.getNumPartitions() == 6


def test_years_need_a_year_column(spark, tmp_path):
    spark.createDataFrame([("1", "x")], "cik string, section_1 string").write.parquet(str(tmp_path / "f"))
    assert read_filings(spark, str(tmp_path / "f")).count() == 1
    with pytest.raises(ValueError, match="year"):
        read_filings(spark, str(tmp_path / "f"), years=["1999"])


def test_first_filings_are_the_same_however_the_table_is_split(spark):
    rows = spark.createDataFrame([("1", "2020", f"t{i}") for i in range(50)], "cik string, year string, section_1 string")
    first = [{r.section_1 for r in first_filings(rows.repartition(n), 5).collect()} for n in (1, 3, 7)]
    assert first[0] == first[1] == first[2]
