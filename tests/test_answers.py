import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sheafline.functions.answers import extract_answer
from sheafline.operators.answering import apply_generator, last_per_query, render_prompts, with_answers
from sheafline.operators.encode import HashingEncoder
from sheafline.operators.metrics import observed
from sheafline.operators.retrieval import build_vector_table, retrieve
from sheafline.plans.batch_qa import ask
from sheafline.plans.company_ingest import company_ingest
from sheafline.plans.document_map import document_map
from sheafline.session import scratch_path, shared_folder, stored
from sheafline.sources.sinks import (
    read_plot_csv, read_results_json, read_vector_table, result_records, write_plot_csv,
    write_results_json, write_vector_table,
)


def test_braces_in_values_stay(spark):
    rows = spark.createDataFrame([("{year} {x}", "{query}")], "query string, context string")
    made = render_prompts(rows, 2020, "{{{year}}}|{query}|{context}").collect()[0].prompt
    assert made == "{2020}|{year} {x}|{query}"
    with pytest.raises(ValueError):
        render_prompts(rows, 2020, "{unknown}")


def test_generator_errors_stay_in_their_row(spark):
    def generate(prompts, **options):
        assert options == {"temperature": 0.3, "max_new_tokens": 200}
        if any("bad" in p for p in prompts):
            raise RuntimeError("no")
        return [p.upper() for p in prompts]

    rows = spark.createDataFrame([(i, "bad" if i == 5 else f"p{i}") for i in range(20)], "i int, prompt string")
    got = {r.i: (r.answer, r.error) for r in apply_generator(rows, generate, batch_size=4).collect()}
    assert got[5] == (None, "Error: no")
    assert all(got[i] == (f"P{i}", None) for i in range(20) if i != 5)


def test_generator_with_wrong_number_of_answers_is_repeated(spark):
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "i int, prompt string")
    got = apply_generator(rows, lambda prompts, **_: prompts[:1], batch_size=3).collect()
    assert all(r.answer == r.prompt and r.error is None for r in got)


def test_extract_answer(spark):
    cases = {'{"answer":"x"}': "x", '{"b":1}': "", "nope": "nope", "": "", "[1]": "", '{"answer":3}': "3",
             '{"answer":null}': None, '"text"': "", '{"answer":"a\\"b"}': 'a"b', '{"answer": "x"': '{"answer": "x"'}
    rows = spark.createDataFrame([(c,) for c in cases] + [(None,)], "raw string")
    got = {r.raw: r.a for r in rows.select("raw", extract_answer(F.col("raw")).alias("a")).collect()}
    assert got == {**cases, None: None}
    assert with_answers(spark.createDataFrame([('{"answer":"x"}',)], "answer string")).collect()[0].answer == "x"


def test_last_result_at_first_position(spark):
    rows = spark.createDataFrame([(1, "a", "old"), (2, "b", "x"), (3, "a", "new")], "query_id int, query string, answer string")
    got = [tuple(r) for r in last_per_query(rows).orderBy("position").collect()]
    assert got == [("a", 1, 3, "new"), ("b", 2, 2, "x")]
    assert {tuple(r) for r in last_per_query(rows.select("query_id", "query")).collect()} == {("a", 1, 3), ("b", 2, 2)}


def test_csv_keeps_quotes_and_lines(spark, tmp_path):
    rows = spark.createDataFrame([(0.1, -2.5, 3, 1, 'a "b", c'), (1e-300, 2.0, 0, 0, "7")],
                                 "PC1 double, PC2 double, Cluster int, Is_Outlier int, Section string")
    path = str(tmp_path / "csv")
    write_plot_csv(rows.coalesce(1), path)
    assert {tuple(r) for r in read_plot_csv(spark, path).collect()} == {tuple(r) for r in rows.collect()}
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_text().splitlines()[0] == "PC1,PC2,Cluster,Is_Outlier,Section"


def test_vector_table_is_partitioned_by_year(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2019", [1.0]), ("b", "2020", [2.0])], "text string, year string, embeddings array<float>")
    for name, rebalance in (("plain", False), ("even", True)):
        path = tmp_path / name
        write_vector_table(rows, str(path), rebalance=rebalance)
        assert {p.name for p in path.glob("year=*")} == {"year=2019", "year=2020"}
        back = read_vector_table(spark, str(path), rows.schema)
        assert {(r.text, r.year) for r in back.collect()} == {("a", "2019"), ("b", "2020")}


def library(spark):
    texts = [("2020", "1", "revenue grew"), ("2020", "7", "staff of nine"), ("2019", "1", "revenue fell")]
    rows = spark.createDataFrame([(f"c{i}", y, s, 1, t) for i, (y, s, t) in enumerate(texts)],
                                 "chunk_key string, year string, section_number string, chunk_number int, text string")
    return build_vector_table(rows, HashingEncoder(128))


def test_json_results_leave_out_missing_scores(spark, tmp_path):
    table, encoder = library(spark)
    asked = spark.createDataFrame([(0, "revenue")], "query_id int, query string")
    found = retrieve(encoder.transform(asked, "query", "embeddings"), table, 10, 2020).withColumn("answer", F.lit("x"))
    for with_score in (False, True):
        path = str(tmp_path / f"json{with_score}")
        write_results_json(result_records(found, with_score).coalesce(1), path)
        (part,) = (tmp_path / f"json{with_score}").glob("part-*")
        record = json.loads(part.read_text())
        assert record["query"] == "revenue" and record["answer"] == "x"
        assert record["chunks"][0]["metadata"] == {"chunk_number": 1, "section_number": "1", "year": "2020"}
        assert record["chunks"][0]["content"] == "revenue grew"
        assert ("score" in record["chunks"][0]) == with_score
        assert len(read_results_json(spark, path).collect()[0].chunks) == 2


def test_ask(spark):
    def generate(prompts, **_):
        if any("fail" in p for p in prompts):
            raise RuntimeError("down")
        return [json.dumps({"answer": p.split("Content: ")[1].split("\n")[0] if "Content: " in p else "none"})
                for p in prompts]

    table, encoder = library(spark)
    questions = spark.createDataFrame([(0, "revenue"), (1, "staff"), (2, "fail"), (3, "revenue")],
                                      "query_id bigint, query string")
    got = {r.query: r for r in ask(questions, table, encoder, 2020, generate).collect()}
    assert len(got) == 3
    assert (got["revenue"].answer, got["revenue"].position, got["revenue"].query_id) == ("revenue grew", 0, 3)
    assert got["staff"].answer == "staff of nine" and got["staff"].error is None
    assert (got["fail"].answer, got["fail"].error) == (None, "Error: down")
    empty = ask(questions.limit(1), table, encoder, 1999, generate).collect()[0]
    assert empty.answer == "none" and empty.chunks == []


@pytest.fixture(scope="module")
def filings(spark):
    long = " ".join(f"word{i % 97}" for i in range(700))
    rows = [("1", str(2018 + i % 3), f"item {i} of report", long if i % 4 == 0 else "short text", "" if i % 5 else None)
            for i in range(30)]
    rows.append((None, "2018", "nobody", "text", "x"))
    return spark.createDataFrame(rows, "cik string, year string, section_1 string, section_1A string, section_7 string")


def test_document_map(filings):
    points, models = document_map(filings, encoder=HashingEncoder(32))
    assert points.count() == 30 + 8 * 2 + 22
    assert len(models.kmeans.clusterCenters()) == 5
    few, _ = document_map(filings, max_filings=10, encoder=HashingEncoder(32), n_clusters=2)
    assert few.select("year").distinct().count() == 1
    named = filings.selectExpr("row_number() over (order by section_1) as filing", "*")
    traced, _ = document_map(named, encoder=HashingEncoder(32))
    assert traced.select("filing", "section", "chunk_id").distinct().count() == traced.count()
    again, _ = document_map(named.repartition(5), encoder=HashingEncoder(32))
    flags = lambda df: sorted((r.filing, r.section, r.chunk_id, r.cluster, r.is_outlier) for r in df.collect())
    assert flags(traced) == flags(again)


def test_company_ingest(spark, filings, tmp_path):
    table, encoder = company_ingest(filings, ["2018", "2019"], "1", str(tmp_path / "v"), encoder=HashingEncoder(32))
    rows = table.collect()
    assert {r.year for r in rows} == {"2018", "2019"} and all(r.embeddings.size == 32 for r in rows)
    assert {r.section_number for r in rows} == {"1", "1A", "7"}
    assert all(len(r.text) <= 512 for r in rows)
    assert sum(r.section_number == "7" and r.text == "" for r in rows) > 0
    assert max(r.chunk_number for r in rows) > 5
    assert len({r.chunk_key for r in rows}) == len(rows)


def test_two_filings_of_a_year_are_told_apart(spark, tmp_path):
    rows = [("1", "2020", "profit rose"), ("1", "2020", "profit fell"), ("1", "2020", "profit fell"),
            ("1", "2020", None), ("2", "2020", "profit rose")]
    filings = spark.createDataFrame(rows, "cik string, year string, section_1 string")
    table, encoder = company_ingest(filings, ["2020"], "1", str(tmp_path / "v"), encoder=HashingEncoder(64))
    asked = spark.createDataFrame([(7, "profit rose")], "query_id bigint, query string")
    (found,) = retrieve(encoder.transform(asked, "query", "embeddings"), table, 2, 2020).collect()
    assert [(c["rank"], c.content, round(c.distance, 6) == 0) for c in found.chunks] == [
        (1, "profit rose", True), (2, "profit fell", False)]


def test_answers_that_are_no_text_are_errors(spark):
    def generate(prompts, **_):
        return [{"a": 1} if "dict" in p else 3 if "number" in p else None if "none" in p else p for p in prompts]
    rows = spark.createDataFrame([(1, "dict"), (2, "number"), (3, "none"), (4, "text")], "i int, prompt string")
    got = {r.i: (r.answer, r.error) for r in apply_generator(rows, generate).collect()}
    assert got == {1: (None, "Error: a dict is no text"), 2: (None, "Error: a int is no text"),
                   3: (None, None), 4: ("text", None)}


def test_observed_counts_come_with_the_job(spark):
    rows, seen = observed(spark.range(10), "rows", n=F.count(F.lit(1)), top=F.max("id"))
    assert rows.where("id > 5").count() == 4
    assert seen.get == {"n": 10, "top": 9}


def test_stored_survives_and_lives_in_the_shared_folder(spark):
    table = stored(spark.range(5).withColumn("x", F.array(F.lit(1.5))))
    assert table.count() == 5 and table.inputFiles()[0].split("file://")[1].startswith(
        shared_folder(spark).removeprefix("file:"))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_clean_removes_what_was_stored(spark):
    from sheafline import session
    before = list(session._written)
    session._written.clear()
    table = stored(spark.range(3), "short")
    (path,) = session._written
    assert table.count() == 3
    session.clean(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|not exist"):
        spark.read.parquet(path).count()
    session._written.extend(before)


def test_hits_in_rows_of_bounded_size(spark):
    rows = spark.createDataFrame([(f"c{i:02d}", str(2019 + i % 2), "1", 1, f"text {i // 4} " + "revenue " * (i // 4)) for i in range(60)],
                                 "chunk_key string, year string, section_number string, chunk_number int, text string")
    table, encoder = build_vector_table(rows, HashingEncoder(64))
    questions = spark.createDataFrame([(0, "revenue"), (1, "text 3"), (2, "revenue")], "query_id bigint, query string")
    for year, best in ((2020, 1), (2020, 3), (1999, 1)):
        whole = ask(questions, table, encoder, year, lambda prompts, **_: prompts, k=60, best=best)
        parts = ask(questions, table, encoder, year, lambda prompts, **_: prompts, k=60, best=best, per_row=9)
        assert set(parts.columns) == {*whole.columns, "part"}
        got = {}
        for r in sorted(parts.collect(), key=lambda r: r.part):
            assert len(r.chunks) <= 9
            got.setdefault((r.query, r.query_id, r.position, r.answer, r.error), []).extend(r.chunks)
        assert got == {(r.query, r.query_id, r.position, r.answer, r.error): r.chunks for r in whole.collect()}
        assert parts.count() == (2 if year == 1999 else parts.select("query", "part").distinct().count())


def test_company_questions_ask_for_all_chunks(spark, tmp_path):
    from sheafline.catalog import all_queries
    spark.createDataFrame([(3 * i + 2, f"first line {i}", "src3") for i in range(300)], "doc_id long, text string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "line 7"), (2, "first"), (3, "line 7")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    got = {r.query: r.n_chunks for r in all_queries()["company_questions_json"](spark, str(tmp_path)).collect()}
    # One distinct line for each filing that has a company; section 7 is an empty text.
    n = sum((3 * i + 2) % 11 != 0 for i in range(300))
    assert got == {"line 7": n + 1, "first": n + 1}


def test_company_questions_write_less_than_their_contents(spark, tmp_path, monkeypatch):
    import random

    from sheafline import session
    from sheafline.catalog import all_queries
    from sheafline.sources import sinks
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    texts = [f"line {i}\nmore\n" + " ".join(rng.choices(words, k=150)) for i in range(90)]
    spark.createDataFrame([(i, t, "src3") for i, t in enumerate(texts)],
                          "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, f"which {words[i]}") for i in range(30)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))

    def run():
        before = session.mark()
        rows = sorted(map(tuple, all_queries()["company_questions_json"](spark, str(tmp_path)).collect()), key=str)
        size = {}
        for path in map(Path, (p.removeprefix("file:") for p in session._written[before:])):
            size[path.name.rpartition("-")[0]] = sum(f.stat().st_size for f in path.rglob("part-*"))
        ranked = [p for p in session._written[before:] if "/ranked-" in p]
        return rows, size, spark.read.parquet(ranked[0]).count()

    own = [i for i in range(90) if i % 3 == 2 and i % 11]
    rows, size, ranked = run()
    # Lines and numbers of the year's filings: a first line and a rest of each, and one second line.
    assert {r[3] for r in rows} == {2 * len(own) + 1} and len(rows) == 30
    assert size["answers-json"] < 0.7 * 30 * sum(len(texts[i]) for i in own)
    # Hits of the other years are ranked, but not stored.
    assert ranked == 30 * 3 * len(own)
    turns = []
    real = sinks.write_results_json
    monkeypatch.setattr(sinks, "write_results_json", lambda *a, **b: turns.append(a[2]) or real(*a, **b))
    monkeypatch.setattr(sinks, "TURN_BYTES", 200_000)
    assert run()[0] == rows and len(turns) > 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
