"""Questions with their own company and year, and models that workers keep."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafline.operators import neighbors
from sheafline.operators.answering import apply_generator
from sheafline.operators.encode import HashingEncoder
from sheafline.operators.neighbors import nearest
from sheafline.operators.retrieval import build_vector_table
from sheafline.plans.batch_qa import ask
from sheafline.sources.stores import PartitionedStore

RNG = np.random.default_rng(17)
SCOPE = ["company", "year"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    chunks = [(f"k{i:03d}", f"c{i % 3}" if i % 17 else None, str(2018 + i % 4), [float(x) for x in RNG.normal(size=5)])
              for i in range(200)]
    queries = [(i, f"c{i % 4}" if i % 7 else None, str(2018 + i % 2), [float(x) for x in RNG.normal(size=5)])
               for i in range(24)]
    store = PartitionedStore(spark, str(tmp_path_factory.mktemp("scoped") / "t"), SCOPE)
    columns = "company string, year string, embeddings array<double>"
    store.add(spark.createDataFrame(chunks, f"chunk_key string, {columns}"), "chunk_key")
    expected = set()
    for q, company, year, v in queries:
        own = sorted((float(np.linalg.norm(np.subtract(w, v))), key) for key, c, y, w in chunks
                     if c is not None and (c, y) == (company, year))
        expected |= {(q, key, rank) for rank, (_, key) in enumerate(own[:4], 1)}
    return spark.createDataFrame(queries, f"query_id int, {columns}"), store, expected


@pytest.mark.parametrize("query_rows", [None, 5])
def test_each_query_meets_its_own_scope(tables, query_rows):
    queries, store, expected = tables
    found = nearest(queries, store.read(), 4, within=SCOPE, query_rows=query_rows)
    assert {(r.query_id, r.chunk_key, r["rank"]) for r in found.collect()} == expected
    assert len(expected) > 40


def test_the_scan_is_pruned_by_the_questions(spark, tables, monkeypatch):
    queries, store, _ = tables
    made = []
    real = neighbors.keep_best
    monkeypatch.setattr(neighbors, "keep_best", lambda found, *rest: made.append(found) or real(found, *rest))
    nearest(queries.where("year = '2018'"), store.read(), 4, within=SCOPE)
    made[0].collect()
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SubqueryBroadcast dynamicpruning") == 2


def test_one_batch_of_several_years(spark):
    rows = [(f"{c}{y}{i}", c, y, "1", 1, f"{c} earned {n} in {y}") for c in "ab" for y in ("2019", "2020")
            for i, n in enumerate(("ten", "nine"))]
    chunks = spark.createDataFrame(rows, "chunk_key string, cik string, year string, section_number string, chunk_number int, text string")
    table, encoder = build_vector_table(chunks, HashingEncoder(128))
    asked = [(0, "earned ten", "a", "2019"), (1, "earned ten", "b", "2020"), (2, "earned nine", "a", "2020"),
             (3, "earned ten", "a", "2019"), (4, "earned ten", "a", "1999"), (5, "earned ten", None, "2019")]
    questions = spark.createDataFrame(asked, "query_id bigint, query string, cik string, year string")

    def load():
        return lambda prompts, **_: [p.split("Content: ")[1].split("\n")[0] if "Content: " in p else "none of " + p.split("reports of ")[1][:4]
                                     for p in prompts]

    got = {r.query_id: (r.answer, r.position, r.year, len(r.chunks)) for r in ask(
        questions, table, encoder, load=load, within=["cik", "year"], k=1).collect()}
    assert got == {3: ("a earned ten in 2019", 0, "2019", 1), 1: ("b earned ten in 2020", 1, "2020", 1),
                   2: ("a earned nine in 2020", 2, "2020", 1), 4: ("none of 1999", 4, "1999", 0), 5: ("none of 2019", 5, "2019", 0)}
    for wrong in ({}, {"within": ["cik"], "year": 2019}):
        with pytest.raises(ValueError):
            ask(questions, table, encoder, load=load, **wrong)


def test_a_model_is_loaded_once_per_worker(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        import os
        loads.add(1)
        return lambda prompts, **_: [f"{os.getpid()}" for _ in prompts]

    rows = spark.range(400).select("id", F.concat(F.lit("p"), F.col("id")).alias("prompt")).repartition(40)
    workers = {r.answer for r in apply_generator(rows, load=load, batch_size=2).collect()}
    assert 1 <= loads.value <= max(len(workers), spark.sparkContext.defaultParallelism) < 40
    with pytest.raises(ValueError):
        apply_generator(rows)
