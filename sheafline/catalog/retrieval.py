"""Nearest chunks, post-filters, duplicates, contexts and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.catalog.base import query, r6, table
from sheafline.catalog.chunks import COMPANY_CHUNKS_SQL
from sheafline.catalog.filings import filings
from sheafline.catalog.maps import weights_sql
from sheafline.functions.vectors import as_array, euclidean
from sheafline.operators.answering import DEFAULT_TEMPLATE, render_prompts
from sheafline.operators.inverted import build_index, search_index
from sheafline.operators.neighbors import nearest, nearest_by_hash
from sheafline.operators.retrieval import (
    attach_chunks, digest, first_by_content, in_year, retrieve, with_context,
)
from sheafline.plans.company_ingest import company_ingest
from sheafline.session import scratch_path, stored
from sheafline.sources.sinks import (
    read_results_json, read_vector_table, result_records, write_results_json, write_vector_table,
)
from sheafline.sources.stores import PartitionedStore

# The vectors alone, and the vector table: every document with the vector of its number,
# where numbers start again after the last vector, and vectors without a document with an
# empty text. Vectors with the number of a benchmark item are the questions.
VECTORS_SQL = """
SELECT vec_id AS chunk_key, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings"""

CHUNKS_SQL = """
SELECT *, CAST(2018 + chunk_key % 3 AS VARCHAR) AS "year", 1 AS chunk_number FROM (
  SELECT coalesce(doc_id, vec_id) AS chunk_key, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e,
         coalesce(text, '') AS text, coalesce(source, 'none') AS section_number
  FROM embeddings LEFT JOIN (
    SELECT *, doc_id % (SELECT max(vec_id) + 1 FROM embeddings) AS number FROM documents) ON vec_id = number)"""

QUERIES_SQL = """
SELECT vec_id AS chunk_key, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, text
FROM embeddings JOIN benchmark ON vec_id = item_id"""


def ranked_sql(k: int, distance: str = "list_distance(q.e, c.e)", chunks: str = CHUNKS_SQL) -> str:
    return f"""
SELECT query_id, chunk_key, d, CAST("rank" AS INTEGER) AS "rank" FROM (
  SELECT query_id, chunk_key, d, row_number() OVER (PARTITION BY query_id ORDER BY d, chunk_key) AS "rank"
  FROM (SELECT q.chunk_key AS query_id, c.chunk_key, {distance} AS d
        FROM ({QUERIES_SQL}) q, ({chunks}) c))
WHERE "rank" <= {k}"""


def plain_vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_key"), F.col("embedding").alias("embeddings"))


def vector_chunks(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("embeddings"))
    last = vectors.select(F.max("vec_id")).scalar()
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", (F.col("doc_id") % (last + 1)).alias("number"))
    return vectors.join(documents, vectors.vec_id == documents.number, "left").select(
        F.coalesce("doc_id", "vec_id").alias("chunk_key"), "embeddings", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("source", F.lit("none")).alias("section_number"),
    ).select("*", (F.lit(2018) + F.col("chunk_key") % 3).cast("string").alias("year"),
             F.lit(1).alias("chunk_number"))


def vector_queries(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return items.join(plain_vectors(spark, sf_dir), F.col("query_id") == F.col("chunk_key")).select(
        "query_id", "embeddings", "query")


@query("topk_neighbors", f"""
SELECT query_id, chunk_key, round(d, 6) + 0.0 AS distance, "rank" FROM ({ranked_sql(20, chunks=VECTORS_SQL)})""")
def _topk_neighbors(spark, sf_dir):
    found = nearest(vector_queries(spark, sf_dir), plain_vectors(spark, sf_dir), 20)
    return found.withColumn("distance", r6("distance"))


@query("topk_neighbors_by_block", f"""
SELECT query_id, chunk_key, round(d, 6) + 0.0 AS distance, "rank" FROM ({ranked_sql(20, chunks=VECTORS_SQL)})""")
def _topk_neighbors_by_block(spark, sf_dir):
    """The form for query tables that are not broadcast."""
    found = nearest(vector_queries(spark, sf_dir), plain_vectors(spark, sf_dir), 20,
                    query_rows=32)
    return found.withColumn("distance", r6("distance"))


COSINE = "list_cosine_distance(q.e, c.e)"


@query("topk_cosine", f"""
SELECT query_id, chunk_key, round(d, 6) + 0.0 AS distance, "rank" FROM ({ranked_sql(20, COSINE, VECTORS_SQL)})""")
def _topk_cosine(spark, sf_dir):
    found = nearest(vector_queries(spark, sf_dir), plain_vectors(spark, sf_dir), 20, metric="cosine")
    return found.withColumn("distance", r6("distance"))


@query("ivf_neighbors", f"""
SELECT chunk_key AS query_id, 20::BIGINT AS n_found, true AS recalled, true AS pruned, true AS exact
FROM ({QUERIES_SQL})""")
def _ivf_neighbors(spark, sf_dir):
    """The inverted file finds nine tenths of the true neighbours, at their exact distances,
    and measures at most a fifth of the vectors for a query. It grew from two parts."""
    vectors, queries = plain_vectors(spark, sf_dir), vector_queries(spark, sf_dir)
    index = build_index(vectors.where("chunk_key % 3 > 0"), scratch_path(spark, "index"))
    index.add(vectors)
    found = search_index(queries, index, 20, refine=4)
    true = nearest(queries, vectors, 20).select("query_id", "chunk_key", F.col("distance").alias("d"))
    total = vectors.select(F.count("*")).scalar()
    return found.join(true, ["query_id", "chunk_key"], "left").groupBy("query_id").agg(
        F.count("*").alias("n_found"), (F.count("d") >= 18).alias("recalled"),
        (F.lit(4 * 20) <= total * 0.2).alias("pruned"),
        F.coalesce(F.bool_and(F.abs(F.col("distance") - F.col("d")) < 1e-9), F.lit(True)).alias("exact"))


@query("lsh_neighbors")
def _lsh_neighbors(spark, sf_dir):
    return nearest_by_hash(vector_queries(spark, sf_dir), plain_vectors(spark, sf_dir), 20)


@query("lsh_neighbors_counts", f"""
SELECT chunk_key AS query_id, 20::BIGINT AS n_found, 20::BIGINT AS n_distinct, 20 AS last_rank, true AS exact
FROM ({QUERIES_SQL})""")
def _lsh_neighbors_counts(spark, sf_dir):
    """Every query has its k chunks, each once, at their exact distances."""
    found = _lsh_neighbors(spark, sf_dir)
    v = plain_vectors(spark, sf_dir)
    gap = euclidean(as_array(v, "embeddings"), F.col("q"))
    measured = found.join(v, "chunk_key").join(
        v.select(F.col("chunk_key").alias("query_id"), as_array(v, "embeddings").alias("q")), "query_id")
    return measured.groupBy("query_id").agg(
        F.count("*").alias("n_found"), F.count_distinct("chunk_key").alias("n_distinct"),
        F.max("rank").alias("last_rank"), F.bool_and(F.abs(F.col("distance") - gap) < 1e-6).alias("exact"))


@query("lsh_neighbors_first", f"""
SELECT a.chunk_key AS query_id, min(b.chunk_key) AS chunk_key, 0.0::DOUBLE AS distance
FROM ({QUERIES_SQL}) a JOIN ({VECTORS_SQL}) b ON a.e = b.e GROUP BY a.chunk_key""")
def _lsh_neighbors_first(spark, sf_dir):
    """Equal vectors share every bucket, so each vector finds itself or its first copy."""
    return _lsh_neighbors(spark, sf_dir).where("rank = 1").select("query_id", "chunk_key", "distance")


@query("topk_postfilter", f"""
SELECT query_id, chunk_key, "rank", "year" FROM ({ranked_sql(200)}) JOIN ({CHUNKS_SQL}) USING (chunk_key)
WHERE "year" = '2020'""")
def _topk_postfilter(spark, sf_dir):
    chunks = vector_chunks(spark, sf_dir)
    ranked = stored(nearest(vector_queries(spark, sf_dir), chunks, 200), "ranked")
    hits = in_year(attach_chunks(ranked, chunks.select("chunk_key", "year")), 2020)
    return hits.select("query_id", "chunk_key", "rank", "year")


@query("topk_within_scope", f"""
SELECT query_id, "year", section_number, chunk_key, CAST("rank" AS INTEGER) AS "rank" FROM (
  SELECT q.chunk_key AS query_id, c."year", c.section_number, c.chunk_key, row_number() OVER (
           PARTITION BY q.chunk_key ORDER BY list_distance(q.e, c.e), c.chunk_key) AS "rank"
  FROM ({QUERIES_SQL}) q JOIN ({CHUNKS_SQL}) c
    ON c."year" = CAST(2018 + q.chunk_key % 2 * 2 AS VARCHAR) AND c.section_number = 'src' || q.chunk_key % 4)
WHERE "rank" <= 10""")
def _topk_within_scope(spark, sf_dir):
    """Every question against the chunks of its own year and source, in one job, from a
    table with a directory for each."""
    store = PartitionedStore(spark, scratch_path(spark, "scoped"), ("year", "section_number"))
    store.add(vector_chunks(spark, sf_dir), "chunk_key")
    scope = ["year", "section_number"]
    questions = vector_queries(spark, sf_dir).withColumn(
        "year", (F.lit(2018) + F.col("query_id") % 2 * 2).cast("string")).withColumn(
        "section_number", F.concat(F.lit("src"), (F.col("query_id") % 4).cast("string")))
    found = nearest(questions, store.read(), 10, within=scope)
    return found.join(questions.select("query_id", *scope), "query_id").select(
        "query_id", *scope, "chunk_key", "rank")


@query("dedupe_by_content", """
SELECT lang, doc_id, source, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS n FROM documents)
WHERE n = 1""")
def _dedupe_by_content(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "lang", "doc_id", "source", F.md5("text").alias("text_md5"), digest(F.col("text")).alias("same"))
    return first_by_content(documents, ["lang"], F.col("same"), ["doc_id"]).drop("same")


HITS_SQL = f"""
SELECT query_id, "rank", chunk_key, d, text, "year", section_number, chunk_number FROM (
  SELECT r.*, c.text, c."year", c.section_number, c.chunk_number,
         row_number() OVER (PARTITION BY query_id, c.text ORDER BY "rank") AS n
  FROM ({ranked_sql(200)}) r JOIN ({CHUNKS_SQL}) c USING (chunk_key) WHERE c."year" = '2020')
WHERE n = 1"""


def retrieved_chunks(spark, sf_dir):
    return retrieve(vector_queries(spark, sf_dir), vector_chunks(spark, sf_dir), 200, 2020)


@query("chunks_per_query", f"""
SELECT q.chunk_key AS query_id, CAST(count(h.chunk_key) AS INTEGER) AS n_chunks,
       coalesce(string_agg(CAST(h.chunk_key AS VARCHAR), ',' ORDER BY h."rank"), '') AS chunk_keys
FROM ({QUERIES_SQL}) q LEFT JOIN ({HITS_SQL}) h ON h.query_id = q.chunk_key GROUP BY q.chunk_key""")
def _chunks_per_query(spark, sf_dir):
    keys = F.array_join(F.transform("chunks", lambda c: c["chunk_key"].cast("string")), ",")
    return retrieved_chunks(spark, sf_dir).select(
        "query_id", F.size("chunks").alias("n_chunks"), keys.alias("chunk_keys"))


def context_sql(best: int) -> str:
    return f"""
SELECT q.chunk_key AS query_id, q.text AS query, coalesce(string_agg(
         'Chunk Metadata: ' || to_json({{'year': h."year", 'section_number': h.section_number,
                                         'chunk_number': h.chunk_number}})
         || ' ' || chr(10) || 'Content: ' || h.text, chr(10) ORDER BY h."rank"), '') AS context
FROM ({QUERIES_SQL}) q LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY "rank") AS m FROM ({HITS_SQL}))
  WHERE m <= {best}) h ON h.query_id = q.chunk_key
GROUP BY q.chunk_key, q.text"""


@query("context_text", f"""
SELECT query_id, context FROM ({context_sql(1)})""")
def _context_text(spark, sf_dir):
    return with_context(retrieved_chunks(spark, sf_dir)).select("query_id", "context")


@query("context_text_best3", f"""
SELECT query_id, md5(context) AS context_md5, length(context) AS n_chars FROM ({context_sql(3)})""")
def _context_text_best3(spark, sf_dir):
    return with_context(retrieved_chunks(spark, sf_dir), 3).select(
        "query_id", F.md5("context").alias("context_md5"),
        F.char_length("context").cast("long").alias("n_chars"))


def template_sql(**fields: str) -> str:
    """The default template as one SQL expression."""
    mark = "\x00"
    filled = DEFAULT_TEMPLATE.format(**{n: f"{mark}{n}{mark}" for n in fields})
    parts = []
    for i, part in enumerate(filled.split(mark)):
        parts.append(fields[part] if i % 2 else "'" + part.replace("'", "''") + "'")
    return " || ".join(parts)


@query("prompt_text", f"""
SELECT query_id, md5(prompt) AS prompt_md5, length(prompt) AS n_chars
FROM (SELECT query_id, {template_sql(year="'2020'", query="query", context="context")} AS prompt
      FROM ({context_sql(1)}))""")
def _prompt_text(spark, sf_dir):
    prompts = render_prompts(with_context(retrieved_chunks(spark, sf_dir)), 2020)
    return prompts.select("query_id", F.md5("prompt").alias("prompt_md5"),
                          F.char_length("prompt").cast("long").alias("n_chars"))


@query("vector_table_roundtrip", f"""
SELECT chunk_key, "year", section_number, chunk_number, md5(text) AS text_md5,
       round(list_sum(e), 6) + 0.0 AS vector_sum FROM ({CHUNKS_SQL})""")
def _vector_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "vector-table")
    write_vector_table(vector_chunks(spark, sf_dir), path)
    total = F.aggregate(F.col("embeddings").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return read_vector_table(spark, path).select(
        "chunk_key", "year", "section_number", "chunk_number", F.md5("text").alias("text_md5"),
        r6(total).alias("vector_sum"))


@query("json_results_roundtrip", f"""
SELECT CAST(q.chunk_key AS VARCHAR) AS query, 'answer "' || q.chunk_key || '"' AS answer,
       CAST(count(h.chunk_key) AS INTEGER) AS n_chunks,
       md5(coalesce(string_agg(h.text, '|' ORDER BY h."rank"), '')) AS contents_md5,
       coalesce(string_agg(h."year" || h.section_number || h.chunk_number, '|' ORDER BY h."rank"), '') AS metadata,
       round(coalesce(sum(h.d), 0), 6) + 0.0 AS scores
FROM ({QUERIES_SQL}) q LEFT JOIN ({HITS_SQL}) h ON h.query_id = q.chunk_key GROUP BY q.chunk_key""")
def _json_results_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "results-json")
    results = retrieved_chunks(spark, sf_dir).select(
        F.col("query_id").cast("string").alias("query"),
        F.concat(F.lit('answer "'), F.col("query_id").cast("string"), F.lit('"')).alias("answer"), "chunks")
    write_results_json(result_records(results, with_score=True), path)
    metadata = F.transform("chunks", lambda c: F.concat(
        c["metadata"]["year"], c["metadata"]["section_number"], c["metadata"]["chunk_number"].cast("string")))
    return read_results_json(spark, path).select(
        "query", "answer", F.size("chunks").alias("n_chunks"),
        F.md5(F.array_join(F.transform("chunks", lambda c: c["content"]), "|")).alias("contents_md5"),
        F.array_join(metadata, "|").alias("metadata"),
        r6(F.aggregate("chunks", F.lit(0.0), lambda a, c: a + c["score"])).alias("scores"))


@query("vector_table_grown", f"""
SELECT chunk_key, "year", section_number, chunk_number, md5(text) AS text_md5,
       round(list_sum(e), 6) + 0.0 AS vector_sum FROM ({CHUNKS_SQL})""")
def _vector_table_grown(spark, sf_dir):
    """Chunks added in three parts that overlap, and one of them twice."""
    store = PartitionedStore(spark, scratch_path(spark, "vector-table"))
    chunks = vector_chunks(spark, sf_dir)
    for part in ("chunk_key % 4 <> 1", "year <> '2019'", "year = '2019'", "year = '2019'"):
        only = F.col("year") == "2019" if part.startswith("year =") else None
        store.add(chunks.where(part), "chunk_key", only)
    total = F.aggregate(F.col("embeddings").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return store.read().select(
        "chunk_key", "year", "section_number", "chunk_number", F.md5("text").alias("text_md5"),
        r6(total).alias("vector_sum"))


COMPANY_VECTORS_SQL = weights_sql(COMPANY_CHUNKS_SQL, "chunk_key", "text", 256)


@query("company_ingest_grown", f"""
SELECT chunk_key, doc_id, "year", section_number, chunk_number, md5(text) AS text_md5,
       round(coalesce(total, 0), 4) + 0.0 AS vector_sum
FROM ({COMPANY_CHUNKS_SQL}) LEFT JOIN (
  SELECT chunk_key, sum(w) AS total FROM ({COMPANY_VECTORS_SQL}) GROUP BY chunk_key) USING (chunk_key)""")
def _company_ingest_grown(spark, sf_dir):
    """One year after another into the same table, the second one twice."""
    path = scratch_path(spark, "company")
    for year in ("2018", "2019", "2020", "2019"):
        grown, _ = company_ingest(filings(spark, sf_dir, heavy=True), [year], "src3", path, filing_id="doc_id")
    vector = as_array(grown, "embeddings")
    return grown.select(
        "chunk_key", "doc_id", "year", "section_number", "chunk_number", F.md5("text").alias("text_md5"),
        (F.round(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x), 4) + F.lit(0.0)).alias("vector_sum"))


@query("company_ingest", f"""
SELECT doc_id, "year", section_number, chunk_number, chunk_key, text, 256 AS n_dimensions,
       CASE WHEN trim(text, chr(10) || ' ') = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS norm
FROM ({COMPANY_CHUNKS_SQL})""")
def _company_ingest(spark, sf_dir):
    path = scratch_path(spark, "company")
    stored_table, _ = company_ingest(filings(spark, sf_dir, heavy=True), ["2018", "2019", "2020"], "src3", path,
                                     filing_id="doc_id")
    vector = as_array(stored_table, "embeddings")
    return stored_table.select(
        "doc_id", "year", "section_number", "chunk_number", "chunk_key", "text",
        F.size(vector).alias("n_dimensions"),
        r6(F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))).alias("norm"))
