"""Token counts, chunk plans and both chunkers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.catalog.base import documents_table, query, r6
from sheafline.catalog.filings import FILINGS_SQL, SECTIONS_SQL, filings
from sheafline.functions.text import section_name, token_count
from sheafline.operators.chunk_plan import (
    attach_plan, chunk_plan, merged_token_stats, section_token_state, section_token_stats,
)
from sheafline.operators.metrics import count_by, observed
from sheafline.operators.recursive import (
    chunk_records, recursive_chunks, split_sections, with_recursive_chunks,
)
from sheafline.operators.sections import unpivot_sections
from sheafline.operators.word_windows import word_chunks
from sheafline.plans.company_ingest import company_chunks, plan_and_split
from sheafline.session import scratch_path
from sheafline.sources.filings import sections_view
from sheafline.sources.stores import PartitionedStore

WORDS_SQL = r"list_filter(string_split_regex({text}, '\s+'), lambda w: w <> '')"

VIEW_SQL = """
SELECT doc_id, CAST(2018 + doc_id % 3 AS VARCHAR) AS "year", source AS section_number,
       text AS section_text FROM documents"""


def word_chunks_sql(rows: str, ids: str, text: str, limit: int = 512, overlap: int = 51) -> str:
    return f"""
SELECT {ids}, CAST(c.i AS INTEGER) AS chunk_id, c.t AS chunk_text
FROM (
  SELECT {ids}, unnest(
    CASE WHEN len(w) <= {limit} THEN [{{'i': 0, 't': txt}}]
    ELSE list_transform(range(0, len(w), {limit - overlap}),
         lambda s: {{'i': s // {limit - overlap}, 't': array_to_string(w[s + 1 : s + {limit}], ' ')}}) END) AS c
  FROM (SELECT {ids}, {text} AS txt, {WORDS_SQL.format(text=text)} AS w FROM ({rows})))
"""


STATS_SQL = f"""
SELECT section_number, CAST(max(n) AS INTEGER) AS max_tokens, avg(n) AS mean_tokens,
       coalesce(stddev_samp(n), 0) AS std_dev_tokens
FROM (SELECT section_number, len({WORDS_SQL.format(text='section_text')}) AS n FROM ({VIEW_SQL}))
GROUP BY section_number"""


def plan_sql(stats: str, limit: int) -> str:
    step = repr(limit * (1 - 0.1))
    return f"""
SELECT section_number, max_tokens, round(mean_tokens, 6) AS mean_tokens,
       round(std_dev_tokens, 6) AS std_dev_tokens,
       max_tokens > {limit} AS requires_chunking,
       CASE WHEN max_tokens > {limit} THEN {limit} END AS suggested_chunk_size,
       CASE WHEN max_tokens > {limit} THEN {int(limit * 0.1)} END AS overlap,
       CASE WHEN max_tokens > {limit} THEN
         round((CAST(max_tokens AS DOUBLE) - CAST(max_tokens AS DOUBLE) % CAST({step} AS DOUBLE))
               / CAST({step} AS DOUBLE)) + 1 END AS chunks_needed
FROM ({stats})"""


def recursive_sql(rows: str, size: int, overlap: int) -> str:
    """Chunks of ``rows`` (rid, txt), derived differently from the Spark fold: the
    pieces get offsets within their run, and each step of the recursion finds the
    whole next chunk from the offsets."""
    def parts(source: str, parents: str, index: str, sep: str, run: str) -> str:
        return f"""
  SELECT rid, {parents}, {index}, run, p AS t FROM (
    SELECT rid, {parents}, run, unnest(ps) AS p, generate_subscripts(ps, 1) AS {index}
    FROM (SELECT *, {run} AS run, list_transform(string_split(t, {sep}),
            lambda s, i: CASE WHEN i > 1 THEN {sep} || s ELSE s END) AS ps FROM ({source})))
  WHERE p <> ''"""
    blocks = f"""
  SELECT rid, i1, 'r' AS run, p AS t FROM (
    SELECT rid, unnest(ps) AS p, generate_subscripts(ps, 1) AS i1
    FROM (SELECT rid, list_transform(string_split(txt, chr(10) || chr(10)),
            lambda s, i: CASE WHEN i > 1 THEN chr(10) || chr(10) || s ELSE s END) AS ps FROM ({rows})))
  WHERE p <> ''"""
    lines = parts(f"SELECT rid, i1, t FROM blocks WHERE length(t) > {size}", "i1", "i2", "chr(10)", "'b' || i1")
    tokens = parts(f"SELECT rid, i1, i2, t FROM lines WHERE length(t) > {size}", "i1, i2", "i3", "' '",
                   "'l' || i1 || '.' || i2")
    step = size - overlap
    return f"""
WITH RECURSIVE blocks AS ({blocks}),
lines AS ({lines}),
tokens AS ({tokens}),
slices AS (
  SELECT rid, i1, i2, i3, j AS i4, 's' || i1 || '.' || i2 || '.' || i3 || '.' || j AS run,
         substr(t, j * {step} + 1, {size}) AS t
  FROM (SELECT *, unnest(range(0, CAST(ceil((length(t) - {overlap}) / {step}.0) AS BIGINT))) AS j
        FROM tokens WHERE length(t) > {size})),
pieces AS (
  SELECT rid, i1, 0 AS i2, 0 AS i3, 0 AS i4, run, t FROM blocks WHERE length(t) <= {size}
  UNION ALL SELECT rid, i1, i2, 0, 0, run, t FROM lines WHERE length(t) <= {size}
  UNION ALL SELECT rid, i1, i2, i3, 0, run, t FROM tokens WHERE length(t) <= {size}
  UNION ALL SELECT rid, i1, i2, i3, i4, run, t FROM slices),
marked AS (
  SELECT *, CASE WHEN lag(run) OVER w IS DISTINCT FROM run THEN 1 ELSE 0 END AS fresh
  FROM pieces WINDOW w AS (PARTITION BY rid ORDER BY i1, i2, i3, i4)),
numbered AS (
  SELECT rid, t, sum(fresh) OVER w AS run_no, row_number() OVER w AS n
  FROM marked WINDOW w AS (PARTITION BY rid ORDER BY i1, i2, i3, i4)),
placed AS (
  SELECT *, sum(length(t)) OVER (PARTITION BY rid, run_no ORDER BY n) AS till FROM numbered),
runs AS (
  SELECT rid, run_no, list(t ORDER BY n) AS ts, list(till ORDER BY n) AS tills,
         list(till - length(t) ORDER BY n) AS froms
  FROM placed GROUP BY rid, run_no),
walk AS (
  SELECT rid, run_no, 1 AS a, len(list_filter(tills, lambda x: x <= {size})) AS b FROM runs
  UNION ALL
  SELECT rid, run_no, a, len(list_filter(tills, lambda x: x <= froms[a] + {size})) AS b FROM (
    SELECT r.*, 1 + len(list_filter(r.froms,
        lambda x: x < greatest(r.tills[w.b] - {overlap}, r.tills[w.b + 1] - {size}))) AS a
    FROM walk w JOIN runs r ON w.rid = r.rid AND w.run_no = r.run_no
    WHERE w.b < len(r.tills))),
cut AS (
  SELECT w.rid, w.run_no, w.a, trim(array_to_string(r.ts[w.a : w.b], ''), chr(10) || ' ') AS t
  FROM walk w JOIN runs r ON w.rid = r.rid AND w.run_no = r.run_no)
SELECT rid, CAST(row_number() OVER (PARTITION BY rid ORDER BY run_no, a) AS INTEGER) AS chunk_number, t
FROM cut WHERE t <> ''"""


@query("token_counts", f"""
SELECT doc_id, CAST(len({WORDS_SQL.format(text='text')}) AS INTEGER) AS token_count FROM documents""")
def _token_counts(spark, sf_dir):
    return documents_table(spark, sf_dir).select("doc_id", token_count(F.col("text")).alias("token_count"))


@query("section_token_stats", f"""
SELECT section_number, max_tokens, round(mean_tokens, 6) AS mean_tokens,
       round(std_dev_tokens, 6) AS std_dev_tokens FROM ({STATS_SQL})""")
def _section_token_stats(spark, sf_dir):
    stats = section_token_stats(sections_view(documents_table(spark, sf_dir)))
    return stats.withColumns({c: r6(c) for c in ("mean_tokens", "std_dev_tokens")})


def _plan(spark, sf_dir, limit):
    return chunk_plan(section_token_stats(sections_view(documents_table(spark, sf_dir))), limit)


@query("chunk_plan_merged", plan_sql(STATS_SQL, 4000))
def _chunk_plan_merged(spark, sf_dir):
    """The plan from stored states: one year after another, the second one twice."""
    sections = sections_view(documents_table(spark, sf_dir))
    store = PartitionedStore(spark, scratch_path(spark, "token-state"))
    for year in ("2018", "2019", "2020", "2019"):
        store.replace(section_token_state(sections.where(F.col("year") == year)))
    return chunk_plan(merged_token_stats(store.read()), 4000).withColumns(
        {c: r6(c) for c in ("mean_tokens", "std_dev_tokens")})


@query("chunk_plan", plan_sql(STATS_SQL, 4000))
def _chunk_plan(spark, sf_dir):
    return _plan(spark, sf_dir, 4000).withColumns({c: r6(c) for c in ("mean_tokens", "std_dev_tokens")})


@query("chunk_plan_join", f"""
SELECT doc_id, 'section_' || section_number AS section, requires_chunking, suggested_chunk_size, overlap
FROM ({VIEW_SQL}) LEFT JOIN ({plan_sql(STATS_SQL, 4000)}) USING (section_number)""")
def _chunk_plan_join(spark, sf_dir):
    sections = sections_view(documents_table(spark, sf_dir))
    planned = attach_plan(sections, _plan(spark, sf_dir, 4000))
    return planned.select("doc_id", section_name(F.col("section_number")).alias("section"),
                          "requires_chunking", "suggested_chunk_size", "overlap")


@query("word_chunks", word_chunks_sql("SELECT * FROM documents", "doc_id", "text"))
def _word_chunks(spark, sf_dir):
    return word_chunks(documents_table(spark, sf_dir).select("doc_id", "text"), "text")


SECTION_CHUNKS_SQL = word_chunks_sql(
    f"SELECT * FROM ({SECTIONS_SQL}) WHERE section_text <> ''",
    'doc_id, cik, "year", section', "section_text")


@query("section_word_chunks", SECTION_CHUNKS_SQL)
def _section_word_chunks(spark, sf_dir):
    return word_chunks(unpivot_sections(filings(spark, sf_dir, heavy=True), ("doc_id", "cik", "year")))


@query("chunks_per_section", f"""
SELECT section, count(*) AS n_chunks FROM ({SECTION_CHUNKS_SQL}) GROUP BY section""")
def _chunks_per_section(spark, sf_dir):
    return count_by(_section_word_chunks(spark, sf_dir), ["section"], "n_chunks")


@query("run_metrics", f"""
SELECT (SELECT count(*) FROM ({SECTIONS_SQL}) WHERE section_text <> '') AS n_sections,
       count(*) AS n_chunks, CAST(sum(length(chunk_text)) AS BIGINT) AS n_chars FROM ({SECTION_CHUNKS_SQL})""")
def _run_metrics(spark, sf_dir):
    sections, seen = observed(unpivot_sections(filings(spark, sf_dir, heavy=True), ("doc_id", "cik", "year")),
                              "sections", n_sections=F.count(F.lit(1)))
    chunks, made = observed(word_chunks(sections), "chunks", n_chunks=F.count(F.lit(1)),
                            n_chars=F.sum(F.char_length("chunk_text")))
    chunks.write.format("noop").mode("overwrite").save()
    counts = {**seen.get, **made.get}
    return spark.createDataFrame([(counts["n_sections"], counts["n_chunks"], counts["n_chars"])],
                                 "n_sections long, n_chunks long, n_chars long")


DOC_TEXTS = "SELECT doc_id AS rid, text AS txt FROM documents"


@query("recursive_chunks", f"""
SELECT rid AS doc_id, chunk_number, t AS text FROM ({recursive_sql(DOC_TEXTS, 512, 51)})""")
def _recursive_chunks(spark, sf_dir):
    documents = documents_table(spark, sf_dir).select("doc_id", "text")
    return recursive_chunks(documents, "text", 512, 51)


@query("recursive_chunks_lossless", """
SELECT doc_id, md5(text) AS text_md5, length(text) AS n_chars FROM documents""")
def _recursive_chunks_lossless(spark, sf_dir):
    """Without overlap and trimming the chunks are the text."""
    documents = documents_table(spark, sf_dir).select("doc_id", "text")
    again = F.array_join("chunks", "")
    return with_recursive_chunks(documents, "text", 512, 0, trim=False).select(
        "doc_id", F.md5(again).alias("text_md5"), F.char_length(again).cast("long").alias("n_chars"))


@query("planned_chunks", f"""
WITH flagged AS (SELECT section_number FROM ({STATS_SQL}) WHERE max_tokens > 4000)
SELECT doc_id, "year", section_number, 1 AS chunk_number, section_text AS text
FROM ({VIEW_SQL}) WHERE section_number NOT IN (SELECT section_number FROM flagged)
UNION ALL
SELECT doc_id, "year", section_number, chunk_number, t
FROM ({VIEW_SQL}) JOIN ({recursive_sql(DOC_TEXTS, 4000, 400)}) ON rid = doc_id
WHERE section_number IN (SELECT section_number FROM flagged)""")
def _planned_chunks(spark, sf_dir):
    return plan_and_split(sections_view(documents_table(spark, sf_dir)), 4000,
                          ids=("doc_id", "year", "section_number"))


COMPANY_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, "year", replace(section, 'section_', '') AS section_number, section_text AS txt,
       doc_id || '/' || section AS rid
FROM ({SECTIONS_SQL}) WHERE cik = 'src3' AND "year" IN ('2018', '2019', '2020')"""

COMPANY_CHUNKS_SQL = f"""
WITH flagged AS (
  SELECT section_number FROM ({COMPANY_SQL}) GROUP BY section_number
  HAVING max(len({WORDS_SQL.format(text='txt')})) > 512),
chunked AS (
  SELECT doc_id, "year", section_number, 1 AS chunk_number, txt AS text
  FROM ({COMPANY_SQL}) WHERE section_number NOT IN (SELECT section_number FROM flagged)
  UNION ALL
  SELECT doc_id, "year", section_number, chunk_number, t
  FROM ({COMPANY_SQL}) s JOIN ({recursive_sql(f'SELECT rid, txt FROM ({COMPANY_SQL})', 512, 51)}) c
    ON c.rid = s.rid
  WHERE section_number IN (SELECT section_number FROM flagged))
SELECT CAST(doc_id AS BIGINT) AS doc_id, "year", section_number, chunk_number, text,
       CAST(to_json([doc_id, "year", section_number, CAST(chunk_number AS VARCHAR)]) AS VARCHAR) AS chunk_key
FROM chunked"""


@query("company_chunks", COMPANY_CHUNKS_SQL)
def _company_chunks(spark, sf_dir):
    return company_chunks(filings(spark, sf_dir, heavy=True), ["2018", "2019", "2020"], "src3", filing_id="doc_id")


# Of filings that are equal in company, year and all sections one is left, named by them.
FILING_SQL = f"""
SELECT filing, any_value(cik) AS cik, any_value("year") AS "year", any_value(section_1) AS section_1,
       any_value(section_1A) AS section_1A, any_value(section_7) AS section_7
FROM (SELECT *, md5(concat_ws('|', {', '.join(f"coalesce(md5({c}), '-')" for c in (
    'cik', '"year"', 'section_1', 'section_1A', 'section_7'))})) AS filing
      FROM ({FILINGS_SQL}) WHERE cik = 'src3' AND "year" IN ('2018', '2019', '2020')) GROUP BY filing"""

FILING_CHUNKS_SQL = COMPANY_CHUNKS_SQL.replace(COMPANY_SQL, f"""
SELECT filing AS doc_id, "year", replace(section, 'section_', '') AS section_number,
       section_text AS txt, filing || '/' || section AS rid
FROM (SELECT filing, "year", unnest(['section_1', 'section_1A', 'section_7']) AS section,
             unnest([section_1, section_1A, section_7]) AS section_text FROM ({FILING_SQL}))
WHERE section_text IS NOT NULL""").replace("CAST(doc_id AS BIGINT) AS doc_id", "doc_id AS filing")


@query("company_chunks_by_content", FILING_CHUNKS_SQL)
def _company_chunks_by_content(spark, sf_dir):
    """Filings of a company and year told apart by what they say."""
    return company_chunks(filings(spark, sf_dir, heavy=True), ["2018", "2019", "2020"], "src3")


@query("chunks_of_two_limits", f"""
SELECT doc_id, section_number, chunk_number, text FROM (
  SELECT rid AS doc_id, 'short' AS section_number, chunk_number, t AS text
  FROM ({recursive_sql("SELECT doc_id AS rid, text AS txt FROM documents WHERE doc_id % 2 = 0", 300, 30)})
  UNION ALL
  SELECT rid, 'long', chunk_number, t
  FROM ({recursive_sql("SELECT doc_id AS rid, text AS txt FROM documents WHERE doc_id % 2 = 1", 900, 45)}))""")
def _chunks_of_two_limits(spark, sf_dir):
    """A plan with a size and an overlap for each group of sections."""
    name = F.when(F.col("doc_id") % 2 == 0, "short").otherwise("long")
    sections = documents_table(spark, sf_dir).select(
        "doc_id", name.alias("section_number"), F.col("text").alias("section_text"))
    plan = spark.createDataFrame(
        [("short", True, 300, 30), ("long", True, 900, 45)],
        "section_number string, requires_chunking boolean, suggested_chunk_size int, overlap int")
    return split_sections(attach_plan(sections, plan, max_sections=2), ids=("doc_id", "section_number"))


@query("chunk_metadata_struct", f"""
SELECT to_json({{'year': "year", 'section_number': section_number, 'chunk_number': chunk_number}}) ::VARCHAR AS metadata,
       "year", section_number, chunk_number, md5(t) AS text_md5
FROM ({VIEW_SQL}) JOIN ({recursive_sql(DOC_TEXTS, 512, 51)}) ON rid = doc_id""")
def _chunk_metadata_struct(spark, sf_dir):
    sections = sections_view(documents_table(spark, sf_dir))
    return chunk_records(recursive_chunks(sections)).select(
        F.to_json("metadata").alias("metadata"), F.col("metadata.year").alias("year"),
        F.col("metadata.section_number").alias("section_number"),
        F.col("metadata.chunk_number").alias("chunk_number"), F.md5("text").alias("text_md5"))
