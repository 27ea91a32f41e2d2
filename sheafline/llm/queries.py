"""Every operator of this package as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm.decontaminate import contamination
from sheafline.llm.divergence import source_divergence
from sheafline.llm.language import fit_languages, identify
from sheafline.llm.lines import without_repeated_lines
from sheafline.llm.minhash import near_duplicates
from sheafline.llm.mixing import mix
from sheafline.llm.neighbour_graph import nearest
from sheafline.llm.quality import fit_quality, score_quality
from sheafline.llm.sampling import per_label, remainder
from sheafline.llm.substrings import without_repeats
from sheafline.llm.suffixes import without_repeated_bytes
from sheafline.llm.toxicity import fit_toxicity, score_toxicity
from sheafline.llm.warc import captures, read_archives, write_archives
from sheafline.llm.whitening import whitened
from sheafline.session import scratch_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op9_minhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies over shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


_WORDS4 = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op4_benchmark_decontamination", f"""
WITH items AS (
  SELECT item_id, coalesce({_WORDS4.format('text')}, []) AS w FROM benchmark),
windows AS (
  SELECT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)),
docs AS (
  SELECT doc_id, coalesce({_WORDS4.format('text')}, []) AS w FROM documents),
starts AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM docs, (SELECT DISTINCT size FROM windows)),
hits AS (
  SELECT s.doc_id, s.i, s.size, x.item_id
  FROM starts s JOIN windows x
    ON x.size = s.size AND x.win = array_to_string(s.w[s.i:s.i + s.size - 1], ' ')),
n_hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
n_items AS (
  SELECT doc_id, count(*) AS n_items,
         string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN n_hits USING (doc_id) LEFT JOIN n_items USING (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of ten words of benchmark items."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside windows of 35 words that occur elsewhere too."""
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them. A row without
    doc_id is held out."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(True)).alias("held_out"))
    model = fit_languages(docs.where("not held_out"))
    return identify(docs, model, ["doc_id", "held_out"])


#: Labelled ids that are sent to all tasks to find the texts of a sample.
LABEL_IDS = 8000


def _labelled(spark: SparkSession, sf_dir: str, label: str, divisor: int, held: int) -> DataFrame:
    """Texts with their label of a bounded sample of the documents that may teach. The ids
    are drawn before the join, so the texts stay where they are."""
    labels = table(spark, sf_dir, "labels").select("doc_id", label).where(
        F.col(label).isNotNull() & (remainder("doc_id", divisor) != held))
    chosen = stored(per_label(labels, label, "doc_id", LABEL_IDS), "labels")
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(
        F.broadcast(chosen), "doc_id")


def _held_out(spark: SparkSession, sf_dir: str, divisor: int, held: int) -> DataFrame:
    """Every document, and whether it teaches nothing; one without doc_id does not."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text",
        F.coalesce(remainder("doc_id", divisor) == held, F.lit(True)).alias("held_out"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labels."""
    model = fit_toxicity(_labelled(spark, sf_dir, "toxic", 3, 1))
    return score_toxicity(_held_out(spark, sf_dir, 3, 1), model, ["doc_id", "held_out"]).select(
        "*", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four fifths of the labels."""
    model = fit_quality(_labelled(spark, sf_dir, "quality", 5, 0))
    return score_quality(_held_out(spark, sf_dir, 5, 0), model, ["doc_id", "held_out"]).select(
        "*", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line up to two edits."""
    return without_repeated_lines(table(spark, sf_dir, "documents")).drop("kept_text")


@query("op6_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
             sha1(payload) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM d WHERE payload_bytes >= 1000
      GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN keeper IS NOT NULL AND keeper IS DISTINCT FROM page_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN keeper IS DISTINCT FROM page_id THEN keeper END AS refers_to
FROM d LEFT JOIN k ON k.payload_digest = d.payload_digest AND d.payload_bytes >= 1000
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives, read back and assembled into captures."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = captures(stored(read_archives(spark, path, with_payload=False), "records"))
    revisit = F.col("record_type") == "revisit"
    return found.select(
        F.col("metadata.page_id").alias("page_id"),
        F.when(revisit, F.col("original.payload_bytes")).otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(revisit, F.col("original.payload_sha1")).otherwise(F.col("payload_sha1"))
        .alias("payload_digest"),
        "record_type", F.col("original.page_id").alias("refers_to"))


@query("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors of every vector whose id is divisible by twenty."""
    return nearest(table(spark, sf_dir, "embeddings"))


#: Bisects like the operator, one exponent at a time; the weights follow from six decimals.
_OP2_SQL = """
WITH RECURSIVE counted AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D\\x20]+')) AS n_tokens
  FROM documents),
docs AS (SELECT * FROM counted WHERE n_tokens > 0),
sources AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY source),
facts AS (SELECT list(tokens) AS ts, CAST(sum(tokens) AS BIGINT) AS total, count(*) AS n
          FROM sources),
steps AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS elow, CAST(1 AS DOUBLE) AS ehigh,
         CAST(0 AS DOUBLE) AS llow, CAST(1 AS DOUBLE) AS lhigh
  UNION ALL
  SELECT step + 1,
    CASE WHEN h < 0.92 * ln(n) THEN elow ELSE (elow + ehigh) / 2 END,
    CASE WHEN h < 0.92 * ln(n) THEN (elow + ehigh) / 2 ELSE ehigh END,
    CASE WHEN r <= 4 THEN llow ELSE (llow + lhigh) / 2 END,
    CASE WHEN r <= 4 THEN (llow + lhigh) / 2 ELSE lhigh END
  FROM (
    SELECT steps.*, n,
      -list_sum(list_transform(pe, lambda p: p / list_sum(pe) * ln(p / list_sum(pe)))) AS h,
      list_max(list_transform(range(1, n + 1), lambda i: total * pl[i] / list_sum(pl) / ts[i])) AS r
    FROM (SELECT steps.*, ts, total, n,
                 list_transform(ts, lambda t: pow(t / total, (elow + ehigh) / 2)) AS pe,
                 list_transform(ts, lambda t: pow(t / total, (llow + lhigh) / 2)) AS pl
          FROM steps, facts WHERE step < 45) AS steps)),
power AS (SELECT round(greatest(ehigh, CASE WHEN lhigh < 1e-9 THEN 0 ELSE lhigh END), 6) AS a
          FROM steps ORDER BY step DESC LIMIT 1),
plan AS (
  SELECT source, tokens, quota, quota // tokens AS passes, quota % tokens AS rest
  FROM (SELECT source, tokens, CAST(floor(total * pow(tokens / total, a) / every + 1e-6) AS BIGINT)
                 AS quota
        FROM sources, facts, power,
             (SELECT sum(pow(tokens / total, a)) AS every FROM sources, facts, power))),
drawn AS (
  SELECT doc_id, docs.source, n_tokens, tokens, quota, passes, rest, pass,
         CAST('0x' || substr(md5(concat_ws('|', docs.source, CAST(pass AS VARCHAR),
              coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 13) AS BIGINT) / pow(2, 52) AS u
  FROM (SELECT docs.*, tokens, quota, passes, rest, unnest(range(0, passes + 1)) AS pass
        FROM docs JOIN plan USING (source)) AS docs),
fitting AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, pass ORDER BY u, doc_id, n_tokens
                                ROWS UNBOUNDED PRECEDING) AS upto FROM drawn)
SELECT doc_id, source, CAST(pass AS INTEGER) AS pass,
       round(least((pass + u) * tokens / quota, 1.0), 9) AS slot,
       CAST(least(floor(least((pass + u) * tokens / quota, 1.0) * 64), 63) AS INTEGER) AS block,
       CAST(n_tokens AS BIGINT) AS n_tokens
FROM fitting WHERE pass < passes OR upto <= rest
"""


@query("op2_source_mixing", _OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are, drawn from flattened sources."""
    docs = table(spark, sf_dir, "documents").withColumn("source", F.coalesce("source", F.lit("")))
    return mix(docs, ["doc_id", "source"])


@query("op11_suffix_array_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes inside strings of 200 bytes that start elsewhere too."""
    return without_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


@query("op13_source_divergence", r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
found AS (
  SELECT row, lang, source, term, count(*) AS n
  FROM (SELECT row, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL),
kept AS (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n
  FROM found GROUP BY lang, term HAVING count(*) >= 3),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, CAST(sum(found.n) AS HUGEINT) AS n
  FROM found JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source)
  GROUP BY lang, source),
priced AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
         1 + 1000000000 * (k.n + 1) // (l.total + l.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM priced WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                   ORDER BY value DESC, encode(item)) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 200
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source is from the others of its language, and its own terms."""
    return source_divergence(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every vector. A deviation beyond 64 bits is null here;
    the operator has it as a decimal."""
    return whitened(table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.expr("try_cast(deviation AS bigint)"))
