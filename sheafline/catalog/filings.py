"""Scans, filters, unions and the unpivot."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.catalog.base import documents_table, query, table
from sheafline.functions.text import section_name, section_number
from sheafline.operators.metrics import count_by
from sheafline.operators.sections import unpivot_sections
from sheafline.session import scratch_path
from sheafline.sources.filings import (
    filings_view, first_filings, in_years, of_company, read_filings, union_years, with_company,
)

FILINGS_SQL = """
SELECT doc_id,
       CASE WHEN doc_id % 11 <> 0 THEN source END AS cik,
       CAST(2018 + doc_id % 3 AS VARCHAR) AS "year",
       lines[1] AS section_1,
       lines[2] AS "section_1A",
       array_to_string(lines[3:], chr(10)) AS section_7
FROM (SELECT *, string_split(text, chr(10)) AS lines FROM documents)
"""

SECTIONS_SQL = f"""
SELECT doc_id, cik, "year", s.section AS section, s.section_text AS section_text
FROM (
  SELECT doc_id, cik, "year", unnest([
    {{'section': 'section_1', 'section_text': section_1}},
    {{'section': 'section_1A', 'section_text': "section_1A"}},
    {{'section': 'section_7', 'section_text': section_7}}]) AS s
  FROM ({FILINGS_SQL}))
WHERE s.section_text IS NOT NULL
"""


def filings(spark, sf_dir, heavy=False):
    """The filings view; ``heavy`` for work that is bound by CPU."""
    return filings_view((documents_table if heavy else table)(spark, sf_dir, "documents"))


@query("filings_view", FILINGS_SQL)
def _filings_view(spark, sf_dir):
    return filings(spark, sf_dir)


@query("filter_company_years", f"""
SELECT doc_id, cik, "year", section_1 FROM ({FILINGS_SQL})
WHERE cik = 'src3' AND "year" IN ('2018', '2020')""")
def _filter_company_years(spark, sf_dir):
    chosen = of_company(in_years(filings(spark, sf_dir), ["2018", "2020"]), "src3")
    return chosen.select("doc_id", "cik", "year", "section_1")


@query("partitioned_year_scan", f"""
SELECT doc_id, cik, "year", section_1 FROM ({FILINGS_SQL})
WHERE "year" IN ('2018', '2020') AND "section_1A" IS NOT NULL""")
def _partitioned_year_scan(spark, sf_dir):
    """Filings stored by year and split and read back by both. Filings with a second
    section stand for the split that is wanted."""
    split = F.when(F.col("section_1A").isNotNull(), "train").otherwise("test")
    path = scratch_path(spark, "filings-by-year")
    (filings(spark, sf_dir).select("doc_id", "cik", "section_1", "year", split.alias("split"))
     .write.partitionBy("year", "split").parquet(path))
    schema = "doc_id long, cik string, section_1 string, year string, split string"
    return read_filings(spark, path, ["2018", "2020"], "train", schema)


@query("union_of_years", f"""
SELECT doc_id, cik, "year" FROM ({FILINGS_SQL}) WHERE "year" = '2019'
UNION ALL SELECT doc_id, cik, "year" FROM ({FILINGS_SQL}) WHERE "year" = '2018'
UNION ALL SELECT doc_id, cik, "year" FROM ({FILINGS_SQL}) WHERE "year" = '2019'""")
def _union_of_years(spark, sf_dir):
    wide = filings(spark, sf_dir)
    return union_years(lambda y: in_years(wide, [y]), ["2019", "2018", "2019"]).select("doc_id", "cik", "year")


@query("first_filings", f"""
SELECT doc_id, cik, "year", section_1 FROM ({FILINGS_SQL})
WHERE cik IS NOT NULL ORDER BY cik, "year", doc_id LIMIT 10""")
def _first_filings(spark, sf_dir):
    ordered = first_filings(with_company(filings(spark, sf_dir)), 10, ("cik", "year", "doc_id"))
    return ordered.select("doc_id", "cik", "year", "section_1")


@query("unpivot_sections", f"""
SELECT doc_id, "year", replace(section, 'section_', '') AS section_number, section_text
FROM ({SECTIONS_SQL})""")
def _unpivot_sections(spark, sf_dir):
    return unpivot_sections(filings(spark, sf_dir), ("doc_id", "year"), drop_empty=False,
                            short_names=True, name_col="section_number")


@query("unpivot_nonempty", f"""
SELECT doc_id, cik, "year", section, section_text FROM ({SECTIONS_SQL}) WHERE section_text <> ''""")
def _unpivot_nonempty(spark, sf_dir):
    return unpivot_sections(filings(spark, sf_dir), ("doc_id", "cik", "year"))


@query("section_names", f"""
SELECT section, replace(section, 'section_', '') AS section_number,
       'section_' || replace(section, 'section_', '') AS section_again, count(*) AS n_sections
FROM ({SECTIONS_SQL}) GROUP BY section""")
def _section_names(spark, sf_dir):
    sections = unpivot_sections(filings(spark, sf_dir), ("doc_id",), drop_empty=False)
    number = section_number(F.col("section"))
    return count_by(sections, ["section"], "n_sections").select(
        "section", number.alias("section_number"), section_name(number).alias("section_again"), "n_sections")
