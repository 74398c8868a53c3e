"""Derived postings table.

The driver tables hold no job postings.  This text derives a 19-column raw
postings table from ``orders`` and ``documents`` (one posting per order).  It
runs unchanged on Spark and DuckDB; the DuckDB oracle starts from the same
text.  Placeholders ``{orders}`` and ``{documents}`` name the inputs.

Every row carries two narrow ids, as stored raw tables do: ``row_id`` (here the
order) and ``description_id``, the key of its text in :func:`posting_texts`.

Texts are dealt round over all documents.  A quarter of the jobs share few
companies, so that several channels post the same job; the others have
companies that grow in number with the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.sources.tables import read_table

POSTINGS_SQL = """
SELECT
 CASE WHEN k % 97 = 0 THEN '' WHEN k % 89 = 0 THEN NULL ELSE 'J' || CAST(g AS STRING) END AS source_job_id,
 split_part('Data Engineer|Senior Software Developer|HR Manager|Sales Executive 📣 Job Ad|Office Manager|Staff Nurse|Business Analyst|Receptionist|Chef|  data engineer |Marketing Lead|Accountant', '|', CAST(g % 12 AS INT) + 1) AS job_title,
 CASE CAST(g % 3 AS INT) WHEN 0 THEN 'https://sabbar.com/en/jobs/c-' || split_part('riyadh|al-khobar|jeddah', '|', CAST((CASE WHEN g % 5 = 0 THEN k ELSE g END) % 3 AS INT) + 1) || '-r-x/id-' || CAST(g AS STRING)
   WHEN 1 THEN 'https://saudi.tanqeeb.com/jobs/' || CAST(g AS STRING) ELSE 'https://www.gulftalent.com/jobs/' || CAST(g AS STRING) END AS url,
 CASE WHEN g % 13 = 0 THEN NULL WHEN floor(g / 60) % 4 > 0 THEN 'Company ' || CAST(CAST(floor(g / 10) AS BIGINT) AS STRING)
   ELSE split_part('Acme|ACME |Beta Co|Gamma|Delta Health', '|', CAST(g % 5 AS INT) + 1) END AS company_name,
 CASE WHEN g % 7 = 0 THEN NULL ELSE 'https://c.example/' || CAST(g % 5 AS STRING) END AS company_url,
 split_part('Oil &amp; Gas||Retail| |Health', '|', CAST(g % 5 AS INT) + 1) AS industry,
 split_part('Riyadh|JEDDAH|Al Khobar|Saudi|'' Makkah ''|Unknownville|Eastern Province|Mecca', '|', CAST(g % 8 AS INT) + 1) AS city,
 split_part('Riyadh|makkah region|Saudi Arabia - Jeddah|Saudi Arabia|al-khobar|Western|x &amp;#1575; y|foo-bar region', '|', CAST(g % 8 AS INT) + 1) AS region,
 split_part('Saudi|Saudi Arabia|Egypt|Saudi Arabia|Saudi', '|', CAST(g % 5 AS INT) + 1) AS country,
 split_part('FULL_TIME|part time|Contractor|Freelance|temporary|Seasonal|Internship|Shift', '|', CAST(g % 8 AS INT) + 1) AS employment_type,
 split_part('ON-SITE|remote|Hybrid|field|Onsite|Other', '|', CAST(g % 6 AS INT) + 1) AS workplace_type,
 CASE WHEN g % 17 = 0 THEN NULL ELSE split_part('5-10 yrs|10+ yrs|Fresh graduate|No experience|up to 3 years|less than a year|2|02/05/2026|3+|1-2 years|7 - 15 years|+5|2.5|20', '|', CAST(g % 14 AS INT) + 1) END AS experience_years,
 split_part('information technology||IT|Human Resources|Accounting, Finance & Banking|engineering| |Cooking', '|', CAST(g % 8 AS INT) + 1) AS job_category,
 split_part('True|False|yes|maybe|', '|', CAST(g % 5 AS INT) + 1) AS is_salary_disclosed,
 CASE WHEN g % 19 = 0 THEN NULL ELSE split_part('Tanqeeb|GulfTalent|Aggregated (source not specified)|Sabbar|Jadarat.com', '|', CAST(g % 5 AS INT) + 1) END AS job_source,
 CASE WHEN g % 23 = 0 THEN NULL ELSE split_part('yesterday|3 days ago|2 hours ago|45 minutes ago|1 week ago|monday|Sunday|03 Feb 2026|2026-01-15|today|last week|2 months ago|n/a', '|', CAST(g % 13 AS INT) + 1) END AS job_posted_date,
 split_part('active|CLOSED|Expired|paused', '|', CAST(k % 4 AS INT) + 1) AS job_status,
 CASE WHEN k % 211 = 0 THEN NULL ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || ' ' || lpad(CAST(k % 24 AS STRING), 2, '0') || ':' || lpad(CAST(k % 60 AS STRING), 2, '0') || ':00' END AS collected_at,
 d.text AS description,
 k AS row_id, CASE WHEN d.doc_id IS NOT NULL THEN CAST(d.doc_id AS STRING) END AS description_id
FROM (SELECT o_orderkey AS k, CAST(floor(o_orderkey / 2) AS BIGINT) AS g, o_orderdate, o_orderkey % n AS text_id
      FROM {orders} CROSS JOIN (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE count(*) END AS n FROM {documents}) c) o
LEFT JOIN {documents} d ON d.doc_id = o.text_id
"""


def postings_sql_for(orders: str = "orders", documents: str = "documents") -> str:
    """The portable text with plain table names (used by the oracle)."""
    return POSTINGS_SQL.replace("{orders}", orders).replace("{documents}", documents)


def derived_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """19 string columns and the two ids, one posting per order."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spark.sql(POSTINGS_SQL, orders=orders, documents=docs)


def posting_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(description_id, description): the texts the postings point to."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("description_id"), F.col("text").alias("description"))
