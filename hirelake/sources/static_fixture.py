"""A static job dataset derived from ``orders`` (the profiling job's input
shape: job_title, comp_name, comp_type, comp_size, city, region,
eco_activity, benefits, contract, positions, gender, exper, salary,
job_date).  Portable text, run by Spark and by the DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.sources.tables import read_table

STATIC_SQL = """
SELECT
 CASE WHEN o_orderkey % 11 = 0 THEN ' ' || o_orderpriority || ' ' ELSE o_orderpriority END AS job_title,
 'Company ' || CAST(o_custkey % 37 AS STRING) AS comp_name,
 CASE WHEN o_custkey % 2 = 0 THEN 'private' ELSE 'public' END AS comp_type,
 'medium' AS comp_size,
 split_part('Riyadh|Jeddah|Dammam|Abha', '|', CAST(o_orderkey % 4 AS INT) + 1) AS city,
 split_part('Riyadh Region|Makkah Region|Eastern Province|Asir Region', '|', CAST(o_orderkey % 4 AS INT) + 1) AS region,
 o_orderstatus AS eco_activity,
 CAST(NULL AS STRING) AS benefits,
 'full time' AS contract,
 CAST(o_orderkey % 5 AS BIGINT) - 1 AS positions,
 'any' AS gender,
 CAST(o_custkey % 9 AS BIGINT) - 1 AS exper,
 CASE WHEN o_totalprice > 150000 THEN o_totalprice END AS salary,
 CASE WHEN o_orderkey % 13 = 0 THEN 'not a date' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS job_date
FROM {orders}
"""


def static_sql_for(orders: str = "orders") -> str:
    return STATIC_SQL.replace("{orders}", orders)


def static_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                        "o_orderpriority", "o_totalprice", "o_orderdate")
    return spark.sql(STATIC_SQL, orders=orders)
