"""Phrase catalog of the test tables.

The driver's documents are invented prose, so the fixed skill phrases hardly
occur in them.  The catalog used by the registered queries is a table that
begins with a few phrases that do occur, goes on with the skill phrases of
the postings profile, and ends with phrases cut from the ``benchmark`` texts,
three entries for each: it grows with that table.  The derived part runs
unchanged on Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.functions.skill_catalog import SKILL_CATALOG
from hirelake.operators.phrases import catalog_table
from hirelake.sources.tables import read_table

LOCAL_PHRASES = [
    ("Open Source Licensing", "technical_skill", ["apache license", "mit license", "gnu general public license"]),
    ("Apache", "technical_skill", ["apache"]),
    ("MIT", "technical_skill", ["mit"]),
    ("AI", "technical_skill", ["ai", "artificial intelligence"]),
    ("Versioning", "technical_skill", ["version 2.0", "semantic versioning"]),
    ("C++", "technical_skill", ["c++"]),
    ("Problem Solving", "soft_skill", ["problem-solving", "problem solving"]),
    ("German", "language_skill", ["und", "der"]),
    ("French", "language_skill", ["les", "des"]),
    ("Spanish", "language_skill", ["que", "del"]),
    # one skill under two names that differ in case only
    ("Straße", "domain_skill", ["straße"]),
    ("STRASSE", "domain_skill", ["strasse"]),
]

FIXED_ENTRIES = [*LOCAL_PHRASES, *SKILL_CATALOG]

BENCHMARK_PHRASES_SQL = """
SELECT entry, skill_name, skill_category, alias_rank, alias FROM (
 SELECT CAST(1000 + 3 * item_id AS INT) AS entry, 'Phrase ' || CAST(item_id AS STRING) || 'a' AS skill_name, 'domain_skill' AS skill_category,
  0 AS alias_rank, split_part(text, ' ', 3) || ' ' || split_part(text, ' ', 4) || ' ' || split_part(text, ' ', 5) AS alias FROM {benchmark}
 UNION ALL
 SELECT CAST(1000 + 3 * item_id AS INT), 'Phrase ' || CAST(item_id AS STRING) || 'a', 'domain_skill', 1, split_part(text, ' ', 7) FROM {benchmark}
 UNION ALL
 SELECT CAST(1001 + 3 * item_id AS INT), 'Phrase ' || CAST(item_id AS STRING) || 'b', 'soft_skill', 0,
  split_part(text, ' ', 10) || ' ' || split_part(text, ' ', 11) FROM {benchmark}
 UNION ALL
 SELECT CAST(1002 + 3 * item_id AS INT), 'Phrase ' || CAST(item_id AS STRING) || 'c', 'technical_skill', 0, split_part(text, ' ', 14) FROM {benchmark}
) p WHERE length(alias) > 3 AND lower(alias) <> upper(alias)
"""


def catalog_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalog as a table of aliases."""
    derived = spark.sql(BENCHMARK_PHRASES_SQL, benchmark=read_table(spark, sf_dir, "benchmark"))
    return catalog_table(spark, FIXED_ENTRIES).unionByName(derived)
