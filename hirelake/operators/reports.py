"""Reporting aggregates over the star.

Facts are aggregated by their foreign key first (map-side partial counts),
and only the small per-key result is joined to a dimension, so no join ever
sees fact-sized input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions import rules


def _count_by(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))


def _roll_up(per_key: DataFrame, dim: DataFrame, key: str, by: list, how: str = "inner") -> DataFrame:
    return per_key.join(dim, key, how).groupBy(*by).agg(F.sum("__n").cast("bigint").alias("postings"))


def total_postings(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("total_postings"))


def postings_by_city_region(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    return _roll_up(_count_by(fact, "location_key"), dim_location, "location_key", ["city", "region"])


def postings_by_employment_type(fact: DataFrame, dim_employment_type: DataFrame) -> DataFrame:
    per = _count_by(fact, "employment_type_key")
    joined = per.join(dim_employment_type, "employment_type_key", "left")
    name = F.coalesce(F.col("employment_type_name"), F.lit(rules.MISSING_PLACEHOLDER)).alias("employment_type")
    return joined.groupBy(name).agg(F.sum("__n").cast("bigint").alias("postings"))


def postings_by_workplace(fact: DataFrame) -> DataFrame:
    return fact.groupBy("workplace_type").agg(F.count(F.lit(1)).alias("postings"))


def experience_requirements(fact: DataFrame, dim_job: DataFrame) -> DataFrame:
    j = fact.select("job_key", "experience_min_years", "experience_max_years").join(
        dim_job.select("job_key", "seniority_level"), "job_key", "inner")
    return j.groupBy("seniority_level").agg(
        F.count(F.lit(1)).alias("postings"),
        F.min("experience_min_years").alias("min_years"),
        F.round(F.avg("experience_min_years"), 4).alias("avg_min_years"),
        F.round(F.avg("experience_max_years"), 4).alias("avg_max_years"),
        F.max("experience_max_years").alias("max_years"),
    )


def postings_by_source(fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    return _roll_up(_count_by(fact, "source_key"), dim_source, "source_key", ["source_name"])


def postings_by_channel(fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    return _roll_up(_count_by(fact, "source_key"), dim_source, "source_key", ["source_channel"])


def top_skills(bridge: DataFrame, dim_skills: DataFrame, k: int = 10) -> DataFrame:
    per = bridge.groupBy("skill_key").agg(F.count(F.lit(1)).alias("postings"))
    ranked = per.join(dim_skills, "skill_key", "inner").select("skill_name", "skill_category", "postings")
    return ranked.orderBy(F.col("postings").desc(), F.col("skill_name").asc(), F.col("skill_category").asc()).limit(k)


def posting_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per = _count_by(fact, "job_posted_date_key").withColumnRenamed("job_posted_date_key", "date_key")
    return _roll_up(per, dim_date, "date_key", ["year", "month"])
