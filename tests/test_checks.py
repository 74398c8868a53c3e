"""The checks pass on the built star and fail on a seeded fault."""

from pyspark.sql import functions as F

from conftest import SF0001
from hirelake.operators import checks as C
from hirelake.plans.postings import Postings
from hirelake.plans.star import Star
from hirelake.sources.catalog import LOCAL_PHRASES


def test_checks_on_built_star_and_seeded_faults(spark):
    p = Postings.from_testdata(spark, SF0001)
    s = Star(p, LOCAL_PHRASES)
    final, fact = s.final(), s.fact()
    assert C.check_unique(final, "job_key").count() == 0
    assert C.check_unique(final.unionByName(final.limit(1)), "job_key").count() == 1
    assert C.check_no_duplicates(p.deduped(), ["source_job_id", "job_url"]).count() == 0
    assert C.check_dedupe_exact(p.staged(), p.deduped(), ["source_job_id", "job_url"]).count() == 0
    assert C.check_dedupe_exact(p.staged(), p.staged(), ["source_job_id", "job_url"]).count() == 1
    group = [F.trim(F.lower("job_title")), F.trim(F.lower("company_name")), F.col("normalized_city_name")]
    assert C.check_group_row_count(final, s.preferred(), group).count() == 0
    assert C.check_group_row_count(final, final, group).count() == 1
    assert C.check_flag_consistency(final, "has_category_data", "normalized_job_category").count() == 0
    bad_flag = final.withColumn("has_category_data", F.lit(False))
    assert C.check_flag_consistency(bad_flag, "has_category_data", "normalized_job_category").count() > 0
    dims = {"job_key": (s.dim_job(), "job_key"), "company_key": (s.dim_company(), "company_key"),
            "location_key": (s.dim_location(), "location_key"), "source_key": (s.dim_source(), "source_key"),
            "employment_type_key": (s.dim_employment_type(), "employment_type_key"),
            "job_posted_date_key": (s.dim_date(), "date_key")}
    assert C.check_fact_foreign_keys(fact, dims).count() == 0
    dims["location_key"] = (s.dim_location().limit(0), "location_key")
    assert C.check_fact_foreign_keys(fact, dims).count() == fact.count()
    assert C.check_year_ranges(final).count() == 0
    seeded = spark.createDataFrame([(15, 7), (-1, 3), (2, 60), (1, 2)], "experience_min_years int, experience_max_years int")
    assert C.check_year_ranges(seeded).count() == 3
    assert C.check_accepted_values(final, "job_source_channel",
                                   ["Direct", "Aggregated via Tanqeeb", "Aggregated via Sabbar"]).count() == 0
    assert C.check_accepted_values(final, "job_source_channel", ["Direct"]).count() > 0
    assert C.check_not_null(final, "job_key").count() == 0
    assert C.check_accepted_range(s.skills(), "confidence", 0.85, 1).count() == 0


def test_suite_counts_as_single_checks(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), (None, 9, None), (None, -1, "x"), ("b", 2, "z")], "k string, v int, s string")
    rules = {"null": C.null_rule("v"), "range": C.range_rule("v", 0, 5), "values": C.values_rule("s", ["x", "y"])}
    want = {"null": 1, "range": 2, "values": 1}
    assert {r.check_name: r.failures for r in C.suite_counts(df, rules).collect()} == want
    assert {r.check_name: r.failures for r in C.suite_counts(df, rules, ["k"]).collect()} == want | {"unique": 2}
    assert {r.check_name: r.failures for r in C.suite_counts(df.limit(0), rules, ["k"]).collect()} == dict.fromkeys([*want, "unique"], 0)
    assert sorted((str(r.k), r.check_name) for r in C.failing_rows(df, rules, ["k"]).collect()) == [
        ("None", "range"), ("None", "range"), ("a", "null"), ("b", "values")]
    plan = C.suite_counts(spark.read.parquet(f"{SF0001}/lineitem.parquet"), {"a": C.null_rule("l_tax"), "b": C.range_rule("l_discount", 0, 1)}, ["l_orderkey"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
