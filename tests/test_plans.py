"""What the chain's queries read: no text, unless an output shows it."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF0001

QUERIES = E.queries()
#: Queries over the postings chain whose output shows no text and needs none.
NARROW = """
stage_postings select_wide lookup_city_region normalize_region normalize_country filter_country parse_posted_date
normalize_workplace normalize_employment_type normalize_status normalize_source derive_channel parse_experience derive_seniority
category_from_title normalize_category filter_in_set placeholder_for_missing void_untrusted_column keep_latest preferred_row surrogate_key
nullable_key build_dim_date build_dim_company build_dim_location build_dim_source build_dim_employment_type build_dim_job scd2_current
scd2_check status_history incremental_since_watermark merge_by_key total_postings postings_by_city_region postings_by_employment_type
postings_by_workplace experience_requirements postings_by_source postings_by_channel posting_trend check_not_null check_unique
check_unique_combination check_relationships check_flag_consistency check_dedupe_exact check_no_duplicates check_group_row_count
check_year_ranges check_posted_dates check_posted_dates_as_of check_not_null_warn check_suite failing_rows dedupe_keep_missing_ids dedupe_counts
""".split()


@pytest.mark.parametrize("key", NARROW)
def test_no_text_is_read(spark, key):
    plan = QUERIES[key](spark, SF0001)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and not [s for s in scans if re.search(r"(^|,)text:", s)], scans
    assert "sha2" not in plan


def test_tie_goes_by_row_id(spark):
    from hirelake.plans.postings import Postings
    plan = Postings.from_testdata(spark, SF0001).deduped()._jdf.queryExecution().toString()
    order = re.search(r"row_number\(\) windowspecdefinition\(([^)]*)\)", plan)[1]
    assert "row_id" in order and "job_title" not in order


def test_rows_without_ids_get_them(spark):
    """Raw tables without the two ids give the same postings, whatever the order of the rows."""
    from hirelake.plans.postings import Postings
    from hirelake.sources.bronze import conform_columns
    from hirelake.sources.seeds import city_region_seed
    raw = conform_columns(Postings.from_testdata(spark, SF0001).raw)
    cols = ["source_job_id", "job_url", "job_title", "collected_at", "description"]
    a, b = (sorted(map(str, Postings(spark, r, city_region_seed(spark)).final().select(*cols).collect())) for r in (raw, raw.repartition(5)))
    assert a == b == sorted(map(str, Postings.from_testdata(spark, SF0001).final().select(*cols).collect()))


def test_catalog_size_leaves_the_plan_alone(spark):
    from hirelake.operators.tagging import tag_phrases
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")

    def nodes(n):
        catalog = [(f"Term {i}", "technical_skill", [f"term {i}", f"t{i}"]) for i in range(n)]
        return len(re.findall(r"^[ :+\-]*[*()0-9 ]*\w+", tag_phrases(docs, "doc_id", "text", catalog)._jdf.queryExecution().optimizedPlan().toString(), re.M))

    assert nodes(10) == nodes(500)
