"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Each runs over the whole derived tables.

Queries return a projection of the columns that show the operator's work
(not every carried column), with every computed column aliased.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.plans.postings import Postings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def P(spark: SparkSession, sf_dir: str) -> Postings:
    return Postings.from_testdata(spark, sf_dir)


ID = ["source_job_id", "job_url"]


# -- 2.4 staging ----------------------------------------------------------------

@register("stage_postings")
def q_stage_postings(spark, sf_dir):
    return P(spark, sf_dir).staged().drop("description")  # noqa: the text itself is compared by tag queries


@register("select_wide")
def q_select_wide(spark, sf_dir):
    return P(spark, sf_dir).cleaned_narrow().drop("description_id")


# -- 2.5 normalisation --------------------------------------------------------------

@register("city_from_url")
def q_city_from_url(spark, sf_dir):
    from hirelake.operators.normalize import city_from_url
    stg = P(spark, sf_dir).staged()
    u, c = city_from_url("job_url", "city")
    return stg.select(*ID, "city", u.alias("url_city_raw"), c.alias("city_final"))


@register("lookup_city_region")
def q_lookup_city_region(spark, sf_dir):
    return P(spark, sf_dir).located().select(
        *ID, "city_final", "city_lookup_key", "normalized_city_name", "seed_mapped_region")


@register("normalize_region")
def q_normalize_region(spark, sf_dir):
    return P(spark, sf_dir).located().select(*ID, "region", "seed_mapped_region", "normalized_region_name")


@register("normalize_country")
def q_normalize_country(spark, sf_dir):
    return P(spark, sf_dir).located().select(*ID, "country", "normalized_country_name")


@register("filter_country")
def q_filter_country(spark, sf_dir):
    return P(spark, sf_dir).in_country().select(*ID, "normalized_city_name", "normalized_region_name",
                                                "normalized_country_name")


@register("parse_posted_date")
def q_parse_posted_date(spark, sf_dir):
    return P(spark, sf_dir).dated().select(*ID, "job_posted_date", "collected_at", "normalized_job_posted_date")


@register("normalize_workplace")
def q_normalize_workplace(spark, sf_dir):
    return P(spark, sf_dir).attributed().select(*ID, "workplace_type", "normalized_workplace_type")


@register("normalize_employment_type")
def q_normalize_employment_type(spark, sf_dir):
    return P(spark, sf_dir).attributed().select(*ID, "employment_type", "normalized_employment_type")


@register("normalize_status")
def q_normalize_status(spark, sf_dir):
    return P(spark, sf_dir).attributed().select(*ID, "job_status", "normalized_job_status")


@register("normalize_source")
def q_normalize_source(spark, sf_dir):
    return P(spark, sf_dir).attributed().select(*ID, "job_source", "normalized_job_source")


@register("derive_channel")
def q_derive_channel(spark, sf_dir):
    return P(spark, sf_dir).attributed().select(*ID, "job_source", "job_source_channel")


@register("parse_experience")
def q_parse_experience(spark, sf_dir):
    return P(spark, sf_dir).experienced().select(
        *ID, "experience_years", "is_date_like", "exp_num1", "exp_num2", "is_fresh", "is_open_ended",
        "is_upper_bound_only", "experience_min_years", "experience_max_years", "experience_is_open_ended")


@register("derive_seniority")
def q_derive_seniority(spark, sf_dir):
    return P(spark, sf_dir).experienced().select(
        *ID, "experience_years", "experience_min_years", "experience_max_years", "seniority_level")


@register("category_from_title")
def q_category_from_title(spark, sf_dir):
    return P(spark, sf_dir).categorized().select(*ID, "job_title", "title_derived_category")


@register("normalize_category")
def q_normalize_category(spark, sf_dir):
    return P(spark, sf_dir).categorized().select(
        *ID, "job_category", "normalized_job_category", "has_category_data", "is_category_derived_from_title")


@register("filter_in_set")
def q_filter_in_set(spark, sf_dir):
    return P(spark, sf_dir).in_scope().select(*ID, "normalized_job_category")


@register("placeholder_for_missing")
def q_placeholder_for_missing(spark, sf_dir):
    return P(spark, sf_dir).cleaned_narrow().select(
        *ID, "company_industry", "company_industry_clean", "has_company_industry_data")


@register("void_untrusted_column")
def q_void_untrusted_column(spark, sf_dir):
    return P(spark, sf_dir).cleaned_narrow().select(
        *ID, "normalized_job_source", "company_url", "company_url_clean", "has_valid_company_url")


# -- 2.6 de-duplication -------------------------------------------------------------

@register("keep_latest")
def q_keep_latest(spark, sf_dir):
    return P(spark, sf_dir).deduped().drop("row_id", "description_id")


@register("preferred_row")
def q_preferred_row(spark, sf_dir):
    return P(spark, sf_dir).preferred_narrow().select(
        "job_key", "job_title", "company_name", "normalized_city_name", "job_source_channel",
        "company_url_clean", "collected_at", "priority_rank", "channel_duplicate_count")


# -- 2.9 keys -----------------------------------------------------------------------

@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    return P(spark, sf_dir).final_narrow().select("job_key", "source_job_id", "normalized_job_source", "job_url")


# -- 2.10 star schema ------------------------------------------------------------------

def S(spark: SparkSession, sf_dir: str):
    from hirelake.plans.star import Star
    from hirelake.sources.catalog import catalog_of
    return Star(P(spark, sf_dir), catalog_of(spark, sf_dir))


@register("build_dim_date")
def q_dim_date(spark, sf_dir):
    return S(spark, sf_dir).dim_date()


@register("build_dim_company")
def q_dim_company(spark, sf_dir):
    return S(spark, sf_dir).dim_company()


@register("build_dim_location")
def q_dim_location(spark, sf_dir):
    return S(spark, sf_dir).dim_location()


@register("build_dim_source")
def q_dim_source(spark, sf_dir):
    return S(spark, sf_dir).dim_source()


@register("build_dim_employment_type")
def q_dim_employment_type(spark, sf_dir):
    return S(spark, sf_dir).dim_employment_type()


@register("build_dim_job")
def q_dim_job(spark, sf_dir):
    return S(spark, sf_dir).dim_job()


@register("build_dim_skills")
def q_dim_skills(spark, sf_dir):
    return S(spark, sf_dir).dim_skills()


@register("build_fact_posting")
def q_fact(spark, sf_dir):
    return S(spark, sf_dir).fact().drop("description")


@register("dense_sequence")
def q_dense_sequence(spark, sf_dir):
    return S(spark, sf_dir).fact_narrow().select("job_posting_key", "job_key", "job_url")


@register("build_bridge_job_skills")
def q_bridge(spark, sf_dir):
    return S(spark, sf_dir).bridge()


@register("date_key")
def q_date_key(spark, sf_dir):
    from hirelake.functions.dates import date_key
    from hirelake.sources.tables import read_table
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", date_key(F.to_date("o_orderdate")).alias("order_date_key"))


@register("nullable_key")
def q_nullable_key(spark, sf_dir):
    return S(spark, sf_dir).fact_rows().select("job_key", "company_key", "employment_type_key")


@register("pipe_key")
def q_pipe_key(spark, sf_dir):
    from hirelake.functions.keys import pipe_key
    d = _table(spark, sf_dir, "documents")
    # null and empty values on either side
    lang = F.when(F.col("doc_id") % 7 != 0, F.col("lang"))
    source = F.when(F.col("doc_id") % 11 == 0, F.lit("")).otherwise(F.when(F.col("doc_id") % 5 != 0, F.col("source")))
    return d.select("doc_id", pipe_key(lang, source).alias("key"))


# -- 2.11 skill tagging ------------------------------------------------------------------

@register("tag_phrases")
def q_tag_phrases(spark, sf_dir):
    from hirelake.plans.star import extracted_skills
    from hirelake.sources.catalog import catalog_of
    return extracted_skills(P(spark, sf_dir), catalog_of(spark, sf_dir))


@register("stage_skills")
def q_stage_skills(spark, sf_dir):
    from hirelake.plans.star import extracted_skills
    from hirelake.operators.tagging import stage_skills
    from hirelake.sources.catalog import catalog_of
    return stage_skills(extracted_skills(P(spark, sf_dir), catalog_of(spark, sf_dir)))


@register("high_confidence")
def q_high_confidence(spark, sf_dir):
    return S(spark, sf_dir).skills()


@register("pending_work")
def q_pending_work(spark, sf_dir):
    from hirelake.operators.tagging import pending_work
    return pending_work(P(spark, sf_dir).final(), None, None).select("job_key")


@register("tag_run_log")
def q_tag_run_log(spark, sf_dir):
    """Two runs over Arabic and other texts; what the first one's translator fails at is taken up by the second."""
    from hirelake.operators.tagging import outcome_log, outcomes_by_text_id, pending_work, with_live_text
    from hirelake.sources.bronze import append_log, scratch_dir
    from hirelake.sources.catalog import catalog_of
    path, catalog, p = scratch_dir(spark, "run-log"), catalog_of(spark, sf_dir), P(spark, sf_dir)
    arabic = F.when(F.col("job_key").startswith("a"), F.lit("arabic-0")).when(F.col("job_key").startswith("b"), F.lit("arabic-1"))
    texts = p.texts().unionByName(spark.createDataFrame([(f"arabic-{n}", t) for n, t in enumerate(GLOSSARY_TEXTS)], "description_id string, description string"))
    # the queue holds ids of texts; each text is tagged once in a run
    final = with_live_text(p.final_narrow().select("job_key", F.coalesce(arabic, "description_id").alias("description_id")), texts)
    log = None
    for ts, words in ((T1, GLOSSARY), (T2, GLOSSARY | MORE_WORDS)):
        work = pending_work(final, None, log, text_col="description_id")
        append_log(outcome_log(outcomes_by_text_id(work, texts, catalog, translate=_glossary(words)), ts), path)
        log = spark.read.parquet(path)
    return log


#: Arabic texts and the words of a small glossary, which stands in for a translation model.
GLOSSARY_TEXTS = ["\u0631\u062e\u0635\u0629 MIT license", "\u0645\u0647\u0646\u062f\u0633 Apache"]
GLOSSARY = {"\u0631\u062e\u0635\u0629": "licence", "MIT": "MIT", "license": "license", "Apache": "Apache"}
MORE_WORDS = {"\u0645\u0647\u0646\u062f\u0633": "engineer"}


def _glossary(words):
    def translate(text):
        return " ".join(words[w] for w in text.split())
    return translate


@register("normalize_text")
def q_normalize_text(spark, sf_dir):
    from hirelake.operators.tagging import normalize_text
    from hirelake.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.length(normalize_text("text")).alias("normalized_chars"),
                    F.md5(normalize_text("text")).alias("normalized_md5"))


@register("detect_arabic")
def q_detect_arabic(spark, sf_dir):
    from hirelake.operators.tagging import detect_arabic
    from hirelake.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", detect_arabic("text").alias("is_arabic"))


# -- 2.8 history ---------------------------------------------------------------------------

@register("scd2_current")
def q_scd2_current(spark, sf_dir):
    from hirelake.operators.history import scd2_current
    return scd2_current(S(spark, sf_dir).snapshot()).select(
        "job_key", "normalized_job_status", "normalized_job_category", "seniority_level",
        "dbt_scd_id", "dbt_valid_from", "dbt_valid_to")


# -- 2.12 reports ----------------------------------------------------------------------------

def _report(fn_name, *parts):
    from hirelake.operators import reports as R

    def run(spark, sf_dir):
        s = S(spark, sf_dir)
        return getattr(R, fn_name)(*[getattr(s, p)() for p in parts])
    return run


QUERIES["total_postings"] = _report("total_postings", "fact_rows")
QUERIES["postings_by_city_region"] = _report("postings_by_city_region", "fact_rows", "dim_location")
QUERIES["postings_by_employment_type"] = _report("postings_by_employment_type", "fact_rows", "dim_employment_type")
QUERIES["postings_by_workplace"] = _report("postings_by_workplace", "fact_rows")
QUERIES["experience_requirements"] = _report("experience_requirements", "fact_rows", "dim_job")
QUERIES["postings_by_source"] = _report("postings_by_source", "fact_rows", "dim_source")
QUERIES["postings_by_channel"] = _report("postings_by_channel", "fact_rows", "dim_source")
QUERIES["top_skills"] = _report("top_skills", "bridge_rows", "dim_skills")
QUERIES["posting_trend"] = _report("posting_trend", "fact_rows", "dim_date")


# -- 2.13 checks: inputs hold planted faults, in the rows whose key begins with "a" ---------------------------------------------------------------------------------

def _planted(key: str = "job_key"):
    return F.col(key).startswith("a")


@register("check_not_null")
def q_check_not_null(spark, sf_dir):
    from hirelake.operators.checks import check_not_null
    p = P(spark, sf_dir)
    return check_not_null(p.dated(), "normalized_job_posted_date", "error", ID)


@register("check_unique")
def q_check_unique(spark, sf_dir):
    from hirelake.operators.checks import check_unique
    final = P(spark, sf_dir).final_narrow()
    return check_unique(final.unionByName(final.filter(_planted())), "job_key")


@register("check_unique_combination")
def q_check_unique_combination(spark, sf_dir):
    from hirelake.operators.checks import check_unique_combination
    kept = P(spark, sf_dir).preferred_narrow()
    return check_unique_combination(kept.unionByName(kept.filter(_planted())), ["job_title", "company_name", "normalized_city_name"])


@register("check_accepted_values")
def q_check_accepted_values(spark, sf_dir):
    from hirelake.operators.checks import check_accepted_values
    from hirelake.sources.tables import read_table
    # order status against the single-letter codes the orders table uses
    return check_accepted_values(read_table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@register("check_relationships")
def q_check_relationships(spark, sf_dir):
    from hirelake.operators.checks import check_relationships
    s = S(spark, sf_dir)
    return check_relationships(s.fact_rows(), "job_key", s.dim_job().filter(~_planted()), "job_key")


@register("check_accepted_range")
def q_check_accepted_range(spark, sf_dir):
    from hirelake.operators.checks import check_accepted_range
    from hirelake.sources.tables import read_table
    li = read_table(spark, sf_dir, "lineitem")
    return check_accepted_range(li, "l_discount", 0.0, 0.08, ["l_orderkey", "l_linenumber"])


@register("check_flag_consistency")
def q_check_flag_consistency(spark, sf_dir):
    from hirelake.operators.checks import check_flag_consistency
    final = P(spark, sf_dir).final_narrow()
    flag = F.when(_planted(), ~F.col("has_category_data")).otherwise(F.col("has_category_data"))
    return check_flag_consistency(final.withColumn("has_category_data", flag), "has_category_data", "normalized_job_category", ["job_key"])


@register("check_dedupe_exact")
def q_check_dedupe_exact(spark, sf_dir):
    from hirelake.operators.checks import check_dedupe_exact
    p = P(spark, sf_dir)
    return check_dedupe_exact(p.staged(), p.deduped().filter(~F.col("source_job_id").endswith("7")), ID)


@register("check_no_duplicates")
def q_check_no_duplicates(spark, sf_dir):
    from hirelake.operators.checks import check_no_duplicates
    kept = P(spark, sf_dir).deduped()
    return check_no_duplicates(kept.unionByName(kept.filter(F.col("source_job_id").endswith("7"))), ID)


@register("check_group_row_count")
def q_check_group_row_count(spark, sf_dir):
    from hirelake.operators.checks import check_group_row_count
    p = P(spark, sf_dir)
    return check_group_row_count(p.final_narrow(), p.preferred_narrow().filter(~_planted()), [
        F.trim(F.lower("job_title")), F.trim(F.lower("company_name")), F.col("normalized_city_name")])


@register("check_year_ranges")
def q_check_year_ranges(spark, sf_dir):
    from hirelake.operators.checks import check_year_ranges
    final = P(spark, sf_dir).final_narrow()
    most = F.when(_planted(), F.col("experience_max_years") + 45).otherwise(F.col("experience_max_years"))
    return check_year_ranges(final.withColumn("experience_max_years", most), keep=["job_key", "experience_years"])


@register("check_posted_dates")
def q_check_posted_dates(spark, sf_dir):
    from hirelake.operators.checks import check_posted_dates
    return check_posted_dates(P(spark, sf_dir).final_narrow(), None, ["job_key"])


@register("check_fact_foreign_keys")
def q_check_fact_foreign_keys(spark, sf_dir):
    from hirelake.operators.checks import check_fact_foreign_keys
    s = S(spark, sf_dir)
    dims = {
        "job_key": (s.dim_job(), "job_key"),
        "company_key": (s.dim_company(), "company_key"),
        "location_key": (s.dim_location(), "location_key"),
        "source_key": (s.dim_source(), "source_key"),
        "employment_type_key": (s.dim_employment_type(), "employment_type_key"),
        "job_posted_date_key": (s.dim_date(), "date_key"),
    }
    faulty = {fk: (dim.filter(~_planted(dk) if dk != "date_key" else F.col(dk) % 7 != 0), dk) for fk, (dim, dk) in dims.items()}
    return check_fact_foreign_keys(s.fact_narrow(), faulty)


@register("check_suite")
def q_check_suite(spark, sf_dir):
    """Failures of many checks in one scan for each table, over inputs with planted faults."""
    from hirelake.functions import rules
    from hirelake.operators import checks as C
    p = P(spark, sf_dir)
    final = p.final_narrow().withColumns({
        "has_category_data": F.when(_planted(), ~F.col("has_category_data")).otherwise(F.col("has_category_data")),
        "experience_max_years": F.when(_planted(), F.col("experience_max_years") + 45).otherwise(F.col("experience_max_years")),
        "seniority_level": F.when(F.col("job_key").startswith("b"), F.lit("Guru")).otherwise(F.col("seniority_level"))})
    suites = {
        "final": C.suite_counts(final.unionByName(final.filter(_planted())), {
            "city_not_null": C.null_rule("normalized_city_name"), "seniority_accepted": C.values_rule("seniority_level", rules.SENIORITY_LABELS),
            "category_flag": C.flag_rule("has_category_data", "normalized_job_category"), "year_ranges": C.years_rule(),
            "posted_dates": C.posted_rule()}, ["job_key"], "job_key_unique"),
        "deduped": C.suite_counts(p.deduped(), {"id_not_null": C.null_rule("source_job_id")}, ID, "no_duplicates"),
        "lineitem": C.suite_counts(_table(spark, sf_dir, "lineitem"), {"discount_range": C.range_rule("l_discount", 0.0, 0.08)}),
    }
    out = None
    for name, df in suites.items():
        df = df.select(F.lit(name).alias("table_name"), "check_name", "failures")
        out = df if out is None else out.unionByName(df)
    return out


@register("failing_rows")
def q_failing_rows(spark, sf_dir):
    from hirelake.functions import rules
    from hirelake.operators import checks as C
    final = P(spark, sf_dir).final_narrow().withColumn("experience_max_years", F.when(
        _planted(), F.col("experience_max_years") + 45).otherwise(F.col("experience_max_years")))
    return C.failing_rows(final, {
        "city_not_null": C.null_rule("normalized_city_name"), "year_ranges": C.years_rule(),
        "status_accepted": C.values_rule("normalized_job_status", [label for label, _ in rules.STATUS_ALIASES])}, ["job_key"])


# -- 2.3 static dataset profiling ------------------------------------------------------------

def _static(spark, sf_dir):
    from hirelake.sources.static_fixture import static_dataset
    return static_dataset(spark, sf_dir)


def _table(spark, sf_dir, name):
    from hirelake.sources.tables import read_table
    return read_table(spark, sf_dir, name)


AS_OF = "2026-12-02 00:00:00"


@register("profile_table")
def q_profile_table(spark, sf_dir):
    from hirelake.operators.profiling import profile_table
    return profile_table(_table(spark, sf_dir, "orders"))


@register("count_duplicate_rows")
def q_count_duplicate_rows(spark, sf_dir):
    from hirelake.operators.profiling import count_duplicate_rows
    return count_duplicate_rows(_table(spark, sf_dir, "documents").drop("doc_id"))


@register("flag_group_duplicates")
def q_flag_group_duplicates(spark, sf_dir):
    from hirelake.operators.profiling import flag_group_duplicates
    return flag_group_duplicates(_table(spark, sf_dir, "documents"), ["text"]).select("doc_id", "group_size")


@register("clean_column_names")
def q_clean_column_names(spark, sf_dir):
    from hirelake.operators.profiling import clean_column_names
    s = _static(spark, sf_dir)
    messy = s.toDF(*[f" {c.upper()} " for c in s.columns])
    return clean_column_names(messy)


@register("trim_text_columns")
def q_trim_text_columns(spark, sf_dir):
    from hirelake.operators.profiling import trim_text_columns
    t = trim_text_columns(_table(spark, sf_dir, "documents"))
    return t.select("doc_id", F.length("text").alias("text_chars"), F.md5("text").alias("text_md5"), "lang", "source")


@register("drop_exact_duplicates")
def q_drop_exact_duplicates(spark, sf_dir):
    from hirelake.operators.profiling import drop_exact_duplicates
    d = drop_exact_duplicates(_table(spark, sf_dir, "documents").drop("doc_id"))
    return d.select(F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@register("coerce_dates")
def q_coerce_dates(spark, sf_dir):
    from hirelake.operators.profiling import coerce_dates
    return coerce_dates(_static(spark, sf_dir), "job_date").select("comp_name", "job_title", "job_date")


@register("value_frequencies")
def q_value_frequencies(spark, sf_dir):
    from hirelake.operators.profiling import value_frequencies
    return value_frequencies(_table(spark, sf_dir, "orders"), "o_orderpriority")


@register("range_violations")
def q_range_violations(spark, sf_dir):
    from hirelake.operators.profiling import range_violations
    return range_violations(_table(spark, sf_dir, "customer"), "c_acctbal", allow_zero=True).select(
        "c_custkey", "c_acctbal")


@register("conform_static_dataset")
def q_conform_static_dataset(spark, sf_dir):
    from hirelake.operators import profiling as PR
    s = PR.clean_column_names(_static(spark, sf_dir))
    s = PR.drop_exact_duplicates(PR.trim_text_columns(s))
    return PR.conform_static_dataset(s, AS_OF)


# -- 2.6 / 2.7 picks and joins over the driver tables ------------------------------------------

@register("one_per_key_pick")
def q_one_per_key_pick(spark, sf_dir):
    from hirelake.operators.dedupe import keep_latest
    o = _table(spark, sf_dir, "orders")
    latest = keep_latest(o, ["o_custkey"], [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc()])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate")


@register("join_left_lookup")
def q_join_left_lookup(spark, sf_dir):
    from hirelake.operators.joins import join_left_lookup
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return join_left_lookup(c, n, F.col("c_nationkey"), "n_nationkey").select("c_custkey", "n_name")


@register("join_inner_composite")
def q_join_inner_composite(spark, sf_dir):
    from hirelake.operators.joins import join_inner_composite
    s = S(spark, sf_dir)
    return join_inner_composite(s.skills(), s.dim_skills(), ["skill_name", "skill_category"]).select("job_key", "skill_key", "confidence")


@register("semi_join")
def q_semi_join(spark, sf_dir):
    from hirelake.operators.joins import semi_join
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return semi_join(c, o, "c_custkey")


@register("anti_join")
def q_anti_join(spark, sf_dir):
    from hirelake.operators.joins import anti_join
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = _table(spark, sf_dir, "orders")
    finished = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    big = o.filter(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return anti_join(anti_join(c, finished, "c_custkey"), big, "c_custkey")


@register("orphan_rows")
def q_orphan_rows(spark, sf_dir):
    from hirelake.operators.joins import orphan_rows
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = _table(spark, sf_dir, "supplier").select("s_suppkey").filter(F.col("s_suppkey") % 10 != 3)
    return orphan_rows(li, s, "l_suppkey", "s_suppkey")


@register("cross_join_scalars")
def q_cross_join_scalars(spark, sf_dir):
    from hirelake.operators.joins import cross_join_scalars
    a = _table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("orders"))
    b = _table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("customers"))
    c = _table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("lineitems"))
    return cross_join_scalars(a, b, c)


@register("union_all")
def q_union_all(spark, sf_dir):
    from hirelake.operators.joins import union_all
    parts = [_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(t).alias("table_name"), "row_count") for t in ("orders", "customer", "lineitem", "documents")]
    return union_all(*parts)


@register("distinct_rows")
def q_distinct_rows(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@register("scalar_max_filter")
def q_scalar_max_filter(spark, sf_dir):
    from hirelake.operators.joins import scalar_max_filter
    e = _table(spark, sf_dir, "events")
    ref = e.filter(F.col("event_type") == "view")
    return scalar_max_filter(e, "value", ref, "value", ">").select("event_id", "event_type", "value")


# -- 2.8 incremental and historical tables ------------------------------------------------------

CUTOFF = "1998-01-01 00:00:00"
T1, T2 = "2026-12-01 00:00:00", "2026-12-02 00:00:00"


def _second_batch(final):
    """The next day's source: expired postings are gone, active ones
    collected before the cutoff are now closed."""
    st = F.col("normalized_job_status")
    old = F.col("collected_at") < F.lit(CUTOFF).cast("timestamp_ntz")
    return final.filter(~st.eqNullSafe("Expired")).withColumn(
        "normalized_job_status", F.when((st == "Active") & old, F.lit("Closed")).otherwise(st))


@register("incremental_since_watermark")
def q_incremental_since_watermark(spark, sf_dir):
    from hirelake.operators.history import incremental_since_watermark
    f = P(spark, sf_dir).final_narrow()
    loaded = f.filter(F.col("collected_at") <= F.lit(CUTOFF).cast("timestamp_ntz"))
    return incremental_since_watermark(f, loaded, "collected_at").select("job_key", "collected_at")


@register("merge_by_key")
def q_merge_by_key(spark, sf_dir):
    from hirelake.operators.history import merge_by_key
    f = P(spark, sf_dir).final_narrow().select("job_key", "normalized_job_status", "collected_at")
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    target = f.filter(F.col("collected_at") <= cut)
    updates = _second_batch(f).filter((F.col("collected_at") > cut) | (F.col("normalized_job_status") == "Closed"))
    return merge_by_key(target, updates, "job_key")


def _two_runs(spark, sf_dir):
    from hirelake.functions import rules
    from hirelake.operators.history import scd2_check
    f = P(spark, sf_dir).final_narrow().select("job_key", *rules.SNAPSHOT_CHECK_COLS, "job_title", "collected_at")
    snap1 = scd2_check(None, f, "job_key", rules.SNAPSHOT_CHECK_COLS, T1)
    return scd2_check(snap1, _second_batch(f), "job_key", rules.SNAPSHOT_CHECK_COLS, T2)


@register("scd2_check")
def q_scd2_check(spark, sf_dir):
    return _two_runs(spark, sf_dir).select("job_key", "normalized_job_status", "dbt_scd_id", "dbt_updated_at",
                                           "dbt_valid_from", "dbt_valid_to")


@register("status_history")
def q_status_history(spark, sf_dir):
    from hirelake.operators.history import status_history
    return status_history(_two_runs(spark, sf_dir), "job_key", ["normalized_job_status"])


# -- 2.11 candidates and phrase resolution over documents ------------------------------------------

def _doc_words(spark, sf_dir, more=None):
    from hirelake.operators.tagging import html_unescape
    d = _table(spark, sf_dir, "documents").select("doc_id", html_unescape("text").alias("text"))
    return d.select("doc_id", F.split(F.col("text") if more is None else F.concat("text", more), " ").alias("words"))


@register("resolve_phrase")
def q_resolve_phrase(spark, sf_dir):
    from hirelake.operators.tagging import resolve_phrase
    from hirelake.sources.catalog import catalog_of
    return resolve_phrase(_table(spark, sf_dir, "documents"), ["doc_id"], "text", catalog_of(spark, sf_dir))


@register("clean_candidate")
def q_clean_candidate(spark, sf_dir):
    from hirelake.operators.tagging import clean_candidate
    words = _doc_words(spark, sf_dir).select("doc_id", F.posexplode("words").alias("position", "word"))
    return words.select("doc_id", "position", clean_candidate("word", unescape=False).alias("candidate"))


def _scored(spark, sf_dir):
    """Words of each text as a model scores them (by their length here); some documents end with symbols, a skill of two words and a sharp s."""
    planted = F.when(F.col("doc_id") % 10 == 0, F.lit(" with C++ from Straße with STRASSE have problem solving")).otherwise(F.lit(""))
    score = lambda w: ((F.length(w) % 4 + 13) / 16.0).cast("double")
    scored = F.transform("words", lambda w: F.struct(w.alias("word"), score(w).alias("score")))
    return _doc_words(spark, sf_dir, planted).select(F.col("doc_id").alias("job_key"), scored.alias("words"))


@register("resolve_scored_candidates")
def q_resolve_scored_candidates(spark, sf_dir):
    from hirelake.operators.tagging import joined_candidates, resolve_scored_candidates
    from hirelake.sources.catalog import catalog_of
    return resolve_scored_candidates(joined_candidates(_scored(spark, sf_dir)), catalog_of(spark, sf_dir), unescape=False)


@register("merge_tag_sources")
def q_merge_tag_sources(spark, sf_dir):
    from hirelake.operators.tagging import joined_candidates, merge_tag_sources, resolve_scored_candidates, tag_texts
    from hirelake.sources.catalog import catalog_of
    catalog = catalog_of(spark, sf_dir)
    model = resolve_scored_candidates(joined_candidates(_scored(spark, sf_dir)), catalog, unescape=False)
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_key"), "text")
    return merge_tag_sources(model, tag_texts(docs, "job_key", "text", catalog))


# -- 2.2 page extraction ----------------------------------------------------------------------------

def _pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages")


def _job_pages(spark, sf_dir):
    from hirelake.sources.job_pages import job_pages
    return job_pages(spark, sf_dir)


PAGE_AS_OF = "2026-12-02 00:00:00"
PAGE_AS_OF_EPOCH = 1796169600  # 2026-12-02 00:00:00 UTC
ORDER_AS_OF_EPOCH = 902016000  # 1998-08-02 00:00:00 UTC


@register("extract_links")
def q_extract_links(spark, sf_dir):
    from hirelake.operators.pages import SITE_LINK, extract_links
    return extract_links(_pages(spark, sf_dir), SITE_LINK)


@register("absolutize_url")
def q_absolutize_url(spark, sf_dir):
    from hirelake.operators.pages import absolutize_url, page_origin
    p = _pages(spark, sf_dir)
    hrefs = p.select("page_id", page_origin("url").alias("root"),
                     F.posexplode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("pos", "href"))
    return hrefs.select("page_id", "pos", absolutize_url("href", F.col("root")).alias("link_url"))


@register("unseen_only")
def q_unseen_only(spark, sf_dir):
    from hirelake.operators.pages import SITE_LINK, extract_links, unseen_only
    p = _pages(spark, sf_dir)
    links = extract_links(p, SITE_LINK)
    return unseen_only(links, "link_url", p, "url", [F.col("page_id").asc(), F.col("pos").asc()])


def _jsonld(spark, sf_dir):
    from hirelake.operators.pages import jsonld_job_posting
    jp = _job_pages(spark, sf_dir)
    return jp.select("page_id", "url", jsonld_job_posting("html").alias("j")).filter(F.col("j").isNotNull())


@register("extract_jsonld")
def q_extract_jsonld(spark, sf_dir):
    from hirelake.operators.pages import jsonld_to_posting
    j = _jsonld(spark, sf_dir)
    cols = jsonld_to_posting("j", "url", PAGE_AS_OF, PAGE_AS_OF_EPOCH)
    return j.select("page_id", *[v.alias(k) for k, v in cols.items()])


@register("json_path_or_empty")
def q_json_path_or_empty(spark, sf_dir):
    from hirelake.operators.pages import json_path_or_empty
    e = _table(spark, sf_dir, "events")
    return e.select("event_id", json_path_or_empty("props", "$.k").alias("k"),
                    json_path_or_empty("props", "$.missing.inner").alias("missing"))


@register("list_to_csv_text")
def q_list_to_csv_text(spark, sf_dir):
    from hirelake.operators.pages import list_to_csv_text
    return _jsonld(spark, sf_dir).select("page_id", list_to_csv_text("j", "$.employmentType").alias("employment_type"))


@register("remote_from_marker")
def q_remote_from_marker(spark, sf_dir):
    from hirelake.operators.pages import remote_from_marker
    return _jsonld(spark, sf_dir).select(
        "page_id", remote_from_marker(F.get_json_object("j", "$.jobLocationType")).alias("workplace_type"))


@register("company_url_slug")
def q_company_url_slug(spark, sf_dir):
    from hirelake.operators.pages import company_url_slug, json_path_or_empty
    j = _jsonld(spark, sf_dir)
    return j.select("page_id", company_url_slug(json_path_or_empty("j", "$.hiringOrganization.name"),
                                                json_path_or_empty("j", "$.hiringOrganization.sameAs")).alias("company_url"))


@register("disclosed_flag")
def q_disclosed_flag(spark, sf_dir):
    from hirelake.operators.pages import card_attr, card_elements, disclosed_not_blank
    c = card_elements(_job_pages(spark, sf_dir))
    return c.select("page_id", disclosed_not_blank(card_attr("attrs", "data-job-salary")).alias("is_salary_disclosed"))


@register("extract_card_attributes")
def q_extract_card_attributes(spark, sf_dir):
    from hirelake.operators.pages import card_elements, card_to_posting
    c = card_elements(_job_pages(spark, sf_dir))
    return c.select("page_id", *[v.alias(k) for k, v in card_to_posting("attrs", "inner", PAGE_AS_OF).items()])


@register("parse_location_text")
def q_parse_location_text(spark, sf_dir):
    from hirelake.operators.pages import card_attr, card_elements, parse_location_text
    c = card_elements(_job_pages(spark, sf_dir))
    country, city = parse_location_text(card_attr("attrs", "data-job-country"), card_attr("attrs", "data-job-state"),
                                        card_attr("attrs", "data-job-workplace-location"))
    return c.select("page_id", country.alias("country"), city.alias("city"))


@register("map_city_to_region")
def q_map_city_to_region(spark, sf_dir):
    from hirelake.operators.pages import card_attr, card_elements, map_city_to_region
    c = card_elements(_job_pages(spark, sf_dir)).select("page_id", card_attr("attrs", "data-job-state").alias("city"))
    return c.select("page_id", "city", map_city_to_region("city").alias("region"))


@register("reassemble_embedded_json")
def q_reassemble_embedded_json(spark, sf_dir):
    from hirelake.operators.pages import reassemble_embedded_json
    jp = _job_pages(spark, sf_dir)
    uuid = F.concat_ws("-", *[F.substring(F.md5(F.col("page_id").cast("string")), a, b)
                              for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    o = jp.select("page_id", reassemble_embedded_json("html", uuid).alias("obj"))
    return o.select("page_id", F.get_json_object("obj", "$.jobPositionValue").alias("job_title"),
                    F.get_json_object("obj", "$.cityValue").alias("city"),
                    F.get_json_object("obj", "$.experienceYears").alias("experience_years"))


@register("embedded_to_posting")
def q_embedded_to_posting(spark, sf_dir):
    from hirelake.operators.embedded import embedded_to_posting
    uuid = F.concat_ws("-", *[F.substring(F.md5(F.col("page_id").cast("string")), a, b)
                              for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return embedded_to_posting(_job_pages(spark, sf_dir), uuid, PAGE_AS_OF, ["page_id"])


#: Markup that a pattern of plain tags reads wrongly.
ODD_MARKUP = ('<p title="a > b" data-x=\'c > d\'>kept</p><!-- gone <b>x</b> > --><script type="x > y">var s = "<p>gone</p>" > 1;</script>'
              '<STYLE>p > a { color: red }</STYLE >if a < b then<br/>1 <2 tail')


@register("html_to_text")
def q_html_to_text(spark, sf_dir):
    from hirelake.operators.pages import html_to_text
    return _pages(spark, sf_dir).select("page_id", html_to_text(F.concat("html", F.lit(ODD_MARKUP))).alias("text"))


@register("strip_markup_symbols")
def q_strip_markup_symbols(spark, sf_dir):
    from hirelake.operators.pages import strip_markup_symbols
    d = _table(spark, sf_dir, "documents").select("doc_id", strip_markup_symbols("text").alias("t"))
    return d.select("doc_id", F.length("t").alias("text_chars"), F.md5("t").alias("text_md5"))


@register("heading_text")
def q_heading_text(spark, sf_dir):
    from hirelake.operators.pages import heading_text
    return _pages(spark, sf_dir).select("page_id", heading_text("html").alias("heading"))


@register("first_present")
def q_first_present(spark, sf_dir):
    from hirelake.functions.text import first_present
    raw = P(spark, sf_dir).raw
    return raw.select("source_job_id", "url", "collected_at",
                      first_present("experience_years", "job_posted_date", "job_source").alias("first_value"))


@register("first_truthy_key")
def q_first_truthy_key(spark, sf_dir):
    from hirelake.operators.pages import first_truthy_key, json_path_or_empty
    values = ['"0"', "0", "false", '"false"', '" "', "[]", "{}", "null", '""', "0.0", '"" ', "7"]
    a = F.array([F.lit(v) for v in values])[(F.col("event_id") % len(values)).cast("int")]
    j = F.concat(F.lit('{"a":'), a, F.lit(',"b":"'), json_path_or_empty("props", "$.k"), F.lit('"}'))
    e = _table(spark, sf_dir, "events").select("event_id", j.alias("j"))
    return e.select("event_id", first_truthy_key("j", ["$.a", "$.missing", "$.b"]).alias("value"))


@register("id_from_url")
def q_id_from_url(spark, sf_dir):
    from hirelake.operators.pages import id_from_url
    return _pages(spark, sf_dir).select("page_id", "url", id_from_url("url").alias("url_id"))


@register("map_codes")
def q_map_codes(spark, sf_dir):
    from hirelake.operators.normalize import map_codes
    o = _table(spark, sf_dir, "orders")
    return o.select("o_orderkey", map_codes("o_orderstatus", [("Finished", ["F"]), ("Open", ["O"])], key=None)
                    .alias("status_label"))


@register("normalize_experience_text")
def q_normalize_experience_text(spark, sf_dir):
    from hirelake.operators.pages import normalize_experience_text
    raw = P(spark, sf_dir).raw
    return raw.select("source_job_id", "url", "collected_at", "experience_years",
                      normalize_experience_text("experience_years").alias("experience_text"))


@register("months_to_years")
def q_months_to_years(spark, sf_dir):
    from hirelake.operators.pages import months_to_years
    li = _table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", months_to_years("l_quantity").alias("years"))


@register("expiry_status")
def q_expiry_status(spark, sf_dir):
    from hirelake.functions.dates import expiry_status
    o = _table(spark, sf_dir, "orders")
    return o.select("o_orderkey", expiry_status(F.col("o_orderdate").cast("string"), ORDER_AS_OF_EPOCH).alias("status"))


@register("epoch_to_date")
def q_epoch_to_date(spark, sf_dir):
    from hirelake.functions.dates import epoch_to_date_text
    e = _table(spark, sf_dir, "events")
    return e.select("event_id", epoch_to_date_text(F.col("value") * 10000000,
                                                   F.substring(F.col("ts").cast("string"), 1, 10)).alias("posted"))


@register("dedupe_keep_missing_ids")
def q_dedupe_keep_missing_ids(spark, sf_dir):
    from hirelake.operators.dedupe import dedupe_keep_missing_ids
    raw = P(spark, sf_dir).raw.select("source_job_id", "url", "collected_at")
    return dedupe_keep_missing_ids(raw, "source_job_id", [F.col("url").asc(), F.col("collected_at").asc_nulls_first()])


# -- 2.1 sources, sinks, ingestion ------------------------------------------------------------------

def _platform_of_url():
    u = F.col("url")
    return (F.when(u.contains("sabbar.com"), F.lit("sabbar")).when(u.contains("tanqeeb.com"), F.lit("tanqeeb"))
            .when(u.contains("gulftalent.com"), F.lit("golftalent")).otherwise(F.lit(None).cast("string")))


def _landed(spark, sf_dir, label):
    """Write the derived postings as landed CSV files under platform folders."""
    from hirelake.sources.bronze import scratch_dir, write_csv
    from hirelake.sources.bronze import conform_columns
    land = scratch_dir(spark, label)
    raw = conform_columns(P(spark, sf_dir).raw).withColumn("platform", _platform_of_url())
    write_csv(raw, land, partition_by=["platform"])
    return land


@register("read_bronze")
def q_read_bronze(spark, sf_dir):
    from hirelake.sources.bronze import read_bronze
    return _text_digest(read_bronze(spark, _landed(spark, sf_dir, "bronze")))


@register("ingest_new_files")
def q_ingest_new_files(spark, sf_dir):
    from hirelake.sources.bronze import scratch_dir, write_csv
    from hirelake.streaming.ingest import ingest_new_files, read_quarantine, read_raw
    from hirelake.sources.bronze import conform_columns
    land, table, ckpt = (scratch_dir(spark, x) for x in ("landing", "raw-table", "ingest-ckpt"))
    raw = conform_columns(P(spark, sf_dir).raw).withColumn("platform", _platform_of_url())
    first = raw.filter(F.col("platform").isin("sabbar", "tanqeeb"))
    second = raw.filter(~F.col("platform").isin("sabbar", "tanqeeb") | F.col("platform").isNull())
    write_csv(first, land, "append", ["platform"])
    ingest_new_files(spark, land, table, ckpt)
    write_csv(second, land, "append", ["platform"])
    # rows with too few and too many fields
    nation = _table(spark, sf_dir, "nation")
    for n in (3, 25):
        write_csv(nation.select(*[F.col("n_name").alias(f"c{i}") for i in range(n)]), f"{land}/platform=unknown", "append")
    ingest_new_files(spark, land, table, ckpt)
    ingest_new_files(spark, land, table, ckpt)  # nothing new: appends nothing
    rows = _text_digest(read_raw(spark, table).drop("row_id", "description_id", "collected_ts"))
    broken = read_quarantine(spark, table).select(*[F.lit(None).cast(t).alias(c) if c != "platform" else F.lit("(bad row)").alias(c) for c, t in rows.dtypes])
    return rows.unionByName(broken)


def _text_digest(df):
    """The description as a digest: line breaks and quotes are compared, the text does not leave Spark."""
    return df.withColumn("description_sha256", F.sha2("description", 256)).drop("description")


@register("quarantine_bad_rows")
def q_quarantine_bad_rows(spark, sf_dir):
    from hirelake.sources.bronze import quarantine_bad_rows, write_csv
    land = _landed(spark, sf_dir, "quarantine")
    nation = _table(spark, sf_dir, "nation")
    wide = nation.select(*[F.col("n_name").alias(f"c{i}") for i in range(20)])
    write_csv(wide, f"{land}/platform=unknown", "append")
    good, bad = quarantine_bad_rows(spark, land)
    return good.groupBy(F.lit("good").alias("kind")).agg(F.count(F.lit(1)).alias("row_count")).unionByName(
        bad.groupBy(F.lit("bad").alias("kind")).agg(F.count(F.lit(1)).alias("row_count")))


@register("route_by_platform")
def q_route_by_platform(spark, sf_dir):
    from hirelake.sources.bronze import conform_columns, land_files, route_by_platform, scratch_dir
    land, bronze = scratch_dir(spark, "flat-landing"), scratch_dir(spark, "routed")
    raw = conform_columns(P(spark, sf_dir).raw)
    keyword = _file_keyword()
    name = F.concat(F.lit("2026-12-02_"), F.when(keyword == "sabbar", F.upper(keyword)).otherwise(keyword), F.lit("_jobs"))
    # a folder name never counts, so the landing folder carries a misleading one
    land_files(raw.withColumn("__file", name), f"{land}/tanqeeb_drop", "__file")
    return _text_digest(route_by_platform(spark, f"{land}/tanqeeb_drop", bronze))


def _file_keyword():
    """The site a posting's file is named after; postings of one source come in files of their own."""
    u = F.col("url")
    return (F.when(F.col("job_source") == "Jadarat.com", F.lit("jadarat")).when(u.contains("sabbar.com"), F.lit("sabbar"))
            .when(u.contains("tanqeeb.com"), F.lit("tanqeeb")).when(u.contains("gulftalent.com"), F.lit("gulftalent")).otherwise(F.lit("other")))


@register("read_seed")
def q_read_seed(spark, sf_dir):
    from hirelake.sources.bronze import scratch_dir
    from hirelake.sources.seeds import CITY_REGION_SCHEMA, read_seed
    path = scratch_dir(spark, "seed")
    n, r = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    seed = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.upper("n_name").alias("raw_value_normalized"), F.col("n_name").alias("mapped_city"),
        F.col("r_name").alias("mapped_region"))
    seed.coalesce(1).write.option("header", True).csv(path)
    return read_seed(spark, path, CITY_REGION_SCHEMA, key="raw_value_normalized")


@register("conform_columns")
def q_conform_columns(spark, sf_dir):
    from hirelake.sources.bronze import union_conformed
    raw = P(spark, sf_dir).raw
    site = _platform_of_url()
    a = raw.filter(site == "sabbar")
    b = raw.filter(site == "tanqeeb").drop("description", "industry")
    c = raw.filter(~site.isin("sabbar", "tanqeeb") | site.isNull()).withColumnRenamed(
        "source_job_id", "job_id").withColumn("junk", F.lit("x"))
    from hirelake.sources.bronze import conform_columns
    c = conform_columns(c, renames={"job_id": "source_job_id"})
    return _text_digest(union_conformed([a, b, c]))


@register("write_csv_snapshot")
def q_write_csv_snapshot(spark, sf_dir):
    from hirelake.sources.bronze import scratch_dir, write_csv_snapshot
    from hirelake.sources.bronze import conform_columns
    path = scratch_dir(spark, "snapshot-csv")
    raw = conform_columns(P(spark, sf_dir).raw)
    write_csv_snapshot(raw.filter(F.col("url").contains("sabbar.com")), path)
    return _text_digest(write_csv_snapshot(raw, path))


@register("materialize")
def q_materialize(spark, sf_dir):
    """All four kinds; a version of the table that was only written in part lies beside it."""
    from hirelake.sources.bronze import materialize, scratch_dir
    cols = ["job_key", "normalized_job_status", "collected_at"]
    f = P(spark, sf_dir).final_narrow().select(*cols).persist()
    first = f.filter(F.col("collected_at") <= F.lit(CUTOFF).cast("timestamp_ntz"))
    view = materialize(first, "view", name="first_postings")
    path = scratch_dir(spark, "table")
    materialize(f, "table", path=path)
    table = materialize(first, "table", path=path, keep=1)
    f.limit(5).write.parquet(f"{path}/version=3")  # no pointer: never read
    path = scratch_dir(spark, "incremental")
    for batch in (first, f):
        merged = materialize(batch, "incremental", path=path, key="job_key", watermark="collected_at")
    path = scratch_dir(spark, "snapshot")
    for ts, source in ((T1, f), (T2, _second_batch(f))):
        snapshot = materialize(source, "snapshot", path=path, key="job_key", check_cols=["normalized_job_status"], run_ts=ts, keep=1)
    parts = {"view": view, "table": table, "incremental": merged, "snapshot": snapshot}
    out = None
    for kind, df in parts.items():
        valid_to = F.col("dbt_valid_to") if kind == "snapshot" else F.lit(None).cast("timestamp_ntz")
        df = df.select(F.lit(kind).alias("kind"), *cols, valid_to.alias("valid_to"))
        out = df if out is None else out.unionByName(df)
    return out


@register("append_log")
def q_append_log(spark, sf_dir):
    from hirelake.operators.tagging import tag_postings, tag_run_log, with_live_text
    from hirelake.sources.bronze import append_log, scratch_dir
    from hirelake.sources.catalog import catalog_of
    path, p = scratch_dir(spark, "tag-log"), P(spark, sf_dir)
    catalog, texts = catalog_of(spark, sf_dir), p.texts()
    final = p.final_narrow().select("job_key", "collected_at", "description_id")
    early = final.filter(F.col("collected_at") <= F.lit(CUTOFF).cast("timestamp_ntz"))
    run1 = tag_postings(early, catalog, texts=texts)
    work1 = with_live_text(early, texts).select("job_key").distinct()
    append_log(tag_run_log(work1, run1, T1), path)
    logged = spark.read.parquet(path)
    run2 = tag_postings(final, catalog, log=logged, texts=texts)
    work2 = with_live_text(final, texts).select("job_key").distinct().join(
        logged.select("job_key"), "job_key", "left_anti")
    append_log(tag_run_log(work2, run2, T2), path)
    return spark.read.parquet(path)


# -- further forms of registered operators ------------------------------------------------------------

@register("date_profile")
def q_date_profile(spark, sf_dir):
    from hirelake.operators.profiling import coerce_dates, date_profile
    raw = P(spark, sf_dir).raw.select("job_posted_date")
    return date_profile(coerce_dates(raw, "job_posted_date"), "job_posted_date")


@register("ranked_frequencies")
def q_ranked_frequencies(spark, sf_dir):
    from hirelake.operators.profiling import ranked_frequencies
    return ranked_frequencies(_table(spark, sf_dir, "documents"), "lang")


@register("dedupe_counts")
def q_dedupe_counts(spark, sf_dir):
    from hirelake.operators.dedupe import dedupe_counts
    return dedupe_counts(P(spark, sf_dir).raw, "source_job_id")


@register("check_posted_dates_as_of")
def q_check_posted_dates_as_of(spark, sf_dir):
    from hirelake.operators.checks import check_posted_dates
    return check_posted_dates(P(spark, sf_dir).final_narrow(), "1998-01-01", ["job_key"])


@register("check_not_null_warn")
def q_check_not_null_warn(spark, sf_dir):
    from hirelake.operators.checks import check_not_null
    return check_not_null(P(spark, sf_dir).located(), "normalized_region_name", "warn", ID)


@register("map_codes_default")
def q_map_codes_default(spark, sf_dir):
    from hirelake.operators.normalize import map_codes
    o = _table(spark, sf_dir, "orders")
    label = map_codes("o_orderstatus", [("closed", ["F"])], default="active", passthrough=False)
    return o.select("o_orderkey", label.alias("status_label"))


@register("disclosed_not_null")
def q_disclosed_not_null(spark, sf_dir):
    from hirelake.operators.pages import disclosed_not_null
    j = _jsonld(spark, sf_dir)
    return j.select("page_id", disclosed_not_null(F.get_json_object("j", "$.baseSalary.value.value")).alias("is_salary_disclosed"))
