import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from hirelake.functions.dates import parse_posted_date
from hirelake.functions.keys import surrogate_key
from hirelake.functions.text import initcap_delims, try_boolean
from hirelake.operators import normalize as N

D = dt.date


def test_posted_dates_relative_to_collection(spark):
    cases = [
        ("yesterday", D(2026, 12, 1)), ("3 days ago", D(2026, 11, 29)), ("45 minutes ago", D(2026, 12, 1)),
        ("today", None), ("2 hours ago", D(2026, 12, 1)), ("last week", None), ("1 week ago", D(2026, 11, 25)),
        ("2 months ago", None), ("monday", D(2026, 11, 30)), ("03 Feb 2026", D(2026, 2, 3)),
        ("wednesday", D(2026, 12, 2)), ("2026-01-15", D(2026, 1, 15)), ("Saturday", D(2026, 11, 28)),
        ("Monday, 3 days ago", D(2026, 11, 29)), ("02/05/2026", D(2026, 2, 5)), (None, None),
    ]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string").withColumn(
        "ts", F.lit("2026-12-02 00:30:00").cast("timestamp_ntz"))
    got = rows(df.select("t", parse_posted_date("t", "ts").alias("d")))
    assert got == [(t, d) for t, d in cases]


def test_experience_ranges_and_seniority(spark):
    cases = [
        (None, None, None, None, "Not Specified"), ("", None, None, False, "Not Specified"),
        ("5-10 yrs", 5, 10, False, "Senior-level"), ("10+ yrs", 10, None, True, "Executive / Director"),
        ("+5", 5, None, True, "Senior-level"), ("3+", 3, None, True, "Associate / Mid-level"),
        ("1+", 1, None, True, "Entry-level"), ("Fresh graduate", 0, 0, False, "Entry-level"),
        ("up to 3 years", 0, 3, False, "Associate / Mid-level"),
        ("less than a year", 0, None, False, "Executive / Director"),
        ("up to 5+", 0, 5, True, "Entry-level"), ("2.5", 2, 5, False, "Associate / Mid-level"),
        ("02/05/2026", None, None, False, "Not Specified"), ("20", 20, 20, False, "Executive / Director"),
        ("15-7", 15, 7, False, "Senior-level"),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "e string")
    df = df.withColumns(N.experience_parts("e"))
    df = df.withColumns(N.experience_range("experience_years_clean", "is_date_like", "exp_num1", "exp_num2",
                                           "is_fresh", "is_open_ended", "is_upper_bound_only"))
    df = df.withColumn("s", N.derive_seniority("experience_min_years", "experience_max_years", "is_open_ended"))
    got = rows(df, "e", "experience_min_years", "experience_max_years", "experience_is_open_ended", "s")
    assert got == cases


def test_region_rules_without_mapping(spark):
    cases = [("al-khobar", "Eastern Province"), ("x &amp;#1575; y", None), ("Saudi Arabia - Abha", "Abha"),
             ("Saudi Arabia", None), ("foo-bar region", "Foo-Bar Region"), ("riyadh region", "Riyadh Province")]
    df = spark.createDataFrame([(r, None) for r, _ in cases], "region string, seed string")
    assert rows(df.select("region", N.normalize_region("region", "seed"))) == cases


def test_mapped_region_wins_unless_blank(spark):
    df = spark.createDataFrame([("Riyadh", "Mapped"), ("Riyadh", " ")], "region string, seed string")
    assert [r[0] for r in rows(df.select(N.normalize_region("region", "seed")))] == ["Mapped", "Riyadh Province"]


def test_initcap_starts_words_after_punctuation(spark):
    df = spark.createDataFrame([("dhahran/ al-khobar (hub-based with x)",), ("IT",), ("HR",), (None,)], "s string")
    assert [r[0] for r in rows(df.select(initcap_delims("s")))] == [
        "Dhahran/ Al-Khobar (Hub-Based With X)", "It", "Hr", None]


def test_category_rules(spark):
    cases = [("IT", "Anything", "It", False), ("information technology", "x", "IT", False),
             ("", "Data Analyst", "IT", True), (" ", "Chef", None, False), (None, "Software Engineer", "Engineering", True)]
    df = spark.createDataFrame([(a, b) for a, b, _, _ in cases], "c string, t string")
    df = df.withColumn("d", N.category_from_title("t")).withColumns(N.normalize_category("c", "d"))
    got = rows(df, "normalized_job_category", "is_category_derived_from_title")
    assert got == [(n, f) for _, _, n, f in cases]


def test_channel_rules_keep_three_valued_logic(spark):
    cases = [("https://saudi.tanqeeb.com/jobs/1", "GulfTalent", "Aggregated via Tanqeeb"),
             ("https://saudi.tanqeeb.com/jobs/1", None, "Direct"),
             ("https://sabbar.com/en/jobs/x", "AGGREGATED", "Direct"),
             ("https://sabbar.com/en/jobs/x", "Aggregated (source not specified)", "Aggregated via Sabbar")]
    df = spark.createDataFrame([(u, s) for u, s, _ in cases], "u string, s string")
    assert [r[0] for r in rows(df.select(N.derive_channel("u", "s")))] == [c for _, _, c in cases]


def test_forgiving_boolean(spark):
    df = spark.createDataFrame([("True",), ("off",), ("yes",), ("maybe",), ("",), (None,)], "b string")
    assert [r[0] for r in rows(df.select(try_boolean("b")))] == [True, False, True, None, None, None]


def test_surrogate_key_distinguishes_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a")], "x string, y string")
    k = [r[0] for r in rows(df.select(surrogate_key("x", "y")))]
    assert k[0] != k[1] and all(len(v) == 32 for v in k)
