"""Postings from the objects that page scripts carry.

The object is cut out of the page once (``reassemble_embedded_json``) and parsed once,
by one ``from_json`` with a schema: values that may have any type are variants, so
that 0, false and "" can be told from text.  Codes are translated by tables of
(code, label) joined on the code; whether a table is broadcast is left to Spark's byte
threshold, and the tables are data, not part of the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import col, ColumnOrName, first_present
from hirelake.operators.pages import (
    SITE_ROOT_EMBEDDED, heading_text, html_to_text, jsonld_job_posting, normalize_experience_text, reassemble_embedded_json,
    strip_markup_symbols, truthy,
)

#: Values of any type; the rest is text.
ANY = sorted({*rules.EMBEDDED_EXPERIENCE_KEYS, *rules.EMBEDDED_INDUSTRY_KEYS, *rules.EMBEDDED_SOURCE_KEYS, "salary", "createdDate", "cityValue",
              "countryValue", "partnerSlug"})
TEXT = ["jobPositionValue", "partnerName", "city", "contractType", "workplaceType", "jobStatus"]
OBJECT_SCHEMA = ", ".join([f"{k} variant" for k in ANY] + [f"{k} string" for k in TEXT])
LINKED_SCHEMA = ("hiringOrganization struct<name:string>, experienceRequirements variant, industry variant, occupationalCategory variant, "
                 "baseSalary variant, datePosted string, description string")
COMPANY_LINK = (r"""(?is)<a\b(?:[^>"']|"[^"]*"|'[^']*')*?\bhref="([^"]*""" + rules.EMBEDDED_COMPANY_PATH
                + r"""[^"]*)"(?:[^>"']|"[^"]*"|'[^']*')*>(.*?)</a\s*>""")


def code_table(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(pairs), "code string, label string")


def site_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The site's own code tables, by the column they fill."""
    return {"region": code_table(spark, rules.EMBEDDED_CITY_REGION), "employment_type": code_table(spark, rules.EMBEDDED_CONTRACT),
            "workplace_type": code_table(spark, rules.EMBEDDED_WORKPLACE), "job_status": code_table(spark, rules.EMBEDDED_STATUS)}


def with_label(df: DataFrame, code: str, table: DataFrame, other: Column | None = None) -> DataFrame:
    """``code`` replaced by its label; a code without one becomes ``other`` (default: null).

    A code given twice has its smallest label, so no row is repeated.
    """
    labels = table.groupBy(F.col("code").alias("__code")).agg(F.min("label").alias("__label"))
    joined = df.join(labels, F.col(code) == F.col("__code"), "left")
    label = F.col("__label") if other is None else F.coalesce("__label", other)
    return joined.withColumn(code, label).drop("__code", "__label")


def text_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def if_truthy(v: Column) -> Column:
    return F.when(truthy(v), text_of(v))


def first_key(obj: ColumnOrName, keys: Sequence[str]) -> Column:
    """The first truthy value among the keys, as a variant."""
    return F.get(F.filter(F.array(*[col(obj)[k] for k in keys]), truthy), 0)


def experience_value(v: Column) -> Column:
    """A number as it is, text by the rules of ``normalize_experience_text``, anything else null."""
    kind = F.schema_of_variant(v)
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(number, text_of(v)).when(kind == "STRING", normalize_experience_text(text_of(v)))


def linked_experience(requirements: Column) -> Column:
    """Experience of the page's JSON-LD: months of an object in years, else the value itself."""
    is_object = F.schema_of_variant(requirements).startswith("OBJECT")
    months = F.try_variant_get(requirements, "$.monthsOfExperience", "string").try_cast("double")
    return F.when(is_object, (months / 12).cast("string")).otherwise(experience_value(requirements))


def created_date(v: Column) -> Column:
    """A number of seconds since 1970 as a day; null, 0 and what is no number: null."""
    kind = F.schema_of_variant(v)
    seconds = F.when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.try_variant_get(v, "$", "double"))
    day = F.floor(seconds / 86400)
    return F.when((seconds != 0) & day.between(-719162, 2932896), F.date_format(F.date_from_unix_date(day.cast("int")), "yyyy-MM-dd"))


def embedded_to_posting(pages: DataFrame, object_id: ColumnOrName, as_of: str, keep: Sequence[str] = (),
                        tables: Mapping[str, DataFrame] | None = None, html: str = "html", url: str = "url") -> DataFrame:
    """``keep`` and the 19 raw columns of every page, from its heading, the embedded
    object with id ``object_id``, and its JSON-LD where the object says nothing.

    A page without an object (or a broken one) still gives a row.  Missing
    values are null; a country defaults to the site's, a status to active.
    """
    tables = site_tables(pages.sparkSession) if tables is None else tables
    o, d = F.col("__o"), F.col("__d")
    p = pages.withColumns({
        "__id": col(object_id),
        "__o": F.from_json(reassemble_embedded_json(html, object_id), OBJECT_SCHEMA),
        "__d": F.from_json(jsonld_job_posting(html), LINKED_SCHEMA),
        "__href": F.nullif(F.regexp_extract(html, COMPANY_LINK, 1), F.lit("")),
        "__link": F.nullif(F.regexp_extract(html, COMPANY_LINK, 2), F.lit("")),
        "__title": heading_text(html)})
    salary = F.coalesce(F.schema_of_variant(o["salary"]) != "VOID", F.lit(False))
    linked_salary = F.try_variant_get(d["baseSalary"], "$.value.value", "variant")
    experience = first_key(o, rules.EMBEDDED_EXPERIENCE_KEYS)
    root = F.lit(SITE_ROOT_EMBEDDED)
    rows = p.select(*keep, *[v.alias(c) for c, v in {
        "source_job_id": F.col("__id"),
        "job_title": first_present(F.col("__title"), o["jobPositionValue"]),
        "url": col(url),
        "company_name": first_present(html_to_text(F.col("__link")), o["partnerName"], d["hiringOrganization"]["name"]),
        "company_url": F.coalesce(F.when(F.col("__href").startswith("/"), F.concat(root, F.col("__href"))),
                                  F.concat(root, F.lit(rules.EMBEDDED_COMPANY_PATH), if_truthy(o["partnerSlug"]))),
        "city": if_truthy(o["cityValue"]),
        "region": o["city"],
        "country": F.coalesce(if_truthy(o["countryValue"]), F.lit(rules.EMBEDDED_COUNTRY)),
        "employment_type": o["contractType"],
        "workplace_type": o["workplaceType"],
        "experience_years": F.when(experience.isNotNull(), experience_value(experience)).otherwise(linked_experience(d["experienceRequirements"])),
        "job_category": text_of(first_key(o, rules.EMBEDDED_CATEGORY_KEYS)),
        "industry": text_of(F.coalesce(first_key(o, rules.EMBEDDED_INDUSTRY_KEYS), first_key(d, ["industry", "occupationalCategory"]))),
        "is_salary_disclosed": salary | F.coalesce(F.schema_of_variant(linked_salary) != "VOID", F.lit(False)),
        "job_source": text_of(first_key(o, rules.EMBEDDED_SOURCE_KEYS)),
        "job_posted_date": F.coalesce(created_date(o["createdDate"]), F.nullif(d["datePosted"], F.lit(""))),
        "job_status": o["jobStatus"],
        "collected_at": F.lit(as_of),
        "description": F.when(d["description"] != "", strip_markup_symbols(d["description"])),
    }.items()])
    others = {"region": None, "employment_type": F.col("employment_type"), "workplace_type": F.col("workplace_type"),
              "job_status": F.lit(rules.EMBEDDED_STATUS_OTHER)}
    for column, other in others.items():
        rows = with_label(rows, column, tables[column], other)
    return rows.select(*keep, *rules.RAW_COLUMNS)
