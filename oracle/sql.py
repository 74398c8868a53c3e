"""Independent DuckDB SQL for every registered query.

The postings chain is written out as SQL CTEs (``WITH raw AS (...), stg AS
(...), ...``); each oracle is the chain up to the stage it needs followed by
its own ``SELECT``.  The SQL uses DuckDB's own functions (ILIKE, QUALIFY,
``regexp_extract_all(...)[n]``, ``try_strptime``) rather than mirroring the
Spark expressions, so the two sides only agree when the logic does.
Rule values are stated in :mod:`oracle.values`; only the texts that derive the
fixture tables (postings, pages, seed, phrases) are shared with the library.
"""

from __future__ import annotations

from oracle import values as R
from hirelake.sources.catalog import BENCHMARK_PHRASES_SQL, FIXED_ENTRIES
from hirelake.sources.fixture import postings_sql_for
from hirelake.sources.seeds import city_region_values_sql


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


_DELIM_CLASS = "[\\s" + "".join("\\" + ch for ch in R.INITCAP_DELIMITERS) + "]"


def initcap(x: str) -> str:
    """Delimiter-aware initcap in DuckDB (no built-in exists)."""
    return (
        f"array_to_string(list_transform(range(1, length({x}) + 1), lambda i: "
        f"CASE WHEN i = 1 OR regexp_matches(substr({x}, i - 1, 1), '{_DELIM_CLASS}') "
        f"THEN upper(substr({x}, i, 1)) ELSE lower(substr({x}, i, 1)) END), '')"
    )


def T(x: str) -> str:
    """Space-only trim (the warehouse and Spark default)."""
    return f"trim({x}, ' ')"


def skey(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), {q(R.SURROGATE_NULL)})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def nth_digits(x: str, n: int) -> str:
    return f"try_cast(regexp_extract_all({x}, '\\d+')[{n}] AS INTEGER)"


def _case_aliases(key: str, table, other: str) -> str:
    arms = " ".join(f"WHEN {key} IN {in_list(a)} THEN {q(label)}" for label, a in table)
    return f"CASE {arms} ELSE {other} END"


def _region_case() -> str:
    ic = "region_ic"
    arms = " ".join(f"WHEN {ic} IN {in_list(names)} THEN {q(canon)}" for canon, names in R.REGION_ALIASES)
    garbage = " OR ".join(f"region LIKE {q('%' + m + '%')}" for m in R.REGION_GARBAGE_MARKERS)
    p = R.REGION_COUNTRY_PREFIX
    return (
        f"CASE WHEN {garbage} THEN NULL "
        f"WHEN seed_mapped_region IS NOT NULL AND {T('seed_mapped_region')} <> '' THEN seed_mapped_region "
        f"{arms} "
        f"WHEN {ic} LIKE {q(p + '%')} THEN replace({ic}, {q(p)}, '') "
        f"WHEN {ic} = {q(R.REGION_COUNTRY_NAME)} THEN NULL ELSE {ic} END"
    )


def _posted_date_case() -> str:
    low = f"lower({T('job_posted_date')})"
    n = nth_digits("job_posted_date", 1)
    wd = " ".join(f"WHEN {q(d)} THEN {i}" for i, d in enumerate(R.WEEKDAYS))
    s = "job_posted_date"
    digits = f"CASE WHEN regexp_full_match({s}, '\\d+') THEN try_cast({s} AS BIGINT) END"
    secs = (f"CASE WHEN {digits} < 31536000000 THEN {digits} WHEN {digits} < 31536000000000 THEN floor({digits} / 1000) "
            f"WHEN {digits} < 31536000000000000 THEN floor({digits} / 1000000) ELSE floor({digits} / 1000000000) END")
    auto = (f"coalesce(CAST(try_strptime({s}, '%Y-%m-%d') AS DATE), CAST(try_cast({s} AS TIMESTAMP) AS DATE), "
            f"CAST(try_strptime({s}, '%d-%b-%Y') AS DATE), CAST(try_strptime({s}, '%m/%d/%Y') AS DATE), "
            f"DATE '1970-01-01' + CAST({secs} AS INTEGER))")
    dmy = f"CAST(try_strptime({T(s)}, '%d %b %Y') AS DATE)"
    return (
        f"CASE WHEN {low} = 'yesterday' THEN CAST(collected_at AS DATE) - 1 "
        f"WHEN {low} LIKE '%minute%' THEN CAST(collected_at - to_minutes({n}) AS DATE) "
        f"WHEN {low} LIKE '%hour%' THEN CAST(collected_at - to_hours({n}) AS DATE) "
        f"WHEN {low} LIKE '%week%' THEN CAST(collected_at - to_days(7 * {n}) AS DATE) "
        f"WHEN {low} IN {in_list(R.WEEKDAYS)} THEN CAST(collected_at AS DATE) - "
        f"CAST(((dayofweek(collected_at) - CASE {low} {wd} END + 7) % 7) AS INTEGER) "
        f"WHEN {low} LIKE '%day%' THEN CAST(collected_at - to_days({n}) AS DATE) "
        f"WHEN {dmy} IS NOT NULL THEN {dmy} "
        f"WHEN {auto} IS NOT NULL THEN {auto} ELSE NULL END"
    )


def _category_title_case() -> str:
    arms = []
    for label, pats in R.CATEGORY_TITLE_RULES:
        cond = " OR ".join(f"job_title ILIKE {q(p)}" for p in pats)
        arms.append(f"WHEN {cond} THEN {q(label)}")
    return "CASE " + " ".join(arms) + " ELSE NULL END"


def _seniority_case() -> str:
    arms = ["WHEN experience_min_years IS NULL THEN " + q(R.SENIORITY_NOT_SPECIFIED)]
    for f, label in R.SENIORITY_OPEN_LADDER:
        arms.append(f"WHEN is_open_ended AND experience_min_years >= {f} THEN {q(label)}")
    arms.append(f"WHEN is_open_ended THEN {q(R.SENIORITY_OPEN_DEFAULT)}")
    for c, label in R.SENIORITY_CLOSED_LADDER:
        arms.append(f"WHEN experience_max_years <= {c} THEN {q(label)}")
    return "CASE " + " ".join(arms) + f" ELSE {q(R.SENIORITY_CLOSED_DEFAULT)} END"


def _bool(x: str) -> str:
    v = f"lower({T(x)})"
    return f"CASE WHEN {v} IN {in_list(R.BOOLEAN_TRUE)} THEN true WHEN {v} IN {in_list(R.BOOLEAN_FALSE)} THEN false END"


URL_CITY = (f"CASE WHEN job_url LIKE '%sabbar.com%' THEN "
            f"replace(nullif(regexp_extract(job_url, '/c-(.+?)-r-', 1), ''), '-', ' ') END")

PREF_PART = f"{T('lower(job_title)')}, {T('lower(company_name)')}, normalized_city_name"

CHAIN: list[tuple[str, str]] = [
    ("raw", postings_sql_for()),
    ("stg", f"""
SELECT source_job_id, replace(job_title, {q(R.TITLE_SUFFIX_TO_DROP)}, '') AS job_title, url AS job_url,
 company_name, company_url, replace(industry, ' &amp; ', ' & ') AS company_industry, city, region, country,
 employment_type, workplace_type, experience_years, job_category, {_bool('is_salary_disclosed')} AS is_salary_disclosed,
 try_cast(collected_at AS TIMESTAMP) AS collected_at, replace(job_source, '.com', '') AS job_source,
 job_posted_date, job_status, description, row_id
FROM raw WHERE source_job_id IS NOT NULL AND {T('source_job_id')} <> ''"""),
    ("city_resolved", f"SELECT *, {URL_CITY} AS url_city_raw, coalesce({URL_CITY}, city) AS city_final FROM stg"),
    ("deduped", """SELECT * FROM city_resolved
QUALIFY row_number() OVER (PARTITION BY source_job_id, job_url ORDER BY collected_at DESC NULLS FIRST, row_id) = 1"""),
    ("located0", f"""
SELECT d.*, upper(trim(d.city_final, ' ''')) AS city_lookup_key, m.mapped_city AS normalized_city_name,
 m.mapped_region AS seed_mapped_region, {initcap('d.region')} AS region_ic
FROM deduped d LEFT JOIN {city_region_values_sql()} m ON upper(trim(d.city_final, ' ''')) = m.raw_value_normalized"""),
    ("located", f"""
SELECT * EXCLUDE (region_ic), {_region_case()} AS normalized_region_name,
 CASE WHEN country = 'Saudi' THEN 'Saudi Arabia' ELSE country END AS normalized_country_name
FROM located0"""),
    ("in_country", "SELECT * FROM located WHERE normalized_country_name = 'Saudi Arabia'"),
    ("dated", f"SELECT *, {_posted_date_case()} AS normalized_job_posted_date FROM in_country"),
    ("attributed", f"""
SELECT *,
 {_case_aliases("upper(" + T('workplace_type') + ")", R.WORKPLACE_ALIASES, 'workplace_type')} AS normalized_workplace_type,
 {_case_aliases("upper(" + T('employment_type') + ")", R.EMPLOYMENT_ALIASES, 'employment_type')} AS normalized_employment_type,
 {_case_aliases("upper(" + T('job_status') + ")", R.STATUS_ALIASES, 'job_status')} AS normalized_job_status,
 CASE WHEN upper({T('job_source')}) = {q(R.UNSPECIFIED_SOURCE)} THEN NULL ELSE {initcap(T('job_source'))} END AS normalized_job_source,
 CASE WHEN job_url LIKE '%tanqeeb.com%' AND upper({T('job_source')}) <> 'TANQEEB' THEN 'Aggregated via Tanqeeb'
      WHEN job_url LIKE '%sabbar.com%' AND upper({T('job_source')}) = {q(R.UNSPECIFIED_SOURCE)} THEN 'Aggregated via Sabbar'
      ELSE 'Direct' END AS job_source_channel
FROM dated"""),
    ("exp_numbers", f"""
SELECT *, {T('experience_years')} AS experience_years_clean,
 regexp_full_match({T('experience_years')}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') AS is_date_like,
 {nth_digits('experience_years', 1)} AS exp_num1, {nth_digits('experience_years', 2)} AS exp_num2,
 (experience_years ILIKE '%fresh%' OR experience_years ILIKE '%no experience%') AS is_fresh,
 (experience_years LIKE '%+%') AS is_open_ended,
 (experience_years ILIKE '%up to%' OR experience_years ILIKE '%less than%') AS is_upper_bound_only
FROM attributed"""),
    ("exp_parsed", """
SELECT *,
 CASE WHEN experience_years_clean IS NULL OR is_date_like THEN NULL WHEN is_fresh THEN 0
      WHEN is_upper_bound_only THEN 0 ELSE exp_num1 END AS experience_min_years,
 CASE WHEN experience_years_clean IS NULL OR is_date_like THEN NULL WHEN is_fresh THEN 0
      WHEN is_upper_bound_only THEN coalesce(exp_num1, exp_num2) WHEN is_open_ended THEN NULL
      WHEN exp_num2 IS NOT NULL THEN exp_num2 ELSE exp_num1 END AS experience_max_years,
 CASE WHEN is_date_like THEN false ELSE is_open_ended END AS experience_is_open_ended
FROM exp_numbers"""),
    ("experienced", f"SELECT *, {_seniority_case()} AS seniority_level FROM exp_parsed"),
    ("cat_title", f"SELECT *, {_category_title_case()} AS title_derived_category FROM experienced"),
    ("categorized", f"""
SELECT *,
 CASE WHEN {T("coalesce(job_category, '')")} <> '' THEN
   CASE {initcap(T('job_category'))} {" ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.CATEGORY_SYNONYMS)}
   ELSE {initcap(T('job_category'))} END
 ELSE title_derived_category END AS normalized_job_category,
 ({T("coalesce(job_category, '')")} <> '' OR title_derived_category IS NOT NULL) AS has_category_data,
 ({T("coalesce(job_category, '')")} = '' AND title_derived_category IS NOT NULL) AS is_category_derived_from_title
FROM cat_title"""),
    ("in_scope", f"SELECT * FROM categorized WHERE normalized_job_category IN {in_list(R.CATEGORIES_IN_SCOPE)}"),
    ("industry", f"""
SELECT *, coalesce(nullif({T('company_industry')}, ''), 'Not Specified') AS company_industry_clean,
 (company_industry IS NOT NULL AND {T('company_industry')} <> '') AS has_company_industry_data
FROM in_scope"""),
    ("company", """
SELECT *, CASE WHEN normalized_job_source = 'Gulftalent' THEN NULL ELSE company_url END AS company_url_clean,
 CASE WHEN normalized_job_source = 'Gulftalent' THEN false ELSE company_url IS NOT NULL END AS has_valid_company_url
FROM industry"""),
    ("cleaned", """
SELECT source_job_id, job_title, job_category, normalized_job_category, has_category_data,
 is_category_derived_from_title, company_industry, company_industry_clean, has_company_industry_data,
 company_name, company_url, company_url_clean, has_valid_company_url, city, normalized_city_name, region,
 normalized_region_name, country, normalized_country_name, employment_type, normalized_employment_type,
 workplace_type, normalized_workplace_type, experience_years, experience_min_years, experience_max_years,
 experience_is_open_ended, seniority_level, job_status, normalized_job_status, is_salary_disclosed, job_url,
 normalized_job_source, job_source_channel, job_posted_date, normalized_job_posted_date, collected_at, description
FROM company"""),
    ("final", f"SELECT {skey('source_job_id', 'normalized_job_source', 'job_url')} AS job_key, * FROM cleaned"),
    ("preferred", f"""
SELECT * FROM (
 SELECT *, row_number() OVER (PARTITION BY {PREF_PART} ORDER BY
   CASE job_source_channel WHEN 'Direct' THEN 1 WHEN 'Aggregated via Sabbar' THEN 2
     WHEN 'Aggregated via Tanqeeb' THEN 3 ELSE 4 END,
   CASE WHEN company_url_clean IS NULL THEN 1 ELSE 0 END,
   collected_at DESC NULLS FIRST, job_key ASC NULLS LAST) AS priority_rank,
 count(*) OVER (PARTITION BY {PREF_PART}) AS channel_duplicate_count
 FROM final) WHERE priority_rank = 1"""),
]

_NAMES = [n for n, _ in CHAIN]


def chain(upto: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the chain up to ``upto`` plus extra CTEs."""
    idx = _NAMES.index(upto)
    ctes = CHAIN[: idx + 1] + (extra or [])
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n"


def with_(ctes: list[tuple[str, str]], select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + select


def on_chain(upto: str, select: str, extra: list[tuple[str, str]] | None = None) -> str:
    return chain(upto, extra) + select


# -- star schema, skills, snapshot -------------------------------------------------

RUN_TS = "2026-12-02 00:00:00"


def catalog_cte() -> str:
    """The phrase catalog as rows: fixed entries and those cut from the benchmark texts."""
    fixed = ", ".join(f"({e}, {q(n)}, {q(c)}, {r}, {q(a)})" for e, (n, c, aliases) in enumerate(FIXED_ENTRIES) for r, a in enumerate(aliases))
    return f"""SELECT *, lower(alias) AS low FROM (
 SELECT * FROM (VALUES {fixed}) AS f(entry, skill_name, skill_category, alias_rank, alias)
 UNION ALL {BENCHMARK_PHRASES_SQL.replace("{benchmark}", "benchmark")})"""


#: Of entries whose names differ in case only, the first one.
FIRST_ENTRIES = """SELECT * FROM catalog QUALIFY entry = min(entry) OVER (PARTITION BY replace(lower(skill_name), 'ß', 'ss'))"""


def hits(texts: str, key: str, catalog: str) -> str:
    """Every alias against every text: the key, the alias's row and what it matched.

    The text is split at the alias; between two pieces it stands by itself if no word
    character ends the one or begins the other (an empty piece: the alias does)."""
    word = "regexp_matches({}, '[\\p{{L}}\\p{{N}}_]')".format
    before = "CASE WHEN ps[i] <> '' THEN right(ps[i], 1) WHEN i > 1 THEN right(a, 1) ELSE '' END"
    after = "CASE WHEN ps[i + 1] <> '' THEN left(ps[i + 1], 1) WHEN i + 1 < len(ps) THEN left(a, 1) ELSE '' END"
    return f"""WITH near AS MATERIALIZED (SELECT t.{key}, c.entry, c.alias_rank FROM (SELECT {key}, lower(txt) AS low FROM {texts}) t
  JOIN {catalog} c ON contains(t.low, c.low)),
 cut AS (SELECT n.{key}, c.entry, c.skill_name, c.skill_category, c.alias_rank, t.txt, c.low AS a, string_split(lower(t.txt), c.low) AS ps FROM near n
  JOIN {catalog} c ON c.entry = n.entry AND c.alias_rank = n.alias_rank JOIN {texts} t ON t.{key} = n.{key}),
 placed AS (SELECT *, list_filter(range(1, len(ps)), lambda i: NOT {word(before)} AND NOT {word(after)})[1] AS place FROM cut)
 SELECT {key}, entry, skill_name, skill_category, alias_rank, substr(txt, CAST(length(array_to_string(ps[1:place], '')) + (place - 1) * length(a) + 1 AS BIGINT), length(a)) AS matched
 FROM placed WHERE place IS NOT NULL"""


def first_alias(texts: str, key: str) -> str:
    """Of every entry found in a text, its first alias."""
    return f"""SELECT * FROM ({hits(texts, key, "entries")}) QUALIFY row_number() OVER (PARTITION BY {key}, entry ORDER BY alias_rank) = 1"""


CATALOG_CTES = [("catalog", catalog_cte()), ("entries", FIRST_ENTRIES)]


def _norm_text(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ')"


def skills_ctes() -> list[tuple[str, str]]:
    return CATALOG_CTES + [
        ("work", f"""SELECT job_key, description FROM final
 WHERE description IS NOT NULL AND {T('description')} <> ''
 QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY job_key) = 1"""),
        ("prepared0", f"SELECT job_key, {_norm_text('description')} AS orig FROM work"),
        ("prepared", f"""SELECT job_key, {_norm_text('orig')} AS txt,
 CASE WHEN regexp_matches(orig, '[\\x{{0600}}-\\x{{06FF}}]') THEN orig END AS ar_ev
 FROM prepared0 WHERE orig <> ''"""),
        ("extracted", f"""SELECT h.job_key, skill_name, skill_category, CAST(1.0 AS DOUBLE) AS confidence, coalesce(ar_ev, matched) AS evidence_span
 FROM ({first_alias("prepared", "job_key")}) h JOIN prepared p ON p.job_key = h.job_key"""),
        ("stg_skills", """SELECT job_key, skill_name, skill_category, confidence, evidence_span FROM (
 SELECT job_key, trim(skill_name, ' ') AS skill_name, lower(trim(skill_category, ' ')) AS skill_category, confidence,
  trim(evidence_span, ' ') AS evidence_span FROM extracted WHERE job_key IS NOT NULL AND skill_name IS NOT NULL)
 QUALIFY row_number() OVER (PARTITION BY job_key, lower(skill_name) ORDER BY confidence DESC NULLS FIRST,
  skill_name ASC NULLS LAST, skill_category ASC NULLS LAST, evidence_span ASC NULLS LAST) = 1"""),
        ("int_skills", f"""SELECT job_key, lower(trim(skill_name, ' ')) AS skill_name,
 lower(trim(skill_category, ' ')) AS skill_category, confidence, evidence_span,
 confidence >= {R.CONFIDENCE_THRESHOLD} AS is_high_confidence FROM stg_skills WHERE confidence >= {R.CONFIDENCE_THRESHOLD}"""),
    ]


def star_ctes() -> list[tuple[str, str]]:
    ts = f"TIMESTAMP {q(RUN_TS)}"
    return skills_ctes() + [
        ("snapshot", f"""SELECT *, md5(CAST(job_key AS VARCHAR) || '|' || CAST({ts} AS VARCHAR)) AS dbt_scd_id,
 {ts} AS dbt_updated_at, {ts} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM final"""),
        ("dim_date", """SELECT DISTINCT CAST(strftime(normalized_job_posted_date, '%Y%m%d') AS INTEGER) AS date_key,
 normalized_job_posted_date AS full_date, CAST(year(normalized_job_posted_date) AS INTEGER) AS year,
 CAST(month(normalized_job_posted_date) AS INTEGER) AS month, strftime(normalized_job_posted_date, '%b') AS month_name,
 CAST(quarter(normalized_job_posted_date) AS INTEGER) AS quarter, CAST(day(normalized_job_posted_date) AS INTEGER) AS day,
 CAST(dayofweek(normalized_job_posted_date) AS INTEGER) AS day_of_week
 FROM preferred WHERE normalized_job_posted_date IS NOT NULL"""),
        ("dim_company", f"""SELECT {skey('company_name', 'company_url_clean')} AS company_key, company_name, company_url_clean AS company_url,
 min(company_industry_clean) AS company_industry FROM preferred GROUP BY company_name, company_url_clean"""),
        ("dim_location", f"""SELECT DISTINCT {skey('normalized_city_name', 'normalized_region_name', 'normalized_country_name')}
 AS location_key, normalized_city_name AS city, normalized_region_name AS region, normalized_country_name AS country
 FROM preferred"""),
        ("dim_source", f"""SELECT DISTINCT {skey('normalized_job_source', 'job_source_channel')} AS source_key,
 coalesce(normalized_job_source, 'Not Specified') AS source_name, job_source_channel AS source_channel FROM preferred"""),
        ("dim_employment_type", f"""SELECT DISTINCT {skey('normalized_employment_type')} AS employment_type_key,
 normalized_employment_type AS employment_type_name FROM preferred WHERE normalized_employment_type IS NOT NULL"""),
        ("dim_job", """SELECT DISTINCT job_key, source_job_id, job_title, normalized_job_category AS job_category,
 normalized_job_status AS job_status, seniority_level FROM snapshot
 WHERE job_key IS NOT NULL AND dbt_valid_to IS NULL AND job_key IN (SELECT job_key FROM preferred)"""),
        ("dim_skills", """SELECT md5(coalesce(skill_name, '') || '|' || coalesce(skill_category, '')) AS skill_key,
 skill_name, skill_category FROM (SELECT DISTINCT skill_name, skill_category FROM int_skills WHERE is_high_confidence)"""),
        ("fact", f"""SELECT row_number() OVER (ORDER BY j.job_key, j.source_job_id, j.job_url) AS job_posting_key, j.job_key,
 CASE WHEN company_name IS NULL AND company_url_clean IS NULL THEN NULL
  ELSE {skey('company_name', 'company_url_clean')} END AS company_key,
 {skey('normalized_city_name', 'normalized_region_name', 'normalized_country_name')} AS location_key,
 {skey('normalized_job_source', 'job_source_channel')} AS source_key,
 CASE WHEN normalized_employment_type IS NULL THEN NULL ELSE {skey('normalized_employment_type')} END AS employment_type_key,
 d.date_key AS job_posted_date_key, j.normalized_workplace_type AS workplace_type, j.is_salary_disclosed, j.job_url,
 j.description, j.experience_min_years, j.experience_max_years, j.experience_is_open_ended, j.collected_at
 FROM (SELECT * FROM preferred WHERE job_key IS NOT NULL) j
 LEFT JOIN dim_date d ON j.normalized_job_posted_date = d.full_date"""),
        ("bridge", """SELECT fact.job_posting_key, ds.skill_key, 'nlp' AS extraction_method, js.confidence, js.evidence_span
 FROM (SELECT * FROM int_skills WHERE is_high_confidence = true) js
 JOIN dim_skills ds ON js.skill_name = ds.skill_name AND js.skill_category = ds.skill_category
 JOIN fact ON js.job_key = fact.job_key"""),
    ]


def on_star(select: str, extra: list[tuple[str, str]] | None = None) -> str:
    return on_chain("preferred", select, star_ctes() + (extra or []))
