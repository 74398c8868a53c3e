"""Oracle SQL per registered query key (DuckDB)."""

from __future__ import annotations

from oracle.sql import on_chain

ID = "source_job_id, job_url"

ORACLE: dict[str, str] = {}


def reg(name: str, sql: str) -> None:
    ORACLE[name] = sql


# -- 2.4 staging
reg("stage_postings", on_chain("stg", "SELECT * EXCLUDE (description, row_id) FROM stg"))
reg("select_wide", on_chain("cleaned", "SELECT * EXCLUDE (description) FROM cleaned"))

# -- 2.5 normalisation
reg("city_from_url", on_chain("city_resolved", f"SELECT {ID}, city, url_city_raw, city_final FROM city_resolved"))
reg("lookup_city_region", on_chain(
    "located", f"SELECT {ID}, city_final, city_lookup_key, normalized_city_name, seed_mapped_region FROM located"))
reg("normalize_region", on_chain(
    "located", f"SELECT {ID}, region, seed_mapped_region, normalized_region_name FROM located"))
reg("normalize_country", on_chain("located", f"SELECT {ID}, country, normalized_country_name FROM located"))
reg("filter_country", on_chain(
    "in_country", f"SELECT {ID}, normalized_city_name, normalized_region_name, normalized_country_name FROM in_country"))
reg("parse_posted_date", on_chain(
    "dated", f"SELECT {ID}, job_posted_date, collected_at, normalized_job_posted_date FROM dated"))
reg("normalize_workplace", on_chain("attributed", f"SELECT {ID}, workplace_type, normalized_workplace_type FROM attributed"))
reg("normalize_employment_type", on_chain(
    "attributed", f"SELECT {ID}, employment_type, normalized_employment_type FROM attributed"))
reg("normalize_status", on_chain("attributed", f"SELECT {ID}, job_status, normalized_job_status FROM attributed"))
reg("normalize_source", on_chain("attributed", f"SELECT {ID}, job_source, normalized_job_source FROM attributed"))
reg("derive_channel", on_chain("attributed", f"SELECT {ID}, job_source, job_source_channel FROM attributed"))
reg("parse_experience", on_chain("experienced", f"""SELECT {ID}, experience_years, is_date_like, exp_num1, exp_num2,
 is_fresh, is_open_ended, is_upper_bound_only, experience_min_years, experience_max_years, experience_is_open_ended
 FROM experienced"""))
reg("derive_seniority", on_chain("experienced", f"""SELECT {ID}, experience_years, experience_min_years,
 experience_max_years, seniority_level FROM experienced"""))
reg("category_from_title", on_chain("categorized", f"SELECT {ID}, job_title, title_derived_category FROM categorized"))
reg("normalize_category", on_chain("categorized", f"""SELECT {ID}, job_category, normalized_job_category,
 has_category_data, is_category_derived_from_title FROM categorized"""))
reg("filter_in_set", on_chain("in_scope", f"SELECT {ID}, normalized_job_category FROM in_scope"))
reg("placeholder_for_missing", on_chain("cleaned", f"""SELECT {ID}, company_industry, company_industry_clean,
 has_company_industry_data FROM cleaned"""))
reg("void_untrusted_column", on_chain("cleaned", f"""SELECT {ID}, normalized_job_source, company_url,
 company_url_clean, has_valid_company_url FROM cleaned"""))

# -- 2.6 de-duplication
reg("keep_latest", on_chain("deduped", "SELECT * EXCLUDE (description, row_id) FROM deduped"))
reg("preferred_row", on_chain("preferred", """SELECT job_key, job_title, company_name, normalized_city_name,
 job_source_channel, company_url_clean, collected_at, priority_rank, channel_duplicate_count FROM preferred"""))

# -- 2.9 keys
reg("surrogate_key", on_chain("final", "SELECT job_key, source_job_id, normalized_job_source, job_url FROM final"))

# -- 2.10 star schema
from oracle.sql import CATALOG_CTES, first_alias, hits, on_star, q, with_  # noqa: E402

reg("build_dim_date", on_star("SELECT * FROM dim_date"))
reg("build_dim_company", on_star("SELECT * FROM dim_company"))
reg("build_dim_location", on_star("SELECT * FROM dim_location"))
reg("build_dim_source", on_star("SELECT * FROM dim_source"))
reg("build_dim_employment_type", on_star("SELECT * FROM dim_employment_type"))
reg("build_dim_job", on_star("SELECT * FROM dim_job"))
reg("build_dim_skills", on_star("SELECT * FROM dim_skills"))
reg("build_fact_posting", on_star("SELECT * EXCLUDE (description) FROM fact"))
reg("dense_sequence", on_star("SELECT job_posting_key, job_key, job_url FROM fact"))
reg("build_bridge_job_skills", on_star("SELECT * FROM bridge"))
reg("date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key FROM orders")
reg("nullable_key", on_star("SELECT job_key, company_key, employment_type_key FROM fact"))
reg("pipe_key", """SELECT doc_id, md5(coalesce(CASE WHEN doc_id % 7 <> 0 THEN lang END, '') || '|' ||
 coalesce(CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 5 <> 0 THEN source END, '')) AS key FROM documents""")

# -- 2.11 skill tagging
reg("tag_phrases", on_star("SELECT * FROM extracted"))
reg("stage_skills", on_star("SELECT * FROM stg_skills"))
reg("high_confidence", on_star("SELECT * FROM int_skills"))
reg("pending_work", on_star("SELECT job_key FROM work"))
_GLOSSED = [("glossed", """SELECT job_key, CASE WHEN job_key LIKE 'a%' THEN 'licence MIT license' WHEN job_key LIKE 'b%' THEN 'engineer Apache' ELSE txt END AS txt
 FROM prepared"""), ("tagged", first_alias("glossed", "job_key"))]
reg("tag_run_log", on_star("""SELECT w.job_key, ts AS processed_at, CAST(CASE WHEN failed THEN 0 ELSE coalesce(c.n, 0) END AS INTEGER) AS skill_count,
 CASE WHEN failed THEN 'error' WHEN coalesce(c.n, 0) > 0 THEN 'skills_found' ELSE 'no_skills_found' END AS status
 FROM (SELECT job_key, TIMESTAMP '2026-12-01 00:00:00' AS ts, job_key LIKE 'b%' AS failed FROM glossed
  UNION ALL SELECT job_key, TIMESTAMP '2026-12-02 00:00:00', false FROM glossed WHERE job_key LIKE 'b%') w
 LEFT JOIN (SELECT job_key, count(*) AS n FROM tagged GROUP BY job_key) c ON w.job_key = c.job_key""", _GLOSSED))
reg("normalize_text", """SELECT doc_id,
 CAST(length(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ')) AS INTEGER) AS normalized_chars,
 md5(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ')) AS normalized_md5
 FROM documents""")
reg("detect_arabic", """SELECT doc_id, lang, coalesce(regexp_matches(text, '[\\x{0600}-\\x{06FF}]'), false) AS is_arabic
 FROM documents""")

# -- 2.8 history
reg("scd2_current", on_star("""SELECT job_key, normalized_job_status, normalized_job_category, seniority_level,
 dbt_scd_id, dbt_valid_from, dbt_valid_to FROM snapshot WHERE dbt_valid_to IS NULL"""))

# -- 2.12 reports
reg("total_postings", on_star("SELECT count(*) AS total_postings FROM fact"))
reg("postings_by_city_region", on_star("""SELECT l.city, l.region, count(*) AS postings
 FROM fact f JOIN dim_location l ON f.location_key = l.location_key GROUP BY l.city, l.region"""))
reg("postings_by_employment_type", on_star("""SELECT coalesce(e.employment_type_name, 'Not Specified') AS employment_type,
 count(*) AS postings FROM fact f LEFT JOIN dim_employment_type e ON f.employment_type_key = e.employment_type_key
 GROUP BY 1"""))
reg("postings_by_workplace", on_star("SELECT workplace_type, count(*) AS postings FROM fact GROUP BY workplace_type"))
reg("experience_requirements", on_star("""SELECT j.seniority_level, count(*) AS postings,
 min(f.experience_min_years) AS min_years, round(avg(f.experience_min_years), 4) AS avg_min_years,
 round(avg(f.experience_max_years), 4) AS avg_max_years, max(f.experience_max_years) AS max_years
 FROM fact f JOIN dim_job j ON f.job_key = j.job_key GROUP BY j.seniority_level"""))
reg("postings_by_source", on_star("""SELECT s.source_name, count(*) AS postings
 FROM fact f JOIN dim_source s ON f.source_key = s.source_key GROUP BY s.source_name"""))
reg("postings_by_channel", on_star("""SELECT s.source_channel, count(*) AS postings
 FROM fact f JOIN dim_source s ON f.source_key = s.source_key GROUP BY s.source_channel"""))
reg("top_skills", on_star("""SELECT s.skill_name, s.skill_category, count(*) AS postings
 FROM bridge b JOIN dim_skills s ON b.skill_key = s.skill_key GROUP BY s.skill_key, s.skill_name, s.skill_category
 ORDER BY postings DESC, s.skill_name ASC, s.skill_category ASC LIMIT 10"""))
reg("posting_trend", on_star("""SELECT d.year, d.month, count(*) AS postings
 FROM fact f JOIN dim_date d ON f.job_posted_date_key = d.date_key GROUP BY d.year, d.month"""))

# -- 2.13 checks
reg("check_not_null", on_chain("dated", f"""SELECT {ID}, 'normalized_job_posted_date' AS column_name,
 'error' AS severity FROM dated WHERE normalized_job_posted_date IS NULL"""))
reg("check_unique", on_chain("final", "SELECT job_key, 2 * count(*) AS duplicate_count FROM final WHERE job_key LIKE 'a%' GROUP BY job_key"))
reg("check_unique_combination", on_chain("preferred", """SELECT job_title, company_name, normalized_city_name,
 sum(n)::BIGINT AS duplicate_count FROM (SELECT *, CASE WHEN job_key LIKE 'a%' THEN 2 ELSE 1 END AS n FROM preferred)
 GROUP BY job_title, company_name, normalized_city_name HAVING sum(n) > 1"""))
reg("check_accepted_values", """SELECT o_orderstatus, count(*) AS n_records FROM orders
 WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus""")
reg("check_relationships", on_star("""SELECT f.job_key FROM fact f LEFT JOIN dim_job d ON f.job_key = d.job_key AND d.job_key NOT LIKE 'a%'
 WHERE f.job_key IS NOT NULL AND d.job_key IS NULL"""))
reg("check_accepted_range", """SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
 WHERE NOT (l_discount >= 0.0 AND l_discount <= 0.08)""")
reg("check_flag_consistency", on_chain("final", """SELECT * FROM (SELECT job_key,
 CASE WHEN job_key LIKE 'a%' THEN NOT has_category_data ELSE has_category_data END AS has_category_data, normalized_job_category FROM final)
 WHERE (has_category_data AND nullif(trim(normalized_job_category, ' '), '') IS NULL)
    OR (NOT has_category_data AND nullif(trim(normalized_job_category, ' '), '') IS NOT NULL)"""))
reg("check_dedupe_exact", on_chain("deduped", """SELECT b.before_rows, e.expected_rows, a.actual_rows,
 b.before_rows - e.expected_rows AS expected_removed_rows, b.before_rows - a.actual_rows AS actual_removed_rows
 FROM (SELECT count(*) AS before_rows FROM stg) b
 CROSS JOIN (SELECT count(*) AS expected_rows FROM (SELECT source_job_id, job_url FROM stg GROUP BY 1, 2)) e
 CROSS JOIN (SELECT count(*) AS actual_rows FROM deduped WHERE source_job_id NOT LIKE '%7') a WHERE a.actual_rows <> e.expected_rows"""))
reg("check_no_duplicates", on_chain("deduped", f"""SELECT {ID}, 2 * count(*) AS duplicate_count FROM deduped
 WHERE source_job_id LIKE '%7' GROUP BY {ID}"""))
reg("check_group_row_count", on_chain("preferred", """SELECT e.expected_rows, a.actual_rows FROM
 (SELECT count(*) AS expected_rows FROM (SELECT trim(lower(job_title), ' '), trim(lower(company_name), ' '),
  normalized_city_name FROM final GROUP BY 1, 2, 3)) e
 CROSS JOIN (SELECT count(*) AS actual_rows FROM preferred WHERE job_key NOT LIKE 'a%') a WHERE e.expected_rows <> a.actual_rows"""))
reg("check_year_ranges", on_chain("final", """SELECT * FROM (SELECT job_key, experience_years, experience_min_years,
 CASE WHEN job_key LIKE 'a%' THEN experience_max_years + 45 ELSE experience_max_years END AS experience_max_years FROM final)
 WHERE experience_min_years < 0 OR experience_max_years < 0 OR experience_min_years > experience_max_years OR experience_max_years > 50"""))
_PD = """coalesce(CAST(try_strptime(CAST({x} AS VARCHAR), '%Y-%m-%d') AS DATE), CAST(try_cast(CAST({x} AS VARCHAR) AS TIMESTAMP) AS DATE),
 CAST(try_strptime(CAST({x} AS VARCHAR), '%d-%b-%Y') AS DATE), CAST(try_strptime(CAST({x} AS VARCHAR), '%m/%d/%Y') AS DATE),
 CAST(try_strptime(trim(CAST({x} AS VARCHAR), ' '), '%d %b %Y') AS DATE))"""
reg("check_posted_dates", on_chain("final", f"""SELECT job_key, job_posted_date, collected_at,
 parsed_job_posted_date, parsed_collected_date FROM (
 SELECT job_key, job_posted_date, collected_at, {_PD.format(x='job_posted_date')} AS parsed_job_posted_date,
  {_PD.format(x='collected_at')} AS parsed_collected_date FROM final)
 WHERE (parsed_job_posted_date IS NOT NULL AND parsed_collected_date IS NOT NULL AND parsed_job_posted_date > parsed_collected_date)
  OR (parsed_job_posted_date IS NOT NULL AND parsed_job_posted_date > (SELECT CAST(max(collected_at) AS DATE) FROM final))"""))
_FK = [("job_key", "dim_job", "job_key"), ("company_key", "dim_company", "company_key"),
       ("location_key", "dim_location", "location_key"), ("source_key", "dim_source", "source_key"),
       ("employment_type_key", "dim_employment_type", "employment_type_key"),
       ("job_posted_date_key", "dim_date", "date_key")]
reg("check_fact_foreign_keys", on_star(" UNION ALL ".join(
    f"SELECT f.job_posting_key, '{fk}' AS foreign_key_name FROM fact f LEFT JOIN {dim} d ON f.{fk} = d.{dk} "
    f"AND {'d.date_key % 7 <> 0' if dk == 'date_key' else f'd.{dk} NOT LIKE {chr(39)}a%{chr(39)}'} "
    f"WHERE f.{fk} IS NOT NULL AND d.{dk} IS NULL" for fk, dim, dk in _FK)))

_FAULTY = [("faulty", """SELECT job_key, normalized_city_name, normalized_job_category, experience_min_years, job_posted_date, collected_at,
 CASE WHEN job_key LIKE 'a%' THEN NOT has_category_data ELSE has_category_data END AS flag,
 CASE WHEN job_key LIKE 'a%' THEN experience_max_years + 45 ELSE experience_max_years END AS max_years,
 CASE WHEN job_key LIKE 'b%' THEN 'Guru' ELSE seniority_level END AS seniority, CASE WHEN job_key LIKE 'a%' THEN 2 ELSE 1 END AS times FROM final""")]
_BAD_YEARS = "experience_min_years < 0 OR max_years < 0 OR experience_min_years > max_years OR max_years > 50"
_SUITE = {
    "city_not_null": "normalized_city_name IS NULL",
    "seniority_accepted": "seniority NOT IN ('Entry-level', 'Associate / Mid-level', 'Senior-level', 'Executive / Director', 'Not Specified')",
    "category_flag": "(nullif(trim(normalized_job_category, ' '), '') IS NOT NULL) <> flag", "year_ranges": _BAD_YEARS,
    "posted_dates": f"{_PD.format(x='job_posted_date')} > {_PD.format(x='collected_at')}"}
reg("check_suite", on_chain("final", " UNION ALL ".join(
    f"SELECT 'final' AS table_name, '{n}' AS check_name, coalesce(sum(times) FILTER ({c}), 0)::BIGINT AS failures FROM faulty" for n, c in _SUITE.items()) + """
 UNION ALL SELECT 'final', 'job_key_unique', count(DISTINCT job_key) FROM faulty WHERE times > 1
 UNION ALL SELECT 'deduped', 'id_not_null', count(*) FROM deduped WHERE source_job_id IS NULL
 UNION ALL SELECT 'deduped', 'no_duplicates', count(*) FROM (SELECT source_job_id, job_url FROM deduped GROUP BY ALL HAVING count(*) > 1)
 UNION ALL SELECT 'lineitem', 'discount_range', count(*) FROM lineitem WHERE NOT (l_discount BETWEEN 0.0 AND 0.08)""", _FAULTY))
reg("failing_rows", on_chain("final", f"""SELECT job_key, 'city_not_null' AS check_name FROM faulty WHERE normalized_city_name IS NULL
 UNION ALL SELECT job_key, 'year_ranges' FROM faulty WHERE {_BAD_YEARS}
 UNION ALL SELECT job_key, 'status_accepted' FROM final WHERE normalized_job_status NOT IN ('Active', 'Closed', 'Expired')""", _FAULTY))

# -- 2.3 static dataset profiling
from oracle import values as _R  # noqa: E402
from hirelake.sources.static_fixture import static_sql_for  # noqa: E402

_TYPES = "CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' " \
         "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof({c})) END"
_OCOLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
reg("profile_table", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, (SELECT {_TYPES.format(c=c)} FROM orders LIMIT 1) AS data_type, "
    f"count(*) AS row_count, {len(_OCOLS)} AS column_count, count(*) - count({c}) AS null_count FROM orders"
    for i, c in enumerate(_OCOLS)))
reg("count_duplicate_rows", """SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_rows,
 CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows FROM (SELECT text, lang, source, n_chars, count(*) AS n
 FROM documents GROUP BY ALL)""")
reg("flag_group_duplicates", """SELECT doc_id, count(*) OVER (PARTITION BY text) AS group_size FROM documents
 QUALIFY count(*) OVER (PARTITION BY text) > 1""")
_STATIC = f"WITH static AS ({static_sql_for()})\n"
reg("clean_column_names", _STATIC + "SELECT * FROM static")
reg("trim_text_columns", """SELECT doc_id, CAST(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS INTEGER) AS text_chars,
 md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_md5, regexp_replace(lang, '^\\s+|\\s+$', '', 'g') AS lang,
 regexp_replace(source, '^\\s+|\\s+$', '', 'g') AS source FROM documents""")
reg("drop_exact_duplicates", "SELECT md5(text) AS text_md5, lang, source, n_chars FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)")
reg("coerce_dates", _STATIC + """SELECT comp_name, job_title, coalesce(CAST(try_strptime(job_date, '%Y-%m-%d') AS DATE),
 CAST(try_cast(job_date AS TIMESTAMP) AS DATE), CAST(try_strptime(job_date, '%d-%b-%Y') AS DATE),
 CAST(try_strptime(job_date, '%m/%d/%Y') AS DATE)) AS job_date FROM static""")
reg("value_frequencies", "SELECT o_orderpriority, count(*) AS frequency FROM orders GROUP BY o_orderpriority")
reg("range_violations", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_BODY = [c for c in _R.RAW_COLUMNS if c != "source_job_id"]
_conf_cols = {
    "job_title": _STRIP.format(c="job_title"), "url": "CAST(NULL AS VARCHAR)",
    "company_name": _STRIP.format(c="comp_name"), "company_url": "CAST(NULL AS VARCHAR)",
    "city": _STRIP.format(c="city"), "region": _STRIP.format(c="region"), "country": "'Saudi Arabia'",
    "employment_type": "CAST(NULL AS VARCHAR)", "workplace_type": "'Onsite'",
    "experience_years": "CAST(exper AS VARCHAR)", "job_category": "CAST(NULL AS VARCHAR)",
    "industry": _STRIP.format(c="eco_activity"),
    "is_salary_disclosed": "CASE WHEN salary IS NOT NULL THEN 'True' ELSE 'False' END",
    "job_source": "'Jadarat.com'",
    "job_posted_date": "strftime(coalesce(CAST(try_strptime(jd, '%Y-%m-%d') AS DATE), CAST(try_cast(jd AS TIMESTAMP) AS DATE), "
                       "CAST(try_strptime(jd, '%d-%b-%Y') AS DATE), CAST(try_strptime(jd, '%m/%d/%Y') AS DATE)), '%Y-%m-%d')",
    "job_status": "'Closed'", "collected_at": "'2026-12-02 00:00:00'", "description": "CAST(NULL AS VARCHAR)",
}
reg("conform_static_dataset", _STATIC + f"""SELECT CAST(row_number() OVER (ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in _BODY)}) AS VARCHAR)
 AS source_job_id, {", ".join(_BODY)} FROM (
 SELECT {", ".join(f"{v} AS {k}" for k, v in _conf_cols.items())} FROM (
  SELECT DISTINCT {_STRIP.format(c="job_title")} AS job_title, {_STRIP.format(c="comp_name")} AS comp_name,
   {_STRIP.format(c="comp_type")} AS comp_type, {_STRIP.format(c="comp_size")} AS comp_size, {_STRIP.format(c="city")} AS city,
   {_STRIP.format(c="region")} AS region, {_STRIP.format(c="eco_activity")} AS eco_activity, {_STRIP.format(c="benefits")} AS benefits,
   {_STRIP.format(c="contract")} AS contract, positions, {_STRIP.format(c="gender")} AS gender, exper, salary,
   {_STRIP.format(c="job_date")} AS jd FROM static))""")

# -- 2.6 / 2.7 over driver tables
reg("one_per_key_pick", """SELECT o_custkey, o_orderkey, o_orderdate FROM orders
 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1""")
reg("join_left_lookup", "SELECT c.c_custkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
reg("join_inner_composite", on_star("""SELECT s.job_key, d.skill_key, s.confidence FROM int_skills s
 JOIN dim_skills d ON s.skill_name = d.skill_name AND s.skill_category = d.skill_category"""))
reg("semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
reg("anti_join", """SELECT c_custkey, c_name FROM customer c
 WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')
   AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)""")
reg("orphan_rows", """SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey FROM lineitem l LEFT JOIN supplier s
 ON l.l_suppkey = s.s_suppkey AND s.s_suppkey % 10 <> 3 WHERE l.l_suppkey IS NOT NULL AND s.s_suppkey IS NULL""")
reg("cross_join_scalars", """SELECT * FROM (SELECT count(*) AS orders FROM orders) CROSS JOIN (SELECT count(*) AS customers FROM customer)
 CROSS JOIN (SELECT count(*) AS lineitems FROM lineitem)""")
reg("union_all", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                                     for t in ("orders", "customer", "lineitem", "documents")))
reg("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
reg("scalar_max_filter", """SELECT event_id, event_type, value FROM events
 WHERE value > (SELECT max(value) FROM events WHERE event_type = 'view')""")

# -- 2.8 history
_CUT = "TIMESTAMP '1998-01-01 00:00:00'"
_SRC2 = f"""SELECT job_key, CASE WHEN normalized_job_status = 'Active' AND collected_at < {_CUT} THEN 'Closed'
 ELSE normalized_job_status END AS normalized_job_status, normalized_job_category, seniority_level, collected_at
 FROM final WHERE normalized_job_status IS DISTINCT FROM 'Expired'"""
reg("incremental_since_watermark", on_chain("final", f"""SELECT job_key, collected_at FROM final
 WHERE collected_at > (SELECT max(collected_at) FROM final WHERE collected_at <= {_CUT})"""))
reg("merge_by_key", on_chain("final", f"""SELECT job_key, normalized_job_status, collected_at FROM (
 SELECT job_key, normalized_job_status, collected_at FROM final t WHERE collected_at <= {_CUT}
  AND job_key NOT IN (SELECT job_key FROM src2 WHERE collected_at > {_CUT} OR normalized_job_status = 'Closed')
 UNION ALL SELECT job_key, normalized_job_status, collected_at FROM src2
  WHERE collected_at > {_CUT} OR normalized_job_status = 'Closed')""", [("src2", _SRC2)]))
_T1, _T2 = "TIMESTAMP '2026-12-01 00:00:00'", "TIMESTAMP '2026-12-02 00:00:00'"
_SNAP = [("src2", _SRC2), ("snap1", f"""SELECT job_key, normalized_job_status, normalized_job_category, seniority_level,
 md5(job_key || '|' || CAST({_T1} AS VARCHAR)) AS dbt_scd_id, {_T1} AS dbt_updated_at, {_T1} AS dbt_valid_from,
 CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM final"""),
         ("cmp", """SELECT o.job_key, s.job_key AS s_key, s.normalized_job_status AS s_status,
 (s.job_key IS NOT NULL AND (o.normalized_job_status IS DISTINCT FROM s.normalized_job_status
   OR o.normalized_job_category IS DISTINCT FROM s.normalized_job_category
   OR o.seniority_level IS DISTINCT FROM s.seniority_level)) AS changed
 FROM snap1 o LEFT JOIN src2 s ON o.job_key = s.job_key"""),
         ("snap2", f"""SELECT o.job_key, o.normalized_job_status, o.dbt_scd_id,
  CASE WHEN c.changed OR c.s_key IS NULL THEN {_T2} ELSE o.dbt_updated_at END AS dbt_updated_at, o.dbt_valid_from,
  CASE WHEN c.changed OR c.s_key IS NULL THEN {_T2} ELSE o.dbt_valid_to END AS dbt_valid_to
 FROM snap1 o JOIN cmp c ON o.job_key = c.job_key
 UNION ALL
 SELECT s.job_key, s.normalized_job_status, md5(s.job_key || '|' || CAST({_T2} AS VARCHAR)), {_T2}, {_T2}, CAST(NULL AS TIMESTAMP)
 FROM src2 s WHERE s.job_key NOT IN (SELECT job_key FROM snap1)
  OR s.job_key IN (SELECT job_key FROM cmp WHERE changed)""")]
reg("scd2_check", on_chain("final", "SELECT * FROM snap2", _SNAP))
reg("status_history", on_chain("final", """SELECT job_key, normalized_job_status, dbt_valid_from, dbt_valid_to,
 row_number() OVER (PARTITION BY job_key ORDER BY dbt_valid_from) AS version_number FROM snap2""", _SNAP))

# -- 2.11 over documents
_FIRST_HIT = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY entry, alias_rank) = 1"
_DOC_HITS = [*CATALOG_CTES, ("texts", "SELECT doc_id, text AS txt FROM documents"), ("hits", hits("texts", "doc_id", "catalog"))]
reg("resolve_phrase", with_(_DOC_HITS, f"""SELECT d.doc_id, skill_name, skill_category, matched FROM documents d
 LEFT JOIN (SELECT * FROM hits {_FIRST_HIT.format(key="doc_id")}) h ON h.doc_id = d.doc_id"""))
_CLEAN = "trim(regexp_replace(replace(word, '##', ''), '\\s+', ' ', 'g'), {chars})".format(chars=q(_R.CANDIDATE_STRIP_CHARS))


def _tokens(more: str) -> str:
    return f"""SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS position, unnest(arr) AS word
 FROM (SELECT doc_id, string_split(text || {more}, ' ') AS arr FROM documents)"""


reg("clean_candidate", f"SELECT doc_id, position, {_CLEAN} AS candidate FROM ({_tokens(q(''))})")
_SCORED = _tokens("CASE WHEN doc_id % 10 = 0 THEN ' with C++ from Straße with STRASSE have problem solving' ELSE '' END")
_MODEL = [
    *CATALOG_CTES,
    ("words", f"SELECT doc_id AS job_key, position, word, (13 + length(word) % 4) / 16.0::DOUBLE AS score FROM ({_SCORED})"),
    ("islands", f"""SELECT *, position - row_number() OVER (PARTITION BY job_key ORDER BY position) AS island FROM words
 WHERE score >= {_R.CONFIDENCE_THRESHOLD}"""),
    ("spans", """SELECT job_key, min(position) AS position, string_agg(word, ' ' ORDER BY position) AS word, sum(score) / count(*) AS score
 FROM islands GROUP BY job_key, island"""),
    ("cands", f"SELECT job_key || '/' || position AS cand_id, job_key, position, score, {_CLEAN} AS txt FROM spans"),
    ("cand_hits", f"SELECT * FROM ({hits('cands', 'cand_id', 'catalog')}) {_FIRST_HIT.format(key='cand_id')}"),
    ("model", """SELECT c.job_key, skill_name, skill_category, round(c.score, 3) AS confidence, matched AS evidence_span
 FROM cands c JOIN cand_hits h ON h.cand_id = c.cand_id
 QUALIFY row_number() OVER (PARTITION BY c.job_key, replace(lower(skill_name), 'ß', 'ss') ORDER BY c.position) = 1"""),
]
reg("resolve_scored_candidates", with_(_MODEL, "SELECT * FROM model"))
reg("merge_tag_sources", with_([
    *_MODEL,
    ("texts", "SELECT doc_id AS job_key, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS txt FROM documents"),
    ("phrases", f"SELECT job_key, skill_name, skill_category, 1.0::DOUBLE AS confidence, matched AS evidence_span FROM ({first_alias('texts', 'job_key')})"),
    ("both_", "SELECT *, 0 AS src FROM model UNION ALL SELECT *, 1 AS src FROM phrases"),
], """SELECT job_key, skill_name, skill_category, confidence, evidence_span FROM both_
 QUALIFY row_number() OVER (PARTITION BY job_key, replace(lower(skill_name), 'ß', 'ss') ORDER BY src) = 1"""))

# -- 2.2 page extraction
from hirelake.sources.job_pages import job_pages_sql_for  # noqa: E402

_JP = f"WITH jp AS ({job_pages_sql_for()})\n"
_ORIGIN = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"


def _decode(x: str) -> str:
    """The entities that occur in the pages, decoded in one left-to-right pass."""
    return (f"regexp_replace(replace(replace(replace(replace(replace({x}, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), "
            f"'&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')")


def _to_text(x: str) -> str:
    return f"trim(regexp_replace({_decode(f'regexp_replace({x}, {chr(39)}<[^>]+>{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '\\s+', ' ', 'g'), ' ')"


_LINKS = f"""links0 AS (SELECT page_id, CAST(generate_subscripts(arr, 1) AS BIGINT) AS i, unnest(arr) AS link_url FROM (
  SELECT page_id, list_transform(regexp_extract_all(html, '(?i)href="(/[^"?#]+)"', 1),
   lambda x: CASE WHEN starts_with(x, '/') THEN {_ORIGIN} || x ELSE x END) AS arr FROM pages)),
 links1 AS (SELECT * FROM links0 QUALIFY row_number() OVER (PARTITION BY page_id, link_url ORDER BY i) = 1),
 links AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, link_url
  FROM links1)"""
reg("extract_links", f"WITH {_LINKS} SELECT * FROM links")
reg("absolutize_url", f"""SELECT page_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos,
 unnest(list_transform(arr, lambda x: CASE WHEN starts_with(x, '/') THEN root || x ELSE x END)) AS link_url
 FROM (SELECT page_id, {_ORIGIN} AS root, regexp_extract_all(html, 'href="([^"]*)"', 1) AS arr FROM pages)""")
reg("unseen_only", f"""WITH {_LINKS} SELECT link_url, page_id, pos FROM links
 WHERE link_url NOT IN (SELECT url FROM pages WHERE url IS NOT NULL)
 QUALIFY row_number() OVER (PARTITION BY link_url ORDER BY page_id, pos) = 1""")

_JSONLD = _JP + """, s1 AS (SELECT page_id, url, unnest(s) AS t, generate_subscripts(s, 1) AS si FROM (
  SELECT page_id, url, regexp_extract_all(html, '(?is)<script[^>]*type="application/ld\\+json"[^>]*>(.*?)</script>', 1) AS s FROM jp)),
 s2 AS (SELECT page_id, url, si, CAST(t AS JSON) AS t FROM s1 WHERE json_valid(t)),
 s3 AS (SELECT page_id, url, si, CASE WHEN json_type(t) = 'ARRAY' THEN CAST(t AS JSON[]) ELSE [t] END AS arr FROM s2),
 s4 AS (SELECT page_id, url, si, unnest(arr) AS item, generate_subscripts(arr, 1) AS ii FROM s3),
 jl AS (SELECT page_id, url, item AS j FROM s4 WHERE json_extract_string(item, '$."@type"') = 'JobPosting'
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY si, ii) = 1)
"""


def _truthy(j: str, path: str) -> str:
    """Truth of a JSON value by its type."""
    v = f"json_extract({j}, '{path}')"
    return (f"coalesce(CASE json_type({j}, '{path}') WHEN 'NULL' THEN false WHEN 'VARCHAR' THEN json_extract_string({j}, '{path}') <> '' "
            f"WHEN 'BOOLEAN' THEN {v}::VARCHAR = 'true' WHEN 'ARRAY' THEN json_array_length({v}) > 0 "
            f"WHEN 'OBJECT' THEN len(json_keys({v})) > 0 ELSE CAST({v} AS DOUBLE) <> 0 END, false)")


def _jp(path: str) -> str:
    return f"coalesce(json_extract_string(j, '{path}'), '')"


_SLUG = ("CASE WHEN regexp_matches(trim(" + _jp("$.hiringOrganization.sameAs") + ", ' '), '(?i)^https?://') THEN trim("
         + _jp("$.hiringOrganization.sameAs") + ", ' ') WHEN trim(regexp_replace(strip_accents(lower(" + _jp("$.hiringOrganization.name")
         + ")), '[^a-z0-9]+', '-', 'g'), '-') <> '' THEN 'https://www.gulftalent.com/companies/' || trim(regexp_replace(strip_accents(lower("
         + _jp("$.hiringOrganization.name") + ")), '[^a-z0-9]+', '-', 'g'), '-') || '-careers' ELSE '' END")
_EMP = ("CASE WHEN starts_with(json_extract(j, '$.employmentType')::VARCHAR, '[') THEN "
        "array_to_string(CAST(json_extract(j, '$.employmentType') AS VARCHAR[]), ',') "
        "ELSE json_extract_string(j, '$.employmentType') END")
_VALID = "json_extract_string(j, '$.validThrough')"
_VT = (f"CASE WHEN coalesce({_VALID}, '') = '' THEN 'active' "
       f"WHEN regexp_matches({_VALID}, '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$') THEN "
       f"CASE WHEN try_cast({_VALID} AS TIMESTAMPTZ) < TIMESTAMPTZ '2026-12-02 00:00:00+00' THEN 'expired' ELSE 'active' END "
       f"WHEN try_cast({_VALID} AS TIMESTAMP) < TIMESTAMP '2026-12-02 00:00:00' THEN 'expired' ELSE 'active' END")
reg("extract_jsonld", _JSONLD + f"""SELECT page_id, {_jp('$.identifier.value')} AS source_job_id, {_jp('$.title')} AS job_title,
 url, {_jp('$.hiringOrganization.name')} AS company_name, {_SLUG} AS company_url,
 {_jp('$.jobLocation.address.addressLocality')} AS city, {_jp('$.jobLocation.address.addressRegion')} AS region,
 {_jp('$.jobLocation.address.addressCountry')} AS country, coalesce({_EMP}, '') AS employment_type,
 CASE WHEN upper(coalesce(json_extract_string(j, '$.jobLocationType'), '')) LIKE '%TELECOMMUTE%' THEN 'Remote' ELSE '' END AS workplace_type,
 {_jp('$.experienceRequirements.monthsOfExperience')} AS experience_years, {_jp('$.occupationalCategory')} AS job_category,
 {_jp('$.industry')} AS industry,
 {_truthy("j", "$.baseSalary")} AS is_salary_disclosed,
 'GulfTalent' AS job_source, {_jp('$.datePosted')} AS job_posted_date, {_VT} AS job_status,
 '2026-12-02 00:00:00' AS collected_at, {_to_text(_jp('$.description'))} AS description FROM jl""")
reg("json_path_or_empty", """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
 coalesce(json_extract_string(props, '$.missing.inner'), '') AS missing FROM events""")
reg("list_to_csv_text", _JSONLD + f"SELECT page_id, {_EMP} AS employment_type FROM jl")
reg("remote_from_marker", _JSONLD + """SELECT page_id, CASE WHEN upper(coalesce(json_extract_string(j, '$.jobLocationType'), ''))
 LIKE '%TELECOMMUTE%' THEN 'Remote' ELSE '' END AS workplace_type FROM jl""")
reg("company_url_slug", _JSONLD + f"SELECT page_id, {_SLUG} AS company_url FROM jl")

_KV = '([A-Za-z0-9_-]+)="([^"]*)"'
_ART = "(?is)(<article\\b(?:[^>\"'']|\"[^\"]*\"|''[^'']*'')*>)(.*?)</article>"
_AGAIN = ("CASE WHEN regexp_matches(t, '</?[a-zA-Z][a-zA-Z0-9]*(?:\\s[^<>]*)?/?>') THEN "
          + _decode("regexp_replace(t, '<[^>]+>', ' ', 'g')") + " ELSE t END AS t")
_CARDS = _JP + f""", c0 AS (SELECT page_id, unnest(list_zip(regexp_extract_all(html, '{_ART}', 1), regexp_extract_all(html, '{_ART}', 2))) AS c FROM jp),
 c1 AS (SELECT page_id, c[1] AS card, c[2] AS inside FROM c0 WHERE contains(c[1], 'data-drawer-trigger="job-card"')),
 kv AS (SELECT page_id, inside, regexp_extract_all(card, '{_KV}', 1) AS ks, regexp_extract_all(card, '{_KV}', 2) AS vs FROM c1),
 c2 AS (SELECT page_id, inside, map_from_entries(list_transform(list_filter(range(1, len(ks) + 1), lambda i: list_position(ks, ks[i]) = i),
   lambda i: {{'k': ks[i], 'v': vs[i]}})) AS attrs FROM kv),
 t1 AS (SELECT page_id, attrs, {_decode("regexp_replace(regexp_extract(inside, '(?is)<div [^>]*job-card-description-source[^>]*>(.*?)</div>', 1), '<[^>]+>', ' ', 'g')")} AS t FROM c2),
 t2 AS (SELECT page_id, attrs, {_AGAIN} FROM t1), t3 AS (SELECT page_id, attrs, {_AGAIN} FROM t2), t4 AS (SELECT page_id, attrs, {_AGAIN} FROM t3),
 cards AS (SELECT page_id, attrs, nullif(trim(regexp_replace(t, '\\s+', ' ', 'g'), ' '), '') AS description FROM t4)
"""


def _at(name: str) -> str:
    v = _decode(f"attrs['{name}']")
    return f"nullif(regexp_replace({v}, '^\\s+|\\s+$', '', 'g'), '')"


_PARTS = ("list_filter(list_transform(string_split(coalesce(" + _at("data-job-workplace-location") + ", "
          + _at("data-job-location") + ", ''), '-'), lambda p: trim(p, ' ')), lambda p: p <> '' AND lower(p) NOT IN ('on-site', 'remote', 'hybrid'))")
_COUNTRY = f"coalesce({_at('data-job-country')}, {_PARTS}[1])"
_CITY = f"coalesce({_at('data-job-state')}, CASE WHEN len({_PARTS}) >= 2 THEN {_PARTS}[-1] END)"
_REGION_CITIES = {
    "Riyadh Region": ["Riyadh"], "Makkah Region": ["Jeddah", "Makkah", "Taif", "Al Taif", "Rabigh"],
    "Madinah Region": ["Medina", "Madinah", "Yanbu"],
    "Eastern Province": ["Eastern", "Eastern Province", "Al Damam", "Dammam", "Khobar", "Dhahran", "Jubail", "Qatif", "Al Ahsa", "Hafar Al-Batin"],
    "Asir Region": ["Asir", "Abha", "Khamis Mushait", "Bisha"], "Tabuk Region": ["Tabuk"], "Qassim Region": ["Qassim"], "Hail Region": ["Hail"],
    "Al Jouf Region": ["Jouf", "Al Jouf"], "Al Bahah Region": ["Bahah", "Al Bahah"], "Jazan Region": ["Jizan"],
    "Najran Region": ["Nagran", "Najran"], "Northern Borders Region": ["Northern Borders"],
}
_REGION_MAP = "MAP {" + ", ".join(f"'{c}': '{r}'" for r, cs in _REGION_CITIES.items() for c in cs) + "}"
reg("extract_card_attributes", _CARDS + f"""SELECT page_id, {_at('data-job-id')} AS source_job_id, {_at('data-job-name')} AS job_title,
 CASE WHEN starts_with({_at('data-job-url')}, '/') THEN 'https://saudi.tanqeeb.com' || {_at('data-job-url')} ELSE {_at('data-job-url')} END AS url,
 {_at('data-job-company')} AS company_name,
 CASE WHEN starts_with({_at('data-job-company-url')}, '/') THEN 'https://saudi.tanqeeb.com' || {_at('data-job-company-url')} ELSE {_at('data-job-company-url')} END AS company_url,
 {_CITY} AS city, {_REGION_MAP}[{_CITY}] AS region, {_COUNTRY} AS country, {_at('data-job-type')} AS employment_type,
 {_at('data-job-workplace')} AS workplace_type, {_at('data-job-experience')} AS experience_years,
 {_at('data-job-categories')} AS job_category, {_at('data-job-industry')} AS industry,
 {_at('data-job-salary')} IS NOT NULL AS is_salary_disclosed, {_at('data-job-source')} AS job_source,
 {_at('data-job-date')} AS job_posted_date,
 CASE WHEN coalesce({_at('data-job-closed')}, '') = '1' THEN 'closed' ELSE 'active' END AS job_status,
 '2026-12-02 00:00:00' AS collected_at, description FROM cards""")
reg("disclosed_flag", _CARDS + f"SELECT page_id, {_at('data-job-salary')} IS NOT NULL AS is_salary_disclosed FROM cards")
reg("parse_location_text", _CARDS + f"SELECT page_id, {_COUNTRY} AS country, {_CITY} AS city FROM cards")
reg("map_city_to_region", _CARDS + f"SELECT page_id, {_at('data-job-state')} AS city, {_REGION_MAP}[{_at('data-job-state')}] AS region FROM cards")
_ODD = """<p title="a > b" data-x='c > d'>kept</p><!-- gone <b>x</b> > --><script type="x > y">var s = "<p>gone</p>" > 1;</script><STYLE>p > a { color: red }</STYLE >if a < b then<br/>1 <2 tail"""
_TAGS = """(?is)</?[a-z!?](?:[^>"']|"[^"]*"|'[^']*')*>"""


def _removed(x: str, pattern: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, ' ', 'g')"


# comments first, then scripts and styles, then tags; no page has one of these inside another
_PLAIN = _removed("html || " + q(_ODD), "(?s)<!--.*?-->")
for _element in ("script", "style"):
    _PLAIN = _removed(_PLAIN, f"""(?is)<{_element}\\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?</{_element}\\s*>""")
reg("html_to_text", f"""SELECT page_id, trim(regexp_replace({_decode(_removed(_PLAIN, _TAGS))}, '\\s+', ' ', 'g'), ' ') AS text FROM pages""")
reg("strip_markup_symbols", """SELECT doc_id, CAST(length(t) AS INTEGER) AS text_chars, md5(t) AS text_md5 FROM (
 SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[*_]+', '', 'g'),
  '[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{1F1E6}-\\x{1F1FF}]+', '', 'g'), '\\s+', ' ', 'g'), ' ') AS t FROM documents)""")
reg("heading_text", f"""SELECT page_id, CASE WHEN regexp_extract(html, '(?is)(<h1[^>]*>)', 1) <> '' THEN
 nullif({_to_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, '') END AS heading FROM pages""")
reg("first_present", on_chain("raw", """SELECT source_job_id, url, collected_at,
 coalesce(nullif(experience_years, ''), nullif(job_posted_date, ''), nullif(job_source, '')) AS first_value FROM raw"""))
reg("first_truthy_key", f"""SELECT event_id, CASE WHEN {_truthy("j", "$.a")} THEN json_extract_string(j, '$.a')
 WHEN {_truthy("j", "$.missing")} THEN json_extract_string(j, '$.missing') WHEN {_truthy("j", "$.b")} THEN json_extract_string(j, '$.b') END AS value
 FROM (SELECT event_id, '{{"a":' || CASE event_id % 12 WHEN 0 THEN '"0"' WHEN 1 THEN '0' WHEN 2 THEN 'false' WHEN 3 THEN '"false"' WHEN 4 THEN '" "' WHEN 5 THEN '[]'
  WHEN 6 THEN '{{}}' WHEN 7 THEN 'null' WHEN 8 THEN '""' WHEN 9 THEN '0.0' WHEN 10 THEN '"" ' ELSE '7' END
  || ',"b":"' || coalesce(json_extract_string(props, '$.k'), '') || '"}}' AS j FROM events)""")
reg("id_from_url", "SELECT page_id, url, nullif(regexp_extract(url, '/(\\d+)/?(?:[?#]|$)', 1), '') AS url_id FROM pages")
reg("map_codes", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F') THEN 'Finished' WHEN o_orderstatus IN ('O') THEN 'Open' ELSE o_orderstatus END AS status_label FROM orders")
_NUM = "(\\d+(?:\\.\\d+)?)"


def _fmt(x: str) -> str:
    return (f"CASE WHEN try_cast({x} AS DOUBLE) = floor(try_cast({x} AS DOUBLE)) THEN CAST(CAST(floor(try_cast({x} AS DOUBLE)) AS BIGINT) AS VARCHAR) "
            f"ELSE CAST(try_cast({x} AS DOUBLE) AS VARCHAR) END")


def _experience_text(x: str) -> str:
    v = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    single = f"regexp_extract({v}, '(?i)^{_NUM}\\s*(?:years?|yrs?)?$', 1)"
    plus = f"regexp_extract({v}, '^\\+?\\s*{_NUM}\\s*\\+?$', 1)"
    lo = f"regexp_extract({v}, '^{_NUM}\\s*-\\s*{_NUM}', 1)"
    hi = f"regexp_extract({v}, '^{_NUM}\\s*-\\s*{_NUM}', 2)"
    return f"""CASE WHEN {v} IS NULL OR {v} = '' THEN NULL
  WHEN regexp_full_match({v}, '\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{2,4}}') THEN NULL
  WHEN {single} <> '' THEN {_fmt(single)}
  WHEN {plus} <> '' AND contains({v}, '+') THEN {_fmt(plus)} || '+ yrs'
  WHEN {lo} <> '' THEN {_fmt(lo)} || '-' || {_fmt(hi)} || ' yrs'
  ELSE NULL END"""


reg("normalize_experience_text", on_chain("raw", f"""SELECT source_job_id, url, collected_at, experience_years,
 {_experience_text("experience_years")} AS experience_text FROM raw"""))
reg("months_to_years", "SELECT l_orderkey, l_linenumber, l_quantity / 12 AS years FROM lineitem")
reg("expiry_status", """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-08-02 00:00:00' THEN 'expired' ELSE 'active' END AS status FROM orders""")
reg("epoch_to_date", """SELECT event_id, coalesce(strftime(DATE '1970-01-01' + CAST(floor(value * 10000000 / 86400) AS INTEGER), '%Y-%m-%d'),
 substr(CAST(ts AS VARCHAR), 1, 10)) AS posted FROM events""")
reg("dedupe_keep_missing_ids", on_chain("raw", """SELECT source_job_id, url, collected_at FROM (
 SELECT * FROM raw WHERE source_job_id IS NOT NULL AND trim(source_job_id, ' ') <> '' AND lower(trim(source_job_id, ' ')) NOT IN ('nan', 'none')
 QUALIFY row_number() OVER (PARTITION BY source_job_id ORDER BY url ASC, collected_at ASC NULLS FIRST) = 1)
 UNION ALL SELECT source_job_id, url, collected_at FROM raw
 WHERE NOT (source_job_id IS NOT NULL AND trim(source_job_id, ' ') <> '' AND lower(trim(source_job_id, ' ')) NOT IN ('nan', 'none'))
  OR source_job_id IS NULL"""))

# -- 2.1 sources and sinks (CSV round trips: an empty field reads back as null)
_RAWCOLS = [c for c in _R.RAW_COLUMNS]
_NULLIF = ", ".join(f"nullif({c}, '') AS {c}" for c in _RAWCOLS if c != "description")
_DIG = "sha256(nullif(description, '')) AS description_sha256"
_PLAT = ("CASE WHEN contains(url, 'sabbar.com') THEN 'sabbar' WHEN contains(url, 'tanqeeb.com') THEN 'tanqeeb' "
         "WHEN contains(url, 'gulftalent.com') THEN 'golftalent' END")
reg("read_bronze", on_chain("raw", f"SELECT {_NULLIF}, {_DIG}, {_PLAT} AS platform FROM raw"))
reg("ingest_new_files", on_chain("raw", f"""SELECT {_NULLIF}, {_DIG}, {_PLAT} AS platform FROM raw
 UNION ALL SELECT {', '.join('NULL' for c in _RAWCOLS)}, '(bad row)' FROM nation, range(2)"""))
reg("quarantine_bad_rows", on_chain("raw", """SELECT 'good' AS kind, count(*) AS row_count FROM raw
 UNION ALL SELECT 'bad' AS kind, count(*) AS row_count FROM nation"""))
reg("route_by_platform", on_chain("raw", f"SELECT {_NULLIF}, {_DIG}, CASE WHEN job_source = 'Jadarat.com' THEN 'jadarat' ELSE {_PLAT} END AS platform FROM raw"))
reg("read_seed", """SELECT upper(n.n_name) AS raw_value_normalized, n.n_name AS mapped_city, r.r_name AS mapped_region
 FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
reg("conform_columns", on_chain("raw", ", ".join(["SELECT " + ", ".join(
    c if c != "industry" else "CASE WHEN contains(url, 'tanqeeb.com') AND NOT contains(url, 'sabbar.com') THEN NULL ELSE industry END AS industry"
    for c in _RAWCOLS if c != "description")]) + ", CASE WHEN contains(url, 'tanqeeb.com') AND NOT contains(url, 'sabbar.com') THEN NULL ELSE sha256(description) END AS description_sha256 FROM raw"))
reg("write_csv_snapshot", on_chain("raw", f"SELECT {_NULLIF}, {_DIG} FROM raw"))
_STATUS2 = [*_SNAP[:1], ("st", f"""SELECT job_key, 'snapshot' AS kind, normalized_job_status, collected_at,
 CASE WHEN job_key NOT IN (SELECT job_key FROM src2) OR (normalized_job_status = 'Active' AND collected_at < {_CUT}) THEN {_T2} END AS valid_to FROM final""")]
_M = "job_key, normalized_job_status, collected_at, CAST(NULL AS TIMESTAMP) AS valid_to FROM final"
reg("materialize", on_chain("final", f"""SELECT 'view' AS kind, {_M} WHERE collected_at <= {_CUT}
 UNION ALL SELECT 'table', {_M} WHERE collected_at <= {_CUT}
 UNION ALL SELECT 'incremental', {_M} WHERE collected_at <= {_CUT} OR collected_at > (SELECT max(collected_at) FROM final WHERE collected_at <= {_CUT})
 UNION ALL SELECT kind, job_key, normalized_job_status, collected_at, valid_to FROM st
 UNION ALL SELECT 'snapshot', s.job_key, s.normalized_job_status, s.collected_at, NULL FROM src2 s JOIN final f ON f.job_key = s.job_key
  WHERE s.normalized_job_status IS DISTINCT FROM f.normalized_job_status""", _STATUS2))
reg("append_log", on_star(f"""SELECT w.job_key,
 CASE WHEN f.collected_at <= {_CUT} THEN TIMESTAMP '2026-12-01 00:00:00' ELSE TIMESTAMP '2026-12-02 00:00:00' END AS processed_at,
 CAST(coalesce(c.n, 0) AS INTEGER) AS skill_count,
 CASE WHEN coalesce(c.n, 0) > 0 THEN 'skills_found' ELSE 'no_skills_found' END AS status
 FROM work w JOIN final f ON w.job_key = f.job_key
 LEFT JOIN (SELECT job_key, count(*) AS n FROM extracted GROUP BY job_key) c ON w.job_key = c.job_key"""))

# the embedded object: chunks decoded as JSON string literals (kept raw when
# that fails), joined, and from the id on the shortest text that is valid JSON
_PUSH = r'self\.__next_f\.push\(\[1,"((?:[^"\\]|\\.)*)'
_UUID = ("substr(md5(CAST(page_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(page_id AS VARCHAR)), 9, 4) || '-' || "
         "substr(md5(CAST(page_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(page_id AS VARCHAR)), 17, 4) || '-' || "
         "substr(md5(CAST(page_id AS VARCHAR)), 21, 12)")
reg("reassemble_embedded_json", _JP + f""", bufs AS (
  SELECT page_id, {_UUID} AS uuid, array_to_string(list_transform(regexp_extract_all(html, '{_PUSH}', 1),
   lambda p: CASE WHEN json_valid('"' || p || '"') THEN json_extract_string('"' || p || '"', '$') ELSE p END), '') AS buf
  FROM jp),
 tails AS (SELECT page_id, substr(buf, nullif(instr(buf, '{{"id":"' || uuid || '","partner'), 0)) AS tail FROM bufs),
 objs AS (SELECT page_id, tail[1:list_filter(range(1, len(tail) + 1), lambda i: tail[i] = '}}' AND json_valid(tail[1:i]))[1]] AS obj FROM tails)
SELECT page_id, CASE WHEN json_valid(obj) THEN json_extract_string(obj, '$.jobPositionValue') END AS job_title,
 CASE WHEN json_valid(obj) THEN json_extract_string(obj, '$.cityValue') END AS city,
 CASE WHEN json_valid(obj) THEN json_extract_string(obj, '$.experienceYears') END AS experience_years FROM objs""")

_OBJ_CTES = f""", bufs AS (
  SELECT page_id, {_UUID} AS uuid, array_to_string(list_transform(regexp_extract_all(html, '{_PUSH}', 1),
   lambda p: CASE WHEN json_valid('"' || p || '"') THEN json_extract_string('"' || p || '"', '$') ELSE p END), '') AS buf
  FROM jp),
 tails AS (SELECT page_id, uuid, substr(buf, nullif(instr(buf, '{{"id":"' || uuid || '","partner'), 0)) AS tail FROM bufs),
 objs AS (SELECT page_id, uuid, CAST(tail[1:list_filter(range(1, len(tail) + 1), lambda i: tail[i] = '}}' AND json_valid(tail[1:i]))[1]] AS JSON) AS o FROM tails)
"""


def _first_key(j: str, keys: list[str], then=lambda v, j, k: v) -> str:
    return "CASE " + " ".join(f"WHEN {_truthy(j, '$.' + k)} THEN " + then(f"json_extract_string({j}, '$.{k}')", j, k) for k in keys) + " END"


def _experience(v: str, j: str, k: str) -> str:
    kind = f"json_type({j}, '$.{k}')"
    return f"(CASE WHEN {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN {v} WHEN {kind} = 'VARCHAR' THEN {_experience_text(v)} END)"


_EXP_KEYS = ["experienceYears", "experienceYearsValue", "minExperienceYears", "yearsOfExperience", "yearsOfExperienceValue", "experience",
             "experienceValue", "requiredExperienceYears"]
_ANY_EXP = " OR ".join(_truthy("o", f"$.{k}") for k in _EXP_KEYS)
_CODES = {
    "Riyadh Region": "RIYADH", "Makkah Region": "JEDDAH MAKKAH TAIF", "Madinah Region": "MEDINA MADINAH YANBU",
    "Eastern Province": "DAMMAM KHOBAR DHAHRAN JUBAIL QATIF AL_AHSA HOFUF HAFAR_AL_BATIN", "Asir Region": "ABHA KHAMIS_MUSHAYT BISHA",
    "Tabuk Region": "TABUK", "Qassim Region": "QASSIM BURAYDAH UNAYZAH", "Hail Region": "HAIL", "Al Jouf Region": "JOUF SAKAKA",
    "Al Bahah Region": "BAHAH", "Jazan Region": "JIZAN", "Najran Region": "NAJRAN", "Northern Borders Region": "ARAR"}
_CODE_REGION = "MAP {" + ", ".join(f"'SA_{c}': '{r}'" for r, cs in _CODES.items() for c in cs.split()) + "}"
_JO = "json_extract_string(o, '$.{}')"
_LINK = """(?is)<a\\b(?:[^>"'']|"[^"]*"|''[^'']*'')*?\\bhref="([^"]*/en/jobs/companies/[^"]*)"(?:[^>"'']|"[^"]*"|''[^'']*'')*>(.*?)</a\\s*>"""
reg("embedded_to_posting", _JSONLD + _OBJ_CTES + f"""SELECT page_id, uuid AS source_job_id,
 coalesce(nullif({_to_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, ''), nullif({_JO.format('jobPositionValue')}, '')) AS job_title, url,
 coalesce(nullif({_to_text(f"regexp_extract(html, '{_LINK}', 2)")}, ''), nullif({_JO.format('partnerName')}, ''),
  nullif(json_extract_string(j, '$.hiringOrganization.name'), '')) AS company_name,
 CASE WHEN starts_with(regexp_extract(html, '{_LINK}', 1), '/') THEN 'https://sabbar.com' || regexp_extract(html, '{_LINK}', 1)
  WHEN {_truthy('o', '$.partnerSlug')} THEN 'https://sabbar.com/en/jobs/companies/' || {_JO.format('partnerSlug')} END AS company_url,
 CASE WHEN {_truthy('o', '$.cityValue')} THEN {_JO.format('cityValue')} END AS city, {_CODE_REGION}[{_JO.format('city')}] AS region,
 CASE WHEN {_truthy('o', '$.countryValue')} THEN {_JO.format('countryValue')} ELSE 'Saudi Arabia' END AS country,
 coalesce(MAP {{'FULLTIME': 'Full Time', 'PARTTIME': 'Part Time', 'CONTRACT': 'Contract', 'SEASONAL': 'Seasonal',
  'INTERNSHIP': 'Internship'}}[{_JO.format('contractType')}], {_JO.format('contractType')}) AS employment_type,
 coalesce(MAP {{'ON_SITE': 'On-site', 'REMOTE': 'Remote', 'FIELD': 'Field'}}[{_JO.format('workplaceType')}], {_JO.format('workplaceType')}) AS workplace_type,
 CASE WHEN {_ANY_EXP} THEN {_first_key("o", _EXP_KEYS, _experience)}
  ELSE CAST(try_cast(json_extract_string(j, '$.experienceRequirements.monthsOfExperience') AS DOUBLE) / 12 AS VARCHAR) END AS experience_years,
 {_first_key("o", ["jobCategoryValue", "categoryValue"])} AS job_category,
 coalesce({_first_key("o", ["industryValue", "industry", "sectorValue", "sector", "categoryValue", "jobCategoryValue", "jobCategory"])},
  {_first_key("j", ["industry", "occupationalCategory"])}) AS industry,
 coalesce(json_type(o, '$.salary') <> 'NULL', false) OR coalesce(json_type(j, '$.baseSalary.value.value') <> 'NULL', false) AS is_salary_disclosed,
 {_first_key("o", ["sourceName", "sourceValue", "jobSourceName", "jobSource", "source"])} AS job_source,
 coalesce(CASE WHEN json_type(o, '$.createdDate') IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND CAST({_JO.format('createdDate')} AS DOUBLE) <> 0
  THEN strftime(make_timestamp(CAST(CAST({_JO.format('createdDate')} AS DOUBLE) * 1000000 AS BIGINT)), '%Y-%m-%d') END,
  nullif(json_extract_string(j, '$.datePosted'), '')) AS job_posted_date,
 coalesce(MAP {{'OPEN': 'active', 'CLOSED': 'closed'}}[{_JO.format('jobStatus')}], 'active') AS job_status, '2026-12-02 00:00:00' AS collected_at,
 trim(regexp_replace(regexp_replace(regexp_replace(json_extract_string(j, '$.description'), '<[^>]+>', ' ', 'g'), '[*_]+', '', 'g'), '\\s+', ' ', 'g'), ' ') AS description
 FROM jp JOIN objs USING (page_id) LEFT JOIN (SELECT page_id, j FROM jl) USING (page_id)""")

# -- further forms of registered operators
_AUTO = """coalesce(CAST(try_strptime({x}, '%Y-%m-%d') AS DATE), CAST(try_cast({x} AS TIMESTAMP) AS DATE),
 CAST(try_strptime({x}, '%d-%b-%Y') AS DATE), CAST(try_strptime({x}, '%m/%d/%Y') AS DATE))"""
reg("date_profile", on_chain("raw", f"""SELECT min(d) AS earliest, max(d) AS latest, count(*) FILTER (d IS NULL) AS invalid_dates
 FROM (SELECT {_AUTO.format(x='job_posted_date')} AS d FROM raw)"""))
reg("ranked_frequencies", """SELECT lang, frequency, CAST(rank() OVER (ORDER BY frequency DESC) AS INTEGER) AS rank
 FROM (SELECT lang, count(*) AS frequency FROM documents GROUP BY lang)""")
reg("dedupe_counts", on_chain("raw", """SELECT rows_before, rows_with_id, distinct_ids, rows_before - rows_with_id + distinct_ids AS rows_after,
 rows_with_id - distinct_ids AS rows_removed FROM (SELECT count(*) AS rows_before, count(*) FILTER (ok) AS rows_with_id,
 count(DISTINCT source_job_id) FILTER (ok) AS distinct_ids FROM (SELECT source_job_id, coalesce(trim(source_job_id, ' ') <> ''
  AND lower(trim(source_job_id, ' ')) NOT IN ('nan', 'none'), false) AS ok FROM raw))"""))
reg("check_posted_dates_as_of", on_chain("final", f"""SELECT job_key, job_posted_date, collected_at,
 parsed_job_posted_date, parsed_collected_date FROM (
 SELECT job_key, job_posted_date, collected_at, {_PD.format(x='job_posted_date')} AS parsed_job_posted_date,
  {_PD.format(x='collected_at')} AS parsed_collected_date FROM final)
 WHERE parsed_job_posted_date > parsed_collected_date OR parsed_job_posted_date > DATE '1998-01-01'"""))
reg("check_not_null_warn", on_chain("located", f"""SELECT {ID}, 'normalized_region_name' AS column_name, 'warn' AS severity
 FROM located WHERE normalized_region_name IS NULL"""))
reg("map_codes_default", "SELECT o_orderkey, CASE WHEN upper(trim(o_orderstatus, ' ')) = 'F' THEN 'closed' ELSE 'active' END AS status_label FROM orders")
reg("disclosed_not_null", _JSONLD + "SELECT page_id, json_extract_string(j, '$.baseSalary.value.value') IS NOT NULL AS is_salary_disclosed FROM jl")
