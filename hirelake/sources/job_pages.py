"""Job pages derived from the ``pages`` table.

The driver's pages are generic web pages.  This portable SQL appends, to
every page, the three structures job sites carry: a JSON-LD script (a lone
object, a list, a broken script before a good one, or a non-job object), a
job card element with ``data-job-*`` attributes, and two script chunks that
together hold an escaped JSON object.  Values derive from the page itself
(its ``h1`` and id).  ``chr(92)`` is the backslash and ``chr(34)`` the double
quote, so the text needs no escapes in either SQL dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.sources.tables import read_table



def _escaped(x: str) -> str:
    """One level of HTML escaping, as SQL."""
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _inside(x: str) -> str:
    """Markup that holds other markup as escaped text, as SQL."""
    return f"('<p>' || {_escaped(x)} || '</p>')"


# the card's description: markup pasted as text up to three times
_MARKUP = "('<p>Role <b>' || title_attr || '</b> at ' || org || '</p>')"
_DESC = ("CASE CAST(page_id % 4 AS INT) WHEN 0 THEN " + _MARKUP + " WHEN 1 THEN " + _inside(_MARKUP)
         + " WHEN 2 THEN " + _inside(_inside(_MARKUP)) + " ELSE " + _inside(_inside(_inside(_MARKUP))) + " END")

JOB_PAGES_SQL = """
SELECT page_id, url,
 html
 || CASE CAST(page_id % 4 AS INT)
    WHEN 0 THEN '<script type="application/ld+json">' || obj || '</script>'
    WHEN 1 THEN '<script type="application/ld+json">[{"@type":"Organization","name":"Board"}, ' || obj || ']</script>'
    WHEN 2 THEN '<script type="application/ld+json">{"@type": "JobPosting", broken</script><script type="application/ld+json">' || obj || '</script>'
    ELSE '<script type="application/ld+json">{"@type":"WebPage","name":"About"}</script>' END
 || '<article class="first" data-job-note="a > b" data-job-categories="Sales &amp; more" data-job-categories="second" data-drawer-trigger="job-card" data-job-id="' || CAST(page_id AS STRING)
 || '" data-job-name="' || title_attr || '" data-job-url="/jobs/' || CAST(page_id AS STRING)
 || '" data-job-company="' || org || '" data-job-type=" Full Time " data-job-salary="'
 || CASE WHEN page_id % 3 = 0 THEN '' ELSE '5000' END
 || '" data-job-closed="' || CASE WHEN page_id % 5 = 0 THEN '1' ELSE '0' END
 || '" data-job-country="' || CASE WHEN page_id % 7 = 0 THEN '' ELSE 'Saudi' END
 || '" data-job-state="' || CASE WHEN page_id % 6 = 0 THEN ' ' ELSE city END
 || '" data-job-workplace-location="On-site - Saudi - ' || city || '"><h2>' || title_attr || '</h2><div class="hidden job-card-description-source">' || {desc} || '</div></article>'
 || CASE WHEN page_id % 4 = 1 THEN '<a title="a > b" href="/en/jobs/companies/c-' || CAST(page_id AS STRING) || '"><b>Link</b> &amp; Co</a>' ELSE '' END
 || '<script>self.__next_f.push([1,"' || substr(chunk, 1, 30) || '"])</script>'
 || '<script>self.__next_f.push([1,"' || substr(chunk, 31) || '"])</script>'
 AS html
FROM (
 SELECT page_id, url, html, org, city, title_attr,
  '{"@type":"JobPosting","title":"' || jt || '","identifier":{"value":"P' || CAST(page_id AS STRING) || '"},'
  || '"hiringOrganization":{"name":"' || org || '"'
  || CASE WHEN page_id % 3 = 0 THEN ',"sameAs":"https://org.example/' || CAST(page_id AS STRING) || '"' ELSE '' END
  || '},"jobLocation":{"address":{"addressLocality":"' || city || '","addressRegion":"Region '
  || CAST(page_id % 13 AS STRING) || '","addressCountry":"SA"}},"employmentType":'
  || CASE WHEN page_id % 2 = 0 THEN '["FULL_TIME","CONTRACTOR"]' ELSE '"FULL_TIME"' END
  || ',"jobLocationType":"' || CASE WHEN page_id % 5 = 0 THEN 'TELECOMMUTE' ELSE '' END
  || '","experienceRequirements":{"monthsOfExperience":' || CAST(page_id % 61 AS STRING) || '},"baseSalary":'
  || CASE WHEN page_id % 4 = 0 THEN '{}' ELSE '{"value":{"value":' || CAST(page_id * 10 AS STRING) || '}}' END
  || ',"datePosted":"2026-11-' || lpad(CAST(page_id % 28 + 1 AS STRING), 2, '0') || '","validThrough":"'
  || CASE CAST(page_id % 3 AS INT) WHEN 0 THEN '2026-12-01T00:00:00Z' WHEN 1 THEN '2026-12-31T10:00:00' ELSE 'soon' END
  || '","description":"<p>Role &amp; duties: ' || jt || '</p>"}' AS obj,
  replace(replace('{"id":"' || uuid || '","partnerId":' || CAST(page_id % 9 AS STRING) || ',"jobPositionValue":"' || jt
   || '","cityValue":"' || CASE WHEN page_id % 9 = 4 THEN '' ELSE city END || '"' || split_part(',"createdDate":' || CAST(1700000000 + page_id * 86400 AS STRING)
    || '|,"createdDate":0|,"createdDate":"soon"|,"createdDate":1.7e9|', '|', CAST(page_id % 5 AS INT) + 1)
   || ',"meta":{"note":"a } b { c","inner":{"n":1}}'
   || split_part(',"experienceYears":"5-10"|,"experienceYears":"+3"|,"experienceYears":0,"minExperienceYears":4|,"experienceYears":false,"yearsOfExperience":"2 years"|,"experience":"02/05/2026"|,"experienceValue":2.5|,"experienceYears":true|', '|', CAST(page_id % 8 AS INT) + 1)
   || split_part(',"city":"SA_RIYADH"|,"city":"SA_ABHA"|,"city":"XX_NOWHERE"|,"city":null|', '|', CAST(page_id % 5 AS INT) + 1)
   || split_part(',"contractType":"FULLTIME"|,"contractType":"CONTRACT"|,"contractType":"ODD_CODE"|', '|', CAST(page_id % 4 AS INT) + 1)
   || split_part(',"workplaceType":"ON_SITE"|,"workplaceType":"HYBRID"|,"workplaceType":null|', '|', CAST(page_id % 4 AS INT) + 1)
   || split_part(',"jobStatus":"OPEN"|,"jobStatus":"CLOSED"|,"jobStatus":"PAUSED"|', '|', CAST(page_id % 4 AS INT) + 1)
   || split_part(',"salary":null|,"salary":0|,"salary":{"min":1}|', '|', CAST(page_id % 4 AS INT) + 1)
   || split_part(',"partnerName":"Partner ' || CAST(page_id AS STRING) || '","partnerSlug":"p-1"|,"partnerName":"","partnerSlug":""|', '|', CAST(page_id % 3 AS INT) + 1)
   || split_part(',"countryValue":"Egypt"|,"countryValue":""|,"countryValue":false|', '|', CAST(page_id % 4 AS INT) + 1)
   || split_part(',"industryValue":"","sector":"Tech"|,"industry":0,"sectorValue":"Retail"|,"categoryValue":"Cat A"|,"jobCategoryValue":"Cat B","industry":[]|', '|', CAST(page_id % 5 AS INT) + 1)
   || split_part(',"sourceName":"","jobSource":"IN_PLATFORM"|,"source":"AGGREGATED"|,"sourceValue":false|', '|', CAST(page_id % 4 AS INT) + 1) || '}',
   chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)) AS chunk
 FROM (
  SELECT page_id, url, html,
   replace(replace(h1, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)) AS jt,
   replace(h1, chr(34), '') AS title_attr,
   split_part('Acme Corp|Société Générale|Beta and Co|Gamma-Delta Ltd|Zeta Works', '|', CAST(page_id % 5 AS INT) + 1) AS org,
   split_part('Riyadh|Jeddah|Al Damam|Abha', '|', CAST(page_id % 4 AS INT) + 1) AS city,
   substr(md5(CAST(page_id AS STRING)), 1, 8) || '-' || substr(md5(CAST(page_id AS STRING)), 9, 4) || '-'
    || substr(md5(CAST(page_id AS STRING)), 13, 4) || '-' || substr(md5(CAST(page_id AS STRING)), 17, 4) || '-'
    || substr(md5(CAST(page_id AS STRING)), 21, 12) AS uuid
  FROM (SELECT page_id, url, html, regexp_extract(html, '<h1>(.*?)</h1>', 1) AS h1 FROM {pages}) a
 ) b
) c
"""


JOB_PAGES_SQL = JOB_PAGES_SQL.replace("{desc}", _DESC)


def job_pages_sql_for(pages: str = "pages") -> str:
    return JOB_PAGES_SQL.replace("{pages}", pages)


def job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # literal braces of the JSON text are doubled for the SQL formatter
    text = JOB_PAGES_SQL.replace("{", "{{").replace("}", "}}").replace("{{pages}}", "{pages}")
    return spark.sql(text, pages=read_table(spark, sf_dir, "pages"))
