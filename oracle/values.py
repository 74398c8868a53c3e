"""Values of the rules as the oracle states them: written out here, so that a wrong constant in the library is not on both sides."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
INITCAP_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
TITLE_SUFFIX_TO_DROP = " 📣 Job Ad"
BOOLEAN_TRUE = ["true", "t", "yes", "y", "on", "1"]
BOOLEAN_FALSE = ["false", "f", "no", "n", "off", "0"]
REGION_GARBAGE_MARKERS = ["&amp;#", "&Amp;#"]
REGION_ALIASES = [
    ("Riyadh Province", ["Riyadh", "Riyadh Region", "Riyadh Province"]),
    ("Makkah Al-Mukarramah Province", [
        "Jeddah", "Taif", "At Taif", "Mecca", "Jiddah", "Makkah", "Makkah Region",
        "Saudi Arabia-Jeddah", "Saudi Arabia - Jeddah", "Saudi Arabia - Taif",
    ]),
    ("Eastern Province", [
        "Eastern", "Eastern Province", "Dammam", "Dhahran", "Khobar",
        "Dhahran/ Al-Khobar (Hub-Based With Regional Coverage)", "Al-Khobar",
    ]),
    ("Al-Madinah Al-Munawwarah Province", ["Madinah", "Madinah Region"]),
    ("Qassim Province", ["Qassim", "Qassim Region"]),
    ("Northern Borders Province", ["Northern Borders", "Northern Borders Region"]),
    ("Hail Province", ["Hail", "Hail Region"]),
    ("Tabuk Province", ["Tabuk", "Tabuk Region", "Neom", "Amaala"]),
    ("Al-Jawf Province", ["Al Jouf", "Al Jouf Region", "Jouf"]),
    ("Al-Bahah Province", ["Al Baha", "Al Bahah Region", "Bahah"]),
    ("Aseer Province", ["Asir", "Asir Region", "Aseer", "'Asir"]),
    ("Najran Province", ["Najran", "Najran Region"]),
    ("Jazan Province", ["Jazan", "Jazan Region", "Gezan"]),
    ("Makkah Al-Mukarramah Province", ["Western", "Western Region", "Western Province"]),
    ("Riyadh Province", ["Central", "Central Region", "Central Province"]),
]
REGION_COUNTRY_PREFIX = "Saudi Arabia - "
REGION_COUNTRY_NAME = "Saudi Arabia"
WORKPLACE_ALIASES = [
    ("On-site", ["ON-SITE", "ONSITE", "ON SITE"]),
    ("Remote", ["REMOTE"]),
    ("Hybrid", ["HYBRID"]),
    ("Field", ["FIELD"]),
]
EMPLOYMENT_ALIASES = [
    ("Full Time", ["FULL TIME", "FULL_TIME", "FULLTIME"]),
    ("Part Time", ["PART TIME", "PART_TIME", "PARTTIME"]),
    ("Contract", ["CONTRACT", "CONTRACTOR"]),
    ("Freelance / Project", ["FREELANCE/ PROJECT", "FREELANCE", "PROJECT"]),
    ("Temporary", ["TEMPORARY EMPLOYEE", "TEMPORARY"]),
    ("Seasonal", ["SEASONAL"]),
    ("Internship", ["INTERNSHIP"]),
]
STATUS_ALIASES = [
    ("Active", ["ACTIVE"]),
    ("Closed", ["CLOSED"]),
    ("Expired", ["EXPIRED"]),
]
UNSPECIFIED_SOURCE = "AGGREGATED (SOURCE NOT SPECIFIED)"
WEEKDAYS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
SENIORITY_NOT_SPECIFIED = "Not Specified"
SENIORITY_OPEN_LADDER = [
    (10, "Executive / Director"),
    (5, "Senior-level"),
    (3, "Associate / Mid-level"),
]
SENIORITY_OPEN_DEFAULT = "Entry-level"
SENIORITY_CLOSED_LADDER = [
    (2, "Entry-level"),
    (5, "Associate / Mid-level"),
    (10, "Senior-level"),
]
SENIORITY_CLOSED_DEFAULT = "Executive / Director"
CATEGORY_TITLE_RULES = [
    ("Engineering", ["%engineer%", "%engineering%"]),
    ("IT", [
        "%developer%", "%software%", "%data %", "% it %", "% it", "it %",
        "%information technology%", "%network%", "%system admin%", "%cyber%",
        "%cybersecurity%", "%information security%", "%infosec%", "%soc analyst%",
        "%security analyst%", "%penetration test%", "%pentest%", "%siem%",
        "%front end%", "%front-end%", "%frontend%", "%back end%", "%back-end%",
        "%backend%", "%full stack%", "%full-stack%", "%fullstack%",
    ]),
    ("Administrative", ["%admin%", "%office manager%", "%secretary%", "%coordinator%"]),
    ("Sales", ["%sales%", "%account manager%", "%business development%"]),
    ("Marketing", ["%marketing%", "%social media%"]),
    ("HR", ["%hr %", "%human resources%", "%recruit%"]),
    ("Finance", ["%finance%", "%accountant%", "%accounting%"]),
    ("Analyst", ["%Analyst%", "%data analyst%", "%business analyst%"]),
    ("Receptionist", ["%Receptionist%"]),
    ("Healthcare / Medical", [
        "%nurse%", "%doctor%", "%physician%", "%pharmacist%", "%medical%",
        "%clinic%", "%dentist%",
    ]),
]
CATEGORY_SYNONYMS = [
    ("Information Technology", "IT"),
    ("Human Resources", "HR"),
    ("Administration", "Administrative"),
    ("Healthcare & Medical", "Healthcare / Medical"),
    ("Accounting, Finance & Banking", "Finance"),
]
CATEGORIES_IN_SCOPE = [
    "Engineering", "IT", "Administrative", "Sales", "Marketing", "HR", "Finance",
    "Analyst", "Receptionist", "Healthcare / Medical",
]
CONFIDENCE_THRESHOLD = 0.85
CANDIDATE_STRIP_CHARS = " \n\t,.;:!?()[]{}-_/&"
RAW_COLUMNS = [
    "source_job_id", "job_title", "url", "company_name", "company_url", "city", "region",
    "country", "employment_type", "workplace_type", "experience_years", "job_category",
    "industry", "is_salary_disclosed", "job_source", "job_posted_date", "job_status",
    "collected_at", "description",
]
