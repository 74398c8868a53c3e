"""Rule tables for the postings profile.

Everything below the "Fixed values" marker is data that must equal the
behaviour being reproduced (labels, aliases, keywords, thresholds).  It is
written out plainly, in the order the rules are applied, so that the rule
order -- which matters for first-match ladders -- is visible.  The code that
applies the rules lives in :mod:`hirelake.operators.normalize`; callers may
pass their own tables instead.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Null sentinel and separator of the surrogate-key convention (md5 of fields
# joined by '-', with nulls replaced by this text).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"

# Word delimiters of the warehouse initcap: whitespace plus these characters.
INITCAP_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

# Literal replacements applied at staging.
TITLE_SUFFIX_TO_DROP = " 📣 Job Ad"
INDUSTRY_ENTITY_FROM = " &amp; "
INDUSTRY_ENTITY_TO = " & "
SOURCE_SUFFIX_TO_DROP = ".com"

# Forgiving boolean text.
BOOLEAN_TRUE = ["true", "t", "yes", "y", "on", "1"]
BOOLEAN_FALSE = ["false", "f", "no", "n", "off", "0"]

# City from URL: only for this site, slug between these markers.
URL_CITY_SITE = "sabbar.com"
URL_CITY_PATTERN = "/c-(.+?)-r-"

# Region: entity garbage markers (matched with LIKE '%…%').
REGION_GARBAGE_MARKERS = ["&amp;#", "&Amp;#"]

# Region alias groups, in rule order: (canonical, initcap'd aliases).
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

# Country aliases (exact match) and the one country kept.
COUNTRY_ALIASES = [("Saudi Arabia", ["Saudi"])]
KEEP_COUNTRY = "Saudi Arabia"

# Workplace, employment type and status: (label, upper-case aliases), in order.
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

# Source label that means "unknown", compared after upper(trim()).
UNSPECIFIED_SOURCE = "AGGREGATED (SOURCE NOT SPECIFIED)"

# Collection channel rules.
CHANNEL_DIRECT = "Direct"
CHANNEL_VIA_TANQEEB = "Aggregated via Tanqeeb"
CHANNEL_VIA_SABBAR = "Aggregated via Sabbar"
TANQEEB_SITE = "tanqeeb.com"
TANQEEB_SOURCE = "TANQEEB"
SABBAR_SITE = "sabbar.com"
# Channel priority for the preferred row (lower wins; anything else is 4).
CHANNEL_PRIORITY = [(CHANNEL_DIRECT, 1), (CHANNEL_VIA_SABBAR, 2), (CHANNEL_VIA_TANQEEB, 3)]
CHANNEL_PRIORITY_OTHER = 4

# Relative posted dates.
WEEKDAYS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]

# Experience text.
EXPERIENCE_DATE_LIKE = r"^\d{1,2}/\d{1,2}/\d{4}$"
EXPERIENCE_FRESH_MARKERS = ["fresh", "no experience"]
EXPERIENCE_UPPER_BOUND_MARKERS = ["up to", "less than"]
EXPERIENCE_OPEN_MARKER = "+"
SENIORITY_NOT_SPECIFIED = "Not Specified"
# Open-ended ranges: minimum-year thresholds, highest first; below all -> last label.
SENIORITY_OPEN_LADDER = [
    (10, "Executive / Director"),
    (5, "Senior-level"),
    (3, "Associate / Mid-level"),
]
SENIORITY_OPEN_DEFAULT = "Entry-level"
# Closed ranges: maximum-year ceilings, lowest first; above all -> last label.
SENIORITY_CLOSED_LADDER = [
    (2, "Entry-level"),
    (5, "Associate / Mid-level"),
    (10, "Senior-level"),
]
SENIORITY_CLOSED_DEFAULT = "Executive / Director"
SENIORITY_LABELS = [
    "Entry-level", "Associate / Mid-level", "Senior-level", "Executive / Director", "Not Specified",
]

# Category from title: ordered rules of case-insensitive LIKE patterns.
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
# Raw category synonyms, compared after initcap(trim()).
CATEGORY_SYNONYMS = [
    ("Information Technology", "IT"),
    ("Human Resources", "HR"),
    ("Administration", "Administrative"),
    ("Healthcare & Medical", "Healthcare / Medical"),
    ("Accounting, Finance & Banking", "Finance"),
]
# Categories in scope.
CATEGORIES_IN_SCOPE = [
    "Engineering", "IT", "Administrative", "Sales", "Marketing", "HR", "Finance",
    "Analyst", "Receptionist", "Healthcare / Medical",
]

# Industry placeholder and the source whose company URL is not trusted.
MISSING_PLACEHOLDER = "Not Specified"
UNTRUSTED_URL_SOURCE = "Gulftalent"

# Skill confidence threshold and tagger statuses.
CONFIDENCE_THRESHOLD = 0.85
CANDIDATE_STRIP_CHARS = " \n\t,.;:!?()[]{}-_/&"
ARABIC_CLASS = r"[\x{0600}-\x{06FF}]"
STATUS_FOUND = "skills_found"
STATUS_NONE = "no_skills_found"
STATUS_ERROR = "error"

# Snapshot: columns whose change opens a new version.
SNAPSHOT_CHECK_COLS = ["normalized_job_status", "normalized_job_category", "seniority_level"]

# Landing: file-name keyword -> platform folder, first keyword wins.
PLATFORM_KEYWORDS = [("sabbar", "sabbar"), ("tanqeeb", "tanqeeb"), ("gulftalent", "golftalent"), ("jadarat", "jadarat")]

# City as job cards spell it -> region, fixed values.
CARD_CITY_REGION = [
    ("Riyadh", "Riyadh Region"),
    ("Jeddah", "Makkah Region"), ("Makkah", "Makkah Region"), ("Taif", "Makkah Region"), ("Al Taif", "Makkah Region"),
    ("Rabigh", "Makkah Region"),
    ("Medina", "Madinah Region"), ("Madinah", "Madinah Region"), ("Yanbu", "Madinah Region"),
    ("Eastern", "Eastern Province"), ("Eastern Province", "Eastern Province"), ("Al Damam", "Eastern Province"),
    ("Dammam", "Eastern Province"), ("Khobar", "Eastern Province"), ("Dhahran", "Eastern Province"),
    ("Jubail", "Eastern Province"), ("Qatif", "Eastern Province"), ("Al Ahsa", "Eastern Province"),
    ("Hafar Al-Batin", "Eastern Province"),
    ("Asir", "Asir Region"), ("Abha", "Asir Region"), ("Khamis Mushait", "Asir Region"), ("Bisha", "Asir Region"),
    ("Tabuk", "Tabuk Region"), ("Qassim", "Qassim Region"), ("Hail", "Hail Region"),
    ("Jouf", "Al Jouf Region"), ("Al Jouf", "Al Jouf Region"),
    ("Bahah", "Al Bahah Region"), ("Al Bahah", "Al Bahah Region"),
    ("Jizan", "Jazan Region"), ("Nagran", "Najran Region"), ("Najran", "Najran Region"),
    ("Northern Borders", "Northern Borders Region"),
]

# Embedded objects: city code -> region, codes -> labels, and the keys a value may stand under.
EMBEDDED_CITY_REGION = [
    ("SA_RIYADH", "Riyadh Region"),
    ("SA_JEDDAH", "Makkah Region"), ("SA_MAKKAH", "Makkah Region"), ("SA_TAIF", "Makkah Region"),
    ("SA_MEDINA", "Madinah Region"), ("SA_MADINAH", "Madinah Region"), ("SA_YANBU", "Madinah Region"),
    ("SA_DAMMAM", "Eastern Province"), ("SA_KHOBAR", "Eastern Province"), ("SA_DHAHRAN", "Eastern Province"),
    ("SA_JUBAIL", "Eastern Province"), ("SA_QATIF", "Eastern Province"), ("SA_AL_AHSA", "Eastern Province"),
    ("SA_HOFUF", "Eastern Province"), ("SA_HAFAR_AL_BATIN", "Eastern Province"),
    ("SA_ABHA", "Asir Region"), ("SA_KHAMIS_MUSHAYT", "Asir Region"), ("SA_BISHA", "Asir Region"),
    ("SA_TABUK", "Tabuk Region"),
    ("SA_QASSIM", "Qassim Region"), ("SA_BURAYDAH", "Qassim Region"), ("SA_UNAYZAH", "Qassim Region"),
    ("SA_HAIL", "Hail Region"),
    ("SA_JOUF", "Al Jouf Region"), ("SA_SAKAKA", "Al Jouf Region"),
    ("SA_BAHAH", "Al Bahah Region"), ("SA_JIZAN", "Jazan Region"), ("SA_NAJRAN", "Najran Region"), ("SA_ARAR", "Northern Borders Region"),
]
EMBEDDED_CONTRACT = [("FULLTIME", "Full Time"), ("PARTTIME", "Part Time"), ("CONTRACT", "Contract"), ("SEASONAL", "Seasonal"),
                     ("INTERNSHIP", "Internship")]
EMBEDDED_WORKPLACE = [("ON_SITE", "On-site"), ("REMOTE", "Remote"), ("FIELD", "Field")]
EMBEDDED_STATUS = [("OPEN", "active"), ("CLOSED", "closed")]
EMBEDDED_STATUS_OTHER = "active"
EMBEDDED_COUNTRY = "Saudi Arabia"
EMBEDDED_COMPANY_PATH = "/en/jobs/companies/"
EMBEDDED_EXPERIENCE_KEYS = ["experienceYears", "experienceYearsValue", "minExperienceYears", "yearsOfExperience", "yearsOfExperienceValue",
                            "experience", "experienceValue", "requiredExperienceYears"]
EMBEDDED_INDUSTRY_KEYS = ["industryValue", "industry", "sectorValue", "sector", "categoryValue", "jobCategoryValue", "jobCategory"]
EMBEDDED_CATEGORY_KEYS = ["jobCategoryValue", "categoryValue"]
EMBEDDED_SOURCE_KEYS = ["sourceName", "sourceValue", "jobSourceName", "jobSource", "source"]

# Raw posting columns, in order.
RAW_COLUMNS = [
    "source_job_id", "job_title", "url", "company_name", "company_url", "city", "region",
    "country", "employment_type", "workplace_type", "experience_years", "job_category",
    "industry", "is_salary_disclosed", "job_source", "job_posted_date", "job_status",
    "collected_at", "description",
]

# Static-dataset conformance: columns dropped, renamed, and constants added.
STATIC_DROP = ["comp_type", "comp_size", "benefits", "contract", "positions", "gender"]
STATIC_RENAME = {"comp_name": "company_name", "eco_activity": "industry", "contract": "contract_type",
                 "exper": "experience_years", "job_date": "job_posted_date"}
STATIC_NULL_COLUMNS = ["url", "company_url", "employment_type", "job_category", "description"]
STATIC_CONSTANTS = {"country": "Saudi Arabia", "job_source": "Jadarat.com", "workplace_type": "Onsite",
                    "job_status": "Closed"}
