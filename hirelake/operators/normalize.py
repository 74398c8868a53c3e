"""Normalisation by rule tables.

Each function turns rule data (from :mod:`hirelake.functions.rules` or the
caller) into one Column expression, evaluated in the same projection as its
neighbours -- no joins, no UDFs.  Rule order is kept: ladders are built as
``CASE WHEN`` chains in table order (first match wins).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import (
    ColumnOrName, col, initcap_delims, like_any, regexp_substr, trim_chars,
)


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def map_codes(c: ColumnOrName, table: Sequence[tuple[str, Sequence[str]]],
              key: Callable[[Column], Column] | None = upper_trim,
              default: Column | str | None = None, passthrough: bool = True) -> Column:
    """Alias sets -> label, first matching set wins.  Unknown values pass
    through unchanged, or become ``default`` when ``passthrough`` is false."""
    x = col(c)
    k = key(x) if key is not None else x
    out = None
    for label, aliases in table:
        cond = k.isin(*aliases)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    other = x if passthrough else (F.lit(default) if isinstance(default, str) or default is None else default)
    return out.otherwise(other) if out is not None else other


# -- location ---------------------------------------------------------------

def city_from_url(url: ColumnOrName, city: ColumnOrName, site: str = rules.URL_CITY_SITE,
                  pattern: str = rules.URL_CITY_PATTERN) -> tuple[Column, Column]:
    """(slug city or null, slug city else the city column).  The slug is the
    lazy group between the markers, dashes -> spaces, for one site only."""
    u = col(url)
    slug = F.regexp_extract(u, pattern, 1)
    from_url = F.when(u.contains(site), F.replace(F.when(slug != "", slug), F.lit("-"), F.lit(" ")))
    return from_url, F.coalesce(from_url, col(city))


def city_lookup_key(city: ColumnOrName) -> Column:
    """``upper(trim(city, ' '''))`` -- the seed join key."""
    return F.upper(trim_chars(city, " '"))


def normalize_region(region: ColumnOrName, seed_region: ColumnOrName, region_initcap: ColumnOrName | None = None,
                     aliases=rules.REGION_ALIASES) -> Column:
    """Ordered: entity garbage -> null; a non-blank mapped region; alias
    groups -> canonical; ``Saudi Arabia - X`` -> ``X``; the country -> null;
    else the initcap'd text.  ``region_initcap`` lets the caller materialise
    ``initcap_delims(region)`` once."""
    r = col(region)
    ic = col(region_initcap) if region_initcap is not None else initcap_delims(r)
    seed = col(seed_region)
    garbage = None
    for m in rules.REGION_GARBAGE_MARKERS:
        cond = r.contains(m)
        garbage = cond if garbage is None else (garbage | cond)
    out = F.when(garbage, F.lit(None).cast("string")).when(seed.isNotNull() & (F.trim(seed) != ""), seed)
    for canonical, names in aliases:
        out = out.when(ic.isin(*names), F.lit(canonical))
    prefix = rules.REGION_COUNTRY_PREFIX
    return (
        out.when(ic.startswith(prefix), F.replace(ic, F.lit(prefix), F.lit("")))
        .when(ic == rules.REGION_COUNTRY_NAME, F.lit(None).cast("string"))
        .otherwise(ic)
    )


def normalize_country(country: ColumnOrName, aliases=rules.COUNTRY_ALIASES) -> Column:
    """Exact alias -> country name, else unchanged."""
    return map_codes(country, aliases, key=None)


# -- attributes -------------------------------------------------------------

def normalize_workplace(c: ColumnOrName) -> Column:
    return map_codes(c, rules.WORKPLACE_ALIASES)


def normalize_employment_type(c: ColumnOrName) -> Column:
    return map_codes(c, rules.EMPLOYMENT_ALIASES)


def normalize_status(c: ColumnOrName) -> Column:
    return map_codes(c, rules.STATUS_ALIASES)


def normalize_source(source: ColumnOrName) -> Column:
    """The "unspecified" label -> null, else initcap(trim())."""
    s = col(source)
    return F.when(upper_trim(s) == rules.UNSPECIFIED_SOURCE, F.lit(None).cast("string")).otherwise(
        initcap_delims(F.trim(s)))


def derive_channel(url: ColumnOrName, source: ColumnOrName) -> Column:
    """Site of the URL vs. the stated source.  Three-valued logic is kept on
    purpose: a null source never takes an aggregated branch."""
    u, s = col(url), upper_trim(col(source))
    return (
        F.when(u.contains(rules.TANQEEB_SITE) & (s != rules.TANQEEB_SOURCE), F.lit(rules.CHANNEL_VIA_TANQEEB))
        .when(u.contains(rules.SABBAR_SITE) & (s == rules.UNSPECIFIED_SOURCE), F.lit(rules.CHANNEL_VIA_SABBAR))
        .otherwise(F.lit(rules.CHANNEL_DIRECT))
    )


def channel_priority(channel: ColumnOrName) -> Column:
    c = col(channel)
    out = None
    for label, rank in rules.CHANNEL_PRIORITY:
        out = F.when(c == label, F.lit(rank)) if out is None else out.when(c == label, F.lit(rank))
    return out.otherwise(F.lit(rules.CHANNEL_PRIORITY_OTHER))


# -- experience ---------------------------------------------------------------

def experience_parts(exp: ColumnOrName) -> dict[str, Column]:
    """Flags and the first two digit runs of an experience text."""
    e = col(exp)
    return {
        "experience_years_clean": F.trim(e),
        "is_date_like": F.trim(e).rlike(rules.EXPERIENCE_DATE_LIKE),
        "exp_num1": regexp_substr(e, r"\d+", 1).try_cast("int"),
        "exp_num2": regexp_substr(e, r"\d+", 2).try_cast("int"),
        "is_fresh": like_any(e, [f"%{m}%" for m in rules.EXPERIENCE_FRESH_MARKERS]),
        "is_open_ended": e.contains(rules.EXPERIENCE_OPEN_MARKER),
        "is_upper_bound_only": like_any(e, [f"%{m}%" for m in rules.EXPERIENCE_UPPER_BOUND_MARKERS]),
    }


def experience_range(clean: ColumnOrName, date_like: ColumnOrName, n1: ColumnOrName, n2: ColumnOrName,
                     fresh: ColumnOrName, open_ended: ColumnOrName, upper_only: ColumnOrName) -> dict[str, Column]:
    """(min, max, open-ended flag).  Digits are taken one run at a time, so
    ``2.5`` reads as 2..5; ``less than a year`` gives min 0 and no max."""
    c, d, a, b = col(clean), col(date_like), col(n1), col(n2)
    f, o, u = col(fresh), col(open_ended), col(upper_only)
    nothing = c.isNull() | d
    null_int = F.lit(None).cast("int")
    mn = F.when(nothing, null_int).when(f, F.lit(0)).when(u, F.lit(0)).otherwise(a)
    mx = (F.when(nothing, null_int).when(f, F.lit(0)).when(u, F.coalesce(a, b))
          .when(o, null_int).when(b.isNotNull(), b).otherwise(a))
    flag = F.when(d, F.lit(False)).otherwise(o)
    return {"experience_min_years": mn, "experience_max_years": mx, "experience_is_open_ended": flag}


def derive_seniority(min_years: ColumnOrName, max_years: ColumnOrName, raw_open: ColumnOrName) -> Column:
    """Threshold ladder.  Reads the raw open-ended flag (not the date-guarded
    one), as the source rules do."""
    mn, mx, o = col(min_years), col(max_years), col(raw_open)
    out = F.when(mn.isNull(), F.lit(rules.SENIORITY_NOT_SPECIFIED))
    for floor_years, label in rules.SENIORITY_OPEN_LADDER:
        out = out.when(o & (mn >= floor_years), F.lit(label))
    out = out.when(o, F.lit(rules.SENIORITY_OPEN_DEFAULT))
    for ceiling, label in rules.SENIORITY_CLOSED_LADDER:
        out = out.when(mx <= ceiling, F.lit(label))
    return out.otherwise(F.lit(rules.SENIORITY_CLOSED_DEFAULT))


# -- category -----------------------------------------------------------------

def category_from_title(title: ColumnOrName, table=rules.CATEGORY_TITLE_RULES) -> Column:
    """First rule whose case-insensitive LIKE patterns hit the title."""
    t = col(title)
    out = None
    for label, patterns in table:
        cond = like_any(t, patterns)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def normalize_category(raw: ColumnOrName, derived: ColumnOrName,
                       synonyms=rules.CATEGORY_SYNONYMS) -> dict[str, Column]:
    """Raw category (initcap'd, synonyms mapped) when present, else the
    title-derived one; plus the has-data and derived-from-title flags."""
    r, d = col(raw), col(derived)
    present = F.trim(F.coalesce(r, F.lit(""))) != ""
    ic = initcap_delims(F.trim(r))
    mapped = map_codes(ic, [(to, [frm]) for frm, to in synonyms], key=None)
    return {
        "normalized_job_category": F.when(present, mapped).otherwise(d),
        "has_category_data": present | d.isNotNull(),
        "is_category_derived_from_title": ~present & d.isNotNull(),
    }


# -- placeholders ---------------------------------------------------------------

def placeholder_for_missing(c: ColumnOrName, placeholder: str = rules.MISSING_PLACEHOLDER) -> tuple[Column, Column]:
    """(trimmed value or placeholder, has-data flag)."""
    x = col(c)
    t = F.trim(x)
    return F.coalesce(F.when(t != "", t), F.lit(placeholder)), x.isNotNull() & (t != "")


def void_untrusted_column(c: ColumnOrName, source: ColumnOrName,
                          bad_source: str = rules.UNTRUSTED_URL_SOURCE) -> tuple[Column, Column]:
    """(value nulled for one source, validity flag)."""
    x, s = col(c), col(source)
    return (
        F.when(s == bad_source, F.lit(None).cast("string")).otherwise(x),
        F.when(s == bad_source, F.lit(False)).otherwise(x.isNotNull()),
    )
