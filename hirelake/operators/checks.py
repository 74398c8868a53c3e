"""Data checks.  Each returns the offending rows: empty means pass.

They are plain filters, anti-joins and grouped counts, so they scale with
the table and can run as part of the same job that builds it.

A suite runs many checks of a table together: the rules on rows are counted in
one scan (:func:`suite_counts`, with the uniqueness of a key in the same
aggregate) and the rows that fail are listed with the names of the rules
(:func:`failing_rows`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import ColumnOrName, col
from hirelake.operators.joins import cross_join_scalars, orphan_rows


# -- rules on rows: true where a row fails, null counts as passed ----------------

def null_rule(column: str) -> Column:
    return F.col(column).isNull()


def values_rule(column: str, values: Sequence[str]) -> Column:
    """Non-null values outside the list (a null is not a violation)."""
    return ~F.col(column).isin(*values)


def range_rule(column: str, min_value=None, max_value=None) -> Column:
    inside = F.lit(True)
    if min_value is not None:
        inside = inside & (F.col(column) >= min_value)
    if max_value is not None:
        inside = inside & (F.col(column) <= max_value)
    return ~inside


def flag_rule(flag: str, value: str) -> Column:
    """Flag says data is there but the value is blank, or the reverse."""
    v = F.trim(F.col(value).cast("string"))
    present = v.isNotNull() & (v != "")
    f = F.col(flag)
    return (f & ~present) | (~f & present)


def years_rule(lo: str = "experience_min_years", hi: str = "experience_max_years", cap: int = 50) -> Column:
    mn, mx = F.col(lo), F.col(hi)
    return (mn < 0) | (mx < 0) | (mn > mx) | (mx > cap)


def posted_rule(limit: Column | None = None) -> Column:
    """Raw posted date (parsed by format only) after the collection day, or after ``limit``."""
    p, c = _parsed_date("job_posted_date"), _parsed_date("collected_at")
    late = p.isNotNull() & c.isNotNull() & (p > c)
    return late if limit is None else late | (p.isNotNull() & (p > limit))


# -- suites -----------------------------------------------------------------------

def suite_counts(df: DataFrame, rules: Mapping[str, Column], key: Sequence[ColumnOrName] = (), key_name: str = "unique") -> DataFrame:
    """(check_name, failures) for every rule, and for ``key`` how many of its values occur more than once.

    One scan: with a key, rows are counted by it together with the rules (partial
    counts, so a hot key ships one row per task), and the groups are summed up.
    """
    names = [*rules, key_name] if key else list(rules)
    if key:
        groups = df.groupBy(*[col(k).alias(f"__k{i}") for i, k in enumerate(key)]).agg(
            F.count(F.lit(1)).alias("__n"), *[F.count_if(rule).alias(f"__r{i}") for i, rule in enumerate(rules.values())])
        one = groups.agg(*[F.coalesce(F.sum(f"__r{i}"), F.lit(0)).alias(f"__r{i}") for i in range(len(rules))],
                         F.count_if(F.col("__n") > 1).alias(f"__r{len(rules)}"))
    else:
        one = df.agg(*[F.count_if(rule).alias(f"__r{i}") for i, rule in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"__r{i}").alias("failures")) for i, n in enumerate(names)])
    return one.select(F.explode(rows).alias("c")).select("c.check_name", "c.failures")


def failing_rows(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per row and rule that it fails: ``keep`` and check_name; one scan for all rules."""
    failed = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return df.select(*keep, F.explode(failed).alias("check_name"))


# -- single checks ------------------------------------------------------------------

def check_not_null(df: DataFrame, column: str, severity: str = "error", keep: Sequence[str] = ()) -> DataFrame:
    return df.filter(null_rule(column)).select(
        *keep, F.lit(column).alias("column_name"), F.lit(severity).alias("severity"))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return check_unique_combination(df, [column])


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("duplicate_count")).filter(F.col("duplicate_count") > 1)


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-null values outside the list (a null is not a violation)."""
    return df.filter(values_rule(column, values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def check_relationships(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return orphan_rows(child, parent, child_key, parent_key).select(child_key)


def check_accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                         keep: Sequence[str] = ()) -> DataFrame:
    return df.filter(range_rule(column, min_value, max_value)).select(*keep, column)


def check_flag_consistency(df: DataFrame, flag: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flag says data is there but the value is blank, or the reverse."""
    return df.filter(flag_rule(flag, value)).select(*keep, flag, value)


def check_dedupe_exact(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row when the rows kept differ from the distinct keys."""
    b = before.agg(F.count(F.lit(1)).alias("before_rows"))
    e = before.select(*keys).distinct().agg(F.count(F.lit(1)).alias("expected_rows"))
    a = after.agg(F.count(F.lit(1)).alias("actual_rows"))
    return cross_join_scalars(b, e, a).select(
        "before_rows", "expected_rows", "actual_rows",
        (F.col("before_rows") - F.col("expected_rows")).alias("expected_removed_rows"),
        (F.col("before_rows") - F.col("actual_rows")).alias("actual_removed_rows"),
    ).filter(F.col("actual_rows") != F.col("expected_rows"))


def check_no_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return check_unique_combination(df, keys)


def check_group_row_count(source: DataFrame, kept: DataFrame, group: Sequence[Column]) -> DataFrame:
    e = source.select(*[g.alias(f"g{i}") for i, g in enumerate(group)]).distinct().agg(
        F.count(F.lit(1)).alias("expected_rows"))
    a = kept.agg(F.count(F.lit(1)).alias("actual_rows"))
    return cross_join_scalars(e, a).filter(F.col("expected_rows") != F.col("actual_rows"))


def check_year_ranges(df: DataFrame, lo: str = "experience_min_years", hi: str = "experience_max_years",
                      cap: int = 50, keep: Sequence[str] = ()) -> DataFrame:
    return df.filter(years_rule(lo, hi, cap)).select(*keep, lo, hi)


def _parsed_date(c: str) -> Column:
    from hirelake.functions.dates import try_date_auto, try_date_day_mon_year
    text = F.col(c).cast("string")
    return F.coalesce(try_date_auto(text), try_date_day_mon_year(text))


def check_posted_dates(df: DataFrame, as_of: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Raw posted date (parsed by format only) after the collection day, or
    after the latest collection day in the data (``as_of=None``) or after
    the given ``as_of`` date."""
    posted, collected = _parsed_date("job_posted_date"), _parsed_date("collected_at")
    base = df.select(*keep, "job_posted_date", "collected_at",
                     posted.alias("parsed_job_posted_date"), collected.alias("parsed_collected_date"))
    if as_of is None:
        limit = df.agg(F.to_date(F.max("collected_at")).alias("__limit"))
        base = base.crossJoin(F.broadcast(limit))
        lim = F.col("__limit")
    else:
        lim = F.lit(as_of).cast("date")
    p, c = F.col("parsed_job_posted_date"), F.col("parsed_collected_date")
    bad = (p.isNotNull() & c.isNotNull() & (p > c)) | (p.isNotNull() & (p > lim))
    out = base.filter(bad)
    return out.drop("__limit") if as_of is None else out


def check_fact_foreign_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]],
                            id_col: str = "job_posting_key") -> DataFrame:
    """All fact keys against their dimensions in one pass over the fact, a row
    per missing one with the key name.  ``dims`` maps fact column ->
    (dimension, dimension key)."""
    out = fact.select(id_col, *dims)
    missing = []
    for i, (fk, (dim, dk)) in enumerate(dims.items()):
        out = out.join(dim.select(F.col(dk).alias(f"__k{i}")).distinct(), F.col(fk) == F.col(f"__k{i}"), "left")
        missing.append(F.when(F.col(fk).isNotNull() & F.col(f"__k{i}").isNull(), F.lit(fk)))
    return out.select(id_col, F.explode(F.array_compact(F.array(*missing))).alias("foreign_key_name"))
