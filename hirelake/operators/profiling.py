"""Profiling and clean-up of a static dataset.

Every statistic is one aggregate pass (``count_if`` per column in a single
``agg``); duplicate detection uses grouped counts, never a window over the
group, so a very large duplicate group is counted map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import rules
from hirelake.functions.dates import try_date_auto
from hirelake.operators.sequence import dense_sequence


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows, nulls, distinct-free."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    types = dict(df.dtypes)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                 F.col(f"__n{i}").alias("null_count"))
        for i, c in enumerate(df.columns)]))
    return one.select(F.col("__rows").alias("row_count"), F.lit(len(df.columns)).alias("column_count"),
                      stacked.alias("s")).select("s.position", "s.column_name", "s.data_type", "row_count",
                                                 "column_count", "s.null_count")


def date_profile(df: DataFrame, column: str) -> DataFrame:
    """Earliest, latest and invalid (unparsable or missing) dates."""
    d = F.col(column)
    return df.agg(F.min(d).alias("earliest"), F.max(d).alias("latest"),
                  F.count_if(d.isNull()).alias("invalid_dates"))


def row_digest(columns: Sequence[str]) -> Column:
    """256-bit digest of the values, so that wide texts are no shuffle keys.
    Each value is preceded by its length, a null by a mark of its own."""
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def count_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical group, in one aggregate over
    the grouped digests (partial counts map-side)."""
    g = df.groupBy(row_digest(df.columns).alias("__digest")).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.sum("__n").cast("bigint").alias("row_count"), F.count(F.lit(1)).alias("distinct_rows"),
                 (F.sum("__n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"))


def flag_group_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of any key group larger than one (null keys match each other).
    Group sizes come from a partial-aggregated count joined back on a digest
    of the keys, so a hot group is never gathered into one window task."""
    gk = row_digest(keys)
    sizes = df.groupBy(gk.alias("__gk")).agg(F.count(F.lit(1)).alias("group_size")).filter(F.col("group_size") > 1)
    return df.withColumn("__gk", gk).join(sizes, "__gk", "inner").drop("__gk")


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def strip_whitespace(c: Column) -> Column:
    """Strip Unicode whitespace from both ends (``str.strip()``)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def trim_text_columns(df: DataFrame) -> DataFrame:
    strings = [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: strip_whitespace(F.col(f"`{c}`")) for c in strings})


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One of each group of identical rows; the shuffle key is a digest, not the row's texts."""
    return df.withColumn("__digest", row_digest(df.columns)).dropDuplicates(["__digest"]).drop("__digest")


def coerce_dates(df: DataFrame, column: str) -> DataFrame:
    """Parse a text date; unparsable -> null."""
    return df.withColumn(column, try_date_auto(F.col(column).cast("string")))


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("frequency"))


def ranked_frequencies(df: DataFrame, column: str) -> DataFrame:
    """Value frequencies with their rank, the most frequent first; ties share a rank.

    Only the distinct frequencies are put in order (of n rows, no more than
    the root of 2n); values find their rank by a join.
    """
    values = value_frequencies(df, column)
    more = Window.orderBy(F.desc("frequency")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (values.groupBy("frequency").agg(F.count(F.lit(1)).alias("__n"))
             .select("frequency", (F.coalesce(F.sum("__n").over(more), F.lit(0)) + 1).cast("int").alias("rank")))
    return values.join(ranks, "frequency").select(column, "frequency", "rank")


def range_violations(df: DataFrame, column: str, allow_zero: bool = False) -> DataFrame:
    """Rows with negative values, or non-positive ones when zero is not allowed."""
    c = F.col(column)
    return df.filter(c < 0) if allow_zero else df.filter(c <= 0)


def conform_static_dataset(df: DataFrame, as_of: str, order: Sequence[str] | None = None) -> DataFrame:
    """Drop, rename, add constants, a sequential id, the salary flag; the 19
    raw posting columns as text.  ``as_of`` replaces "now" as the collection
    time; the id follows ``order`` (default: every output column)."""
    d = df.drop(*[c for c in rules.STATIC_DROP if c in df.columns])
    d = d.withColumnsRenamed({k: v for k, v in rules.STATIC_RENAME.items() if k in d.columns})
    d = d.withColumns({c: F.lit(None).cast("string") for c in rules.STATIC_NULL_COLUMNS})
    d = d.withColumns({c: F.lit(v) for c, v in rules.STATIC_CONSTANTS.items()})
    d = d.withColumn("is_salary_disclosed",
                     F.when(F.col("salary").isNotNull(), F.lit("True")).otherwise(F.lit("False"))).drop("salary")
    d = d.withColumn("collected_at", F.lit(as_of))
    if "job_posted_date" in d.columns:
        d = d.withColumn("job_posted_date", F.date_format(try_date_auto(F.col("job_posted_date").cast("string")),
                                                          "yyyy-MM-dd"))
    body = [c for c in rules.RAW_COLUMNS if c != "source_job_id"]
    d = d.select(*[F.col(c).cast(T.StringType()).alias(c) for c in body])
    numbered = dense_sequence(d, [F.col(c).asc_nulls_first() for c in (order or body)], "__seq")
    return numbered.select(F.col("__seq").cast("string").alias("source_job_id"), *body)
