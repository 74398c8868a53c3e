"""Join helpers.  Which side is broadcast is left to Spark's byte threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_left_lookup(df: DataFrame, lookup: DataFrame, left_key: Column, right_key: str) -> DataFrame:
    """Left equi-join of a large frame to a lookup on an expression."""
    return df.join(lookup, left_key == lookup[right_key], "left")


def join_inner_composite(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on several columns; a null in any of them matches nothing."""
    return df.join(other, list(keys), "inner")


def semi_join(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``key IN (subquery)``."""
    return df.join(other.select(*([on] if isinstance(on, str) else on)), on, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``NOT EXISTS``."""
    return df.join(other, on, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    p = parent.select(F.col(parent_key).alias("__pk"))
    return child.filter(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def cross_join_scalars(*frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates side by side."""
    out = frames[0]
    for f in frames[1:]:
        out = out.crossJoin(f)
    return out


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def scalar_max_filter(df: DataFrame, column: str, reference: DataFrame, ref_column: str,
                      op: str = ">") -> DataFrame:
    """Rows whose ``column`` compares to ``max(reference.ref_column)``; the
    maximum is a one-row aggregate joined as a scalar."""
    mx = reference.agg(F.max(ref_column).alias("__max"))
    cond = {">": F.col(column) > F.col("__max"), ">=": F.col(column) >= F.col("__max"),
            "<": F.col(column) < F.col("__max"), "<=": F.col(column) <= F.col("__max")}[op]
    return df.crossJoin(F.broadcast(mx)).filter(cond).drop("__max")
