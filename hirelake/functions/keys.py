"""Deterministic keys: surrogate md5 keys and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import ColumnOrName, col


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 of the fields cast to text and joined by ``-``; a null field is
    replaced by a fixed sentinel so that (null, 'a') and ('', 'a') differ."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(rules.SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(rules.SURROGATE_SEP, *parts))


def pipe_key(a: ColumnOrName, b: ColumnOrName) -> Column:
    """md5 of ``a|b`` with null -> ''."""
    return F.md5(F.concat(F.coalesce(col(a), F.lit("")), F.lit("|"), F.coalesce(col(b), F.lit(""))))
