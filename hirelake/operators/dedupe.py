"""Keep-one-per-group operators.

All of them are written so that a hot group (one key holding a large share
of the rows) never lands in one task in full:

* ``keep_latest`` is ``row_number() = 1``; Catalyst turns it into a partial
  ``WindowGroupLimit`` before the shuffle and a final one after it, so each
  map task ships at most one row per key.
* group sizes are counted by a hash aggregate (map-side partial counts),
  never by ``count(*) over (partition by …)``, which would need every row of
  the group in one partition.
* picks of a single value use ``min`` / ``max`` aggregates (partial too).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from hirelake.functions.text import ColumnOrName, col

_RN = "__rn"
_GK = "__group_key"


def keep_latest(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (write null placement
    explicitly, e.g. ``desc_nulls_first``).  Null keys form one group."""
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def group_key(*cols: ColumnOrName) -> Column:
    """One non-null struct over the grouping expressions.  Equality of the
    struct treats nested nulls as equal, like window partitioning does."""
    return F.struct(*[col(c).alias(f"k{i}") for i, c in enumerate(cols)])


def preferred_row(df: DataFrame, group_cols: Sequence[ColumnOrName], order: Sequence[Column],
                  rank_col: str = "priority_rank", count_col: str = "group_row_count") -> DataFrame:
    """Winner per group by ``order``, with the group size.

    The winner comes from ``row_number() = 1`` (group-limited before the
    shuffle) and the size from a partial-aggregated count; both are
    partitioned by the same struct key, so their join needs no new shuffle.
    """
    keyed = df.withColumn(_GK, group_key(*group_cols))
    best = keep_latest(keyed, [_GK], order)
    sizes = keyed.groupBy(_GK).agg(F.count(F.lit(1)).alias(count_col))
    return (
        best.join(sizes, _GK, "inner")
        .withColumn(rank_col, F.lit(1).cast("bigint"))
        .drop(_GK)
    )


def pick_min(df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """One row per key holding ``min`` of each value expression (a ranked
    pick reduced to an aggregate when only one value is chosen)."""
    return df.groupBy(*keys).agg(*[F.min(v).alias(name) for name, v in values.items()])


def valid_id(c: ColumnOrName) -> Column:
    """An id is usable when it is not null, not blank and not ``nan``/``none``."""
    t = F.lower(F.trim(col(c).cast("string")))
    return col(c).isNotNull() & (t != "") & ~t.isin("nan", "none")


class DedupeCounts:
    """The figures of :func:`dedupe_counts`, taken while a de-duplication runs; :meth:`get` waits for its first action."""

    def __init__(self) -> None:
        self.read, self.kept = Observation(), Observation()

    def get(self) -> dict[str, int]:
        read, kept = self.read.get, self.kept.get
        return {"rows_before": read["rows"], "rows_with_id": read["with_id"], "distinct_ids": kept["with_id"],
                "rows_after": kept["rows"], "rows_removed": read["rows"] - kept["rows"]}


def dedupe_keep_missing_ids(df: DataFrame, id_col: str, order: Sequence[Column], counts: DedupeCounts | None = None) -> DataFrame:
    """Keep the first row per usable id; rows without a usable id all stay.

    One pass: a row without a usable id is a group of its own (a number no other
    row has), so such rows spread over all tasks.  ``counts`` takes its
    figures while the rows go by, without a second scan.
    """
    ok = F.coalesce(valid_id(id_col), F.lit(False))
    marked = df.withColumns({"__ok": ok, "__own": F.when(~ok, F.monotonically_increasing_id())})
    figures = [F.count(F.lit(1)).alias("rows"), F.count_if("__ok").alias("with_id")]
    if counts is not None:
        marked = marked.observe(counts.read, *figures)
    kept = keep_latest(marked, [F.when(F.col("__ok"), F.col(id_col)), "__own"], order)
    if counts is not None:
        kept = kept.observe(counts.kept, *figures)
    return kept.drop("__ok", "__own")


def dedupe_counts(df: DataFrame, id_col: str) -> DataFrame:
    """One row: input rows, rows with usable ids, distinct usable ids, rows
    kept and rows removed by :func:`dedupe_keep_missing_ids`."""
    ok = valid_id(id_col)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(ok).alias("rows_with_id"),
        F.count_distinct(F.when(ok, F.col(id_col))).alias("distinct_ids"),
    ).select(
        "rows_before", "rows_with_id", "distinct_ids",
        (F.col("rows_before") - F.col("rows_with_id") + F.col("distinct_ids")).alias("rows_after"),
        (F.col("rows_with_id") - F.col("distinct_ids")).alias("rows_removed"),
    )
