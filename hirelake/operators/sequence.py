"""Dense 1..n numbering over a global order, without one-partition windows.

``row_number() over (order by …)`` with no partition moves every row to a
single task.  Here the rows are range-partitioned on the order and sorted
inside each partition; in that same job every row records its partition
number and its position inside the partition, and the rows are written as a
Parquet table in the cluster's checkpoint folder.  The written table is
frozen: recomputation after a lost executor cannot change the partitioning
or the positions.  A per-partition count -- one row per partition, a bounded
table, broadcast -- gives each partition its offset; the number is the
offset plus the position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID, _POS, _OFF, _CNT = "__seq_pid", "__seq_pos", "__seq_offset", "__seq_count"


def dense_sequence(df: DataFrame, order: Sequence[Column], name: str,
                   num_partitions: int | None = None) -> DataFrame:
    from hirelake.sources.bronze import scratch_dir

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    pid = F.spark_partition_id()
    positioned = ranged.withColumns({
        _PID: pid,
        _POS: F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33),
    })
    path = scratch_dir(spark, "sequence")
    positioned.write.parquet(path)
    frozen = spark.read.parquet(path)
    counts = frozen.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    offsets = counts.select(
        _PID,
        F.coalesce(
            F.sum(_CNT).over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias(_OFF),
    )
    return (
        frozen.join(F.broadcast(offsets), _PID, "inner")
        .withColumn(name, F.col(_OFF) + F.col(_POS) + 1)
        .drop(_PID, _POS, _OFF)
    )
