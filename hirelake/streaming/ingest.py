"""Incremental file ingestion with Structured Streaming.

``ingest_new_files`` loads only files not loaded before: the file source
remembers what it has seen in its checkpoint, so each run (``availableNow``
trigger: everything new, then stop) takes exactly the new files.  Files are
parsed once: a micro-batch is one write into a folder named after its id,
split by what its rows are good for.  A batch that is replayed after a crash
overwrites its own folder, so nothing is loaded twice and readable and
unreadable rows of a batch always belong together.

``state=good`` rows have a collection time, ``state=undated`` rows have none
that can be read, and ``state=bad`` holds the text of rows with a missing or
surplus field or broken quoting; these never reach the raw table.
Rows carry ids written here once: ``row_id`` (batch, partition, position) and
``description_id`` (digest of the text), so later stages neither sort by
wide columns nor read a text.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import rules
from hirelake.functions.dates import try_timestamp_ntz
from hirelake.sources.bronze import CORRUPT_COL, RAW_SCHEMA, unsorted_partitions

#: What ingestion adds to the raw columns.
ADDED = [T.StructField("platform", T.StringType()), T.StructField("row_id", T.LongType()), T.StructField("description_id", T.StringType()),
         T.StructField("collected_ts", T.TimestampNTZType()), T.StructField(CORRUPT_COL, T.StringType())]
#: A table folder: batch=<id>/state=<good, undated or bad>.
TABLE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, *ADDED, T.StructField("batch", T.LongType()), T.StructField("state", T.StringType())])


def landed_stream(spark: SparkSession, landing: str) -> DataFrame:
    """Rows of landed files, unreadable ones with their text in ``_corrupt_record``."""
    fields = [*RAW_SCHEMA.fields, T.StructField(CORRUPT_COL, T.StringType(), True), T.StructField("platform", T.StringType(), True)]
    return (
        spark.readStream.schema(T.StructType(fields))
        .option("header", True).option("multiLine", True).option("escape", '"')
        .option("encoding", "UTF-8").option("nullValue", "")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("maxFilesPerTrigger", 1000)
        .csv(landing)
    )


def load_batch(rows: DataFrame, batch: int, table: str) -> None:
    """One micro-batch into its folder; the same batch again gives the same folder.

    A row's id holds the batch (15 bits), the partition (13) and the position in it (35).
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    row_id = F.lit(batch << 48) + F.shiftleft(F.spark_partition_id().cast("long"), 35) + position
    ts = try_timestamp_ntz(F.col("collected_at"))
    state = F.when(F.col(CORRUPT_COL).isNotNull(), "bad").when(ts.isNull(), "undated").otherwise("good")
    out = rows.select(*rules.RAW_COLUMNS, "platform", row_id.alias("row_id"), F.sha2("description", 256).alias("description_id"),
                      ts.alias("collected_ts"), CORRUPT_COL, state.alias("state"))
    with unsorted_partitions(rows.sparkSession):
        out.write.mode("overwrite").partitionBy("state").option("compression", "zstd").parquet(f"{table.rstrip('/')}/batch={batch}")


def ingest_new_files(spark: SparkSession, landing: str, table: str, checkpoint: str) -> int:
    """Load the files not yet loaded; returns the number of micro-batches run."""
    q = (landed_stream(spark, landing).writeStream.option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).foreachBatch(lambda rows, batch: load_batch(rows, batch, table)).start())
    q.awaitTermination()
    return len([p for p in q.recentProgress if p["numInputRows"] > 0])


def ingested(spark: SparkSession, table: str) -> DataFrame:
    """All that was loaded, with ``batch`` and ``state``; filters on the two prune folders."""
    try:
        return spark.read.schema(TABLE_SCHEMA).parquet(table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TABLE_SCHEMA)


def read_raw(spark: SparkSession, table: str) -> DataFrame:
    """The raw table: readable rows with their ids."""
    return ingested(spark, table).where("state != 'bad'").drop("batch", "state", CORRUPT_COL)


def read_quarantine(spark: SparkSession, table: str) -> DataFrame:
    """Text and folder of the rows that could not be read."""
    return ingested(spark, table).where("state = 'bad'").select(CORRUPT_COL, "platform")
