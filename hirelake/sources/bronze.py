"""Landing files: reading, routing, quarantining, writing.

Raw postings land as UTF-8 CSV (header row, optional BOM, quoted fields that
may span lines, doubled quotes) under ``platform=<name>/`` folders.  Readers
never infer a schema: the 19 raw columns are fixed strings, and the
platform comes from the folder name (partition discovery).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import rules
from hirelake.session import scratch_dir

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in rules.RAW_COLUMNS])
CORRUPT_COL = "_corrupt_record"
#: Rows of a written CSV file at most.
FILE_ROWS = 20_000


def csv_reader(spark: SparkSession, schema: T.StructType):
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8")
        .option("nullValue", "")
    )


def read_bronze(spark: SparkSession, path: str, with_platform: bool = True) -> DataFrame:
    """Landed CSV files -> 19 string columns (+ ``platform`` from the folder)."""
    df = csv_reader(spark, RAW_SCHEMA).csv(path)
    cols = rules.RAW_COLUMNS + (["platform"] if with_platform and "platform" in df.columns else [])
    return df.select(*cols)


def quarantine_bad_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows): unreadable rows (a surplus or missing field,
    broken quoting) are kept aside with their raw text instead of failing
    the load."""
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    df = (csv_reader(spark, schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT_COL).csv(path))
    # one pass over the files: parsed rows are written once, split by whether they could be read
    out = scratch_dir(spark, "parsed")
    with unsorted_partitions(spark):
        df.withColumn("__bad", F.col(CORRUPT_COL).isNotNull()).write.partitionBy("__bad").option("compression", "zstd").parquet(out)
    parsed = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__bad", T.BooleanType())])).parquet(out)
    return parsed.filter(~F.col("__bad")).drop("__bad", CORRUPT_COL), parsed.filter("__bad").select(CORRUPT_COL)


def platform_from_name(name_col, keywords=rules.PLATFORM_KEYWORDS):
    """File name keyword -> platform folder; first keyword wins; none -> null."""
    low = F.lower(name_col)
    out = None
    for kw, folder in keywords:
        cond = low.contains(kw)
        out = F.when(cond, F.lit(folder)) if out is None else out.when(cond, F.lit(folder))
    return out.otherwise(F.lit(None).cast("string"))


def route_by_platform(spark: SparkSession, landing: str, bronze: str) -> DataFrame:
    """Read flat landed files, route each row by its file's name keyword and
    write the bronze layout (``platform=<name>/``); returns the routed rows
    read back.  Unknown names land with a null platform."""
    df = csv_reader(spark, RAW_SCHEMA).csv(landing).select(
        *rules.RAW_COLUMNS, platform_from_name(F.col("_metadata.file_name")).alias("platform"))
    write_csv(df, bronze, "overwrite", ["platform"])
    return read_bronze(spark, bronze)


def conform_columns(df: DataFrame, columns: Sequence[str] = rules.RAW_COLUMNS,
                    renames: Mapping[str, str] | None = None) -> DataFrame:
    """Old column names renamed, missing columns added as null, order forced,
    other columns dropped."""
    out = df
    for old, new in (renames or {}).items():
        if old in out.columns and new not in out.columns:
            out = out.withColumnRenamed(old, new)
    return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns])


def union_conformed(frames: Sequence[DataFrame], columns: Sequence[str] = rules.RAW_COLUMNS) -> DataFrame:
    out = None
    for f in frames:
        c = conform_columns(f, columns)
        out = c if out is None else out.unionByName(c, allowMissingColumns=True)
    return out


@contextmanager
def unsorted_partitions(spark: SparkSession, writers: int = 16) -> Iterator[None]:
    """Writes split by a column keep up to ``writers`` files open in a task instead of sorting
    (and spilling) whole rows; tasks that meet more values sort the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(writers))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """CSV with a header row; empty text is written as an empty field, so it
    reads back as null, like the landed files.

    Files are compressed and hold at most ``FILE_ROWS`` rows: quoted fields may span
    lines, so a file is read by one task.
    """
    w = (df.write.mode(mode).option("header", True).option("emptyValue", "").option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", FILE_ROWS))
    if partition_by:
        w = w.partitionBy(*partition_by)
    with unsorted_partitions(df.sparkSession):
        w.csv(path)


def land_files(df: DataFrame, folder: str, name_col: str) -> None:
    """Rows as files ``<name>-<n>.csv.gz`` in a landing folder, as uploads leave them; ``name_col``
    (not null) names each row's file and is not written.  One pass over the rows."""
    spark = df.sparkSession
    tmp = scratch_dir(spark, "upload")
    write_csv(df, tmp, partition_by=[name_col])
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for part in fs.listStatus(path(tmp)):
        if not part.isDirectory():
            continue
        name = unquote(part.getPath().getName().split("=", 1)[1])
        files = [f.getPath() for f in fs.listStatus(part.getPath()) if f.getPath().getName().startswith("part-")]
        for n, f in enumerate(sorted(files, key=lambda x: x.getName())):
            fs.rename(f, path(f"{folder}/{name}-{n}.csv.gz"))


def land_file(df: DataFrame, folder: str, name: str) -> None:
    """Rows as files of one name (:func:`land_files`)."""
    land_files(df.withColumn("__file", F.lit(name)), folder, "__file")


def write_csv_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Rewrite one CSV snapshot (header, overwrite) and return it read back."""
    write_csv(df, path, "overwrite")
    return read_bronze(df.sparkSession, path, with_platform=False)


def append_log(df: DataFrame, path: str, ts_col: str = "processed_at", run_ts: str | None = None) -> None:
    """Append log rows; a missing timestamp takes the run timestamp."""
    out = df
    if run_ts is not None:
        out = out.withColumn(ts_col, F.coalesce(F.col(ts_col), F.lit(run_ts).cast("timestamp_ntz")))
    out.write.mode("append").parquet(path)


def materialize(df: DataFrame, kind: str, name: str | None = None, path: str | None = None,
                key: str | None = None, watermark: str | None = None, check_cols: Sequence[str] = (),
                run_ts: str | None = None, keep: int | None = None) -> DataFrame:
    """One model, four materialisations: ``view`` (a temp view, nothing
    stored), ``table`` (a new version of a Parquet table, of which ``keep`` stay),
    ``incremental`` (merge by key into buckets, rows newer than the stored maximum
    only), ``snapshot`` (slowly changing rows as of ``run_ts``) -- each returns
    the stored result read back."""
    from hirelake.operators.history import merge_into_buckets, read_buckets, read_current, scd2_into_path, write_version
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        write_version(df, path, keep=keep)
        return read_current(spark, path)
    if kind == "incremental":
        merge_into_buckets(spark, path, df, key, watermark)
        return read_buckets(spark, path)
    if kind == "snapshot":
        return scd2_into_path(spark, path, df, key, check_cols, run_ts, keep=keep)
    raise ValueError(f"unknown materialisation {kind!r}")
