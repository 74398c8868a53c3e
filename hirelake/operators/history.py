"""Incremental and historical tables on plain Parquet.

* ``incremental_since_watermark`` -- rows strictly newer than the target's
  maximum (late, equal or null timestamps are not merged).
* ``merge_by_key`` -- update matched keys, insert new ones, keep the rest.
  On disk (``merge_into_buckets``) keys fall into buckets by a hash, and a merge
  rewrites only the buckets that it touches.
* ``scd2_check`` -- slowly changing rows: a change in any checked column
  (null-safe) closes the open version and opens a new one; new keys open a
  version; keys gone from the source are closed.  The run timestamp is a
  parameter, so a rerun of the same batch changes nothing.  On disk
  (``scd2_into_path``) closed rows are written once and never again.

What is current is said by a pointer, a one-row file that is written after the
data.  Readers go by it, so a part-written version is never read, and the next
run writes over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.operators.joins import scalar_max_filter
from hirelake.session import scratch_dir

VALID_FROM, VALID_TO, UPDATED_AT, SCD_ID = "dbt_valid_from", "dbt_valid_to", "dbt_updated_at", "dbt_scd_id"


# -- incremental --------------------------------------------------------------

def incremental_since_watermark(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    if target is None:
        return source
    return scalar_max_filter(source, column, target, column, ">")


def merge_by_key(target: DataFrame | None, updates: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not updated, plus all update rows."""
    if target is None:
        return updates
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


# -- versions and their pointer -------------------------------------------------

def pointers(spark: SparkSession, path: str) -> list[Row]:
    """(version, run) of the complete versions, oldest first."""
    try:
        found = spark.read.schema("run string, version int").json(f"{path.rstrip('/')}/pointers").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(found, key=lambda r: r["version"])


def set_pointer(spark: SparkSession, path: str, version: int, run: str | None = None) -> None:
    """Make ``version`` the current one."""
    row = spark.range(1).coalesce(1).select(F.lit(run).cast("string").alias("run"))
    row.write.mode("overwrite").json(f"{path.rstrip('/')}/pointers/version={version}")


def table_versions(spark: SparkSession, path: str) -> list[int]:
    return [r["version"] for r in pointers(spark, path)]


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    versions = table_versions(spark, path)
    if not versions:
        return None
    return spark.read.parquet(f"{path.rstrip('/')}/version={versions[-1]}")


def write_version(df: DataFrame, path: str, run: str | None = None, keep: int | None = None) -> int:
    """The next version, then its pointer.  ``keep`` versions stay (default: all);
    a reader of a pruned one fails, so keep more than readers are behind."""
    spark = df.sparkSession
    versions = table_versions(spark, path)
    n = (versions[-1] + 1) if versions else 1
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={n}")  # without a pointer nobody reads it
    set_pointer(spark, path, n, run)
    if keep is not None:
        for old in [*versions, n][:-keep]:
            remove(spark, f"{path.rstrip('/')}/pointers/version={old}")
            remove(spark, f"{path.rstrip('/')}/version={old}")
    return n


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; without a JVM gateway (Spark Connect) it stays."""
    if hasattr(spark, "_jsparkSession"):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def merge_into_path(spark: SparkSession, path: str, updates: DataFrame, key: str,
                    watermark: str | None = None) -> int:
    """Incremental merge into a versioned Parquet table, written whole; returns the new
    version number.  With ``watermark`` only rows newer than the stored
    maximum are merged.  For tables that outgrow this: :func:`merge_into_buckets`."""
    current = read_current(spark, path)
    batch = incremental_since_watermark(updates, current, watermark) if watermark else updates
    return write_version(merge_by_key(current, batch, key), path)


# -- tables in buckets ------------------------------------------------------------

BUCKET = "bucket"


def read_table_at(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing was written there yet."""
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018 -- resolves the path now
        return df
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    df = read_table_at(spark, f"{path.rstrip('/')}/data")
    return None if df is None else df.drop(BUCKET)


def last_run(spark: SparkSession, path: str) -> str | None:
    """The ``run`` of the last merge into a table in buckets."""
    done = pointers(spark, f"{path.rstrip('/')}/applied")
    return done[-1]["run"] if done else None


def merge_into_buckets(spark: SparkSession, path: str, updates: DataFrame, key: str, watermark: str | None = None,
                       buckets: int = 64, run: str | None = None) -> list[int]:
    """Merge into a table in buckets by a hash of ``key``; returns the buckets rewritten.

    Only buckets with an update are read and written (dynamic partition
    overwrite), so a day with few keys costs few buckets; choose ``buckets`` so that
    one is a few hundred MB, and never change it.  The merged buckets are first
    written aside with a pointer: a run that dies while they are moved into place
    is finished by the next one from there.  ``run`` is kept with the merge.
    """
    root = path.rstrip("/")
    data, staged, applied = f"{root}/data", f"{root}/staged", f"{root}/applied"
    _apply_staged(spark, data, staged, applied)
    current = read_table_at(spark, data)
    batch = updates
    if watermark and current is not None:
        batch = incremental_since_watermark(updates, current.drop(BUCKET), watermark)
    batch = batch.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    new = scratch_dir(spark, "merge-batch")
    batch.write.parquet(new)  # read below by three jobs; later writes to the table cannot change it
    batch = spark.read.parquet(new)
    touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
    if touched:
        old = current.where(F.col(BUCKET).isin(touched)) if current is not None else None
        merged = merge_by_key(old, batch, key)
        n = write_version(merged.repartition(BUCKET), staged, run, keep=1)
    else:
        n = (table_versions(spark, staged) or [0])[-1]
    if touched or run is not None:
        _apply_staged(spark, data, staged, applied, n, run)
    return touched


def _apply_staged(spark: SparkSession, data: str, staged: str, applied: str, n: int | None = None, run: str | None = None) -> None:
    """Put the staged buckets into place if they are not there yet."""
    waiting, done = pointers(spark, staged), pointers(spark, applied)
    last = done[-1]["version"] if done else 0
    if waiting and waiting[-1]["version"] > last:
        rows = read_current(spark, staged)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(data))
        set_pointer(spark, applied, waiting[-1]["version"], waiting[-1]["run"])
    elif n is not None:  # nothing to merge: only the run is noted
        set_pointer(spark, applied, max(n, last), run)


# -- slowly changing rows -----------------------------------------------------

def _changed(cols: Sequence[str], old: str, new: str) -> Column:
    out = None
    for c in cols:
        diff = ~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}"))
        out = diff if out is None else (out | diff)
    return out


def _open_version(df: DataFrame, key: str, run_ts: Column) -> DataFrame:
    return df.withColumns({
        SCD_ID: F.md5(F.concat_ws("|", F.col(key).cast("string"), run_ts.cast("string"))),
        UPDATED_AT: run_ts,
        VALID_FROM: run_ts,
        VALID_TO: F.lit(None).cast("timestamp_ntz"),
    })


def scd2_step(open_: DataFrame | None, source: DataFrame, key: str, check_cols: Sequence[str],
              run_ts: str, invalidate_deleted: bool = True) -> DataFrame:
    """What one run makes of the open versions: those still open, those closed
    now, and new ones.  Closed versions of earlier runs take no part."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    if open_ is None:
        return _open_version(source, key, ts)
    data_cols = [c for c in open_.columns if c not in (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)]
    src = source.select(*data_cols)
    j = open_.alias("o").join(src.alias("s"), F.col(f"o.{key}") == F.col(f"s.{key}"), "full_outer")
    in_old, in_new = F.col(f"o.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    changed = in_old & in_new & _changed(check_cols, "o", "s")
    closing = changed | (in_old & ~in_new if invalidate_deleted else F.lit(False))
    old = F.struct(*[F.when(closing, ts).otherwise(F.col(f"o.{c}")).alias(c) if c in (VALID_TO, UPDATED_AT) else F.col(f"o.{c}").alias(c)
                     for c in open_.columns])
    opened = {SCD_ID: F.md5(F.concat_ws("|", F.col(f"s.{key}").cast("string"), ts.cast("string"))), UPDATED_AT: ts, VALID_FROM: ts,
              VALID_TO: F.lit(None).cast("timestamp_ntz")}
    new = F.struct(*[(opened[c] if c in opened else F.col(f"s.{c}")).alias(c) for c in open_.columns])
    versions = F.array_compact(F.array(F.when(in_old, old), F.when(changed | (~in_old & in_new), new)))
    return j.select(F.explode(versions).alias("v")).select("v.*")


def scd2_check(snapshot: DataFrame | None, source: DataFrame, key: str, check_cols: Sequence[str],
               run_ts: str, invalidate_deleted: bool = True) -> DataFrame:
    """The next snapshot after one run (``run_ts`` like '2026-12-02 00:00:00')."""
    if snapshot is None:
        return scd2_step(None, source, key, check_cols, run_ts)
    closed = snapshot.filter(F.col(VALID_TO).isNotNull())
    return closed.unionByName(scd2_step(scd2_current(snapshot), source, key, check_cols, run_ts, invalidate_deleted))


RUN, STATE = "run", "state"


def _run_id(run_ts: str) -> str:
    return run_ts.replace("-", "").replace(":", "").replace(" ", "T")


def _read_runs(spark: SparkSession, path: str, last: str) -> DataFrame:
    """Rows of all runs with ``run`` and ``state``, which prune the folders read."""
    root = path.rstrip("/")
    one = spark.read.parquet(f"{root}/runs/run={last}").schema
    fields = [f for f in one.fields if f.name != STATE]
    return spark.read.schema(T.StructType([*fields, T.StructField(RUN, T.StringType()), T.StructField(STATE, T.StringType())])).parquet(f"{root}/runs")


def read_snapshot(spark: SparkSession, path: str, state: str | None = None) -> DataFrame | None:
    """The current snapshot: open rows of the last run, closed rows of all runs up to it."""
    done = pointers(spark, path)
    if not done:
        return None
    last = _run_id(done[-1]["run"])
    rows = _read_runs(spark, path, last)
    open_, closed = (F.col(STATE) == "open") & (F.col(RUN) == last), (F.col(STATE) == "closed") & (F.col(RUN) <= last)
    return rows.where({"open": open_, "closed": closed}.get(state, open_ | closed)).drop(RUN, STATE)


def scd2_into_path(spark: SparkSession, path: str, source: DataFrame, key: str, check_cols: Sequence[str], run_ts: str,
                   invalidate_deleted: bool = True, keep: int | None = None) -> DataFrame:
    """One run of the snapshot on disk; returns the snapshot read back.

    A run writes a folder of its own, ``run=<time>/state=open`` and ``state=closed``:
    what is closed stays where the run that closed it put it, only the open
    rows are written anew.  The pointer comes last; a run that died is written
    again, one that is done is left as it is.  ``keep`` runs keep their open rows.
    """
    root = path.rstrip("/")
    done = pointers(spark, path)
    if done and run_ts < done[-1]["run"]:
        raise ValueError(f"run {run_ts} is older than the snapshot's last run {done[-1]['run']}")
    if not done or run_ts != done[-1]["run"]:
        step = scd2_step(read_snapshot(spark, path, "open"), source, key, check_cols, run_ts, invalidate_deleted)
        state = F.when(F.col(VALID_TO).isNull(), "open").otherwise("closed")
        step.withColumn(STATE, state).write.mode("overwrite").partitionBy(STATE).parquet(f"{root}/runs/run={_run_id(run_ts)}")
        set_pointer(spark, path, (done[-1]["version"] if done else 0) + 1, run_ts)
        if keep is not None:
            for old in [*done, None][:-keep]:
                remove(spark, f"{root}/runs/run={_run_id(old['run'])}/state=open")
    return read_snapshot(spark, path)


def scd2_current(snapshot: DataFrame) -> DataFrame:
    return snapshot.filter(F.col(VALID_TO).isNull())


def status_history(snapshot: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Versions per key in order, numbered from 1.  A key has few versions,
    so the per-key window is small."""
    w = Window.partitionBy(key).orderBy(F.col(VALID_FROM).asc())
    return snapshot.select(key, *cols, VALID_FROM, VALID_TO).withColumn(
        "version_number", F.row_number().over(w).cast("bigint"))
