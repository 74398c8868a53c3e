import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hirelake.operators.history import (
    incremental_since_watermark, last_run, merge_by_key, merge_into_buckets, merge_into_path, read_buckets, read_current, read_snapshot,
    scd2_check, scd2_current, scd2_into_path, status_history, table_versions, write_version,
)
from hirelake.operators.sequence import dense_sequence
from hirelake.session import scratch_dir

T = dt.datetime
SCHEMA = "k string, status string, title string, ts timestamp_ntz"
CHECK = ["status"]


def snap(spark, data, prev=None, run="2026-12-01 00:00:00"):
    return scd2_check(prev, spark.createDataFrame(data, SCHEMA), "k", CHECK, run)


def test_first_run_opens_every_key(spark):
    s = snap(spark, [("a", "Active", "t", T(2026, 1, 1)), ("b", "Active", "t", T(2026, 1, 1))])
    assert sorted(rows(s, "k", "dbt_valid_to")) == [("a", None), ("b", None)]


def test_title_change_alone_opens_no_version(spark):
    s1 = snap(spark, [("a", "Active", "old", T(2026, 1, 1))])
    s2 = snap(spark, [("a", "Active", "new", T(2026, 1, 2))], s1, "2026-12-02 00:00:00")
    assert rows(s2, "k", "title", "dbt_valid_to") == [("a", "old", None)]


def test_status_change_closes_and_opens(spark):
    s1 = snap(spark, [("a", "Active", "t", T(2026, 1, 1))])
    s2 = snap(spark, [("a", "Closed", "t", T(2026, 1, 2))], s1, "2026-12-02 00:00:00")
    got = sorted(rows(s2, "status", "dbt_valid_from", "dbt_valid_to"))
    assert got == [("Active", T(2026, 12, 1), T(2026, 12, 2)), ("Closed", T(2026, 12, 2), None)]
    hist = rows(status_history(s2, "k", ["status"]).orderBy("version_number"), "status", "version_number")
    assert hist == [("Active", 1), ("Closed", 2)]


def test_null_to_null_opens_no_version_and_rerun_is_noop(spark):
    data = [("a", None, "t", T(2026, 1, 1)), ("b", "Active", "t", T(2026, 1, 1))]
    s1 = snap(spark, data)
    s2 = snap(spark, data, s1, "2026-12-02 00:00:00")
    assert s2.count() == 2 and scd2_current(s2).count() == 2
    s3 = snap(spark, data, s2, "2026-12-02 00:00:00")
    assert sorted(rows(s3)) == sorted(rows(s2))


def test_vanished_key_is_closed(spark):
    s1 = snap(spark, [("a", "Active", "t", T(2026, 1, 1)), ("b", "Active", "t", T(2026, 1, 1))])
    s2 = snap(spark, [("a", "Active", "t", T(2026, 1, 1))], s1, "2026-12-02 00:00:00")
    assert sorted(rows(s2, "k", "dbt_valid_to")) == [("a", None), ("b", T(2026, 12, 2))]


def test_incremental_is_strictly_newer(spark):
    target = spark.createDataFrame([("a", "x", "t", T(2026, 1, 2))], SCHEMA)
    src = spark.createDataFrame([("b", "x", "t", T(2026, 1, 2)), ("c", "x", "t", T(2026, 1, 3)),
                                 ("d", "x", "t", None)], SCHEMA)
    assert rows(incremental_since_watermark(src, target, "ts"), "k") == [("c",)]


def test_merge_updates_inserts_keeps(spark):
    target = spark.createDataFrame([("a", "old", "t", None), ("b", "keep", "t", None)], SCHEMA)
    upd = spark.createDataFrame([("a", "new", "t", None), ("c", "ins", "t", None)], SCHEMA)
    assert sorted(rows(merge_by_key(target, upd, "k"), "k", "status")) == [("a", "new"), ("b", "keep"), ("c", "ins")]


def test_versioned_merge_on_disk(spark):
    path = scratch_dir(spark, "test-merge")
    b1 = spark.createDataFrame([("a", "x", "t", T(2026, 1, 1))], SCHEMA)
    b2 = spark.createDataFrame([("a", "y", "t", T(2026, 1, 1)), ("b", "x", "t", T(2026, 1, 2))], SCHEMA)
    merge_into_path(spark, path, b1, "k", "ts")
    merge_into_path(spark, path, b2, "k", "ts")
    assert table_versions(spark, path) == [1, 2]
    # the equal-timestamp update of "a" is not merged (strictly newer only)
    assert sorted(rows(read_current(spark, path), "k", "status")) == [("a", "x"), ("b", "x")]


def test_dense_sequence_matches_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), F.col("id"))
    for parts in (1, 8):
        out = dense_sequence(df, [F.col("v").asc(), F.col("id").asc()], "seq", num_partitions=parts)
        got = sorted(rows(out, "v", "seq"))
        assert [s for _, s in got] == list(range(1, 5001))


def test_part_written_version_is_never_read_and_old_ones_are_pruned(spark):
    path = scratch_dir(spark, "test-versions")
    assert table_versions(spark, path) == [] and read_current(spark, path) is None
    for n in range(4):
        assert write_version(spark.range(n + 1), path, keep=2) == n + 1
    spark.range(99).write.parquet(f"{path}/version=5")  # a run that died before its pointer
    assert table_versions(spark, path) == [3, 4] and read_current(spark, path).count() == 4
    assert write_version(spark.range(7), path, keep=2) == 5 and read_current(spark, path).count() == 7
    assert not os.path.exists(local(f"{path}/version=3"))


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local(path)}/**/*.parquet", recursive=True)}


def test_a_changed_key_rewrites_one_bucket(spark):
    path = scratch_dir(spark, "test-buckets")
    assert merge_into_buckets(spark, path, spark.createDataFrame([(f"k{i}", "x", "t", T(2026, 1, 1)) for i in range(200)], SCHEMA), "k", "ts", 8, "1") == list(range(8))
    before = files(f"{path}/data")
    day2 = spark.createDataFrame([("k5", "new", "t", T(2026, 1, 2)), ("k6", "old", "t", T(2026, 1, 1))], SCHEMA)
    touched = merge_into_buckets(spark, path, day2, "k", "ts", 8, "2")
    after = files(f"{path}/data")
    gone = {f.split("bucket=")[1].split("/")[0] for f in before if after.get(f) != before[f]}
    assert len(touched) == 1 and gone == {str(touched[0])}
    got = dict(rows(read_buckets(spark, path), "k", "status"))
    assert len(got) == 200 and got["k5"] == "new" and got["k6"] == "x" and last_run(spark, path) == "2"
    assert merge_into_buckets(spark, path, day2, "k", "ts", 8, "3") == [] and last_run(spark, path) == "3"
    assert files(f"{path}/data") == after


def test_merge_that_died_is_finished_by_the_next(spark, monkeypatch):
    from hirelake.operators import history as H
    path = scratch_dir(spark, "test-died")
    merge_into_buckets(spark, path, spark.createDataFrame([("a", "x", "t", T(2026, 1, 1)), ("b", "x", "t", T(2026, 1, 1))], SCHEMA), "k", "ts", 4, "1")
    apply = H._apply_staged
    monkeypatch.setattr(H, "_apply_staged", lambda *a: apply(*a) if len(a) < 5 else None)
    merge_into_buckets(spark, path, spark.createDataFrame([("a", "y", "t", T(2026, 1, 2))], SCHEMA), "k", "ts", 4, "2")
    monkeypatch.undo()
    assert dict(rows(read_buckets(spark, path), "k", "status")) == {"a": "x", "b": "x"} and last_run(spark, path) == "1"
    merge_into_buckets(spark, path, spark.createDataFrame([("c", "z", "t", T(2026, 1, 3))], SCHEMA), "k", "ts", 4, "3")
    assert dict(rows(read_buckets(spark, path), "k", "status")) == {"a": "y", "b": "x", "c": "z"}


def test_snapshot_on_disk_leaves_closed_rows_alone(spark):
    path = scratch_dir(spark, "test-snapshot")
    days = [[("a", "Active", "t", None), ("b", "Active", "t", None), ("c", "Active", "t", None)],
            [("a", "Closed", "t", None), ("b", "Active", "t", None)],
            [("a", "Closed", "t", None), ("b", "Closed", "t", None), ("c", "Active", "t", None)]]
    memory, closed = None, {}
    for n, day in enumerate(days):
        ts, source = f"2026-12-0{n + 1} 00:00:00", spark.createDataFrame(day, SCHEMA)
        memory = scd2_check(memory, source, "k", CHECK, ts)
        for _ in range(2):  # the second call finds the run done
            disk = scd2_into_path(spark, path, source, "k", CHECK, ts, keep=1)
        assert sorted(rows(disk), key=str) == sorted(rows(memory.select(*disk.columns)), key=str)
        now = {f: t for f, t in files(f"{path}/runs").items() if "state=closed" in f}
        assert closed.items() <= now.items()
        closed = now
    assert len([f for f in files(f"{path}/runs") if "state=open" in f]) >= 1 and not any("run=20261201T000000/state=open" in f for f in files(f"{path}/runs"))
    with pytest.raises(ValueError, match="older"):
        scd2_into_path(spark, path, source, "k", CHECK, "2026-12-01 00:00:00")
    # a run without its pointer is not seen
    disk.limit(1).withColumn("state", F.lit("closed")).write.partitionBy("state").parquet(f"{path}/runs/run=20261209T000000")
    assert read_snapshot(spark, path).count() == memory.count()
