import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from hirelake.operators.dedupe import keep_latest, preferred_row
from hirelake.operators.profiling import flag_group_duplicates


def test_keep_latest_prefers_null_time(spark):
    df = spark.createDataFrame([("a", dt.datetime(2026, 1, 1)), ("a", None)], "k string, t timestamp_ntz")
    assert rows(keep_latest(df, ["k"], [F.col("t").desc_nulls_first()])) == [("a", None)]


def test_preferred_row_channel_beats_url(spark):
    df = spark.createDataFrame([
        ("Chef", "Acme", None, 1, None, "k1"),
        ("chef ", "ACME", None, 3, "https://x", "k2"),
    ], "title string, company string, city string, prio int, url string, key string")
    out = preferred_row(df, [F.trim(F.lower("title")), F.trim(F.lower("company")), F.col("city")],
                        [F.col("prio").asc(), F.when(F.col("url").isNull(), 1).otherwise(0).asc(), F.col("key")],
                        count_col="n")
    assert rows(out, "key", "n", "priority_rank") == [("k1", 2, 1)]


def test_hot_group_is_counted_whole(spark):
    # one key holds a third of the rows
    hot = [("hot", i) for i in range(3000)]
    cold = [(f"c{i}", i) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "k string, v int").repartition(8)
    best = preferred_row(df, [F.col("k")], [F.col("v").desc()], count_col="n")
    got = {r[0]: (r[1], r[2]) for r in rows(best, "k", "v", "n")}
    assert got["hot"] == (2999, 3000) and len(got) == 6001
    flagged = flag_group_duplicates(df, ["k"])
    assert flagged.count() == 3000


def test_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    out = preferred_row(df, [F.col("k")], [F.col("v").asc()], count_col="n")
    assert sorted(rows(out, "k", "v", "n"), key=str) == sorted([(None, 1, 2), ("a", 3, 1)], key=str)


def test_dedupe_counts_from_the_same_pass(spark):
    from hirelake.operators.dedupe import DedupeCounts, dedupe_counts, dedupe_keep_missing_ids
    data = [("a", 1), ("a", 2), (None, 3), (None, 3), (" ", 4), ("NaN", 5), ("none", 6), ("b", 7), ("hot", 8)] + [("hot", i) for i in range(100)]
    df = spark.createDataFrame(data, "k string, v int").repartition(4)
    counts = DedupeCounts()
    got = dedupe_keep_missing_ids(df, "k", [F.col("v").asc()], counts)
    assert sorted(rows(got), key=str) == sorted([("a", 1), (None, 3), (None, 3), (" ", 4), ("NaN", 5), ("none", 6), ("b", 7), ("hot", 0)], key=str)
    assert counts.get() == dedupe_counts(df, "k").first().asDict()
