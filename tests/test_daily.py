"""Two daily runs over landed files: new files load once, the final table
takes only strictly newer rows, the work queue shrinks, checks pass."""

from pyspark.sql import functions as F

from conftest import SF0001
from hirelake.plans.daily import daily_run, new_rows
from hirelake.plans.postings import Postings
from hirelake.plans.star import written_once
from hirelake.sources.catalog import LOCAL_PHRASES
from hirelake.operators.history import incremental_since_watermark, merge_by_key, merge_into_buckets, read_buckets
from hirelake.session import scratch_dir
from hirelake.sources.bronze import conform_columns, write_csv
from hirelake.streaming.ingest import ingest_new_files, read_raw
from hirelake.sources.seeds import city_region_seed

CUT = "1997-01-01 00:00:00"


def test_two_days(spark):
    raw = conform_columns(Postings.from_testdata(spark, SF0001).raw)
    ts = F.col("collected_at")
    day1 = raw.filter(ts <= CUT)
    day2 = raw.filter((ts > CUT) | ts.isNull())
    land, wh = scratch_dir(spark, "t-daily-land"), scratch_dir(spark, "t-daily-wh")
    write_csv(day1.withColumn("platform", F.lit("sabbar")), land, "append", ["platform"])
    seed = city_region_seed(spark)
    r1 = daily_run(spark, land, wh, "2026-12-01 00:00:00", seed, LOCAL_PHRASES)
    write_csv(day2.withColumn("platform", F.lit("tanqeeb")), land, "append", ["platform"])
    r2 = daily_run(spark, land, wh, "2026-12-02 00:00:00", seed, LOCAL_PHRASES)
    r3 = daily_run(spark, land, wh, "2026-12-03 00:00:00", seed, LOCAL_PHRASES)  # nothing new
    assert r1["raw_rows"] == day1.count() and r2["raw_rows"] == raw.count() == r3["raw_rows"]
    assert r2["final_rows"] > r1["final_rows"] and r3["final_rows"] == r2["final_rows"]
    texts = spark.read.parquet(f"{wh}/silver/descriptions")
    assert texts.count() == texts.select("description_id").distinct().count()
    blank = texts.where(F.trim("description") == "").count()
    assert blank == 0 and r1["logged_keys"] == r1["final_rows"]
    assert r3["logged_keys"] == 0 and r3["new_tags"] == 0
    assert r3["snapshot_rows"] == r2["snapshot_rows"]
    assert r1["buckets"] and r2["buckets"] and not r3["buckets"]
    for r in (r1, r2, r3):
        late = r["check_failures"].pop("int_jobs_final.posted_dates")  # the fixture's posted dates are years after its collection
        assert late > 0 and len(r["check_failures"]) == 12
        assert all(v == 0 for v in r["check_failures"].values()), r["check_failures"]
        assert r["marts"]["fact_job_posting"] == r["marts"]["dim_job"]


def test_final_as_chain_over_all_rows(spark):
    """The day's rows alone give what the chain over all raw rows and the watermark give, also with undated and late rows."""
    raw = conform_columns(Postings.from_testdata(spark, SF0001).raw)
    ts = F.col("collected_at")
    early = raw.where((ts <= CUT) | ts.isNull())  # undated rows come first and keep ranking before what follows
    days = [early, raw.where(ts > CUT)]
    land, table, final, ckpt = (scratch_dir(spark, f"t-day-{x}") for x in ("land", "raw", "final", "ckpt"))
    seed, want = city_region_seed(spark), None
    cols = ["job_key", "collected_at", "job_title", "city", "description_id"]
    for n, rows_ in enumerate(days):
        write_csv(rows_.withColumn("platform", F.lit("sabbar")), land, "append", ["platform"])
        ingest_new_files(spark, land, table, ckpt)
        day = new_rows(spark, table, read_buckets(spark, final), n - 1)
        assert day.count() < read_raw(spark, table).count() or n == 0
        merge_into_buckets(spark, final, Postings(spark, day, seed).final_narrow(), "job_key", "collected_at", 4, str(n))
        whole = Postings(spark, read_raw(spark, table), seed).final_narrow()
        want = written_once(merge_by_key(want, incremental_since_watermark(whole.select(*cols), want, "collected_at"), "job_key")
                            if want is not None else whole.select(*cols), "t-want")
        got = read_buckets(spark, final).select(*cols)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_translator_errors_are_logged_and_tried_again(spark):
    raw = conform_columns(Postings.from_testdata(spark, SF0001).raw).withColumn(
        "description", F.when(F.col("source_job_id").endswith("5"), F.lit("\u0645\u0647\u0646\u062f\u0633 apache")).otherwise(F.col("description")))
    land, wh = scratch_dir(spark, "t-daily-land"), scratch_dir(spark, "t-daily-wh")
    write_csv(raw.withColumn("platform", F.lit("sabbar")), land, "append", ["platform"])
    seed = city_region_seed(spark)

    def broken(text):
        raise ValueError("no model")

    r1 = daily_run(spark, land, wh, "2026-12-01 00:00:00", seed, LOCAL_PHRASES, translate=broken)
    r2 = daily_run(spark, land, wh, "2026-12-02 00:00:00", seed, LOCAL_PHRASES, translate=lambda t: t)
    bad = r1["statuses"]["error"]
    assert bad > 0 and r2["statuses"] == {"skills_found": bad} and r2["new_tags"] == bad
