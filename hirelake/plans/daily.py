"""The daily run, in the order the stages depend on each other:

1. load new landed files into the raw table (Structured Streaming,
   ``availableNow``; files seen before are skipped; one parse of each file);
2. run the postings chain over the rows of the new batches and merge into the
   final table -- only rows newer than the stored maximum collection
   time, keyed by ``job_key``, and only into the buckets they fall into;
3. record status history: a run of the snapshot (SCD-2 check strategy);
4. tag skills for the pending queue only (not tagged, not logged as done)
   and append the tags and one log row per processed key, errors included;
5. rebuild the marts as new table versions;
6. run all data checks, one scan for each table; counts are reported.

A day costs what it brings: old raw rows are read only where they could still
win against a new one (no collection time, which ranks first, or a later one),
untouched buckets and closed history are not written, and texts stay in a
table of their own that no stage but tagging reads.

Every table is a Parquet folder under ``warehouse``; scratch data
goes under the session's checkpoint folder.  Nothing passes through the
driver but row counts and bucket numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.operators import checks as C
from hirelake.operators.history import (
    VALID_TO, last_run, merge_into_buckets, read_buckets, read_current, read_snapshot, read_table_at, scd2_into_path, write_version,
)
from hirelake.operators.phrases import Catalog
from hirelake.operators.tagging import Translator, outcome_log, outcome_tags, outcomes_by_text_id
from hirelake.plans.postings import Postings, preferred_postings
from hirelake.plans.star import Star, written_once
from hirelake.streaming.ingest import CORRUPT_COL, ingest_new_files, ingested, read_raw

ID = ["source_job_id", "job_url"]


def preferred_group() -> list[Column]:
    return [F.trim(F.lower("job_title")), F.trim(F.lower("company_name")), F.col("normalized_city_name")]


class StoredFinal:
    """A stored final table seen through the chain's interface: narrow rows
    that carry the id of their text, and the texts."""

    def __init__(self, final: DataFrame, texts: DataFrame):
        self._final, self._texts = final, texts

    def final_narrow(self) -> DataFrame:
        return self._final

    def texts(self) -> DataFrame:
        return self._texts

    def preferred_narrow(self) -> DataFrame:
        return preferred_postings(self._final)


def new_rows(spark: SparkSession, table: str, final: DataFrame | None, after: int) -> DataFrame:
    """Raw rows that a day's chain needs: those of batches after ``after``, and
    of the older ones those that rank before a new row of the same posting,
    found by folder (no time) and by file statistics (later than the stored maximum)."""
    rows = ingested(spark, table).where("state != 'bad'")
    old = rows.where(F.col("batch") <= after)
    parts = rows.where(F.col("batch") > after).unionByName(old.where("state = 'undated'"))
    newest = final.agg(F.max("collected_at")).first()[0] if final is not None else None
    if newest is not None:
        parts = parts.unionByName(old.where((F.col("state") == "good") & (F.col("collected_ts") > F.lit(newest).cast("timestamp_ntz"))))
    return parts.drop("batch", "state", "collected_ts", CORRUPT_COL)


def store_texts(spark: SparkSession, path: str, raw: DataFrame, batch: int) -> DataFrame:
    """Texts not yet stored, in a folder of the batch; returns all (description_id, description)."""
    old = read_table_at(spark, path)
    new = raw.select("description_id", "description").where(F.col("description_id").isNotNull()).dropDuplicates(["description_id"])
    if old is not None:
        new = new.join(old.where(F.col("batch") != batch).select("description_id"), "description_id", "left_anti")
    new.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return spark.read.parquet(path).select("description_id", "description")


def pending_keys(final: DataFrame, tagged: DataFrame | None, log: DataFrame | None) -> DataFrame:
    """Final rows that are neither tagged nor logged as done."""
    todo = final.select("job_key", "description_id")
    if tagged is not None:
        todo = todo.join(tagged.select("job_key"), "job_key", "left_anti")
    if log is not None:
        done = log.where(F.col("status").isin(rules.STATUS_FOUND, rules.STATUS_NONE))
        todo = todo.join(done.select("job_key"), "job_key", "left_anti")
    return todo


def run_checks(final: DataFrame, preferred: DataFrame, staged: DataFrame, deduped: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """(table_name, check_name, failures): all checks, the rules of a table in one scan."""
    fact = gold["fact_job_posting"]
    suites = [
        ("int_jobs_final", C.suite_counts(final, {
            "not_null": C.null_rule("job_key"),
            "accepted_values": C.values_rule("seniority_level", rules.SENIORITY_LABELS),
            "flag_consistency": C.flag_rule("has_category_data", "normalized_job_category"),
            "year_ranges": C.years_rule(), "posted_dates": C.posted_rule()}, ["job_key"], "unique")),
        ("int_jobs_preferred", C.suite_counts(preferred, {}, preferred_group(), "unique_combination")),
        ("int_jobs_city_deduped", C.suite_counts(deduped, {}, ID, "no_duplicates")),
        ("bridge_job_skills", C.suite_counts(gold["bridge_job_skills"], {"accepted_range": C.range_rule("confidence", rules.CONFIDENCE_THRESHOLD, 1)})),
        ("int_jobs_city_deduped", _counted("dedupe_exact", C.check_dedupe_exact(staged, deduped, ID))),
        ("int_jobs_preferred", _counted("group_row_count", C.check_group_row_count(final, preferred, preferred_group()))),
        ("fact_job_posting", _counted("relationships", C.check_relationships(fact, "job_key", gold["dim_job"], "job_key"))),
        ("fact_job_posting", _counted("fact_foreign_keys", C.check_fact_foreign_keys(fact, {
            "job_key": (gold["dim_job"], "job_key"), "company_key": (gold["dim_company"], "company_key"),
            "location_key": (gold["dim_location"], "location_key"), "source_key": (gold["dim_source"], "source_key"),
            "employment_type_key": (gold["dim_employment_type"], "employment_type_key"),
            "job_posted_date_key": (gold["dim_date"], "date_key")}))),
    ]
    out = None
    for table, counts in suites:
        counts = counts.select(F.lit(table).alias("table_name"), "check_name", "failures")
        out = counts if out is None else out.unionByName(counts)
    return out


def _counted(name: str, failures: DataFrame) -> DataFrame:
    return failures.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def daily_run(spark: SparkSession, landing: str, warehouse: str, run_ts: str,
              seed: DataFrame, catalog: Catalog | DataFrame, translate: Translator | None = None,
              buckets: int = 64, keep: int = 7) -> dict:
    """One day; ``keep`` versions of the marts and runs of the snapshot's open rows stay."""
    w = warehouse.rstrip("/")
    raw_path, final_path, snapshot_path = f"{w}/raw/jobs_raw", f"{w}/silver/int_jobs_final", f"{w}/silver/snapshot_job_status"
    extracted, log_path = f"{w}/raw/extracted_skills", f"{w}/raw/skill_extraction_log"
    # 1. new files only
    ingest_new_files(spark, landing, raw_path, f"{w}/_checkpoints/ingest")
    loaded = ingested(spark, raw_path).agg(F.max("batch")).first()[0]
    # 2. chain over what is new + incremental merge (strictly newer than the stored maximum)
    merged = last_run(spark, final_path)
    after, last = -1 if merged is None else int(merged), -1 if loaded is None else loaded
    day = new_rows(spark, raw_path, read_buckets(spark, final_path), after)
    chain = Postings(spark, day, seed)
    touched = []
    if last > after or merged is None:
        texts = store_texts(spark, f"{w}/silver/descriptions", day, last)
        touched = merge_into_buckets(spark, final_path, chain.final_narrow(), "job_key", "collected_at", buckets, str(last))
    else:
        texts = spark.read.parquet(f"{w}/silver/descriptions").select("description_id", "description")
    final = read_buckets(spark, final_path)
    if final is None:  # nothing passed yet
        final = chain.final_narrow().where(F.lit(False))
    # 3. status history; final rows are only ever updated or added, so an untouched table has none
    if touched or read_snapshot(spark, snapshot_path) is None:
        scd2_into_path(spark, snapshot_path, final, "job_key", rules.SNAPSHOT_CHECK_COLS, run_ts, keep=keep)
    snapshot = read_snapshot(spark, snapshot_path)
    # 4. skill tagging of the pending queue, then tags and log appended
    queue = pending_keys(final, read_table_at(spark, extracted), read_table_at(spark, log_path))
    outcomes = written_once(outcomes_by_text_id(queue, texts, catalog, translate=translate), "daily-outcomes")
    outcome_tags(outcomes, ["job_key"]).write.mode("append").parquet(extracted)
    outcome_log(outcomes, run_ts).write.mode("append").parquet(log_path)
    # 5. marts
    star = Star(StoredFinal(final, texts), catalog, run_ts, extracted=spark.read.parquet(extracted), snapshot=snapshot)
    marts = {
        "dim_date": star.dim_date(), "dim_company": star.dim_company(), "dim_location": star.dim_location(),
        "dim_source": star.dim_source(), "dim_employment_type": star.dim_employment_type(),
        "dim_job": star.dim_job(), "dim_skills": star.dim_skills(), "fact_job_posting": star.fact_narrow(),
        "bridge_job_skills": star.bridge(),
    }
    for name, df in marts.items():
        write_version(df, f"{w}/gold/{name}", run_ts, keep)
    gold = {n: read_current(spark, f"{w}/gold/{n}") for n in marts}
    # 6. checks
    report = run_checks(final, star.preferred(), chain.staged_narrow(), chain.deduped(), gold)
    star.release()
    statuses = {r["status"]: r["count"] for r in outcome_log(outcomes, run_ts).groupBy("status").count().collect()}
    return {
        "raw_rows": read_raw(spark, raw_path).count(), "final_rows": final.count(), "snapshot_rows": snapshot.count(),
        "open_versions": snapshot.filter(F.col(VALID_TO).isNull()).count(), "buckets": touched,
        "new_tags": outcome_tags(outcomes, ["job_key"]).count(), "logged_keys": sum(statuses.values()), "statuses": statuses,
        "marts": {n: df.count() for n, df in gold.items()},
        "check_failures": {f"{r['table_name']}.{r['check_name']}": r["failures"] for r in report.collect()},
    }
