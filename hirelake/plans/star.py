"""Star schema over the preferred postings: 7 dimensions, 1 fact, 1 bridge.

Foreign keys of the fact are recomputed from its own columns with the same
key functions the dimensions use, instead of being looked up (no joins); the
date key is computed in place for the same reason (every non-null date of the
preferred rows is in ``dim_date`` by construction).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.dates import date_key
from hirelake.functions.keys import pipe_key, surrogate_key
from hirelake.operators.dedupe import pick_min
from hirelake.operators.history import scd2_check, scd2_current
from hirelake.operators.sequence import dense_sequence
from hirelake.operators.tagging import high_confidence, stage_skills, tag_by_text_id, tag_postings
from hirelake.plans.postings import attach_description
from hirelake.session import scratch_dir

RUN_TS = "2026-12-02 00:00:00"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """A frame that several marts read, written into the shared work folder and read back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def extracted_skills(postings, catalog) -> DataFrame:
    """The tagging run over every posting with text (no batch limit).
    ``postings`` is a :class:`Postings` chain (text by content id) or a
    frame holding the text itself."""
    if isinstance(postings, DataFrame):
        return tag_postings(postings, catalog)
    return tag_by_text_id(postings.final_narrow(), postings.texts(), catalog)


def snapshot_first_run(final: DataFrame, run_ts: str = RUN_TS) -> DataFrame:
    return scd2_check(None, final, "job_key", rules.SNAPSHOT_CHECK_COLS, run_ts)


def build_dim_date(preferred: DataFrame) -> DataFrame:
    d = F.col("normalized_job_posted_date")
    return preferred.filter(d.isNotNull()).select(
        date_key(d).alias("date_key"), d.alias("full_date"), F.year(d).alias("year"), F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"), F.quarter(d).alias("quarter"), F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
    ).distinct()


def company_key():
    return surrogate_key("company_name", "company_url_clean")


def location_key():
    return surrogate_key("normalized_city_name", "normalized_region_name", "normalized_country_name")


def source_key():
    return surrogate_key("normalized_job_source", "job_source_channel")


def employment_type_key():
    return surrogate_key("normalized_employment_type")


def build_dim_company(preferred: DataFrame) -> DataFrame:
    """One row per (name, trusted URL); industry is the first one in
    alphabetical order (a ranked pick reduced to ``min``)."""
    picked = pick_min(preferred, ["company_name", "company_url_clean"],
                      {"company_industry": F.col("company_industry_clean")})
    return picked.select(company_key().alias("company_key"), "company_name",
                         F.col("company_url_clean").alias("company_url"), "company_industry")


def build_dim_location(preferred: DataFrame) -> DataFrame:
    return preferred.select(
        location_key().alias("location_key"), F.col("normalized_city_name").alias("city"),
        F.col("normalized_region_name").alias("region"), F.col("normalized_country_name").alias("country"),
    ).distinct()


def build_dim_source(preferred: DataFrame) -> DataFrame:
    return preferred.select(
        source_key().alias("source_key"),
        F.coalesce(F.col("normalized_job_source"), F.lit(rules.MISSING_PLACEHOLDER)).alias("source_name"),
        F.col("job_source_channel").alias("source_channel"),
    ).distinct()


def build_dim_employment_type(preferred: DataFrame) -> DataFrame:
    return preferred.filter(F.col("normalized_employment_type").isNotNull()).select(
        employment_type_key().alias("employment_type_key"),
        F.col("normalized_employment_type").alias("employment_type_name"),
    ).distinct()


def build_dim_job(snapshot: DataFrame, preferred: DataFrame) -> DataFrame:
    current = scd2_current(snapshot).filter(F.col("job_key").isNotNull())
    kept = current.join(preferred.select("job_key"), "job_key", "left_semi")
    return kept.select(
        "job_key", "source_job_id", "job_title", F.col("normalized_job_category").alias("job_category"),
        F.col("normalized_job_status").alias("job_status"), "seniority_level",
    ).distinct()


def build_dim_skills(skills: DataFrame) -> DataFrame:
    d = skills.filter(F.col("is_high_confidence")).select("skill_name", "skill_category").distinct()
    return d.select(pipe_key("skill_name", "skill_category").alias("skill_key"), "skill_name", "skill_category")


def fact_columns(preferred: DataFrame) -> DataFrame:
    """Fact rows before the sequence number."""
    j = preferred.filter(F.col("job_key").isNotNull())
    no_company = F.col("company_name").isNull() & F.col("company_url_clean").isNull()
    return j.select(
        "job_key", "source_job_id",
        F.when(~no_company, company_key()).alias("company_key"),
        location_key().alias("location_key"),
        source_key().alias("source_key"),
        F.when(F.col("normalized_employment_type").isNotNull(), employment_type_key()).alias("employment_type_key"),
        date_key("normalized_job_posted_date").alias("job_posted_date_key"),
        F.col("normalized_workplace_type").alias("workplace_type"),
        "is_salary_disclosed", "job_url",
        "description_id" if "description_id" in preferred.columns else "description",
        "experience_min_years", "experience_max_years",
        "experience_is_open_ended", "collected_at",
    )


def build_fact_posting(preferred: DataFrame) -> DataFrame:
    rows = fact_columns(preferred)
    numbered = dense_sequence(rows, [F.col("job_key").asc_nulls_last(), F.col("source_job_id").asc_nulls_last(),
                                     F.col("job_url").asc_nulls_last()], "job_posting_key")
    return numbered.drop("source_job_id")


def build_bridge_job_skills(skills: DataFrame, fact: DataFrame, posting_key: str = "job_posting_key") -> DataFrame:
    """Posting and skill keys of confident tags; the skill key is a function of
    the skill, so the skill dimension is not read."""
    s = skills.filter(F.col("is_high_confidence") & F.col("skill_name").isNotNull() & F.col("skill_category").isNotNull())
    return s.join(fact.select(F.col("job_key").alias("__fact_job"), F.col(posting_key).alias("__posting")), F.col("job_key") == F.col("__fact_job")).select(
        F.col("__posting").alias(posting_key), pipe_key("skill_name", "skill_category").alias("skill_key"),
        F.lit("nlp").alias("extraction_method"), "confidence", "evidence_span")


class Star:
    """All marts over one postings chain.

    The chain's narrow frames (description as a content id) feed every
    mart; the text is joined back only for the fact's own output.  The
    final and preferred rows have many readers and are kept once (memory,
    spilling to disk; a lost executor's blocks are recomputed from lineage).
    """

    def __init__(self, postings, catalog, run_ts: str = RUN_TS, persist: bool = True,
                 extracted: DataFrame | None = None, snapshot: DataFrame | None = None):
        self.p = postings
        self.catalog = catalog
        # stored skill tags / snapshot (a daily run) instead of computing them here
        self._extracted = extracted
        self._snapshot = snapshot
        self.run_ts = run_ts
        self._fact = None
        self._final = postings.final_narrow()
        self._preferred = postings.preferred_narrow()
        if persist:
            self._final = self._final.persist(StorageLevel.MEMORY_AND_DISK)
            self._preferred = self._preferred.persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        """Give back what is kept; frames handed out before still work, from their lineage."""
        self._final.unpersist()
        self._preferred.unpersist()

    def final(self):
        return self._final

    def preferred(self):
        return self._preferred

    def skills(self):
        """Confident tags; computed tags are written once, as several marts read them."""
        if self._extracted is None:
            self._extracted = written_once(tag_by_text_id(self._final, self.p.texts(), self.catalog), "skills")
        return high_confidence(stage_skills(self._extracted))

    def snapshot(self):
        if self._snapshot is not None:
            return self._snapshot
        return snapshot_first_run(self.final(), self.run_ts)

    def dim_date(self):
        return build_dim_date(self.preferred())

    def dim_company(self):
        return build_dim_company(self.preferred())

    def dim_location(self):
        return build_dim_location(self.preferred())

    def dim_source(self):
        return build_dim_source(self.preferred())

    def dim_employment_type(self):
        return build_dim_employment_type(self.preferred())

    def dim_job(self):
        return build_dim_job(self.snapshot(), self.preferred())

    def dim_skills(self):
        return build_dim_skills(self.skills())

    def fact_narrow(self):
        """The fact with the description as its content id (what joins,
        reports and checks read)."""
        if self._fact is None:
            self._fact = build_fact_posting(self.preferred())
        return self._fact

    def fact_rows(self):
        """The fact's rows without their number, for readers that do not need it."""
        return fact_columns(self.preferred()).drop("source_job_id")

    def fact(self):
        return attach_description(self.fact_narrow(), self.p.texts())

    def bridge(self):
        return build_bridge_job_skills(self.skills(), self.fact_narrow())

    def bridge_rows(self):
        """The bridge's rows by job key, for readers that do not need the posting's number."""
        return build_bridge_job_skills(self.skills(), self.fact_rows(), "job_key")
