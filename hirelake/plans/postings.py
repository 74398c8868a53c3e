"""The postings profile: raw postings -> cleaned, de-duplicated, keyed rows.

Each stage is a plain ``DataFrame -> DataFrame`` function, so any prefix of
the chain can be run, inspected or replaced.  The whole chain is one lazy
plan; Catalyst collapses the projections.  Two shuffles are inherent:
the de-duplication on (id, url) and the preferred-row choice.

Raw tables may carry two narrow ids that ingestion writes: ``row_id``, which
orders rows that nothing else tells apart, and ``description_id``, the key of
the text.  Then no stage reads or hashes a text; it is joined
back where an output shows it.  Without them the ids are derived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.dates import parse_posted_date, try_timestamp_ntz
from hirelake.functions.keys import surrogate_key
from hirelake.functions.text import initcap_delims, try_boolean
from hirelake.operators import normalize as N
from hirelake.operators.dedupe import keep_latest, preferred_row
from hirelake.operators.joins import join_left_lookup
from hirelake.sources.fixture import derived_postings, posting_texts
from hirelake.sources.seeds import city_region_seed


def description_id(c: str = "description"):
    """Content key of a description (null for a null text)."""
    return F.sha2(F.col(c), 256)


def with_ids(raw: DataFrame) -> DataFrame:
    """``raw`` with both ids; those that are missing are a hash of the narrow
    columns and the digest of the text."""
    narrow = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in rules.RAW_COLUMNS if c != "description"]
    ids = {"row_id": F.xxhash64(F.concat(*narrow)), "description_id": description_id()}
    return raw.withColumns({c: v for c, v in ids.items() if c not in raw.columns})


def description_texts(raw: DataFrame, text_col: str = "description") -> DataFrame:
    """(description_id, description), one row per text id.  Partial
    de-duplication runs map-side, so a text repeated across many postings
    ships once per task."""
    tid = F.col("description_id") if "description_id" in raw.columns else description_id(text_col)
    return (raw.select(tid.alias("description_id"), F.col(text_col).alias("description"))
            .filter(F.col("description_id").isNotNull()).dropDuplicates(["description_id"]))


def attach_description(df: DataFrame, texts: DataFrame) -> DataFrame:
    """Late materialisation of the wide text column: the chain shuffles only
    the 64-character id; the text is joined back where it is needed (AQE
    broadcasts the text side when it is small and splits skewed ids)."""
    cols = [c if c != "description_id" else "description" for c in df.columns]
    # rows without a text get a key of their own each, so they do not gather in one task
    none = F.concat(F.lit("none-"), F.xxhash64(*df.columns).cast("string"))
    keyed = df.withColumn("__text", F.coalesce("description_id", none))
    return keyed.join(texts.withColumnRenamed("description_id", "__text"), "__text", "left").select(*cols)


def stage_postings(raw: DataFrame, late_text: bool = False) -> DataFrame:
    """Rename, literal clean-ups, forgiving casts; drop null or blank ids.
    With ``late_text`` the two ids are carried instead of the description."""
    c = F.col
    raw = with_ids(raw) if late_text else raw
    text = [c("row_id"), c("description_id")] if late_text else [c("description")]
    return raw.filter(c("source_job_id").isNotNull() & (F.trim(c("source_job_id")) != "")).select(
        c("source_job_id"),
        F.replace(c("job_title"), F.lit(rules.TITLE_SUFFIX_TO_DROP), F.lit("")).alias("job_title"),
        c("url").alias("job_url"),
        c("company_name"),
        c("company_url"),
        F.replace(c("industry"), F.lit(rules.INDUSTRY_ENTITY_FROM), F.lit(rules.INDUSTRY_ENTITY_TO)).alias("company_industry"),
        c("city"), c("region"), c("country"), c("employment_type"), c("workplace_type"),
        c("experience_years"), c("job_category"),
        try_boolean(c("is_salary_disclosed")).alias("is_salary_disclosed"),
        try_timestamp_ntz(c("collected_at")).alias("collected_at"),
        F.replace(c("job_source"), F.lit(rules.SOURCE_SUFFIX_TO_DROP), F.lit("")).alias("job_source"),
        c("job_posted_date"), c("job_status"), *text,
    )


def city_deduped(stg: DataFrame) -> DataFrame:
    """City from the URL slug where the site has one; then one row per
    (id, url), newest first, with a null collection time ranked first; ties go
    by the row's own id, so a repeated task picks the same row."""
    url_city, city_final = N.city_from_url("job_url", "city")
    resolved = stg.withColumns({"url_city_raw": url_city, "city_final": city_final})
    return keep_latest(resolved, ["source_job_id", "job_url"], [F.col("collected_at").desc_nulls_first(), F.col("row_id").asc()])


def with_location(df: DataFrame, seed: DataFrame) -> DataFrame:
    """Seed lookup on the cleaned city, region rules, country aliases."""
    keyed = df.withColumn("city_lookup_key", N.city_lookup_key("city_final"))
    joined = join_left_lookup(
        keyed,
        seed.select("raw_value_normalized", "mapped_city", "mapped_region"),
        F.col("city_lookup_key"), "raw_value_normalized",
    )
    located = joined.select(
        *[keyed[c] for c in keyed.columns],
        F.col("mapped_city").alias("normalized_city_name"),
        F.col("mapped_region").alias("seed_mapped_region"),
        initcap_delims(keyed["region"]).alias("__region_ic"),
    )
    return located.withColumns({
        "normalized_region_name": N.normalize_region("region", "seed_mapped_region", "__region_ic"),
        "normalized_country_name": N.normalize_country("country"),
    }).drop("__region_ic")


def country_filtered(df: DataFrame, country: str = rules.KEEP_COUNTRY) -> DataFrame:
    return df.filter(F.col("normalized_country_name") == country)


def with_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("normalized_job_posted_date", parse_posted_date("job_posted_date", "collected_at"))


def with_attributes(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "normalized_workplace_type": N.normalize_workplace("workplace_type"),
        "normalized_employment_type": N.normalize_employment_type("employment_type"),
        "normalized_job_status": N.normalize_status("job_status"),
        "normalized_job_source": N.normalize_source("job_source"),
        "job_source_channel": N.derive_channel("job_url", "job_source"),
    })


def with_experience(df: DataFrame) -> DataFrame:
    parts = df.withColumns(N.experience_parts("experience_years"))
    ranged = parts.withColumns(N.experience_range(
        "experience_years_clean", "is_date_like", "exp_num1", "exp_num2",
        "is_fresh", "is_open_ended", "is_upper_bound_only"))
    return ranged.withColumn(
        "seniority_level", N.derive_seniority("experience_min_years", "experience_max_years", "is_open_ended"))


def with_category(df: DataFrame) -> DataFrame:
    derived = df.withColumn("title_derived_category", N.category_from_title("job_title"))
    return derived.withColumns(N.normalize_category("job_category", "title_derived_category"))


def category_filtered(df: DataFrame, allowed=rules.CATEGORIES_IN_SCOPE) -> DataFrame:
    return df.filter(F.col("normalized_job_category").isin(*allowed))


def with_industry(df: DataFrame) -> DataFrame:
    clean, has = N.placeholder_for_missing("company_industry")
    return df.withColumns({"company_industry_clean": clean, "has_company_industry_data": has})


def with_company(df: DataFrame) -> DataFrame:
    clean, valid = N.void_untrusted_column("company_url", "normalized_job_source")
    return df.withColumns({"company_url_clean": clean, "has_valid_company_url": valid})


WIDE_COLUMNS = [
    "source_job_id", "job_title", "job_category", "normalized_job_category", "has_category_data",
    "is_category_derived_from_title", "company_industry", "company_industry_clean",
    "has_company_industry_data", "company_name", "company_url", "company_url_clean",
    "has_valid_company_url", "city", "normalized_city_name", "region", "normalized_region_name",
    "country", "normalized_country_name", "employment_type", "normalized_employment_type",
    "workplace_type", "normalized_workplace_type", "experience_years", "experience_min_years",
    "experience_max_years", "experience_is_open_ended", "seniority_level", "job_status",
    "normalized_job_status", "is_salary_disclosed", "job_url", "normalized_job_source",
    "job_source_channel", "job_posted_date", "normalized_job_posted_date", "collected_at",
    "description",
]


def select_wide(df: DataFrame) -> DataFrame:
    cols = [c if c != "description" or c in df.columns else "description_id" for c in WIDE_COLUMNS]
    return df.select(*cols)


def with_job_key(df: DataFrame) -> DataFrame:
    return df.select(surrogate_key("source_job_id", "normalized_job_source", "job_url").alias("job_key"), "*")


def preferred_postings(final: DataFrame) -> DataFrame:
    """One posting per normalised (title, company, city): channel priority,
    then has a trusted company URL, then newest (null first), then key."""
    return preferred_row(
        final,
        [F.trim(F.lower("job_title")), F.trim(F.lower("company_name")), F.col("normalized_city_name")],
        [
            N.channel_priority("job_source_channel").asc(),
            F.when(F.col("company_url_clean").isNull(), 1).otherwise(0).asc(),
            F.col("collected_at").desc_nulls_first(),
            F.col("job_key").asc_nulls_last(),
        ],
        rank_col="priority_rank", count_col="channel_duplicate_count",
    )


class Postings:
    """The chain over one input, stage by stage (all lazy).

    Stages run on narrow rows: the description travels as its content id
    and is joined back by :meth:`final`, :meth:`preferred` and
    :meth:`staged` (``*_narrow`` give the id-carrying frames)."""

    def __init__(self, spark: SparkSession, raw: DataFrame, seed: DataFrame, texts: DataFrame | None = None):
        self.spark = spark
        self.raw = raw
        self.seed = seed
        self._texts = texts  # (description_id, description), where the raw rows carry description_id
        self._stages: dict[str, DataFrame] = {}

    def _memo(self, name: str, build) -> DataFrame:
        """Each stage is built (and analysed) once per chain; DataFrames are
        immutable plans, so handing the same one to several readers is safe."""
        if name not in self._stages:
            self._stages[name] = build()
        return self._stages[name]

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> Postings:
        """The chain over the derived postings with the small demo mapping."""
        return cls(spark, derived_postings(spark, sf_dir), city_region_seed(spark), posting_texts(spark, sf_dir))

    def texts(self) -> DataFrame:
        return self._memo("texts", lambda: description_texts(self.raw) if self._texts is None else self._texts)

    def staged_narrow(self) -> DataFrame:
        return self._memo("staged_narrow", lambda: stage_postings(self.raw, late_text=True))

    def staged(self) -> DataFrame:
        return self._memo("staged", lambda: stage_postings(self.raw))

    def deduped(self) -> DataFrame:
        return self._memo("deduped", lambda: city_deduped(self.staged_narrow()))

    def located(self) -> DataFrame:
        return self._memo("located", lambda: with_location(self.deduped(), self.seed))

    def in_country(self) -> DataFrame:
        return self._memo("in_country", lambda: country_filtered(self.located()))

    def dated(self) -> DataFrame:
        return self._memo("dated", lambda: with_dates(self.in_country()))

    def attributed(self) -> DataFrame:
        return self._memo("attributed", lambda: with_attributes(self.dated()))

    def experienced(self) -> DataFrame:
        return self._memo("experienced", lambda: with_experience(self.attributed()))

    def categorized(self) -> DataFrame:
        return self._memo("categorized", lambda: with_category(self.experienced()))

    def in_scope(self) -> DataFrame:
        return self._memo("in_scope", lambda: category_filtered(self.categorized()))

    def cleaned_narrow(self) -> DataFrame:
        return self._memo("cleaned_narrow", lambda: select_wide(with_company(with_industry(self.in_scope()))))

    def cleaned(self) -> DataFrame:
        return self._memo("cleaned", lambda: attach_description(self.cleaned_narrow(), self.texts()))

    def final_narrow(self) -> DataFrame:
        return self._memo("final_narrow", lambda: with_job_key(self.cleaned_narrow()))

    def final(self) -> DataFrame:
        return self._memo("final", lambda: attach_description(self.final_narrow(), self.texts()))

    def preferred_narrow(self) -> DataFrame:
        return self._memo("preferred_narrow", lambda: preferred_postings(self.final_narrow()))

    def preferred(self) -> DataFrame:
        return self._memo("preferred", lambda: attach_description(self.preferred_narrow(), self.texts()))
