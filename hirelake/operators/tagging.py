"""Skill tagging of free text against a phrase catalog.

The catalog is a list ``[(skill_name, category, [alias, …]), …]`` or a table of
aliases; matching is the join of :mod:`hirelake.operators.phrases`.  For every entry,
the first alias (in alias order) found on word boundaries gives (name,
category, confidence, evidence).  Every entry is tested independently, so
overlapping phrases (``apache`` and ``apache license``) are both tagged.

A tagging run gives one row per text: its tags and, where the text could not
be prepared (a translator that fails), the error.  Tags and run log both come
from that row, so one bad text fails neither the run nor the others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import rules
from hirelake.functions.text import ColumnOrName, col, fold_case
from hirelake.operators.dedupe import keep_latest
from hirelake.operators.phrases import Catalog, first_hit, hash_marks, hits_per_text, marked_in

#: Keys that several rows have are marked by their hash in 2**REPEATED_BITS booleans (256 KB); the more there are, the more texts go by rows of words.
REPEATED_BITS = 18

#: Text in, text out; may raise.
Translator = Callable[[str], str]


@F.pandas_udf(T.StringType())
def _unescape_udf(s: pd.Series) -> pd.Series:
    import html
    return s.map(lambda v: None if v is None else html.unescape(v))


# Text changes under HTML unescaping only where '&' is followed by '#' or by a
# character that can start an entity name.
ENTITY_START = r"&(#|[^\t\n\f <&#;])"


def html_unescape(c: ColumnOrName) -> Column:
    """Full HTML entity decoding (named, numeric, legacy forms).  Only text
    that can change is sent to Python; other rows cross the Arrow boundary
    as nulls and keep their own value."""
    x = col(c)
    return F.coalesce(_unescape_udf(F.when(x.rlike(ENTITY_START), x)), x)


# Whitespace that collapsing changes: two in a row, or any other than a blank.
WIDE_SPACE = r"(?U)\s\s|[^\S ]"


def normalize_text(c: ColumnOrName, unescape: bool = True) -> Column:
    """Unescape entities, tags -> space, whitespace runs -> one space, trim."""
    x = html_unescape(c) if unescape else col(c)
    clean = F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"(?U)\s+", " ")
    return F.btrim(F.when(x.contains("<") | x.rlike(WIDE_SPACE), clean).otherwise(x), F.lit(" "))


def detect_arabic(c: ColumnOrName) -> Column:
    return F.coalesce(col(c).rlike(rules.ARABIC_CLASS), F.lit(False))


def cut_evidence(c: Column, chars: int | None) -> Column:
    return c if chars is None else F.left(c, F.lit(chars))


TAG = "struct<skill_name:string,skill_category:string,confidence:double,evidence_span:string>"


def tag_outcomes(df: DataFrame, keys: Sequence[str], text_col: ColumnOrName, catalog: Catalog | DataFrame, confidence: float = 1.0,
                 evidence_override: ColumnOrName | None = None, error: ColumnOrName | None = None,
                 evidence_chars: int | None = None) -> DataFrame:
    """One row per ``keys``: ``tags`` (an array, by entry) and ``error``.

    ``evidence_override`` (the Arabic original) replaces the matched text as
    evidence where it is not null; ``evidence_chars`` cuts the evidence
    (default: whole).  A row with an ``error`` has no tags.
    """
    null = F.lit(None).cast("string")
    extra = F.struct((null if error is None else col(error)).alias("error"), (null if evidence_override is None else col(evidence_override)).alias("evidence"))
    found = hits_per_text(df, keys, text_col, catalog, extra)

    def tag(h: Column) -> Column:
        return F.struct(h["skill_name"].alias("skill_name"), h["skill_category"].alias("skill_category"), F.lit(confidence).cast("double").alias("confidence"),
                        cut_evidence(F.coalesce(F.col("extra.evidence"), h["matched"]), evidence_chars).alias("evidence_span"))

    tags = F.when(F.col("extra.error").isNull(), F.transform("hits", tag)).otherwise(F.array().cast(f"array<{TAG}>"))
    return found.select(*keys, tags.alias("tags"), F.col("extra.error").alias("error"))


def outcome_tags(outcomes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, skill_name, skill_category, confidence, evidence_span) per tag."""
    return outcomes.select(*keys, F.explode("tags").alias("t")).select(*keys, "t.*")


def outcome_log(outcomes: DataFrame, processed_at: str, key_col: str = "job_key") -> DataFrame:
    """One log row per key: number of tags and found, none or error."""
    n = F.size("tags")
    return outcomes.select(key_col, F.lit(processed_at).cast("timestamp_ntz").alias("processed_at"), n.alias("skill_count"),
                           F.when(F.col("error").isNotNull(), F.lit(rules.STATUS_ERROR)).when(n > 0, F.lit(rules.STATUS_FOUND))
                           .otherwise(F.lit(rules.STATUS_NONE)).alias("status"))


def tag_phrases(df: DataFrame, key_col: str, text_col: ColumnOrName, catalog: Catalog | DataFrame,
                confidence: float = 1.0, evidence_override: ColumnOrName | None = None,
                evidence_chars: int | None = None) -> DataFrame:
    """(key, skill_name, skill_category, confidence, evidence_span) per entry found in a text."""
    return outcome_tags(tag_outcomes(df, [key_col], text_col, catalog, confidence, evidence_override, None, evidence_chars), [key_col])


def resolve_phrase(df: DataFrame, keys: Sequence[str], text_col: ColumnOrName, catalog: Catalog | DataFrame, every: bool = True) -> DataFrame:
    """One row per ``keys``: the first catalog entry (catalog order, then
    alias order) found in the text, or nulls; without ``every``, only texts in which one is found."""
    return first_hit(df, keys, text_col, catalog, every).select(
        *keys, F.col("hit.skill_name").alias("skill_name"), F.col("hit.skill_category").alias("skill_category"), F.col("hit.matched").alias("matched"))


def clean_candidate(c: ColumnOrName, unescape: bool = True) -> Column:
    """Unescape, drop word-piece marks ``##``, collapse whitespace, strip
    a punctuation set from both ends.  Words cut from a text that was decoded
    as a whole need no unescaping (one Arrow step for a text, not for a word)."""
    x = F.replace(html_unescape(c) if unescape else col(c), F.lit("##"), F.lit(""))
    x = F.regexp_replace(x, r"(?U)\s+", " ")
    return F.btrim(x, F.lit(rules.CANDIDATE_STRIP_CHARS))


def joined_candidates(cands: DataFrame, key_col: str = "job_key", threshold: float = rules.CONFIDENCE_THRESHOLD) -> DataFrame:
    """Neighbouring words (positions one apart) above the threshold as one
    candidate: words joined by blanks, the first position, the mean score.

    ``cands`` has one row a word (key, ``position``, ``word``, ``score``), or one row a text
    (key, ``words``: an array of ``word`` and ``score``, the position being the place in it).
    Words of a text are joined within its row and nothing moves; only texts whose key
    other rows may have too become rows of words, which count as one text.
    """
    if "words" not in cands.columns:
        return _joined_rows(cands, key_col, threshold)
    repeated = cands.groupBy(key_col).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    may_repeat = marked_in(hash_marks(repeated, [key_col], REPEATED_BITS).scalar(), [key_col], REPEATED_BITS)
    rows = cands.where(may_repeat).select(key_col, F.posexplode("words").alias("position", "__w")).select(key_col, "position", "__w.word", "__w.score")
    return _joined_in_row(cands.where(~may_repeat), key_col, threshold).unionByName(_joined_rows(rows, key_col, threshold))


def _joined_rows(cands: DataFrame, key_col: str, threshold: float) -> DataFrame:
    """A run of neighbours is one group of rows; its position less its rank stays
    the same.  A key's rows meet in one task: they are the words of one text."""
    kept = cands.where(F.col("score") >= threshold)
    rank = F.row_number().over(Window.partitionBy(key_col).orderBy("position"))
    parts = F.array_sort(F.collect_list(F.struct("position", "word")))
    runs = (kept.withColumn("__run", F.col("position") - rank).groupBy(key_col, "__run")
            .agg(parts.alias("__parts"), (F.sum("score") / F.count(F.lit(1))).alias("score")))
    return runs.select(key_col, F.get("__parts", F.lit(0))["position"].alias("position"), F.array_join("__parts.word", " ").alias("word"), "score")


def _joined_in_row(texts: DataFrame, key_col: str, threshold: float) -> DataFrame:
    """What stands between two words below the threshold (or an end of the text) is a run of neighbours."""
    places = F.when(F.col("words").isNotNull(), F.sequence(F.lit(0), F.size("words")))
    ends = F.filter(places, lambda i: ~F.coalesce(F.get("words", i)["score"] >= threshold, F.lit(False)))  # the place behind the last word too

    def run(end: Column, k: Column) -> Column:
        start = F.when(k > 0, F.get("__ends", k - 1) + 1).otherwise(0)
        return F.struct(start.alias("position"), F.slice("words", start + 1, end - start).alias("parts"))

    def candidate(r: Column) -> Column:
        score = F.aggregate(r["parts"]["score"], F.lit(0.0), lambda a, b: a + b) / F.size(r["parts"])
        return F.struct(r["position"].alias("position"), F.array_join(r["parts"]["word"], " ").alias("word"), score.alias("score"))

    runs = F.filter(F.transform("__ends", run), lambda r: F.size(r["parts"]) > 0)
    # an outer explode, as for an inner one Spark would make the runs once more to see whether there are any
    found = texts.select(key_col, "words", ends.alias("__ends")).select(key_col, F.explode_outer(F.transform(runs, candidate)).alias("__c"))
    return found.where(F.col("__c").isNotNull()).select(key_col, "__c.*")


def resolve_scored_candidates(cands: DataFrame, catalog: Catalog | DataFrame, key_col: str = "job_key",
                              threshold: float = rules.CONFIDENCE_THRESHOLD, evidence: DataFrame | None = None,
                              evidence_chars: int | None = None, unescape: bool = True) -> DataFrame:
    """Model output (key, position, word or words, score) -> catalog skills:
    keep score >= threshold, clean the candidate, resolve it to the first catalog
    entry, keep the first hit per (key, case-folded skill) by position.

    ``evidence`` (key, ``evidence_override``), such as the original of an Arabic
    text, replaces the matched word as evidence where it has a row.
    """
    kept = cands.filter(F.col("score") >= threshold).withColumn("__cand", clean_candidate("word", unescape)).filter(F.col("__cand") != "")
    keys = [key_col, "position", "score"]
    hits = resolve_phrase(kept, keys, "__cand", catalog, every=False).select(
        key_col, "position", "skill_name", "skill_category", F.round(F.col("score"), 3).alias("confidence"),
        F.col("matched").alias("evidence_span"))
    if evidence is not None:
        hits = (hits.join(evidence.select(key_col, "evidence_override"), key_col, "left")
                .withColumn("evidence_span", F.coalesce("evidence_override", "evidence_span")).drop("evidence_override"))
    hits = hits.withColumn("evidence_span", cut_evidence(F.col("evidence_span"), evidence_chars))
    first = keep_latest(hits, [key_col, fold_case("skill_name")], [F.col("position").asc(), F.col("confidence").desc(), F.col("skill_name").asc()])
    return first.drop("position")


def merge_tag_sources(model_tags: DataFrame, phrase_tags: DataFrame, key_col: str = "job_key") -> DataFrame:
    """Per (key, case-folded skill) the model result wins over the phrase one."""
    both = model_tags.withColumn("__src", F.lit(0)).unionByName(phrase_tags.withColumn("__src", F.lit(1)))
    return keep_latest(both, [key_col, fold_case("skill_name")], [F.col("__src").asc(), F.col("skill_name").asc()]).drop("__src")


def pending_work(final: DataFrame, tagged: DataFrame | None, log: DataFrame | None,
                 key_col: str = "job_key", text_col: str = "description", limit: int | None = None) -> DataFrame:
    """Keys with non-blank text, one row per key, not yet tagged and not
    logged as done.  ``limit`` is optional: Spark takes the whole queue."""
    todo = final.filter(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != "")).select(key_col, text_col)
    todo = keep_latest(todo, [key_col], [F.col(key_col).asc()])
    if tagged is not None:
        todo = todo.join(tagged.select(key_col), key_col, "left_anti")
    if log is not None:
        done = log.filter(F.col("status").isin(rules.STATUS_FOUND, rules.STATUS_NONE)).select(key_col)
        todo = todo.join(done, key_col, "left_anti")
    if limit is not None:
        todo = todo.orderBy(key_col).limit(limit)
    return todo


def tag_run_log(work: DataFrame, tags: DataFrame, processed_at: str, key_col: str = "job_key",
                failed: DataFrame | None = None) -> DataFrame:
    """One log row per processed key: count of tags and found / none, or error
    for the keys in ``failed`` (logged with no tags, so a later run takes them again)."""
    counts = tags.groupBy(key_col).agg(F.count(F.lit(1)).cast("int").alias("skill_count"))
    out = work.select(key_col).join(counts, key_col, "left")
    bad = F.lit(False)
    if failed is not None:
        out = out.join(failed.select(key_col, F.lit(True).alias("__failed")).distinct(), key_col, "left")
        bad = F.coalesce("__failed", F.lit(False))
    n = F.when(bad, 0).otherwise(F.coalesce(F.col("skill_count"), F.lit(0)))
    return out.select(
        key_col,
        F.lit(processed_at).cast("timestamp_ntz").alias("processed_at"),
        n.alias("skill_count"),
        F.when(bad, F.lit(rules.STATUS_ERROR)).when(n > 0, F.lit(rules.STATUS_FOUND)).otherwise(F.lit(rules.STATUS_NONE)).alias("status"),
    )


def translated(text: Column, translate: Translator) -> Column:
    """``struct(text, error)`` of every non-null text; a row that fails carries its error and no text."""
    @F.pandas_udf("text string, error string")
    def run(texts: pd.Series) -> pd.DataFrame:
        def one(t):
            if t is None:
                return None, None
            try:
                return translate(t), None
            except Exception as e:  # noqa: BLE001 -- whatever the translator raises belongs to its row
                return None, f"{type(e).__name__}: {e}"
        return pd.DataFrame([one(t) for t in texts], columns=["text", "error"], dtype=object)

    return run(text)


def text_outcomes(texts: DataFrame, keys: Sequence[str], text_col: str, catalog: Catalog | DataFrame,
                  translated_col: str | None = None, translate: Translator | None = None,
                  evidence_chars: int | None = None) -> DataFrame:
    """Tag one row per text: normalise, detect Arabic (its evidence is the
    original), match phrases on the model text: a translation when given
    (``translated_col``, or ``translate`` for Arabic texts), else the text.

    One row per ``keys`` with ``tags`` and ``error``; only Arabic texts go to the translator.
    """
    # out of an array, or Spark would normalise the text anew at every use of it
    prepared = texts.select(*keys, F.explode(F.array(normalize_text(text_col))).alias("__orig"),
                            *([F.col(translated_col).alias("__tr")] if translated_col else []))
    arabic = detect_arabic("__orig")
    if translate is not None:
        prepared = prepared.withColumn("__out", translated(F.when(arabic, F.col("__orig")), translate))
        model_text, error = F.when(arabic, F.col("__out.text")).otherwise(F.col("__orig")), F.col("__out.error")
    else:
        model_text = F.coalesce(F.col("__tr"), F.col("__orig")) if translated_col else F.col("__orig")
        error = F.lit(None).cast("string")
    prepared = prepared.select(*keys, normalize_text(model_text).alias("__text"), F.when(arabic, F.col("__orig")).alias("__ev"), error.alias("__error"))
    return tag_outcomes(prepared, keys, "__text", catalog, evidence_override="__ev", error="__error", evidence_chars=evidence_chars)


def tag_texts(texts: DataFrame, id_col: str, text_col: str, catalog: Catalog | DataFrame,
              translated_col: str | None = None, evidence_chars: int | None = None) -> DataFrame:
    """The tags of :func:`text_outcomes`, one row each."""
    return outcome_tags(text_outcomes(texts, [id_col], text_col, catalog, translated_col, evidence_chars=evidence_chars), [id_col])


def tag_documents(work: DataFrame, catalog: Catalog | DataFrame, key_col: str = "job_key", text_col: str = "description",
                  translated_col: str | None = None) -> DataFrame:
    """Tag a work queue of (key, text[, translation]) rows.

    Each distinct text is tagged once: rows carry a content hash, the texts
    are de-duplicated by hash (partial, map-side, so a text repeated across
    many postings ships once per task), tagged, and the tags are joined back
    to the keys on the hash.  Wide text never moves by key.
    """
    content = [F.col(text_col)] + ([F.coalesce(F.col(translated_col), F.lit(""))] if translated_col else [])
    tid = F.sha2(F.concat_ws("\u0001", *content), 256).alias("__tid")
    ids = work.select(key_col, tid)
    cols = [text_col] + ([translated_col] if translated_col else [])
    texts = work.select(tid, *cols).dropDuplicates(["__tid"])
    tags = tag_texts(texts, "__tid", text_col, catalog, translated_col)
    return ids.join(tags, "__tid", "inner").drop("__tid")


def with_live_text(keyed: DataFrame, texts: DataFrame, id_col: str = "description_id", text_col: str = "description") -> DataFrame:
    """Rows whose text, by its id, is not blank; no text moves."""
    live = texts.filter(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
    return keyed.join(live.select(id_col), id_col, "left_semi").select(*keyed.columns)


def tag_postings(final: DataFrame, catalog: Catalog | DataFrame, tagged: DataFrame | None = None,
                 log: DataFrame | None = None, key_col: str = "job_key", text_col: str = "description",
                 translated_col: str | None = None, texts: DataFrame | None = None, id_col: str = "description_id") -> DataFrame:
    """The tagging run over the postings table: the work queue of
    :func:`pending_work`, kept narrow (key, content hash) while it is
    de-duplicated and anti-joined; texts are tagged once per hash.

    With ``texts`` (id, text) the postings carry the id of their text instead of
    the text, and no text is hashed or joined to postings.
    """
    if texts is None:
        ok = final.filter(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
        content = [F.col(text_col)] + ([F.coalesce(F.col(translated_col), F.lit(""))] if translated_col else [])
        tid = F.sha2(F.concat_ws("\u0001", *content), 256)
    else:
        ok, tid = with_live_text(final, texts, id_col, text_col), F.col(id_col)
    ids = keep_latest(ok.select(key_col, tid.alias("__tid")), [key_col], [F.col("__tid").asc()])
    if tagged is not None:
        ids = ids.join(tagged.select(key_col), key_col, "left_anti")
    if log is not None:
        done = log.filter(F.col("status").isin(rules.STATUS_FOUND, rules.STATUS_NONE)).select(key_col)
        ids = ids.join(done, key_col, "left_anti")
    cols = [text_col] + ([translated_col] if translated_col else [])
    found = ok.select(tid.alias("__tid"), *cols).dropDuplicates(["__tid"]) if texts is None else texts.select(F.col(id_col).alias("__tid"), *cols)
    live = found.join(ids.select("__tid").distinct(), "__tid", "left_semi")
    tags = tag_texts(live, "__tid", text_col, catalog, translated_col)
    return ids.join(tags, "__tid", "inner").drop("__tid")


def outcomes_by_text_id(keyed: DataFrame, texts: DataFrame, catalog: Catalog | DataFrame, key_col: str = "job_key",
                        id_col: str = "description_id", text_col: str = "description",
                        translate: Translator | None = None) -> DataFrame:
    """One row per key with a non-blank text: ``tags`` and ``error``.

    Rows carry a content id of their text and the texts sit in their own (id,
    text) table: the queue stays narrow and each text in use is tagged once.
    """
    ids = keyed.select(key_col, id_col).filter(F.col(id_col).isNotNull())
    ids = keep_latest(ids, [key_col], [F.col(id_col).asc()])
    live = (texts.filter(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
            .join(ids.select(id_col), id_col, "left_semi"))
    return ids.join(text_outcomes(live, [id_col], text_col, catalog, translate=translate), id_col, "inner").drop(id_col)


def tag_by_text_id(keyed: DataFrame, texts: DataFrame, catalog: Catalog | DataFrame, key_col: str = "job_key",
                   id_col: str = "description_id", text_col: str = "description") -> DataFrame:
    """The tags of :func:`outcomes_by_text_id`, one row each."""
    return outcome_tags(outcomes_by_text_id(keyed, texts, catalog, key_col, id_col, text_col), [key_col])


def stage_skills(extracted: DataFrame) -> DataFrame:
    """Trim, lower the category, drop null key or name, keep the highest
    confidence per (key, lower(name)); null confidence sorts first, as in the
    warehouse; ties are broken by evidence and category for a stable pick."""
    src = extracted.filter(F.col("job_key").isNotNull() & F.col("skill_name").isNotNull()).select(
        "job_key", F.trim("skill_name").alias("skill_name"), F.lower(F.trim("skill_category")).alias("skill_category"),
        "confidence", F.trim("evidence_span").alias("evidence_span"))
    return keep_latest(src, ["job_key", F.lower("skill_name")], [
        F.col("confidence").desc_nulls_first(), F.col("skill_name").asc_nulls_last(),
        F.col("skill_category").asc_nulls_last(), F.col("evidence_span").asc_nulls_last()])


def high_confidence(staged: DataFrame, threshold: float = rules.CONFIDENCE_THRESHOLD) -> DataFrame:
    return staged.filter(F.col("confidence") >= threshold).select(
        "job_key", F.lower(F.trim("skill_name")).alias("skill_name"),
        F.lower(F.trim("skill_category")).alias("skill_category"), "confidence", "evidence_span",
        (F.col("confidence") >= threshold).alias("is_high_confidence"))
