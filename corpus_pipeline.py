"""Corpus pipeline: documents of a known language, one of each group of near copies,
without personal data, mixed to target weights and encoded.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm import language_id, mixing, near_duplicates, personal_data, sentencepiece_bpe
from hirelake.llm.common import documents, written
from hirelake.llm.queries import tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language the profiles do not tell; the profiles come from all labelled ones not held out."""
    return language_id.identified(docs, language_id.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    found = near_duplicates.near_duplicates(docs, width=5, percent=80)
    return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    return personal_data.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples documents so that the sources come near their target weights."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text and the text decoded from them, as counts and digests."""
    return sentencepiece_bpe.encode_digests(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

#: Learned profiles and the encoding have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
