"""Operator 3: token counts by an exact length histogram.

Documents are aggregated by encoded length; suffix sums over the lengths then
give totals, quantiles and truncated totals for every context limit without
reading a text again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, text_or_empty, written

#: Lengths of one block of the two-level suffix sums.
BLOCK = 1024
OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_lengths(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens`` of every row (null text: 0); the strings of special tokens count as ordinary text.

    ``path`` names a rank file on every executor.  Repeated rows stay.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)

        def rows():
            for b in batches:
                for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    yield doc_id, len(enc.encode_ordinary(text))
        yield from batches_of(rows(), OUT)

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """``length, n_docs``: how many documents have each length (null lengths take no part)."""
    return (lengths.where("n_tokens is not null").groupBy(F.col("n_tokens").alias("length"))
            .agg(F.count(F.lit(1)).alias("n_docs")))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram with what every limit needs, by a suffix sum within blocks of lengths and one over the blocks.

    Per length L: n_tokens of its documents, docs_from and tokens_from of those
    with L tokens or more, truncated_tokens if texts are cut to L tokens, and
    share, the part of all documents with at most L tokens.  An empty table
    gives no rows.
    """
    h = hist.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
                    F.floor(F.col("length") / BLOCK).alias("block"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    down = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.select(
        "block", (F.sum("d").over(down) - F.col("d")).alias("docs_above"), (F.sum("t").over(down) - F.col("t")).alias("tokens_above"),
        F.sum("d").over(Window.partitionBy()).alias("docs"), F.sum("t").over(Window.partitionBy()).alias("tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.select("*", F.sum("n_docs").over(inside).alias("d"), F.sum("n_tokens").over(inside).alias("t"))
    docs_from, tokens_from = F.col("d") + F.col("docs_above"), F.col("t") + F.col("tokens_above")
    return h.join(blocks, "block").select(
        "length", "n_docs", "n_tokens", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"),
        (F.col("tokens") - tokens_from + F.col("length") * docs_from).alias("truncated_tokens"),
        ((F.col("docs") - docs_from + F.col("n_docs")) / F.col("docs")).alias("share"))


def total_tokens(sums: DataFrame) -> int:
    return sums.agg(F.max("tokens_from")).first()[0] or 0


def quantile(sums: DataFrame, q: float) -> int | None:
    """The smallest length that a share ``q`` of the documents does not exceed; None without documents."""
    return sums.where(F.col("share") >= q).agg(F.min("length")).first()[0]


def truncated_total(sums: DataFrame, limit: int) -> int:
    """All tokens if texts are cut to ``limit`` tokens, whether or not a document has this length."""
    r = sums.where(F.col("length") >= limit).orderBy("length").select("docs_from", "tokens_from").first()
    whole = total_tokens(sums)
    return whole if r is None else whole - r["tokens_from"] + limit * r["docs_from"]


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The suffix sums of a documents table; the histogram is written once, as several sums read it."""
    return suffix_sums(written(histogram(token_lengths(docs, path, pattern)), "token-histogram"))
