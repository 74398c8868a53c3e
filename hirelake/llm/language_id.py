"""Operator 4: language identification by rank-order profiles.

A language's profile is its most frequent n-grams (1 to 3 letters, words
padded with a blank) in rank order, counted over all training texts.  A text's
own ranking is compared with each profile by the out-of-place distance: the sum
of rank differences, with the largest possible one for n-grams the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches

UNKNOWN = "und"
#: Ranks kept of each profile.  At most so many languages, whose profiles go to every task.
RANKS, MOST_LANGUAGES = 400, 2000
#: Distinct n-grams a task holds before it hands its counts on, and characters it counts at a time.
HELD, COUNTED = 2_000_000, 400_000
_TWO, _ONE = np.int64(0x110001) << 42, np.int64(0x110002) << 42

OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """The n-grams of a text as integers (three 21-bit code points), repeats included; 0 is the blank."""
    code = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    code = np.where(_letters()[code], code, 0).astype(np.int64)
    code = np.concatenate(([0], code, [0]))
    code = code[(code != 0) | np.append(True, code[:-1] != 0)]
    if len(code) < 2:
        return code[:0]
    if code[-1]:
        code = np.append(code, 0)
    two = code[:-1] << 21 | code[1:]
    three = (code[:-2] << 42 | two[1:])[code[1:-1] != 0]
    return np.concatenate((_ONE | code[code != 0], _TWO | two, three))


def ranked(found: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams in rank order, ties by value."""
    gram, n = np.unique(found, return_counts=True)
    if len(gram) > ranks:
        least = np.partition(n, len(n) - ranks)[len(n) - ranks]
        gram, n = gram[n >= least], n[n >= least]
    return gram[np.argsort(-n, kind="stable")][:ranks]


def _merge(held: dict, lang: str, gram: np.ndarray, n: np.ndarray) -> None:
    if lang in held:
        gram, n = np.concatenate((held[lang][0], gram)), np.concatenate((held[lang][1], n))
        order = np.argsort(gram, kind="stable")
        gram, n = gram[order], n[order]
        start = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        gram, n = gram[start], np.add.reduceat(n, start)
    held[lang] = (gram, n)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def give():
        for lang, (gram, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], schema=COUNTS)
        held.clear()

    def count(lang: str, texts: list[str]) -> None:
        # a word ends at a text's end, so texts may be counted joined
        gram, n = np.unique(grams("\n".join(texts)), return_counts=True)
        if len(gram):
            _merge(held, lang, gram, n.astype(np.int64))

    for b in batches:
        texts: dict[str, list[str]] = {}
        chars: dict[str, int] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            texts.setdefault(lang, []).append(text)
            chars[lang] = chars.get(lang, 0) + len(text)
            if chars[lang] >= COUNTED:
                count(lang, texts.pop(lang))
                chars[lang] = 0
        for lang, ts in texts.items():
            count(lang, ts)
        if sum(len(g) for g, _ in held.values()) > HELD:
            yield from give()
    yield from give()


def profiles(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """``lang, rank, gram``: the ``ranks`` most frequent n-grams of each non-null ``lang`` over all texts."""
    bounded_batches(docs.sparkSession)
    counts = (docs.select("text", "lang").where("text is not null and lang is not null")
              .mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= ranks).select("lang", "rank", "gram")


def collected(profile: DataFrame) -> list[tuple[str, np.ndarray]]:
    """The profiles by language, for every task: at most ``MOST_LANGUAGES`` times ``RANKS`` rows."""
    n = profile.select("lang").distinct().count()
    if n > MOST_LANGUAGES:
        raise ValueError(f"{n} languages; their profiles are sent to every task, {MOST_LANGUAGES} at most")
    by: dict[str, list[tuple[int, int]]] = {}
    for r in profile.collect():
        by.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return [(lang, np.array([g for _, g in sorted(rows)], np.int64)) for lang, rows in sorted(by.items())]


def distances(text: str | None, known: list[tuple[np.ndarray, np.ndarray]], ranks: int) -> np.ndarray | None:
    """Out-of-place distance to each profile, as a share of the largest possible; None without letters."""
    own = ranked(grams(text), ranks) if text else np.empty(0, np.int64)
    if not len(own):
        return None
    out = np.empty(len(known))
    place = np.arange(len(own))
    for k, (gram, rank) in enumerate(known):
        at = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
        out[k] = np.where(gram[at] == own, np.minimum(np.abs(rank[at] - place), ranks), ranks).sum()
    return out / (ranks * len(own))


def predict(docs: DataFrame, learned: list[tuple[str, np.ndarray]], ranks: int = RANKS) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; only ``doc_id`` and ``text`` are read.

    The language of the nearest profile, ties to the smaller name; score is one
    minus the distance as a share of the largest.  ``und`` and 0 for a text that
    is null or without letters, and for all texts if nothing was learned.
    Repeated rows stay, an empty table gives no rows.
    """
    langs = [lang for lang, _ in learned]
    known = [(g[order := np.argsort(g)], order) for _, g in learned]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    d = distances(text, known, ranks) if known else None
                    if d is None:
                        yield doc_id, UNKNOWN, 0.0
                    else:
                        k = int(np.argmin(d))
                        yield doc_id, langs[k], float(1 - d[k])
        yield from batches_of(rows(), OUT)

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame, learned: list[tuple[str, np.ndarray]], least: float = 0.2, ranks: int = RANKS) -> DataFrame:
    """The rows of ``docs`` whose language is known, all columns as they are.

    Rejected are texts that are null or have no letters, and those as far from
    every profile as letters in no language's order (a score below ``least``).
    Rows are dropped where they are read; nothing is shuffled.
    """
    known = [(g[order := np.argsort(g)], order) for _, g in learned]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = [distances(t, known, ranks) if known else None for t in b.column("text").to_pylist()]
            yield b.filter(pa.array([x is not None and 1 - x.min() >= least for x in d], pa.bool_()))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """One document in five, by its id; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, ranks: int = RANKS) -> list[tuple[str, np.ndarray]]:
    """Profiles from the text and non-null lang of the rows whose id is not null and not held out."""
    return collected(profiles(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0), ranks))


def identify(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """Predictions for all rows from profiles of the rows that are not held out."""
    return predict(docs, learn(docs, ranks), ranks).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
