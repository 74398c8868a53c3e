"""Operator 11: source divergence audit by pair tasks that merge sparse arrays.

How far do the sources of a language differ in their words?  Every (lang,
source) group keeps a sparse array of (term id, count), sorted by id.  A pair
task co-groups the arrays of two groups: a galloping intersection finds the
terms both hold; these, those of one side only and those that neither holds
are priced by integer arithmetic, once for both ways, as the price is symmetric.

Arrays are cut into blocks of term ids by a hash of the term, so a task holds
two blocks of bounded length whatever the vocabulary; terms in neither block
all cost the same and are counted, not listed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, rows_of, written

#: Prices are parts of this; counts of a group stay below 2**63 / THOUSAND (9 * 10**15 words).
SCALE, THOUSAND = 10**9, 1000
#: Added to a count, and per kept term to a group's total.
PRIOR = 2
#: Terms of one block of a sparse array, about.
BLOCK = 1 << 12
#: Distinct (group, term) entries a task holds before it sends them on, and bytes of a text counted at a time.
HELD, CHUNK = 400_000, 1 << 20
#: Everything but letters becomes a blank, A-Z become a-z, bytes above ASCII stay.
_LETTERS = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, a bounded piece of it at a time; pieces end between terms."""
    start = 0
    while start < len(text):
        end = start + CHUNK
        piece = text[start:end].translate(_LETTERS)
        while end < len(text) and piece[-1] != 0x20:  # on to the end of the term
            more = text[end:end + 256].translate(_LETTERS)
            blank = more.find(b" ")
            piece += more[:blank + 1] if blank >= 0 else more
            end += blank + 1 if blank >= 0 else len(more)
        yield piece.split()
        start = end


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of (lang, source, term): occurrences and documents."""
    def rows():
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for lang, source, text in rows_of(batches, "lang", "source", "text"):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(n), set()
            for terms in term_lists(text):
                n.update(terms)
                own.update(terms)
            docs.update(own)
            size += len(n) - before
            if size > HELD:
                yield from sent(held)
                held, size = {}, 0
        yield from sent(held)

    def sent(held):
        for (lang, source), (n, docs) in held.items():
            for term, k in n.items():
                yield lang, source, term.decode(), k, docs[term]

    yield from batches_of(rows(), COUNTS, 8192)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: partial sums, several rows for a term; null text, lang and source are ''."""
    bounded_batches(docs.sparkSession)
    d = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    return d.mapInArrow(_count_batches, "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, least_docs: int) -> DataFrame:
    """``lang, source, term, n, lang_n, first`` of the terms in at least ``least_docs`` documents of their language.

    One shuffle: the sums of a term's sources and over them are taken in the
    same partition of (lang, term).  first marks one row of each (lang, term).
    """
    dealt = term_counts(docs).repartition("lang", "term")
    sums = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    every = Window.partitionBy("lang", "term")
    return (sums.withColumns({"lang_docs": F.sum("docs").over(every), "lang_n": F.sum("n").over(every),
                              "first": F.row_number().over(every.orderBy("source")) == 1})
            .where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", "first"))


def scaled(count: Column, total: Column) -> Column:
    """floor(SCALE * count / total) for 0 <= count <= total, three digits at a time, so that nothing overflows."""
    out, rest = F.call_function("div", count, total), count % total
    for _ in range(3):
        out, rest = out * THOUSAND + F.call_function("div", rest * THOUSAND, total), (rest * THOUSAND) % total
    return out


def price(count: Column, total: Column) -> Column:
    """A term's smoothed share of a group in parts of SCALE; ``total`` holds PRIOR for every kept term."""
    return scaled(count + PRIOR, total) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def prices(count: np.ndarray, total: int) -> np.ndarray:
    """:func:`price` of many counts."""
    out, rest = np.divmod(count.astype(np.int64) + PRIOR, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * THOUSAND, total)
        out = out * THOUSAND + digit
    return out + 1


def gallop(few: np.ndarray, many: np.ndarray, stride: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Where the sorted ids of ``few`` stand in it and in ``many``: for each stride of ``few``, doubling steps find the stretch of ``many`` that covers it."""
    mine, theirs = [], []
    at = 0
    for k in range(0, len(few), stride):
        part = few[k:k + stride]
        step = stride
        while at + step < len(many) and many[at + step - 1] < part[-1]:
            step *= 2
        stretch = many[at:at + step]
        place = np.searchsorted(stretch, part)
        found = np.flatnonzero(stretch[np.minimum(place, len(stretch) - 1)] == part) if len(stretch) else place[:0]
        mine.append(found + k)
        theirs.append(place[found] + at)
        at += int(place[-1])  # all before is smaller than what follows in few
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *mine]), np.concatenate([empty, *theirs])


def merged(ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, total_a: int, total_b: int) -> tuple[int, int]:
    """Distance summed over the terms of either side, and how many these are."""
    if len(ids_a) > len(ids_b):
        ids_a, n_a, ids_b, n_b, total_a, total_b = ids_b, n_b, ids_a, n_a, total_b, total_a
    at_a, at_b = gallop(ids_a, ids_b)

    def summed(x: np.ndarray, y: np.ndarray) -> int:
        p, q = prices(x, total_a), prices(y, total_b)
        return int(((p - q) * (p - q) // (p + q)).sum())

    zero = np.zeros(1, np.int64)
    both = summed(n_a[at_a], n_b[at_b])
    only_a, only_b = np.delete(n_a, at_a), np.delete(n_b, at_b)
    one_sided = (summed(only_a, zero) if len(only_a) else 0) + (summed(zero, only_b) if len(only_b) else 0)
    return both + one_sided, len(ids_a) + len(ids_b) - len(at_a)


PAIRED = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64()), ("terms", pa.int64())])


def _pair_task(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block of two groups; a group without a term in it has no row."""
    def array(t: pa.Table, name: str) -> np.ndarray:
        return t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False) if t.num_rows else np.zeros(0, np.int64)

    key = (left if left.num_rows else right).select(["lang", "a", "b", "total_a", "total_b"]).to_pylist()[0]
    value, terms = merged(array(left, "ids"), array(left, "counts"), array(right, "ids"), array(right, "counts"), key["total_a"], key["total_b"])
    return pa.Table.from_pylist([{"lang": key["lang"], "a": key["a"], "b": key["b"], "value": value, "terms": terms}], PAIRED)


def sparse_arrays(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """``lang, source, block, ids, counts``: each group's terms by id, blocks of about BLOCK terms."""
    n_blocks = F.ceil(F.col("v") / BLOCK)
    inside = Window.partitionBy("lang", "block").orderBy("term")
    ids = (kept.where("first").select("lang", "term").join(langs.select("lang", "v"), "lang")
           .select("lang", "term", F.pmod(F.xxhash64("term"), n_blocks).cast("int").alias("block"))
           .withColumn("id", F.row_number().over(inside)))
    return (kept.select("lang", "source", "term", "n").join(ids, ["lang", "term"])
            .groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("x"))
            .select("lang", "source", "block", F.col("x.id").alias("ids"), F.col("x.n").alias("counts")))


def pair_values(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of every two groups of a language, a before b."""
    g = groups.select("lang", "source", "total")
    pairs = (g.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"))
             .join(g.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b")), "lang").where("a < b"))
    arrays = written(sparse_arrays(kept, langs), "divergence-arrays")
    key = ["lang", "a", "b", "block"]

    def side(name: str) -> DataFrame:
        return arrays.withColumnRenamed("source", name).join(pairs, ["lang", name]).select(
            *[F.col(c).alias(c) for c in (*key, "total_a", "total_b", "ids", "counts")])  # attributes of its own for each side

    done = (side("a").groupBy(*key).cogroup(side("b").groupBy(*key))
            .applyInArrow(_pair_task, "lang string, a string, b string, value long, terms long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))
    none = distance(price(F.lit(0), F.col("total_a")), price(F.lit(0), F.col("total_b")))
    absent = F.col("v") - F.coalesce("terms", F.lit(0))
    return (pairs.join(langs.select("lang", "v"), "lang").join(done, ["lang", "a", "b"], "left")
            .select("lang", "a", "b", F.when(F.col("v") > 0, F.coalesce("value", F.lit(0)) + absent * none).otherwise(0).cast("long").alias("value")))


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs from the others of its language and from the language.

    part ``pair``: item is another source of the language, value the distance
    summed over all kept terms; part ``term``: item is one of the ``top`` kept
    terms that the source uses more than its language, by distance.  Ranks go
    by value, then by the bytes of the item.

    Null text, lang and source are ''; every row is a document, repeated ones
    too; a group without terms has no counts and is compared all the same; a
    language with one source has no pairs; a language without kept terms has
    pairs of value 0; an empty table gives no rows.  Only ``text``, ``lang``
    and ``source`` are read.
    """
    kept = written(kept_counts(docs, least_docs), "divergence-kept")
    seen = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    once = F.when(F.col("first"), F.col("lang_n"))
    sums = kept.groupBy("lang").agg(F.count(once).alias("v"), F.sum(once).alias("lang_words"))
    langs = written(seen.select("lang").distinct().join(sums, "lang", "left")
                    .select("lang", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("lang_words", F.lit(0)) + PRIOR * F.coalesce("v", F.lit(0))).alias("lang_total")),
                    "divergence-langs")
    words = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    groups = written(seen.join(words, ["lang", "source"], "left").join(langs, "lang")
                     .select("lang", "source", (F.coalesce("words", F.lit(0)) + PRIOR * F.col("v")).alias("total"), "lang_total"), "divergence-groups")
    both_ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = (pair_values(kept, groups, langs).select("lang", both_ways.alias("x"), "value")
             .select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(order)))
    priced = (kept.join(groups, ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), price(F.col("n"), F.col("total")).alias("p"), price(F.col("lang_n"), F.col("lang_total")).alias("q"))
              .where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", distance(F.col("p"), F.col("q")).alias("value")))
    terms = priced.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
