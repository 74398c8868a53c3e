"""Operator 6: near-duplicates by bottom-k sketches from one hash function.

A document's set is its distinct word shingles, as 64-bit hashes.  The k
smallest hashes of a set are its sketch.  Documents with equal sets form a class
and its representative goes on alone.  Inverted lists of the retained values
give candidates, the sketch of the union estimates their similarity, and the
exact Jaccard similarity of the full sets decides.

No list is turned into all its pairs:

* Two sets that reach the threshold share at least ``need`` retained values (up
  to a chance below 1e-7, see ``sketch_need``), so a list is entered only for
  the rarest values of a sketch, all but ``need - 1``.  Values of common lines
  and passages are entered only where a sketch has little else.
* Each list is first compared with its most central member only (the one with the
  most values that others have too), which joins copies of a text to it.  That is
  done ``rounds`` times, each with the members the ones before did not join.
* What is left are lists whose members lie in different components.  Their
  documents are joined on full sets, by the rarest shingles of a set that
  must hold one of any partner's, with bounds on sizes and on the places of
  the shared shingle as join conditions.  This is exact, so nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, fresh, rows_of, written

#: Retained values of a sketch.
K = 40
FEATURES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("sketch", pa.list_(pa.int64()))])
SETS = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("hashes", pa.list_(pa.int64()))])


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of ``width`` words.

    Words are split at ASCII white space and A-Z lower-cased; fewer words than
    ``width`` make one shingle, no words none.
    """
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, np.int64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], np.uint64).view(np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):  # each word's hash is mixed with its place, so order counts
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= h[i:i + len(out)]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out.view(np.int64))


def features(docs: DataFrame, width: int, k: int = K) -> DataFrame:
    """``doc_id, n, digest, sketch`` of every row: set size, digest of the set (null if empty), the k smallest hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                s = shingles(text, width)
                digest = hashlib.md5(s.tobytes()).hexdigest() if len(s) else None
                yield doc_id, len(s), digest, s[:k].tolist()
        yield from batches_of(rows(), FEATURES, 2048)

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, digest string, sketch array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``rep, n, hashes`` of rows with ``doc_id`` and ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                s = shingles(text, width)
                yield doc_id, len(s), s.tolist()
        yield from batches_of(rows(), SETS, 256)

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "rep long, n long, hashes array<long>")


def sketch_need(size: Column) -> Column:
    """Retained values that two sketches share at least if their sets reach a similarity of 0.8 or more.

    Each of the k smallest hashes of the union is in both sketches with the chance
    J.  For k = 40 and J = 0.85 fewer than half of them are shared with a chance
    of 3e-8.  Smaller sets are their own sketch and share more.
    """
    return F.greatest(F.floor(size / 2), F.lit(1))


def close_sizes(a: str, b: str, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def lists(reps: DataFrame) -> DataFrame:
    """Inverted lists ``v, rep, n, shared``: of each sketch the rarest values that another one has too.

    shared: how many of the sketch's values others have, which tells how central it is.
    """
    values = reps.select("rep", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
    often = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = values.join(often, "v").groupBy("rep", "n", "k").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"))
    # the values that no other sketch has are the rarest and come first
    left = F.col("k") - sketch_need(F.col("k")) + 1 - (F.col("k") - F.size("vs"))
    return (common.where(left > 0).select("rep", "n", F.size("vs").alias("shared"), F.explode(F.slice("vs", F.lit(1), left.cast("int"))).alias("x"))
            .select("x.v", "rep", "n", "shared"))


def star_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """``a, b``: every member of a list with its most central one, if sizes allow the similarity.

    ``entries`` has v, rep, n, shared and the member's component ``comp``; pairs within a component are left out.
    """
    hub = entries.groupBy("v").agg(F.max(F.struct("shared", -F.col("rep"), "n", "comp")).alias("h"))
    hub = hub.select("v", (-F.col("h.col2")).alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.comp").alias("hub_comp"))
    return (entries.join(hub, "v").where((F.col("comp") != F.col("hub_comp")) & close_sizes("n", "hub_n", percent))
            .select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct())


def likely(pairs: DataFrame, reps: DataFrame, percent: int, k: int = K) -> DataFrame:
    """The pairs whose union's sketch does not rule the similarity out.

    The estimate is the share of the union's k smallest hashes that both sketches
    have; half of them is below the threshold by more than five deviations.
    """
    sketch = reps.select("rep", "sketch")
    both = (pairs.join(sketch.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sketch.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return both.where(2 * shared >= F.size(union)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity: 100 times the intersection, ``percent`` times the union."""
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb")), "b"))
    both = both.withColumn("i", F.size(F.array_intersect("ha", "hb")))
    return both.where(100 * F.col("i") >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``rep, comp`` of all linked representatives: the smallest one reachable.

    Each step takes the smallest label among the neighbours and then the label of
    that label, and is written; the number of steps grows with the logarithm
    of the longest path, not with the data.
    """
    both = written(links.select(F.col("a").alias("rep"), F.col("b").alias("to"))
                   .union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy("rep").agg(F.least(F.col("rep"), F.min("to")).alias("comp")), "labels")
    while True:
        near = (both.join(labels.select(F.col("rep").alias("to"), "comp"), "to").groupBy("rep").agg(F.min("comp").alias("near")))
        step = labels.join(near, "rep").select("rep", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("rep").alias("comp"), F.col("comp").alias("further"))
        new = written(step.join(jump, "comp", "left").select("rep", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp")), "labels")
        if new.where("old != comp").isEmpty():
            return new.select("rep", "comp")
        labels = new.select("rep", "comp")


def labelled(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """List entries with their component, the member itself where it has none."""
    if labels is None:
        return entries.withColumn("comp", F.col("rep"))
    return entries.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


def divided(entries: DataFrame) -> DataFrame:
    """The entries of lists whose members lie in more than one component."""
    mixed = entries.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("v")
    return entries.join(mixed, "v")


def rare_shingle_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of different components that may reach the similarity, from ``rep, n, hashes, comp``; exact.

    Shingles are ordered by how many of these sets have them.  Sets that share
    enough share one of the first ``n - ceil(percent * n) + 1``, and at the
    first one they share, enough must be left on both sides.
    """
    one = sets.select("rep", "n", "comp", F.explode("hashes").alias("h"))
    often = one.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = one.join(often, "h").groupBy("rep", "n", "comp").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("hs"))
    alone = F.col("n") - F.size("hs")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    left = (prefix - alone).cast("int")
    p = written(common.where(left > 0).select("rep", "n", "comp", alone.alias("alone"), F.posexplode(F.slice("hs", F.lit(1), left)).alias("at", "x"))
                .select(F.col("x.h").alias("h"), "rep", "n", "comp", (F.col("alone") + F.col("at")).alias("place")), "rare-shingles")
    a = p.select("h", *[F.col(c).alias(f"{c}_a") for c in ("rep", "n", "comp", "place")])
    b = p.select("h", *[F.col(c).alias(f"{c}_b") for c in ("rep", "n", "comp", "place")])
    least = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    on = ((a["h"] == b["h"]) & (F.col("rep_a") < F.col("rep_b")) & (F.col("comp_a") != F.col("comp_b"))
          & close_sizes("n_a", "n_b", percent) & (rest >= least))
    return a.join(b, on).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = K, rounds: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Rows are linked if ``100 * |intersection| >= percent * |union|`` of their
    sets; component_id is the smallest id reachable, kept tells whether it is
    the row's own.  A null or blank text has no shingles and no links.  A row with
    a null id has no links, a null component, and is kept.  Repeated rows stay;
    rows with equal ids count as one document.  Only ``doc_id`` and ``text`` are
    read.  An empty table gives no rows.
    """
    feats = written(features(docs, width, k), "features")
    linked = feats.where("n > 0 and doc_id is not null")
    classes = written(linked.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    entries = written(lists(classes.select("rep", "n", "sketch")), "lists")
    ids = entries.select(F.col("rep").alias("doc_id")).distinct()
    sets = written(full_sets(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), width), "sets")
    links, labels = None, None
    left = labelled(entries, None)
    for r in range(rounds):
        found = confirmed(likely(star_pairs(left, percent), classes, percent, k), sets, percent)
        links = written(found if links is None else found.union(links), "star-links")
        labels = components(links)
        left = written(divided(labelled(entries, labels)), "divided")
        if r + 1 < rounds:  # the members that the most central one has joined are done with
            hub = left.groupBy("v").agg(F.max(F.struct("shared", -F.col("rep"), "comp")).alias("h")).select("v", F.col("h.comp").alias("done"))
            left = left.join(hub, "v").where("comp != done").drop("done")
    rest = sets.join(left.select("rep", "comp").distinct(), "rep")
    found = confirmed(rare_shingle_pairs(rest, percent), sets, percent)
    labels = components(written(found.union(links), "all-links"))
    comp = (classes.select("digest", "rep").join(labels, "rep", "left")
            .select("digest", F.coalesce("comp", "rep").alias("comp")))
    return (feats.select("doc_id", "n", "digest").join(comp, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but for one row of each group of near copies: that with
    the smallest id (null last), then the smallest hash of the text, then the first.

    Groups are of rows, not of ids: of repeated rows one stays, copies without an
    id are copies all the same, and of two texts under one id each is judged by
    itself.  Texts without words are copies of nothing.  Rows are numbered in a
    written copy, so every step sees the same numbers.
    """
    row = fresh(docs, "dedup_row")
    copy = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(copy.select(F.col(row).alias("doc_id"), "text"), width, percent)
    groups = written(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("comp")), "groups")
    several = groups.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("comp")
    order = copy.select(F.col(row).alias("row"), F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash"),
                                                          F.col(row).alias("row")).alias("key"))
    members = written(groups.join(several, "comp").join(order, "row"), "copies")
    first = members.groupBy("comp").agg(F.min("key").alias("first"))
    dropped = members.join(first, "comp").where(F.col("key.row") != F.col("first.row")).select(F.col("row").alias(row))
    return copy.join(dropped, row, "left_anti").select(*[copy[c] for c in docs.columns])
