"""Operator 1: mixing sources to target weights by capped water-filling.

All sources together give as many words as they hold.  A source's target is its
share by weight, at most ``epochs`` times its size; what a clamped source
cannot take is shared by weight among the others until none is above its cap.
The sources clamped are those with the smallest cap per weight, so one ordered
pass over the sources finds them.  A target is met by whole repetitions of
the source and a seeded part of one more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import WORD, fresh, text_or_empty, written

SEED = "mix-1"
#: Leading hexadecimal digits of a document's place in the seeded order that make its bucket.
BUCKET_DIGITS = 3


def words(c: str = "text") -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(WORD)).cast("long")


def repeating_weights(source: str, weights: tuple[int, ...]) -> Column:
    """Weights by the order of the source names (code points, null last), repeating."""
    at = (F.row_number().over(Window.orderBy(F.asc_nulls_last(source))) - 1) % len(weights)
    return F.array([F.lit(w) for w in weights])[at.cast("int")]


def water_fill(sources: DataFrame, epochs: int) -> DataFrame:
    """``source, source_size, weight`` with ``target`` (double): the capped shares of all words.

    Works on one row per source.  Weights are positive; sources of size 0 get 0.
    """
    cap = epochs * F.col("source_size")
    order = Window.orderBy((cap / F.col("weight")), F.asc_nulls_last("source"))
    up = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    total = F.sum("source_size").over(every)
    # what is left for this source and all after it, if those before are clamped
    left = total - (F.sum(cap).over(up) - cap)
    weight_left = F.sum("weight").over(every) - (F.sum("weight").over(up) - F.col("weight"))
    s = sources.select("*", cap.alias("_cap"), left.alias("_left"), weight_left.alias("_weight"))
    clamped = F.col("_cap") * F.col("_weight") <= F.col("_left") * F.col("weight")
    # those after the last clamped one share what is left there
    level = F.struct("_left", "_weight")
    open_ = F.min_by(level, F.struct((F.col("_cap") / F.col("weight")), F.col("source").isNull(), F.col("source"))).over(Window.partitionBy("_clamped"))
    return (s.withColumn("_clamped", clamped).withColumn("_open", open_)
            .withColumn("target", F.when(F.col("_clamped"), F.col("_cap").cast("double"))
                        .otherwise((F.col("weight") * F.col("_open._left")).cast("double") / F.col("_open._weight")))
            .select("source", "source_size", "weight", "target"))


def planned(docs: DataFrame, weights: tuple[int, ...], epochs: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, buckets)``: every row's size and place in the seeded order, and every bucket's share of its source's plan.

    A bucket holds the documents whose places begin alike; before: words of the
    source's earlier buckets; whole: full repetitions of the source; part: words wanted of one more.
    """
    rows = written(docs.select("doc_id", "source", words().alias("size"), place(seed).alias("place"))
                   .withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS)), "mix")
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    sources = buckets.groupBy("source").agg(F.sum("n").alias("source_size"))
    targets = water_fill(sources.withColumn("weight", repeating_weights("source", weights)), epochs)
    want = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(want / F.greatest("source_size", F.lit(1)))).otherwise(0)
    targets = targets.select("*", whole.alias("whole"), (want - whole * F.col("source_size")).alias("part"))
    up = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (buckets.withColumn("before", F.sum("n").over(up) - F.col("n")).alias("b")
               .join(targets.alias("t"), F.expr("b.source <=> t.source"))
               .select(F.col("b.source").alias("source"), "bucket", "n", "before", "source_size", "target", "whole", "part"))
    return rows, buckets


def place(seed: str) -> Column:
    """A document's place in the seeded order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _ends() -> Column:
    """The bucket in which the part ends: only there the order of the documents counts."""
    return (F.col("before") < F.col("part")) & (F.col("before") + F.col("n") > F.col("part"))


def _left() -> Column:
    """Words of the part that the documents before leave, in a bucket where it ends."""
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.col("part") - F.col("before") - (F.sum("size").over(inside) - F.col("size"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every row.

    size: words of the text (null: 0); taken: words the mix takes of the
    document, repeats counted; copies: repetitions that take it whole.  Each
    source gives its target rounded to words: whole repetitions, and of one
    more the documents that come first in the order of an MD5 hash of seed and
    id, the last of them in part.  A null source is a source of its own;
    repeated rows are documents of their own; an empty table gives no rows.
    Ties in the order go by id, then size.
    """
    rows, buckets = planned(docs, weights, epochs, seed)
    rows = (rows.alias("r").join(buckets.alias("b"), F.expr("r.source <=> b.source and r.bucket = b.bucket"))
            .select("doc_id", F.col("r.source").alias("source"), "r.bucket", "place", "size", "n", "before", "source_size", "target", "whole", "part"))
    split = rows.where(_ends()).withColumn("extra", F.least(F.greatest(_left(), F.lit(0)), F.col("size")))
    rest = rows.where(~_ends()).withColumn("extra", F.when(F.col("before") < F.col("part"), F.col("size")).otherwise(0))
    once_more = ((F.col("extra") == F.col("size")) & (F.col("size") > 0)).cast("long")
    return split.unionByName(rest).select(
        "doc_id", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
        (F.col("whole") + once_more).cast("long").alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: str = SEED) -> DataFrame:
    """The mix itself: ``docs`` with every row as often as the mix takes it, no document in part.

    As ``mix``, but the document in which a source's part ends is taken whole if
    at least half of it is wanted, else not.  What a source takes is then all
    documents up to a place in the seeded order, so each row is decided by
    one row of its source and the texts are not shuffled.  Repeated rows share
    their place and are taken alike.
    """
    rows, buckets = planned(docs, weights, epochs, seed)
    b = buckets.where(_ends())  # at most one bucket of each source
    split = (rows.alias("r").join(b.alias("b"), F.expr("r.source <=> b.source and r.bucket = b.bucket"))
             .select("doc_id", F.col("r.source").alias("source"), "r.bucket", "place", "size", "before", "part").withColumn("left", _left()))
    last = split.where((F.col("left") > 0) & (2 * F.col("left") >= F.col("size"))).groupBy("source").agg(F.max("place").alias("last"))
    # before the first bucket that is not taken whole, every place is smaller than the bucket's own name
    plan = buckets.groupBy("source").agg(F.first("whole").alias("whole"), F.min(F.when(F.col("before") + F.col("n") > F.col("part"), F.col("bucket"))).alias("open"))
    plan = written(plan.alias("p").join(last.alias("l"), F.expr("p.source <=> l.source"), "left")
                   .select(F.col("p.source").alias("__source"), "whole", F.coalesce("last", "open", F.lit("")).alias("last")), "mix-plan")
    # the plan's columns by names that the documents do not have
    source, whole, last = (fresh(docs, f"mix_{c}") for c in ("source", "whole", "last"))
    plan = plan.toDF(source, whole, last)
    times = F.col(whole) + (place(seed) <= F.col(last)).cast("long")
    return (docs.join(plan, docs["source"].eqNullSafe(F.col(source)))
            .withColumn(fresh(docs, "mix_time"), F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*[docs[c] for c in docs.columns]))
