"""Operator 2: document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last bytes of the UTF-8 text sets chunk boundaries; each
chunk gives one signature character.  A fingerprint ``b:one:two`` holds the
signatures at block sizes b and 2b; two fingerprints are compared by the edit
distance of signatures made with the same block size.  Equal texts have equal
fingerprints, and an edit changes the signature only near the edit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, rows_of, text_or_empty, written

#: Signature characters, one for each value of a chunk's six hash bits.
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Bytes of the rolling window, smallest block size, signature length a block size aims at.
WINDOW, LEAST_BLOCK, LENGTH = 7, 2, 64
_ROLL = np.uint64(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2**64
_BACK = np.uint64(pow(int(_ROLL), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, 0 to n."""
    if len(_powers[0]) <= n:
        size = 1 << n.bit_length()
        for k, x in enumerate((_ROLL, _BACK)):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def fingerprint(text: str) -> str:
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    n = len(data)
    if not n:
        return f"{LEAST_BLOCK}::"
    up, down = _power(n + 1)
    # sums[j] - sums[i] is the polynomial hash of bytes i..j-1, up to a power of the multiplier
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    roll = sums[1:].copy()
    full = max(0, n - WINDOW)  # positions with a whole window before them
    roll[WINDOW:] -= sums[1:full + 1]
    roll[WINDOW:] *= down[1:full + 1]
    roll = _mixed(roll)
    block = LEAST_BLOCK
    while block * LENGTH < n:
        block *= 2
    one = _signature(sums, roll, down, block)
    while block > LEAST_BLOCK and len(one) < LENGTH // 2:
        block //= 2
        one = _signature(sums, roll, down, block)
    return f"{block}:{one}:{_signature(sums, roll, down, 2 * block)}"


def _signature(sums: np.ndarray, roll: np.ndarray, down: np.ndarray, block: int) -> str:
    """One character for each chunk; a chunk ends where the rolling hash is 0 modulo the block size."""
    n = len(roll)
    end = np.flatnonzero((roll & np.uint64(block - 1)) == 0) + 1
    if not len(end) or end[-1] != n:
        end = np.append(end, n)
    start = np.concatenate(([0], end[:-1]))
    chunk = _mixed((sums[end] - sums[start]) * down[start])
    return ALPHABET[(chunk >> np.uint64(58)).astype(np.intp)].tobytes().decode()


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and substitutions, a column of the table as bits of integers."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    plus, minus, distance = full, 0, len(a)
    for c in b:
        eq = at.get(c, 0)
        diag = (((eq & plus) + plus) ^ plus) | eq | minus
        rise = minus | (full & ~(diag | plus))
        fall = plus & diag
        if rise & last:
            distance += 1
        elif fall & last:
            distance -= 1
        rise = (rise << 1 | 1) & full
        fall = (fall << 1) & full
        plus = fall | (full & ~(diag | rise))
        minus = rise & diag
    return distance


def likeness(x: str, y: str) -> float:
    """0 to 1: one minus the edit distance over the longer signature, the best of the block sizes both have."""
    if x == y:
        return 1.0
    best = 0.0
    (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
    mine = {int(bx): x1, 2 * int(bx): x2}
    for block, sig in ((int(by), y1), (2 * int(by), y2)):
        other = mine.get(block)
        if other and sig:
            best = max(best, 1 - edit_distance(other, sig) / max(len(other), len(sig)))
    return best


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


PAIR = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
ENDS = pa.schema([*OUT, ("part", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_()), ("text", pa.string())])


def compared(doc_id: int | None, text: str, own: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following)
    new = own if changed == text else fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8")).hexdigest(), own, new,
            likeness(own, new), likeness(own, next_print))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition against the next row; its first and last one also with their text."""
    def rows():
        part = TaskContext.get().partitionId()
        held, first = None, True
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            own = fingerprint(text)
            if held:
                yield (*compared(*held, text, own), part, first, False, held[1] if first else None)
                first = False
            held = (doc_id, text, own)
        if held:  # what follows it is in another partition
            yield (held[0], None, None, held[2], None, None, None, part, first, True, held[1])

    yield from batches_of(rows(), ENDS, 512)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (compared(*r) for r in rows_of(batches, "doc_id", "text", "fingerprint", "next_text", "next_print"))
    yield from batches_of(rows, OUT, 512)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and the likeness to it and to the next row's.

    The next document is the one with the next smaller id (after the last: the
    first); rows with the same id follow each other by a hash of the text, a
    null id comes last.  A null text is empty: no chunks, an empty signature,
    like 1 to another empty one and 0 to any other.  A single row is its own
    next.  An empty table gives no rows.

    Texts move once, into ranges of the id; neighbours are compared within a
    range, and the last row of each range with the first of the next one from
    the written result, which holds those two texts of every range.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    d = docs.select("doc_id", text_or_empty().alias("text"))
    tie = F.xxhash64("text")
    sorted_ = (d.withColumn("_tie", tie).repartitionByRange(F.desc_nulls_last("doc_id"), F.col("_tie"))
               .sortWithinPartitions(F.desc_nulls_last("doc_id"), F.col("_tie")).select("doc_id", "text"))
    done = written(sorted_.mapInArrow(_neighbours, PAIR + ", part int, first boolean, last boolean, text string"), "fingerprints")
    # one row per range: whose first row follows whose last one
    parts = done.where("first").select("part")
    order = Window.orderBy("part")
    follows = parts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("next_part"))
    head = done.where("first").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    ends = (done.where("last").select("part", "doc_id", "text", "fingerprint").join(follows, "part").join(head, "next_part")
            .select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(_across, PAIR))
    return done.where("not last").select(*OUT.names).unionByName(ends)
