"""Operator 9: sharding by fixed virtual slots.

Records hash into thousands of slots, which never change; a small versioned
map says which shard holds each slot.  Bytes are summed by slot, and a
rebalancing edits the map, so records move by whole slots only.  The maps
have one row for each slot, so the driver may hold them; records stay in
DataFrames.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.common import text_or_empty, written
from hirelake.session import ensure_checkpoint_dir

SLOTS = 4096
MAP = "slot int, shard int"


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``: UTF-8 bytes plus 1, checksum, and the slot by a hash of the id.

    A null text has size 1 and checksum 0; rows without an id are spread by size and checksum.
    """
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("size", "text_crc32")).otherwise(F.xxhash64("doc_id"))
    return (docs.select("doc_id", (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
                        F.crc32(text_or_empty()).alias("text_crc32"))
            .withColumn("virtual_slot", F.pmod(key, F.lit(slots)).cast("int")))


def slot_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(slots: int, shards: int) -> list[int]:
    """The shard of each slot before anything is known of the data."""
    return [s % shards for s in range(slots)]


def rebalanced(current: list[int], load: list[int], shards: int) -> list[int]:
    """The map edited until the shards' bytes are near equal, from one entry for each slot.

    Shards above the mean give up their smallest slots that bring them down to
    it; these go, largest first, to the shard with the least bytes.  Then single
    slots move or are exchanged between the fullest and the emptiest shard
    as long as that brings the two closer.
    """
    shard_of = list(current)
    total = [0] * shards
    mine: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        total[shard] += load[slot]
        mine[shard].append(slot)
    mean = sum(load) / shards
    loose = []
    for shard in range(shards):
        for slot in sorted(mine[shard], key=lambda s: (load[s], s)):
            if total[shard] <= mean:
                break
            if load[slot]:
                total[shard] -= load[slot]
                loose.append(slot)
    heap = [(total[k], k) for k in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(loose, key=lambda s: (-load[s], s)):
        t, k = heapq.heappop(heap)
        shard_of[slot] = k
        heapq.heappush(heap, (t + load[slot], k))
    total = [0] * shards
    mine = [[] for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        total[shard] += load[slot]
        if load[slot]:
            mine[shard].append(slot)
    for _ in range(4 * shards):
        high, low = max(range(shards), key=lambda k: (total[k], k)), min(range(shards), key=lambda k: (total[k], k))
        gap = total[high] - total[low]
        # a slot of the fullest against none or one of the emptiest, the difference nearest to half the gap
        others = sorted([(0, -1), *((load[s], s) for s in mine[low])])
        best = (gap, None, None)
        at = 0
        for size, slot in sorted((load[s], s) for s in mine[high]):
            while at + 1 < len(others) and size - others[at + 1][0] >= gap / 2:
                at += 1
            for other in others[at:at + 2]:
                left = abs(gap - 2 * (size - other[0]))
                if left < best[0]:
                    best = (left, slot, other[1])
        if best[1] is None:
            break
        for slot, to in ((best[1], low), (best[2], high)):
            if slot >= 0:
                mine[shard_of[slot]].remove(slot)
                total[shard_of[slot]] -= load[slot]
                shard_of[slot] = to
                mine[to].append(slot)
                total[to] += load[slot]
    return shard_of


def grown(current: list[int], load: list[int], shards: int) -> list[int]:
    """The map with one more shard, which takes slots from the others and gives none.

    Every old shard gives the new one slots, largest first, that fit into what it holds above the new mean.
    """
    shard_of = list(current)
    total = [0] * shards
    for slot, shard in enumerate(shard_of):
        total[shard] += load[slot]
    mean = sum(load) / (shards + 1)
    for slot in sorted(range(len(load)), key=lambda s: (-load[s], s)):
        if load[slot] and total[shard_of[slot]] - load[slot] >= mean:
            total[shard_of[slot]] -= load[slot]
            shard_of[slot] = shards
    return shard_of


def write_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """One version of the map; a version that exists is never overwritten."""
    (spark.createDataFrame(list(enumerate(shard_of)), MAP).coalesce(1)
     .write.mode("error").parquet(f"{path}/version={version}"))


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{path}/version={version}")


def assigned(rows: DataFrame, totals: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Every record's shard, and its place in the shard, gapless from 0.

    Records are numbered within their slot, in order of id, and a slot's first
    place is the number of records in the slots before it of the same shard.
    The map and the totals have one row for each slot, so they are broadcast.
    """
    up = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (slot_map.join(totals.withColumnRenamed("virtual_slot", "slot"), "slot")
              .select(F.col("slot").alias("virtual_slot"), "shard", (F.sum("rows").over(up) - F.col("rows")).alias("first")))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("nth", F.row_number().over(inside) - 1).join(F.broadcast(placed), "virtual_slot")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth")).cast("long").alias("slot"), "virtual_slot"))


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot`` of every row.

    Version 1 of the map deals the slots round, version 2 is edited until bytes
    are near equal; both are kept under ``map_path`` (default: a new folder
    under the checkpoint folder).  The law is ``bytes``; ``grown_shard`` is null.
    Repeated rows each get a place; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = written(slotted(docs, slots), "slotted")
    totals = written(slot_totals(rows), "slot-totals")
    load = [0] * slots
    for r in totals.collect():  # at most one row for each slot
        load[r["virtual_slot"]] = r["bytes"]
    path = map_path or f"{ensure_checkpoint_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    start = first_map(slots, shards)
    write_map(spark, path, 1, start)
    write_map(spark, path, 2, rebalanced(start, load, shards))
    return assigned(rows, totals, read_map(spark, path, 2)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """The records as files, one folder for each shard; ``placed`` comes from ``shard`` and ids are unique."""
    docs.join(placed.select("doc_id", "shard"), "doc_id").write.partitionBy("shard").parquet(path)
