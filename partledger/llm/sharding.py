"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partledger.llm.common import new_folder

#: Virtual slots; fixed for the life of a data set, so every map has this many rows at most.
SLOTS = 8192
#: Bytes that a record takes besides its text.
OVERHEAD = 16
MAP_SCHEMA = "virtual_slot int, shard int, slot_bytes long, slot_rows long"


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: a hash of its id and text, NULLs included."""
    return F.pmod(F.xxhash64(F.lit(11), doc_id, text), F.lit(slots)).cast("int")


def slot_loads(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``virtual_slot, slot_bytes, slot_rows`` of the slots that have records."""
    return (
        docs.select(
            virtual_slot(F.col(id_col), F.col(text_col), slots).alias("virtual_slot"),
            record_size(F.col(text_col)).alias("size"),
        )
        .groupBy("virtual_slot")
        .agg(F.sum("size").alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows"))
    )


def rebalance(owner: dict[int, int], loads: dict[int, int], shards: int) -> dict[int, int]:
    """A new owner for as few slots as it takes to level the shards' bytes.

    Slots of shards that no longer exist, or without an owner, go to the lightest shard,
    largest first. Then slots move from the heaviest to the lightest shard, each time the one
    nearest to half the gap, until no move narrows the gap. At most SLOTS entries: the
    driver's work does not grow with the data.
    """
    new = {s: o for s, o in owner.items() if 0 <= o < shards and s in loads}
    weight = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in new.items():
        weight[shard] += loads[slot]
        held[shard].append((loads[slot], slot))
    for slots in held:
        slots.sort()
    light = [(w, k) for k, w in enumerate(weight)]
    heapq.heapify(light)
    for slot in sorted(loads.keys() - new.keys(), key=lambda s: (-loads[s], s)):
        w, shard = heapq.heappop(light)
        new[slot] = shard
        weight[shard] = w + loads[slot]
        insort(held[shard], (loads[slot], slot))
        heapq.heappush(light, (weight[shard], shard))
    for _ in range(20 * len(loads)):
        top = max(range(shards), key=lambda k: (weight[k], -k))
        low = min(range(shards), key=lambda k: (weight[k], k))
        gap = weight[top] - weight[low]
        at = bisect_right(held[top], (gap // 2, SLOTS))
        near = [x for x in held[top][max(0, at - 1) : at + 1] if 0 < x[0] < gap]
        if not near:
            break
        best = min(near, key=lambda x: (abs(gap - 2 * x[0]), x[1]))
        held[top].remove(best)
        insort(held[low], best)
        new[best[1]] = low
        weight[top] -= best[0]
        weight[low] += best[0]
    return new


def next_map(
    spark: SparkSession,
    loads: DataFrame,
    shards: int,
    folder: str,
    version: int,
    before: DataFrame | None = None,
    slots: int = SLOTS,
) -> DataFrame:
    """Writes version ``version`` of the slot-to-shard map below ``folder`` and reads it back.

    The map owns every slot, also those that hold nothing yet, so records that come later have
    a shard. ``before`` is the map in force; without one, slots are first owned in turn. As
    many rows as there are slots are collected, a bound that holds at any data size.
    """
    rows = loads.collect()
    size = dict.fromkeys(range(slots), 0) | {r["virtual_slot"]: r["slot_bytes"] for r in rows}
    count = dict.fromkeys(range(slots), 0) | {r["virtual_slot"]: r["slot_rows"] for r in rows}
    if before is None:
        owner = {s: s % shards for s in size}
    else:
        owner = {r["virtual_slot"]: r["shard"] for r in before.select("virtual_slot", "shard").collect()}
    new = rebalance(owner, size, shards)
    path = f"{folder}/version={version}"
    data = [(s, new[s], size[s], count[s]) for s in sorted(new)]
    spark.createDataFrame(data, MAP_SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.schema(MAP_SCHEMA).parquet(path)


def assign_shards(
    docs: DataFrame, slot_map: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``shard`` and ``virtual_slot``, taken from a map of SLOTS rows.

    Every slot has an owner, so no record is lost whenever it came; NULL and repeated ids and
    texts have a slot like any other.

    The map is bounded, hence broadcast; rows do not move. Columns of the same names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("shard", "virtual_slot")]
    # The row travels as a struct, so that its columns may have any names.
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        virtual_slot(F.col(id_col), F.col(text_col), slots).alias("slot"),
    )
    small = slot_map.select(F.col("virtual_slot").alias("slot"), "shard")
    return rows.join(F.broadcast(small), "slot").select(
        *[F.col("row")[c].alias(c) for c in kept], "shard", F.col("slot").alias("virtual_slot")
    )


def shard_documents(
    docs: DataFrame, shards: int = 40, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, shard, slot`` of every row.

    Records are hashed into virtual slots; the slots' bytes, not the records, are levelled
    over the shards. ``slot`` is the record's place in its shard, gapless from 0: the slots
    of a shard follow one another by number, and records in a slot by id, checksum and size.

    NULL and empty texts have 16 bytes and checksum 0; a NULL id is a value like any other;
    equal rows get places of their own. Other columns are ignored. No rows, no shards.
    """
    spark = docs.sparkSession
    loads = slot_loads(docs, slots, id_col, text_col)
    slot_map = next_map(spark, loads, shards, new_folder(spark, "slot-map"), 1, slots=slots)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select(
        F.col("virtual_slot").alias("_slot"),
        F.col("shard").alias("_shard"),
        F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("_start"),
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        record_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        virtual_slot(F.col(id_col), F.col(text_col), slots).alias("virtual_slot"),
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    placed = rows.withColumn("_place", F.row_number().over(inside) - 1)
    return placed.join(F.broadcast(starts), F.col("virtual_slot") == F.col("_slot")).select(
        "doc_id",
        "size",
        "text_crc32",
        "virtual_slot",
        F.col("_shard").alias("shard"),
        (F.col("_start") + F.col("_place")).cast("long").alias("slot"),
    )
