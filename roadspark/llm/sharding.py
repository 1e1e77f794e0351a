"""Sharding by fixed virtual slots.

Every record hashes into one of a fixed number of slots. The bytes of each slot
are summed, and a stored, versioned map says which shard owns a slot. Balancing
and growing edit the map; a record never changes its slot.

Null text counts as no bytes (size 1), null ids hash like any value, repeated
rows share a slot but keep positions of their own, an empty table gives an
empty result, and columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadspark.runtime import new_path, written

# Thousands of slots, whatever the size of the table: the map stays this small.
SLOTS = 4096


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every record."""
    text = F.coalesce(F.col("text"), F.lit(""))
    records = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return records.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def balanced_map(totals: dict[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """Shard of every slot: heaviest slot first, always to the lightest shard."""
    load = [(0, s) for s in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-totals.get(s, 0), s)):
        weight, shard = heapq.heappop(load)
        owner[slot] = shard
        heapq.heappush(load, (weight + totals.get(slot, 0), shard))
    return owner


def rebalanced_map(owner: list[int], totals: dict[int, int], shards: int) -> list[int]:
    """Edit a map for ``shards`` shards, moving slots only off shards above their share.

    New shards take slots; slots of shards that are gone are handed out. A slot
    moves only while the receiver stays at or below the even share.
    """
    owner = list(owner)
    load = [0] * shards
    homeless = []
    for slot, shard in enumerate(owner):
        if shard < shards:
            load[shard] += totals.get(slot, 0)
        else:
            homeless.append(slot)
    share = sum(totals.values()) / shards
    for slot in sorted(homeless, key=lambda s: (-totals.get(s, 0), s)):
        owner[slot] = min(range(shards), key=lambda s: (load[s], s))
        load[owner[slot]] += totals.get(slot, 0)
    for slot in sorted(range(len(owner)), key=lambda s: (-totals.get(s, 0), s)):
        weight, old = totals.get(slot, 0), owner[slot]
        new = min(range(shards), key=lambda s: (load[s], s))
        if load[old] > share and load[new] + weight <= share and load[old] - weight >= load[new]:
            owner[slot], load[old], load[new] = new, load[old] - weight, load[new] + weight
    return owner


def store_map(spark: SparkSession, folder: str, version: int, owner: list[int]) -> None:
    """Add one version of the map; earlier versions stay readable."""
    shard = F.element_at(F.lit(list(owner)), (F.col("id") + 1).cast("int"))
    spark.range(len(owner)).select(F.col("id").cast("int").alias("vslot"), shard.cast("int").alias("shard")).coalesce(
        1
    ).write.parquet(f"{folder}/version={version}")


def stored_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int").parquet(f"{folder}/version={version}")


def assigned(records: DataFrame, totals: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard of every record and its position there, gapless from 0.

    Records are numbered within their slot, slots within their shard, so no
    task holds a whole shard. The map has one row per slot and is broadcast.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        slot_map.join(totals, "vslot", "left")
        .withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .select("vslot", "shard", "first")
    )
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return records.withColumn("place", F.row_number().over(inside) - 1).join(F.broadcast(places), "vslot").select(
        "doc_id", "size", "text_crc32", "vslot", "shard", (F.col("first") + F.col("place")).alias("slot")
    )


def shard(docs: DataFrame, shards: int, folder: str | None = None) -> DataFrame:
    """All records with shard, position and map version; the map is stored as version 0 of ``folder``."""
    spark = docs.sparkSession
    records = written(slotted(docs), "slots")
    totals = slot_totals(records)
    weights = {row["vslot"]: row["bytes"] for row in totals.collect()}  # at most SLOTS rows
    folder = folder or new_path(spark, "slot-map")
    store_map(spark, folder, 0, balanced_map(weights, shards))
    return assigned(records, totals, stored_map(spark, folder, 0)).withColumn("map_version", F.lit(0))


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), 8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", "map_version",
    )
