"""Sharding by fixed virtual slots.

Every record hashes to one of ``N_SLOTS`` slots. Bytes and rows are summed
for each slot in one aggregate; the slot table has ``N_SLOTS`` rows at every
size of the input, so it is edited on the driver and broadcast. A versioned
table maps slots to shards: the first version gives the heaviest slots away
first, each to the shard with the fewest bytes; a later version moves only
the slots that a changed load or shard count asks for.

A record's place in its shard is the number of rows in the shard's earlier
slots plus its rank in its own slot, so no sort spans more than one slot.

A slot that holds a large share of all bytes, as an id of very many rows or
the null id makes it, is split by the hash of the text: its parts are slots of
the map like others, numbered so that the map tells which slots are split.

Defined results: a null text has size 8; a null id is an id; equal rows are
ranked in any order (they cannot be told apart) and share a slot, as records
with the same id do where it is not split.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.session import scratch_path

N_SLOTS = 8192
N_SHARDS = 24

MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long, rows long, rows_before long"


def virtual_slot(key: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


#: A slot is heavy from this part of a shard's share on (so at most
#: ``HEAVY * n_shards`` slots are), and is then split in ``SUB_SLOTS``.
HEAVY = 4
SUB_SLOTS = 64


def heavy_slots(loads: list[tuple[int, int, int]], n_shards: int) -> list[int]:
    """Slots of several rows with a large share of all bytes, as one id that
    very many rows carry makes them."""
    total = sum(size for _, size, _ in loads)
    return sorted(slot for slot, size, rows in loads if rows > 1 and size * HEAVY * n_shards > total)


def split_slot(key: Column, text: Column, heavy: list[int], n_slots: int = N_SLOTS) -> Column:
    """The slot of a record; in heavy slots one that the text decides as well.
    Its number tells the slot it is part of, so a map is all that is needed to
    find a record again."""
    slot = virtual_slot(key, n_slots)
    if not heavy:
        return slot
    part = F.pmod(F.xxhash64(text), F.lit(SUB_SLOTS)).cast("int")
    return F.when(slot.isin(heavy), n_slots + slot * SUB_SLOTS + part).otherwise(slot)


def heavy_in(slots, n_slots: int = N_SLOTS) -> list[int]:
    """The heavy slots of a stored map, from the numbers of its slots."""
    return sorted({(s - n_slots) // SUB_SLOTS for s in slots if s >= n_slots})


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def slot_loads(records: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of ``records(virtual_slot, size)``: at most
    ``N_SLOTS`` rows."""
    found = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return sorted((r["virtual_slot"], r["bytes"], r["rows"]) for r in found.collect())


def first_map(loads: list[tuple[int, int, int]], n_shards: int) -> dict[int, int]:
    """Slot -> shard: heaviest slot first, to the shard with the fewest bytes."""
    shards = [(0, shard) for shard in range(n_shards)]
    out = {}
    for slot, size, _ in sorted(loads, key=lambda x: (-x[1], x[0])):
        total, shard = heapq.heappop(shards)
        out[slot] = shard
        heapq.heappush(shards, (total + size, shard))
    return out


def rebalanced(old: dict[int, int], loads: list[tuple[int, int, int]], n_shards: int) -> dict[int, int]:
    """An edited map for changed loads or more shards. Slots that had no shard
    go to the lightest one; then slots move from the heaviest to the lightest
    shard while that narrows the gap. All other slots stay."""
    size = {slot: b for slot, b, _ in loads}
    out = {slot: shard for slot, shard in old.items() if slot in size and shard < n_shards}
    held: dict[int, list[int]] = defaultdict(list)
    total = [0] * n_shards
    for slot, shard in out.items():
        total[shard] += size[slot]
    for slot in sorted(size.keys() - out.keys(), key=lambda s: (-size[s], s)):
        out[slot] = total.index(min(total))
        total[out[slot]] += size[slot]
    for slot, shard in out.items():
        held[shard].append(slot)
    while True:
        high, low = total.index(max(total)), total.index(min(total))
        fit = [s for s in held[high] if 0 < 2 * size[s] <= total[high] - total[low]]
        if not fit:
            return out
        slot = max(fit, key=lambda s: (size[s], -s))
        held[high].remove(slot)
        held[low].append(slot)
        total[high] -= size[slot]
        total[low] += size[slot]
        out[slot] = low


def map_rows(version: int, shard_of: dict[int, int], loads: list[tuple[int, int, int]]) -> list[tuple]:
    """Rows of the map table, with the rows in earlier slots of each shard."""
    before: dict[int, int] = defaultdict(int)
    out = []
    for slot, size, rows in sorted(loads):
        shard = shard_of[slot]
        out.append((version, slot, shard, size, rows, before[shard]))
        before[shard] += rows
    return out


class SlotMap:
    """The versioned map, stored as Parquet (one folder for each version)."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "slot-map")

    def store(self, version: int, shard_of: dict[int, int], loads: list[tuple[int, int, int]]) -> DataFrame:
        rows = self.spark.createDataFrame(map_rows(version, shard_of, loads), MAP_SCHEMA)
        rows.coalesce(1).write.mode("error").parquet(f"{self.path}/v{version}")
        return self.load(version)

    def load(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/v{version}")

    def shards(self, version: int) -> dict[int, int]:
        return {r["virtual_slot"]: r["shard"] for r in self.load(version).select("virtual_slot", "shard").collect()}


def place(records: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """``records(virtual_slot, ...)`` with their shard and their place there,
    gapless from 0. The map has at most ``N_SLOTS`` rows: broadcast."""
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order))
    return records.withColumn("rank_in_slot", rank) \
        .join(F.broadcast(slot_map.select("virtual_slot", "shard", "rows_before")), "virtual_slot") \
        .withColumn("slot", F.col("rows_before") + F.col("rank_in_slot") - 1) \
        .drop("rows_before", "rank_in_slot")


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, slot_map: SlotMap | None = None,
                    version: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard and slot (the place in
    the shard) for all documents. The map is stored as ``version``; from the
    second on it is the version before, edited for the loads of ``docs``."""
    spark = docs.sparkSession
    key, text = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    size = record_size(F.col("text"))
    stored = slot_map or SlotMap(spark)
    before = stored.shards(version - 1) if version > 1 else None
    loads = slot_loads(docs.select(virtual_slot(key).alias("virtual_slot"), size.alias("size")))
    heavy = sorted({*heavy_slots(loads, n_shards), *heavy_in(before or [])})
    slot = split_slot(key, text, heavy)
    if heavy:
        loads = slot_loads(docs.select(slot.alias("virtual_slot"), size.alias("size")))
    shard_of = first_map(loads, n_shards) if before is None else rebalanced(before, loads, n_shards)
    current = stored.store(version, shard_of, loads)
    records = docs.select("doc_id", size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                          slot.alias("virtual_slot"))
    return place(records, current, ["doc_id", "text_crc32", "size"])


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str) -> None:
    """The documents themselves, one folder for each shard; files are written
    by the tasks that read the rows, without a shuffle."""
    heavy = heavy_in(r["virtual_slot"] for r in slot_map.select("virtual_slot").collect())  # bounded by its slots
    slot = split_slot(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")), heavy)
    docs.withColumn("virtual_slot", slot) \
        .join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot") \
        .drop("virtual_slot").write.partitionBy("shard").parquet(path)
