"""Sharding through fixed virtual slots.

Records are hashed into a fixed number of virtual slots; bytes and rows are
aggregated per slot, and a versioned slot-to-shard map is stored as a table.
Version 1 spreads the slots evenly; ``rebalance`` edits single entries of the
latest map (moving one slot at a time from the fullest to the emptiest shard)
and stores the result as the next version.  Only slot totals, at most
``N_SLOTS`` rows, ever reach the driver.

Defined results: a null text counts 0 bytes plus 1 and has the checksum of
the empty text; records are hashed by id and text, so rows with null or
repeated ids still spread; rows equal in id and text are numbered and hashed
with their number, so any amount of them spreads over all slots; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portmart.llm.common import materialize, text_of
from portmart.session import scratch_path

N_SLOTS = 4096
MAP_SCHEMA = "virtual_slot int, shard int"
# Copies of a record that one row stands for until they are dealt to the tasks.
COPY_BLOCK = 4096


def assign_slots(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of every record.

    Records equal in these columns cannot be told apart, so they are counted
    (on the map side first) and written out again as numbered copies: no task
    holds all copies of a record, and which slots they get does not depend on
    where they were read.  Copies are dealt to the tasks in blocks.
    """
    t = text_of("text")
    counted = (
        docs.select("doc_id", (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    last = F.col("n") - 1
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPY_BLOCK))))
    first = F.col("block") * COPY_BLOCK
    copies = (
        blocks.repartition("doc_id", "text_crc32", "block")
        .withColumn("copy", F.explode(F.sequence(first, F.least(first + (COPY_BLOCK - 1), last))))
    )
    return copies.select(
        "doc_id",
        "size",
        "text_crc32",
        F.pmod(F.xxhash64("doc_id", "text_crc32", "copy"), F.lit(n_slots)).cast("int").alias("virtual_slot"),
    )


def slot_totals(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of every used slot (never more entries than slots)."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    return {r["virtual_slot"]: (r["b"], r["n"]) for r in rows.collect()}


def initial_map(n_shards: int, n_slots: int = N_SLOTS) -> dict[int, int]:
    return {slot: slot % n_shards for slot in range(n_slots)}


def rebalance(slot_map: dict[int, int], load: dict[int, int], n_shards: int) -> dict[int, int]:
    """Edit ``slot_map`` so that the shards' bytes are near equal.

    Each edit moves the slot that best halves the gap between the fullest and
    the emptiest shard; it stops when no single move narrows that gap.
    """
    out = dict(slot_map)
    members: list[set[int]] = [set() for _ in range(n_shards)]
    totals = [0] * n_shards
    for slot, shard in out.items():
        if load.get(slot, 0):
            members[shard].add(slot)
            totals[shard] += load[slot]
    while True:
        high = max(range(n_shards), key=lambda s: (totals[s], -s))
        low = min(range(n_shards), key=lambda s: (totals[s], s))
        gap = totals[high] - totals[low]
        fits = [s for s in members[high] if load[s] < gap]
        if not fits:
            return out
        slot = min(fits, key=lambda s: (abs(2 * load[s] - gap), s))
        members[high].remove(slot)
        members[low].add(slot)
        totals[high] -= load[slot]
        totals[low] += load[slot]
        out[slot] = low


def store_map(spark: SparkSession, path: str, version: int, slot_map: dict[int, int]) -> None:
    """Write one version of the map; older versions stay beside it."""
    rows = spark.createDataFrame(sorted(slot_map.items()), MAP_SCHEMA)
    rows.coalesce(1).write.parquet(os.path.join(path, f"version={version}"))


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(os.path.join(path, f"version={version}"))


def shard(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Place every record; ``slot`` numbers the records of a shard from 0."""
    spark = docs.sparkSession
    map_path = map_path or scratch_path(spark, "slot-map")
    records = materialize(assign_slots(docs, n_slots), "shard-records")
    totals = slot_totals(records)
    slot_map = initial_map(n_shards, n_slots)
    store_map(spark, map_path, 1, slot_map)
    slot_map = rebalance(slot_map, {k: v[0] for k, v in totals.items()}, n_shards)
    store_map(spark, map_path, 2, slot_map)

    # First position of each virtual slot inside its shard.
    starts, filled = [], [0] * n_shards
    for slot, to in sorted(slot_map.items()):
        starts.append((slot, filled[to]))
        filled[to] += totals.get(slot, (0, 0))[1]
    placed = load_map(spark, map_path, 2).join(
        F.broadcast(spark.createDataFrame(starts, "virtual_slot int, start long")), "virtual_slot"
    )
    # The map has n_slots rows of fixed width, which bounds the broadcast.
    in_slot = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        records.withColumn("in_slot", in_slot)
        .join(F.broadcast(placed), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("in_slot") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(2).alias("map_version"),
        )
    )
