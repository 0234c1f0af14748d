"""Sharding by fixed virtual slots.

A record is hashed to one of thousands of virtual slots, for good. What changes is the map from slots to shards: it
is built from the bytes of each slot, written with a version number, and edited when shards are added, taken away
or have grown apart. Only the slots whose entry changes move.

Defined results: null text has no bytes and CRC 0; every row has at least size 1. Null ids hash like any value.
Rows equal in id and text share a slot. An empty table gives a map of empty slots and no rows. Other columns are
not read, so their names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelens.llm.common import text_of
from storelens.session import path_exists, staged

SLOTS = 4096
# Rows of a slot are numbered in so many independent parts.
LANES = 8


def virtual_slot(*keys: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` per row. The text counts in the hash, so that a repeated id spreads."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_of(text_col)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text_of(text_col), "UTF-8")).alias("text_crc32"),
    )
    return narrow.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots=slots))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes of each slot that has rows; at most as many rows as there are slots."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))


def edited_map(sizes: DataFrame, shards: int, slots: int = SLOTS, before: DataFrame | None = None, slack: float = 0.01) -> DataFrame:
    """A map ``virtual_slot, shard, bytes`` over all ``slots``.

    Slots are dealt from the heaviest to the lightest. A slot stays on the shard that ``before`` gives it while that
    shard exists and holds no more than its equal part plus ``slack``; any other goes to the lightest shard. The
    deal is a fold over an array of ``slots`` entries, a fixed number whatever the data.
    """
    spark = sizes.sparkSession
    known = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot")).join(sizes, "virtual_slot", "left")
    if before is None:
        known = known.withColumn("was", F.lit(None).cast("int"))
    else:
        known = known.join(before.select("virtual_slot", F.col("shard").alias("was")), "virtual_slot", "left")
    # An empty slot weighs one byte in the deal, so that empty slots spread over the shards as well.
    item = F.struct(
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
        (-F.col("virtual_slot")).alias("minus"),
        F.col("was"),
    )
    gathered = known.agg(F.sort_array(F.collect_list(item), asc=False).alias("items"), F.sum("bytes").alias("total"))
    limit = F.coalesce(F.col("total"), F.lit(0)) / shards * (1 + slack)

    def place(state: Column, entry: Column) -> Column:
        loads = state["loads"]
        weight = F.greatest(entry["bytes"], F.lit(1))
        stays = (
            entry["was"].isNotNull()
            & (entry["was"] < shards)
            & (F.coalesce(F.get(loads, entry["was"]), F.lit(0)) + weight <= limit)
        )
        target = F.when(stays, entry["was"]).otherwise((F.array_position(loads, F.array_min(loads)) - 1).cast("int"))
        # A one-element array binds the target, so that it is worked out once per slot.
        return F.transform(
            F.array(target),
            lambda shard: F.struct(
                F.transform(loads, lambda load, i: F.when(i == shard, load + weight).otherwise(load)).alias("loads"),
                F.concat(state["placed"], F.array(shard)).alias("placed"),
            ),
        )[0]

    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), shards).alias("loads"),
        F.array().cast("array<int>").alias("placed"),
    )
    dealt = gathered.select("items", F.aggregate("items", start, place, lambda state: state["placed"]).alias("placed"))
    return dealt.select(F.explode(F.arrays_zip("items", "placed")).alias("e")).select(
        (-F.col("e.items.minus")).alias("virtual_slot"), F.col("e.placed").alias("shard"), F.col("e.items.bytes").alias("bytes")
    )


def store_map(slot_map: DataFrame, folder: str) -> int:
    """Write the map as the next version under ``folder``; earlier versions stay readable."""
    spark = slot_map.sparkSession
    version = latest_version(spark, folder) + 1
    slot_map.coalesce(1).write.parquet(f"{folder}/version={version}")
    return version


def latest_version(spark: SparkSession, folder: str) -> int:
    version = 0
    while path_exists(spark, f"{folder}/version={version + 1}"):
        version += 1
    return version


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    version = version or latest_version(spark, folder)
    return spark.read.parquet(f"{folder}/version={version}").withColumn("version", F.lit(version))


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Rows are numbered within small parts (slot and lane); where a part starts follows from the counts of the parts
    before it, a frame of at most slots x lanes rows. The map has one row per slot: both are broadcast.
    """
    fixed = staged(rows.withColumn("row", F.monotonically_increasing_id()), "slot-records")
    fixed = fixed.withColumn("lane", F.pmod(F.xxhash64("row"), F.lit(LANES)).cast("int"))
    shard_of = F.broadcast(slot_map.select("virtual_slot", "shard"))
    parts = fixed.groupBy("virtual_slot", "lane").agg(F.count(F.lit(1)).alias("rows")).join(shard_of, "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot", "lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("virtual_slot", "lane", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("virtual_slot", "lane").orderBy("doc_id", "row")
    numbered = fixed.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(starts), ["virtual_slot", "lane"]).withColumn("slot", F.col("start") + F.col("place")).drop(
        "lane", "start", "place", "row"
    )


def folder_name(path: str) -> str:
    """A name for the maps of a table folder, told apart by its whole path."""
    return "".join(c if c.isalnum() else "_" for c in path)
