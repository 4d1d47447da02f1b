"""Sharding by fixed virtual slots, with DataFrame functions only.

Records are hashed into a fixed number of virtual slots (thousands, whatever the data), bytes are summed per slot, and a
slot-to-shard map is stored in versions: the first deals slots out in turn, a rebalance edits it so that shards hold
nearly equal bytes, and growing by one shard moves slots only into the new shard.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catchment.session import shared_dir

#: Virtual slots. Fixed for the life of a data set; the map of all of them is what is ever broadcast.
SLOTS = 16384
#: Bytes a record takes beside its text.
OVERHEAD = 16


def virtual_slot(doc_id: Column, text_crc32: Column, slots: int = SLOTS) -> Column:
    """The slot of a record. The checksum spreads records without an id; equal records share a slot."""
    return F.pmod(F.xxhash64(doc_id, text_crc32), F.lit(slots)).cast("int")


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and vslot of each row: all that placing needs, without the text.

    A null text has no bytes and the checksum of no bytes; a null doc_id is a record like any other.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("vslot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots))


def slot_loads(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every virtual slot, empty slots too: exactly `slots` rows, summed before any shuffle."""
    loads = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(loads, "vslot", "left").na.fill(0, ["bytes", "rows"])


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt out in turn."""
    return spark.range(slots).select(F.col("id").cast("int").alias("vslot"), (F.col("id") % shards).cast("int").alias("shard"))


def rebalance(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """Edit a map so that shards hold nearly equal bytes, moving few slots.

    Each shard keeps its largest slots as long as they fit under the mean; what does not fit is dealt out, largest first,
    each to the shard with the least bytes so far. Ties go to the lower number. Both sides have one row per slot.
    """
    joined = slot_map.join(loads, "vslot")
    order = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    target = joined.agg(F.sum("bytes").alias("total")).select((F.col("total") / shards).alias("target"))
    ranked = joined.withColumn("filled", F.sum("bytes").over(order)).join(F.broadcast(target))
    kept = ranked.withColumn("kept", F.col("filled") <= F.col("target"))
    # One row: the loads of all shards and the slots to deal out, both no longer than the map.
    state = kept.groupBy("shard").agg(F.sum(F.when(F.col("kept"), F.col("bytes")).otherwise(0)).alias("load"))
    state = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(state, "shard", "left")
    state = state.na.fill(0, ["load"]).agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "load"))), lambda x: x["load"]).alias("shard_loads"))
    moved = kept.where(~F.col("kept")).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("least"), F.col("vslot")))).alias("pool")
    )

    def place(acc: Column, slot: Column) -> Column:
        to = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(acc["loads"], lambda load, i: load - F.when(i == to, slot["least"]).otherwise(F.lit(0).cast("long"))).alias("loads"),
            F.concat(acc["moves"], F.array(F.struct(slot["vslot"].alias("vslot"), to.alias("shard")))).alias("moves"),
        )

    start = F.struct(F.col("shard_loads").alias("loads"), F.expr("cast(array() as array<struct<vslot:int,shard:int>>)").alias("moves"))
    dealt = state.join(F.broadcast(moved)).select(F.explode(F.aggregate("pool", start, place)["moves"]).alias("move"))
    moves = dealt.select(F.col("move.vslot").alias("vslot"), F.col("move.shard").alias("to_shard"))
    return slot_map.join(F.broadcast(moves), "vslot", "left").select("vslot", F.coalesce("to_shard", "shard").alias("shard"))


def grow(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """Edit a map for one more shard, numbered `shards`: every shard gives up slots, smallest first, while what it has
    given stays within its part of the new mean; no slot moves between old shards."""
    joined = slot_map.join(loads, "vslot")
    order = Window.partitionBy("shard").orderBy("bytes", "vslot")
    whole = Window.partitionBy("shard")
    given = joined.withColumn("given", F.sum("bytes").over(order)).withColumn("held", F.sum("bytes").over(whole))
    gives = F.col("given") * (shards + 1) <= F.col("held")
    return given.select("vslot", F.when(gives, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"))


class SlotMaps:
    """Versions of a slot map below one folder; a version is written once and never changed."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_dir(spark)}/slot-maps-{uuid.uuid4()}"

    def put(self, slot_map: DataFrame, version: int) -> DataFrame:
        slot_map.coalesce(1).write.parquet(f"{self.folder}/version-{version}")
        return self.get(version)

    def get(self, version: int) -> DataFrame:
        return self.spark.read.schema("vslot int, shard int").parquet(f"{self.folder}/version-{version}")


def place(records: DataFrame, slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """Shard of each record and its gapless place `slot` in the shard, from 0, by virtual slot and then doc_id.

    Places are counted per virtual slot and shifted by what the shard's earlier slots hold, so no task needs a whole
    shard. Both small sides have one row per virtual slot, which bounds the broadcast.
    """
    shift = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(loads, "vslot").select("vslot", "shard", F.coalesce(F.sum("rows").over(shift), F.lit(0)).alias("start"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = records.withColumn("n", F.row_number().over(inside))
    return numbered.join(F.broadcast(starts), "vslot").withColumn("slot", F.col("start") + F.col("n") - 1).drop("start", "n")


def shard(docs: DataFrame, shards: int, slots: int = SLOTS, maps: SlotMaps | None = None) -> DataFrame:
    """Place all rows in `shards` shards of nearly equal bytes. Returns doc_id, size, text_crc32, vslot, shard, slot.

    Empty tables give no rows; repeated rows are placed each on its own; only doc_id and text are read, so extra
    columns cannot clash. Version 0 and the rebalanced version 1 of the map stay in `maps`.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/sized-{uuid.uuid4()}"
    sized(docs, slots).write.parquet(folder)
    records = spark.read.parquet(folder)
    maps = maps or SlotMaps(spark)
    loads_at = f"{folder}-loads"
    slot_loads(records, slots).coalesce(1).write.parquet(loads_at)
    loads = spark.read.parquet(loads_at)
    before = maps.put(first_map(spark, shards, slots), 0)
    return place(records, maps.put(rebalance(before, loads, shards), 1), loads)
