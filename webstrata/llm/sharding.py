"""Sharding by fixed virtual slots and a versioned map from slots to shards, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..sources.scratch import fresh_dir, materialize

#: Slots that records are hashed into, whatever the number of shards. Never changed for a data set.
SLOTS = 4096
#: Parts of a slot that are numbered separately, so that a slot of very many rows is no single task's work.
LANES = 16

MAP = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("slot", T.IntegerType()), T.StructField("shard", T.IntegerType())])


def slot_of(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS)).cast("int")


def first_map(spark: SparkSession, shards: int) -> DataFrame:
    """Version 0: slots dealt in turn."""
    return spark.range(SLOTS).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("slot"), (F.col("id") % shards).cast("int").alias("shard")
    )


def rebalanced(current: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, edited for the slots' measured ``bytes`` (``slot``, ``bytes``) and ``shards`` shards.

    Slots, largest first, stay where they are while their shard has room below the mean; the others are moved, again
    largest first, each to the shard with the least so far. A map has ``SLOTS`` rows, so one row holds its arrays."""
    sized = current.join(loads, "slot", "left").select("version", "slot", "shard", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("minus"), "slot", "shard")))
    packed = sized.agg((F.max("version") + 1).alias("version"), F.sum("bytes").alias("total"), order.alias("slots"))
    # Sums of whole bytes; decided with integers, so that every run gives the same map.
    staying = packed.selectExpr(
        "version", "slots",
        f"""aggregate(slots,
            struct(array_repeat(0L, {shards}) AS loads, cast(array() AS array<boolean>) AS stays),
            (a, s) -> if(s.shard < {shards} AND (element_at(a.loads, s.shard % {shards} + 1) - s.minus) * {shards} <= total,
                struct(transform(a.loads, (x, i) -> if(i = s.shard, x - s.minus, x)) AS loads, array_append(a.stays, true) AS stays),
                struct(a.loads AS loads, array_append(a.stays, false) AS stays))) AS first""",
    )
    moved = staying.selectExpr(
        "version",
        """transform(slots, (s, i) -> named_struct('minus', s.minus, 'slot', s.slot, 'shard',
            if(first.stays[i], s.shard, cast(null AS int)))) AS slots""",
        "first.loads AS loads",
    )
    placed = moved.selectExpr(
        "version", "slots",
        """aggregate(slots, struct(loads AS loads, cast(array() AS array<int>) AS shards),
            (a, s) -> if(s.shard IS NOT NULL,
                struct(a.loads AS loads, array_append(a.shards, s.shard) AS shards),
                struct(transform(a.loads, (x, i) -> if(i = array_position(a.loads, array_min(a.loads)) - 1, x - s.minus, x)) AS loads,
                    array_append(a.shards, int(array_position(a.loads, array_min(a.loads)) - 1)) AS shards))).shards AS shards""",
    )
    return placed.select("version", F.explode(F.arrays_zip("slots", "shards")).alias("s")).select(
        "version", F.col("s.slots.slot").alias("slot"), F.col("s.shards").alias("shard")
    )


def store_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to a stored map; earlier versions stay as they are."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(path).where(F.col("version") == version)


def shard_documents(docs: DataFrame, shards: int, map_path: str | None = None) -> DataFrame:
    """Every document's shard (0 to ``shards`` - 1) and place in it, with shards of near equal bytes.

    ``doc_id``, ``size`` (UTF-8 bytes of the text and 1; a null text has none), ``text_crc32``, ``virtual_slot``,
    ``shard``, and ``place``, gapless from 0 in each shard. Records are hashed into slots by id, size and checksum; the
    bytes of the slots are summed, and version 1 of the map, written below ``map_path``, is version 0 edited for them.

    Texts are read once and never shuffled; narrow rows are written, summed with partial aggregation, and matched with
    tables of at most ``SLOTS`` x ``LANES`` rows, which are small enough to broadcast whatever the data. A slot's rows
    are numbered in ``LANES`` parts by where they were read, so repeated rows of one id spread too. Null ids and
    repeated rows are records like others; an empty table gives an empty result and a map all the same."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.spark_partition_id() + F.xxhash64("doc_id"), F.lit(LANES)).cast("int").alias("lane"),
    )
    rows = materialize(rows.withColumn("virtual_slot", slot_of(F.col("doc_id"), F.col("size"), F.col("text_crc32"))), "records")
    sums = rows.groupBy("virtual_slot", "lane").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    sums = materialize(sums, "slots")
    path = map_path or fresh_dir(spark, "slot-map")
    store_map(first_map(spark, shards), path)
    loads = sums.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("bytes").alias("bytes"))
    store_map(rebalanced(load_map(spark, path, 0), loads, shards), path)
    current = load_map(spark, path, 1).select(F.col("slot").alias("virtual_slot"), "shard")
    before = Window.partitionBy("shard").orderBy("virtual_slot", "lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.join(F.broadcast(current), "virtual_slot").select(
        "virtual_slot", "lane", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("virtual_slot", "lane").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("number", F.row_number().over(within) - 1)
    placed = numbered.join(F.broadcast(starts), ["virtual_slot", "lane"])  # at most SLOTS x LANES rows
    return placed.select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("start") + F.col("number")).cast("long").alias("place")
    )
