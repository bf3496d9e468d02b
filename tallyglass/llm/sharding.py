"""Sharding by jump consistent hashing: stable keys, no ring table, few moves when a shard is added.

Edge cases: a null text counts as empty; null keys share one shard; equal keys
always meet in one shard, in an order given by size and checksum; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Multiplier of the generator in the published method (Lamping and Veach, 2014), in 16-bit parts, lowest first.
MULTIPLIER = 2862933555777941757
PARTS = [(MULTIPLIER >> (16 * i)) & 0xFFFF for i in range(4)]


def jump_shard(key: Column, shards: int) -> Column:
    """The shard 0..shards-1 of a 64-bit key.

    The generator multiplies modulo 2**64; since Spark's long arithmetic stops
    at an overflow, the state is kept in four 16-bit parts.  The candidate shard
    only ever grows, so ``shards`` steps suffice; later ones do nothing.
    """
    part = lambda i: F.shiftrightunsigned(key, 16 * i).bitwiseAND(F.lit(0xFFFF))
    zero = F.struct(*[part(i).alias(f"k{i}") for i in range(4)], F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(a: Column, _: Column) -> Column:
        k = [a[f"k{i}"] for i in range(4)]
        carry, new = F.lit(1).cast("long"), []
        for i in range(4):
            s = carry
            for x in range(i + 1):
                s = s + k[x] * F.lit(PARTS[i - x]).cast("long")
            new.append(s.bitwiseAND(F.lit(0xFFFF)))
            carry = F.shiftright(s, 16)
        top = new[3] * 32768 + F.shiftright(new[2], 1)
        leap = F.floor((a["j"] + 1) * (F.lit(2147483648.0) / (top + 1).cast("double"))).cast("long")
        moved = F.struct(*[x.alias(f"k{i}") for i, x in enumerate(new)], a["j"].alias("b"), leap.alias("j"))
        return F.when(a["j"] < shards, moved).otherwise(a)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), zero, step, lambda a: a["b"]).cast("int")


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id", rows_a_block: int = 100_000) -> DataFrame:
    """key, size, text_crc32, shard, slot, grown_shard for each row.

    Slots are gapless from 0 in each shard.  A shard is numbered in blocks dealt
    by a hash of key and text, never in one task: rows inside each block, then
    blocks shifted by the counts of the blocks before them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32")
    )
    hashed = F.xxhash64("_key")
    blocks = max(64, -(-docs.count() // (shards * rows_a_block)))
    placed = rows.select(
        "*", jump_shard(hashed, shards).alias("shard"), jump_shard(hashed, shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64("_key", "text_crc32", "size", F.lit("block")), F.lit(blocks)).cast("int").alias("_block"),
    )
    inside = Window.partitionBy("shard", "_block").orderBy("_key", "size", "text_crc32")
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_block").count().select("shard", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    numbered = placed.withColumn("_i", F.row_number().over(inside) - 1).join(starts, ["shard", "_block"])
    return numbered.select(F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("_i") + F.col("_start")).cast("long").alias("slot"), "grown_shard")
