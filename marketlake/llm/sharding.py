"""Operator 6, sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame operations only.

A stable 64-bit key alone decides the shard: a linear congruential sequence seeded by the key gives the shard counts
at which the key would move, and the last one below the wanted count is its shard. There is no ring table, and a grown
count takes 1/n of the keys, each straight into the new shard.

Definite results: a null text has no bytes (size 1, CRC of the empty string); a null key hashes as 0; repeated rows
share a shard and have slots of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.ranks import numbered

# Fixed value: the multiplier of the published algorithm.
JUMP = 2862933555777941757


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (0 to shards - 1) of a long key.

    The key's sequence is kept as an unsigned 64-bit number in a decimal(20): a product of two such numbers fits 38
    digits, so nothing overflows, with ANSI arithmetic on or off."""
    two64, two33, two31 = (F.lit(str(2**n)).cast("decimal(20,0)") for n in (64, 33, 31))
    first = F.coalesce(key.cast("long"), F.lit(0))
    unsigned = F.when(first < 0, first.cast("decimal(20,0)") + two64).otherwise(first.cast("decimal(20,0)"))
    start = F.struct(unsigned.cast("decimal(20,0)").alias("k"), F.lit(0).cast("long").alias("b"),
                     F.lit(0).cast("long").alias("j"))

    def step(state: Column, _: Column) -> Column:
        product = state["k"] * F.lit(str(JUMP)).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        k = (product % two64).cast("decimal(20,0)")
        high = ((k - k % two33) / two33).cast("long") + 1  # an exact quotient: decimal division would round
        j = F.floor((state["j"] + 1) * (F.lit(float(2**31)) / high.cast("double"))).cast("long")
        return F.when(state["j"] >= shards, state).otherwise(F.struct(k.alias("k"), state["j"].alias("b"), j.alias("j")))

    # b grows with every step, so `shards` steps are enough
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text",
          buckets: int = 256) -> DataFrame:
    """One row per document: key, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``law``, ``shard``, ``slot`` (gapless
    within the shard), ``grown_shard`` (with one more shard). Only these numbers are shuffled, never the text."""
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    keys = docs.select(F.col(f"`{key}`").alias("doc_id"), raw.alias("_raw"))
    rows = keys.select("doc_id", (F.octet_length("_raw") + 1).cast("long").alias("size"),
                       F.crc32("_raw").alias("text_crc32"), F.lit("key").alias("law"),
                       jump_hash(F.col("doc_id"), shards).alias("shard"),
                       jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"))
    counted = docs.select(F.col(f"`{key}`").alias("doc_id")).select(
        "doc_id", jump_hash(F.col("doc_id"), shards).alias("shard"))
    out = numbered(rows, "shard", ["doc_id"], ["doc_id", "text_crc32", "size"], "slot", buckets, counted)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
