"""Operator 7: shards by jump consistent hashing, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import numbered

# Fixed values of the published jump hash: multiplier of its 64-bit linear congruential generator.
MULTIPLIER = 2862933555777941757
WORD_SIZE = 2**64


def jump_chain(key: Column, shards: int) -> Column:
    """The jump hash of a 64-bit key as struct(shard, next): its shard among ``shards``, and the
    smallest number of the shard it moves to when more are appended.

    A key stays in ``shard`` for every count up to ``next``; with ``next + 1`` shards it moves into
    shard ``next``. No table of shards is needed. The generator works modulo 2^64, which decimals
    hold without overflow.
    """
    whole = lambda x: x.cast("decimal(38,0)")
    start = F.struct(
        whole(F.when(key < 0, whole(key) + whole(F.lit(str(WORD_SIZE)))).otherwise(whole(key))).alias("seed"),
        F.lit(-1).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("next"),
    )

    def step(at: Column, _: Column) -> Column:
        seed = whole((at["seed"] * F.lit(str(MULTIPLIER)).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")) % F.lit(str(WORD_SIZE)).cast("decimal(20,0)"))
        # The upper 31 bits: 2^33 divides 2^64, so the double below is that of the published code.
        high = F.floor(seed.cast("decimal(20,0)") / F.lit(str(2**33)).cast("decimal(11,0)")).cast("double")
        jump = F.floor((at["next"] + 1).cast("double") * (F.lit(float(2**31)) / (high + 1.0))).cast("long")
        moved = F.struct(seed.alias("seed"), at["next"].alias("shard"), jump.alias("next"))
        return F.when(at["next"] < shards, moved).otherwise(at)

    # Every step raises ``next`` by one at least.
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)


def shard_documents(docs: DataFrame, shards: int, buckets: int = 4096) -> DataFrame:
    """Put each document into one of ``shards``; one row per row of ``docs``.

    Columns: doc_id, size (UTF-8 bytes and 1), text_crc32, law (`key`), shard, slot (from 0 without
    gaps within the shard), grown_shard (with one shard more). The shard depends on doc_id and the
    count only, and the only rows that move when one is appended move into it. A NULL text has size
    1 and checksum 0; a NULL doc_id is a key like others; rows that repeat get slots of their own.
    ``shards * buckets`` rows are broadcast to number the slots. Other columns are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        # A mixed key: neighbouring ids are not neighbours for the generator.
        jump_chain(F.xxhash64(F.col("doc_id").cast("long")), shards).alias("_jump"),
    )
    placed = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("_jump.shard").cast("int").alias("shard"),
        F.when(F.col("_jump.next") == shards, shards).otherwise(F.col("_jump.shard")).cast("int").alias("grown_shard"),
    )
    slots = numbered(placed, ["shard"], ["doc_id", "text_crc32", "size"], buckets, "slot")
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
