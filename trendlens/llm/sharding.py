"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each shard bids -ln(u)/weight with u a uniform hash of (key, shard); the lowest
bid takes the record. A new shard changes no bid of the others, so it takes
records only into itself, about its share of the weights. Everything is a
column expression: placing a record needs no shuffle.

Slots number a shard's records without gaps: records are dealt into blocks of a
shard by hash, numbered inside the block, and shifted by the counts of the
blocks before; no shard is gathered in one task.

Defined cases: a null doc_id is placed by its text's checksum; a null text has 0
bytes; rows with equal ids go to one shard and get different slots; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import stored

BLOCKS = 64  # blocks of a shard; the table of their counts has shards * BLOCKS rows and is broadcast


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0 to len(weights) - 1) that a key goes to."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")

    def bid(shard: int, weight: float) -> Column:
        u = (F.xxhash64(key, F.lit(shard)).bitwiseAND(F.lit((1 << 53) - 1)) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / F.lit(float(weight))).alias("bid"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[bid(s, w) for s, w in enumerate(weights)]))["shard"]


def record_key(doc_id: Column, checksum: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), checksum.cast("string")))


def place(docs: DataFrame, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of documents (doc_id, text); size is UTF-8 bytes plus 8."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    key = record_key(F.col("doc_id"), F.col("text_crc32"))
    rows = rows.withColumn("shard", rendezvous(key, weights)).withColumn("grown_shard", rendezvous(key, grown) if grown else F.lit(None).cast("int"))
    rows = stored(rows.withColumn("block", F.pmod(F.xxhash64(F.lit("slot"), "doc_id", "text_crc32", "size"), F.lit(BLOCKS))), "shard-rows")
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")) - 1
    rows = rows.withColumn("inside", inside).join(F.broadcast(counts), ["shard", "block"])
    return rows.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("inside")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, weights: list[float], path: str) -> None:
    """Write the documents as one folder per shard (``shard=N``); large shards are split over tasks by id."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    placed = docs.withColumn("shard", rendezvous(record_key(F.col("doc_id"), F.crc32(text)), weights))
    placed.repartition("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(8))).write.partitionBy("shard").parquet(path)
