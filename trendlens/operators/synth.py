"""Search traffic as DataFrame operators.

Each input row (one occurrence id) draws a keyword from a weighted vocabulary:
``draw = hex→int(md5(seed:draw:uid)[0:13]) mod total_weight``, then the keyword
whose half-open interval ``[lo, hi)`` holds the draw. The interval lookup is an
equi-join on ``draw div B`` against the vocabulary expanded to the buckets each
interval spans (≤ V + W/B rows), then a range filter -- never a nested loop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from trendlens.config import BROADCAST_ROW_LIMIT, DEFAULT_SEED, new_work_dir
from trendlens.functions.scalar import epoch_millis

# The generator's vocabulary and weights.
HEAD_WORDS = ["AI", "Spark", "DataLake", "Kafka", "Redis"]
HEAD_WEIGHTS = [2000, 1500, 1200, 1000, 800]
MID_WORDS = [
    "Python", "Cloud", "GPU", "Docker", "VectorDB", "Analytics",
    "Streaming", "Realtime", "BigData", "Search", "Index",
    "Ranking", "NLP", "Agent", "Copilot",
]
MID_WEIGHT = 100
TAIL_SIZE = 10_000  # tail words, weight 1 each; built from a rule below
TAIL_WEIGHT = 1
BURST_WORD = "VibeCoding"
BURST_PERCENT = 90

BUCKET = 64
BLOCK = 4096  # values of ``ord`` that one window of the prefix sum covers


def vocabulary(spark: SparkSession, tail_size: int = TAIL_SIZE) -> DataFrame:
    """D13 + U4: ``(ord, keyword, weight)``; the tail is ``uuid_`` + 8 hex of md5(i)."""
    named = [(i, w, wt) for i, (w, wt) in enumerate(zip(HEAD_WORDS, HEAD_WEIGHTS))]
    named += [(len(HEAD_WORDS) + j, w, MID_WEIGHT) for j, w in enumerate(MID_WORDS)]
    head = spark.createDataFrame(named, "ord long, keyword string, weight long")
    tail = spark.range(tail_size).select(
        (F.col("id") + F.lit(len(named))).alias("ord"),
        F.concat(F.lit("uuid_"), F.substring(F.md5(F.col("id").cast("string")), 1, 8)).alias("keyword"),
        F.lit(TAIL_WEIGHT).cast("long").alias("weight"),
    )
    return head.unionByName(tail)


def with_intervals(vocab: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int, int]:
    """``(keyword, lo, hi)`` of each entry, with ``lo`` the weight before it and ``hi = lo + weight``; the
    total weight and the number of entries.

    A prefix sum in two levels: entries are summed up within blocks of ``block``
    values of ``ord``, each block in its own window, and written with the block's
    weight, so the vocabulary is evaluated once; a window over the blocks (one row in
    ``block``) gives the weight before each. Entries without a positive weight have none.
    """
    spark = vocab.sparkSession
    path = new_work_dir(spark, "vocabulary")
    within = Window.partitionBy("block").orderBy("ord", "keyword").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = vocab.where(F.col("weight") > 0).withColumn("block", F.floor(F.col("ord") / F.lit(block)).cast("long"))
    summed = summed.select(
        "block",
        "keyword",
        F.col("weight").cast("long").alias("weight"),
        F.sum("weight").over(within).cast("long").alias("upto"),
        F.sum("weight").over(Window.partitionBy("block")).cast("long").alias("block_weight"),
    )
    seen = Observation("vocabulary")
    summed.observe(seen, F.sum("weight").alias("total"), F.count(F.lit(1)).alias("rows")).write.parquet(path)
    stored = spark.read.schema(summed.schema).parquet(path)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored.where(F.col("upto") == F.col("weight")).select("block", "block_weight")  # the first entry of each
    blocks = blocks.select("block", F.coalesce(F.sum("block_weight").over(before), F.lit(0)).alias("offset"))
    hi = F.col("offset") + F.col("upto")
    intervals = stored.join(blocks, "block").select("keyword", (hi - F.col("weight")).alias("lo"), hi.alias("hi"))
    found = seen.get
    return intervals, int(found["total"] or 0), int(found["rows"])


def hash_int(seed: str, salt: str, uid: Column) -> Column:
    """52-bit integer from the first 13 hex digits of md5(seed:salt:uid)."""
    h = F.md5(F.concat(F.lit(f"{seed}:{salt}:"), uid.cast("string")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long")


@dataclass(frozen=True)
class Lookup:
    """A vocabulary made ready for draws: ``(_b, keyword, lo, hi)`` for each bucket ``_b`` that an
    interval touches, stored; any number of streams may draw from it."""

    buckets: DataFrame
    total: int
    rows: int  # at most so many
    bucket: int


def lookup(vocab: DataFrame, bucket: int = BUCKET) -> Lookup:
    """Intervals of a vocabulary by bucket, written to the shared folder."""
    intervals, total, n_rows = with_intervals(vocab)
    if total <= 0:
        raise ValueError("vocabulary has no positive weight")
    first, last = (F.floor(x / F.lit(bucket)).cast("long") for x in (F.col("lo"), F.col("hi") - 1))
    buckets = intervals.select(F.explode(F.sequence(first, last)).alias("_b"), "keyword", "lo", "hi")
    path = new_work_dir(vocab.sparkSession, "lookup")
    buckets.write.parquet(path)
    return Lookup(vocab.sparkSession.read.schema(buckets.schema).parquet(path), total, n_rows + total // bucket + 1, bucket)


def assign_keywords(
    rows: DataFrame,
    vocab: DataFrame | Lookup,
    uid_col: str = "uid",
    seed: str = DEFAULT_SEED,
    bucket: int = BUCKET,
) -> DataFrame:
    """G1 + J7: add ``keyword`` drawn with replacement, proportional to weight."""
    ready = vocab if isinstance(vocab, Lookup) else lookup(vocab, bucket)
    # Expanded size ≤ vocabulary rows + total/bucket: checked before the broadcast hint.
    side = F.broadcast(ready.buckets) if ready.rows <= BROADCAST_ROW_LIMIT else ready.buckets
    drawn = rows.withColumn("_draw", F.pmod(hash_int(seed, "draw", F.col(uid_col)), F.lit(ready.total)))
    drawn = drawn.withColumn("_b", F.floor(F.col("_draw") / F.lit(ready.bucket)).cast("long"))
    joined = drawn.join(side, "_b").where((F.col("_draw") >= F.col("lo")) & (F.col("_draw") < F.col("hi")))
    return joined.drop("_b", "_draw", "lo", "hi")


def burst_mixture(
    rows: DataFrame,
    active: Column,
    target: str = BURST_WORD,
    percent: int = BURST_PERCENT,
    uid_col: str = "uid",
    seed: str = DEFAULT_SEED,
) -> DataFrame:
    """While ``active``, ``percent`` % of messages carry ``target``; the rest keep their draw."""
    hit = F.pmod(hash_int(seed, "burst", F.col(uid_col)), F.lit(100)) < F.lit(percent)
    return rows.withColumn("keyword", F.when(active & hit, F.lit(target)).otherwise(F.col("keyword")))


def search_stream(events: DataFrame, vocab: DataFrame | Lookup, seed: str = DEFAULT_SEED) -> DataFrame:
    """One search message per event: ``(keyword, timestamp, uid)`` with uid = event_id."""
    rows = events.select(
        F.col("event_id").cast("string").alias("uid"),
        epoch_millis(events, "ts").alias("timestamp"),
        "event_id",
    )
    return assign_keywords(rows, vocab, "uid", seed).select("keyword", "timestamp", "uid", "event_id")


def to_payload(stream: DataFrame, with_uid: bool = True) -> DataFrame:
    """The D1 JSON payload ``{"keyword": ..., "timestamp": ...}`` as ``value``."""
    fields = [F.col("keyword"), F.col("timestamp")] + ([F.col("uid")] if with_uid else [])
    return stream.select(F.to_json(F.struct(*fields)).alias("value"))


def rate_stream(
    spark: SparkSession,
    rows_per_batch: int,
    vocab: DataFrame | Lookup | None = None,
    seed: str = DEFAULT_SEED,
    burst_target: str | None = None,
    percent: int = BURST_PERCENT,
) -> DataFrame:
    """A live search stream of ``rows_per_batch`` messages per micro-batch.

    Spark's ``rate-micro-batch`` source numbers the messages; each gets a weighted
    vocabulary draw (uid = its number), and with ``burst_target`` set, ``percent`` %
    of them carry that word. The mode is fixed per query; restart it to switch.
    """
    raw = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", int(rows_per_batch)).load()
    rows = raw.select(F.col("value").cast("string").alias("uid"), F.unix_millis("timestamp").alias("timestamp"))
    stream = assign_keywords(rows, vocab if vocab is not None else vocabulary(spark), "uid", seed)
    if burst_target:
        stream = burst_mixture(stream, F.lit(True), burst_target, percent, "uid", seed)
    return stream.select("keyword", "timestamp", "uid")
