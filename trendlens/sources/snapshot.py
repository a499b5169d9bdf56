"""Readers of a published snapshot (S3-S7) and of the stream's epoch log.

A snapshot is one table written by one epoch, so hot topics, samples, counters
and metrics always belong together. Counts are re-typed defensively
(``try_cast``; rows with bad values dropped) and metrics get the reader's
defaults, so the readers also accept snapshots written as text by others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from trendlens.schema import COUNTERS, EVAL_METRICS_FIELDS, SKETCH_STATE, SNAPSHOT
from trendlens.streaming.state import EpochStore


def published_epoch(store: EpochStore) -> int | None:
    """The epoch whose snapshot is current (from the newest committed log row)."""
    row = store.latest_entry()
    if row is None or int(row["snapshot_epoch"]) < 0:
        return None
    return int(row["snapshot_epoch"])


def snapshot(store: EpochStore, epoch: int | None = None) -> DataFrame:
    return store.read("snapshot", published_epoch(store) if epoch is None else epoch, SNAPSHOT)


def parse_counts(frame: DataFrame, count_col: str) -> DataFrame:
    """Keep rows whose count parses as an integer; largest first (keyword on ties)."""
    typed = frame.select("keyword", F.col(count_col).cast("string").try_cast("bigint").alias(count_col))
    return typed.where(F.col(count_col).isNotNull()).orderBy(F.col(count_col).desc(), F.col("keyword").asc())


def _records(store: EpochStore, record_type: str, epoch: int | None) -> DataFrame:
    return snapshot(store, epoch).where(F.col("record_type") == record_type)


def read_hot_topics(store: EpochStore, epoch: int | None = None) -> DataFrame:
    """S3: published MG entries ``(keyword, approx_count)``, count descending."""
    return parse_counts(_records(store, "hot_topic", epoch).withColumnRenamed("count", "approx_count"), "approx_count")


def read_exact_topics(store: EpochStore, epoch: int | None = None) -> DataFrame:
    """Published exact top-K ``(keyword, exact_count)``, count descending."""
    return parse_counts(_records(store, "exact_topic", epoch).withColumnRenamed("count", "exact_count"), "exact_count")


def read_samples(store: EpochStore, epoch: int | None = None) -> DataFrame:
    """The published sample ``(sample_index, keyword)`` in slot order."""
    return _records(store, "sample", epoch).select("sample_index", "keyword").orderBy("sample_index")


def read_counters(store: EpochStore, epoch: int | None = None) -> DataFrame:
    """One row of counters; missing values (or no snapshot at all) read as 0."""
    rows = _records(store, "counters", epoch).select(*COUNTERS.fieldNames())
    return rows.agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS.fieldNames()])


def read_eval_metrics(store: EpochStore, epoch: int | None = None) -> DataFrame:
    """The 12 metrics typed, with defaults (TVD 1.0, the rest 0); no row if none was published."""
    raw = _records(store, "metrics", epoch)
    return raw.select(
        *[
            F.coalesce(F.col(name).cast("string").try_cast(dtype), F.lit(default).cast(dtype)).alias(name)
            for name, dtype, default in EVAL_METRICS_FIELDS
        ]
    )


def read_epoch_log(store: EpochStore) -> DataFrame:
    """One row per committed epoch: batch size, running total, k and n."""
    log = store.log()
    if log is None:
        return store.spark.createDataFrame([], "epoch long, batch_count long, total_processed long, k int, n int")
    return log.select("epoch", "batch_count", "total_processed", "k", "n")


def read_mg_history(store: EpochStore, keyword: str) -> DataFrame:
    """The count of one keyword in the MG state after every committed epoch (0 when absent)."""
    log = store.log()
    if log is None:
        return store.spark.createDataFrame([], "epoch long, approx_count long")
    schema = StructType(SKETCH_STATE.fields + [StructField("epoch", LongType(), True)])
    if not store.epochs("state/sketch"):  # empty batches only
        return log.select("epoch", F.lit(0).cast("long").alias("approx_count"))
    # folders of epochs that aren't committed meet no log row
    sketch = store.spark.read.schema(schema).parquet(store.path("state/sketch"))
    hits = sketch.where((F.col("kind") == "mg") & (F.col("keyword") == F.lit(keyword))).select(
        F.col("epoch").alias("state_epoch"), "approx_count"
    )
    return log.select("epoch", "state_epoch").join(hits, "state_epoch", "left").select(
        "epoch", F.coalesce(F.col("approx_count"), F.lit(0)).cast("long").alias("approx_count")
    )


def read_error_bound(store: EpochStore, epoch: int | None = None) -> DataFrame:
    """One row ``(mg_error_bound)``: no published count, nor the 0 of a keyword without one, is short of the true count by more."""
    rows = _records(store, "counters", epoch).select("mg_error_bound")
    return rows.agg(F.coalesce(F.max("mg_error_bound"), F.lit(0)).cast("long").alias("mg_error_bound"))
