"""Snapshot export records and their views.

A snapshot is small by construction (≤ K hot topics + ≤ N samples + one
counters row), so ranking windows and the one-row stitch are bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.operators.summaries import COUNTERS, snapshot_rows
from trendlens.schema import EXPORT_RECORD

RECORD_COLUMNS = [f.name for f in EXPORT_RECORD.fields]


def export_records(hot: DataFrame, sample: DataFrame, counters: DataFrame, exported_at: int) -> DataFrame:
    """P7 of a snapshot given as three frames."""
    return snapshot_records(snapshot_rows(hot, sample, counters), exported_at)


def snapshot_records(rows: DataFrame, exported_at: int) -> DataFrame:
    """P7 + U2 + W1 + W2 + J6: one flat record per hot topic and per sample slot of a snapshot's typed rows.

    Hot topics get ``rank`` 1.. by (count desc, keyword asc); samples keep their
    0-based ``sample_index``. Every record carries the snapshot counters and the
    export time; fields of the other record type are typed nulls.
    """
    hot, sample = F.col("kind") == "hot", F.col("kind") == "sample"
    whole = Window.partitionBy()  # ≤ K + N + 1 rows
    return rows.select(
        F.when(hot, "hot_topic").when(sample, "sample").alias("record_type"),
        "keyword",
        F.col("value").alias("approx_count"),
        F.when(hot, F.col("at")).alias("rank"),
        F.when(sample, F.col("at")).alias("sample_index"),
        *[F.coalesce(F.max(c).over(whole), F.lit(0)).alias(f"snapshot_{c}") for c in COUNTERS],
        F.lit(int(exported_at)).cast("long").alias("snapshot_exported_at"),
    ).where(F.col("record_type").isNotNull())


def hot_view(records: DataFrame) -> DataFrame:
    """P5: the hot-topic records."""
    return records.where(F.col("record_type") == "hot_topic").select("keyword", "approx_count", "rank")


def sample_view(records: DataFrame) -> DataFrame:
    """P5: the sample records."""
    return records.where(F.col("record_type") == "sample").select("keyword", "sample_index")


def preview(records: DataFrame, limit: int = 10) -> DataFrame:
    """The first ``limit`` hot topics by rank."""
    return hot_view(records).orderBy("rank").limit(limit)


def training_inputs(records: DataFrame) -> DataFrame:
    """One ``text`` input per sampled keyword."""
    return records.where(F.col("record_type") == "sample").select(F.col("keyword").alias("text"))


def export_meta(records: DataFrame, jsonl_file: str, exported_at: int) -> DataFrame:
    """A15 + S13 fields: counts by record type, snapshot counters, file name."""
    return records.agg(
        F.lit(int(exported_at)).cast("long").alias("exported_at"),
        F.coalesce(F.max("snapshot_total_processed"), F.lit(0)).cast("long").alias("total_processed"),
        F.coalesce(F.max("snapshot_last_batch_count"), F.lit(0)).cast("long").alias("last_batch_count"),
        F.coalesce(F.max("snapshot_last_update_epoch"), F.lit(0)).cast("long").alias("last_update_epoch"),
        F.count_if(F.col("record_type") == "hot_topic").cast("long").alias("hot_topic_count"),
        F.count_if(F.col("record_type") == "sample").cast("long").alias("sample_count"),
        F.count(F.lit(1)).cast("long").alias("record_count"),
        F.lit(jsonl_file).alias("jsonl_file"),
    )
