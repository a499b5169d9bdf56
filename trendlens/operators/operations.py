"""Operational metrics, alerts and views over a published snapshot.

All inputs are bounded (hot topics ≤ K rows, sample ≤ N rows, one-row
counters), so whole-frame windows and broadcasts here are safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlens.config import bounded_broadcast
from trendlens.functions.scalar import freshness_seconds, round6
from trendlens.operators.evaluate import stitch
from trendlens.operators.summaries import snapshot_rows

# Keyword -> category map of the topic roll-up, and its default.
CATEGORY_MAP = {
    "AI": "AI/模型",
    "Agent": "AI/模型",
    "Copilot": "AI/模型",
    "NLP": "AI/模型",
    "Spark": "数据基础设施",
    "Kafka": "数据基础设施",
    "Redis": "数据基础设施",
    "DataLake": "数据基础设施",
    "VectorDB": "数据基础设施",
    "BigData": "数据基础设施",
    "Streaming": "实时计算",
    "Realtime": "实时计算",
    "Search": "搜索与推荐",
    "Ranking": "搜索与推荐",
    "Index": "搜索与推荐",
    "Analytics": "分析洞察",
    "Python": "工程生态",
    "Docker": "工程生态",
    "GPU": "工程生态",
    "Cloud": "工程生态",
}
DEFAULT_CATEGORY = "其他"

# Alert thresholds.
FRESHNESS_MIN_SECONDS = 6
FRESHNESS_REFRESH_FACTOR = 3
CONCENTRATION_RATIO = 0.85
CONCENTRATION_MIN_TOTAL = 1000
DIVERSITY_RATIO = 0.35
DIVERSITY_MIN_SAMPLES = 10


def category_dimension(spark: SparkSession) -> DataFrame:
    """The 20-row keyword -> category dimension."""
    return spark.createDataFrame(list(CATEGORY_MAP.items()), "keyword string, category string")


def _judged(rows: DataFrame, as_of: int) -> DataFrame:
    """One row of K9's metrics, the total and the sample size of a snapshot's typed rows, by one aggregate."""
    hot, sample = F.col("kind") == "hot", F.col("kind") == "sample"
    row = rows.agg(
        F.coalesce(F.max(F.when(hot, F.col("value"))), F.lit(0)).alias("_top1"),
        F.coalesce(F.sum(F.when(hot, F.col("value"))), F.lit(0)).alias("_sum"),
        F.count_if(sample).alias("_size"),
        F.size(F.collect_set(F.when(sample, F.col("keyword")))).alias("_distinct"),  # ≤ N
        F.max("last_update_epoch").alias("_last"),
        F.max("total_processed").alias("_total"),
    )
    return row.select(
        round6(F.when(F.col("_sum") > 0, F.col("_top1") / F.col("_sum")).otherwise(0.0)).alias("top1_ratio"),
        round6(F.when(F.col("_size") > 0, F.col("_distinct") / F.col("_size")).otherwise(0.0)).alias("sample_diversity"),
        freshness_seconds(F.col("_last"), as_of).alias("data_freshness_seconds"),
        "_total",
        "_size",
    )


def snapshot_metrics(rows: DataFrame, as_of: int) -> DataFrame:
    """K9 of a snapshot's typed rows: concentration (top-1 / sum of counts), sample diversity (distinct / size), freshness."""
    return _judged(rows, as_of).drop("_total", "_size")


def snapshot_alerts(rows: DataFrame, as_of: int, refresh_seconds: int = 2) -> DataFrame:
    """P9 of a snapshot's typed rows: the three alert predicates and ``healthy`` when none fires (0/1 ints)."""
    return _fired(_judged(rows, as_of), refresh_seconds)


def operational_metrics(hot: DataFrame, sample: DataFrame, counters: DataFrame, as_of: int) -> DataFrame:
    """K9 of a snapshot given as three frames."""
    return snapshot_metrics(snapshot_rows(hot, sample, counters), as_of)


def alerts(metrics: DataFrame, counters: DataFrame, sample: DataFrame, refresh_seconds: int = 2) -> DataFrame:
    """P9 from K9's row, the counters and the sample."""
    row = stitch(
        metrics.select("top1_ratio", "sample_diversity", "data_freshness_seconds"),
        counters.select(F.col("total_processed").alias("_total")),
        sample.agg(F.count(F.lit(1)).cast("long").alias("_size")),
    )
    return _fired(row, refresh_seconds)


def _fired(row: DataFrame, refresh_seconds: int) -> DataFrame:
    lag = F.col("data_freshness_seconds") >= F.lit(max(FRESHNESS_MIN_SECONDS, refresh_seconds * FRESHNESS_REFRESH_FACTOR))
    hot = (F.col("top1_ratio") >= CONCENTRATION_RATIO) & (F.col("_total") > CONCENTRATION_MIN_TOTAL)
    flat = (F.col("sample_diversity") <= DIVERSITY_RATIO) & (F.col("_size") >= DIVERSITY_MIN_SAMPLES)
    return row.select(
        lag.cast("int").alias("alert_freshness"),
        hot.cast("int").alias("alert_concentration"),
        flat.cast("int").alias("alert_diversity"),
        (~(lag | hot | flat)).cast("int").alias("healthy"),
    )


def category_rollup(hot: DataFrame, dim: DataFrame, default: str = DEFAULT_CATEGORY) -> DataFrame:
    """J3 + A11: sum of hot-topic counts per category, largest first (category on ties).

    The dimension is broadcast after a size check (the default one has 20 rows)."""
    joined = hot.join(bounded_broadcast(dim), "keyword", "left")
    return (
        joined.groupBy(F.coalesce(F.col("category"), F.lit(default)).alias("category"))
        .agg(F.sum("approx_count").cast("long").alias("count"))
        .orderBy(F.col("count").desc(), F.col("category").asc())
    )


def hot_topics_flagged(hot: DataFrame, target: str | None) -> DataFrame:
    """Mark the burst target among the hot topics (never flagged when no burst runs)."""
    flag = (F.col("keyword") == F.lit(target)) if target else F.lit(False)
    return hot.select("keyword", "approx_count", F.coalesce(flag, F.lit(False)).cast("int").alias("is_burst_target"))


def ranked(frame: DataFrame, count_col: str, limit: int) -> DataFrame:
    """First ``limit`` rows by (count desc, keyword asc) with a 1-based rank."""
    first = frame.orderBy(F.col(count_col).desc(), F.col("keyword").asc()).limit(limit)
    w = Window.orderBy(F.col(count_col).desc(), F.col("keyword").asc())  # ≤ limit rows
    return first.withColumn("rank", F.row_number().over(w))


def mg_vs_exact(mg: DataFrame, exact_top: DataFrame, limit: int = 20) -> DataFrame:
    """P10 + T5: the first 20 of both rankings side by side, joined on rank."""
    left = ranked(mg, "approx_count", limit).select("rank", F.col("keyword").alias("mg_keyword"), F.col("approx_count").alias("mg_count"))
    right = ranked(exact_top, "exact_count", limit).select(
        "rank", F.col("keyword").alias("exact_keyword"), F.col("exact_count").alias("exact_count")
    )
    return left.join(right, "rank", "full").orderBy("rank")


def batch_counters(stream: DataFrame) -> DataFrame:
    """Counters of one batch: total, batch size, newest message time (epoch seconds; 0 if none)."""
    return stream.agg(
        F.count(F.lit(1)).cast("long").alias("total_processed"),
        F.count(F.lit(1)).cast("long").alias("last_batch_count"),
        F.coalesce(F.floor(F.max("timestamp") / F.lit(1000)), F.lit(0)).cast("long").alias("last_update_epoch"),
    )


def dashboard(store, as_of: int, refresh_seconds: int = 2, k: int | None = None) -> DataFrame:
    """One dashboard refresh from a stream's current published snapshot, in one row:
    memory texts (A13/A14), concentration, diversity, freshness (K9) and alerts (P9).

    ``k`` is the counter budget shown for the size estimate when the exact baseline
    is off; by default the K in force at the snapshot's epoch.
    """
    from trendlens.operators.evaluate import memory_display
    from trendlens.sources.snapshot import (
        published_epoch,
        read_counters,
        read_eval_metrics,
        read_hot_topics,
        read_samples,
    )

    epoch = published_epoch(store)  # one epoch for every read
    hot, samples, counters = read_hot_topics(store, epoch), read_samples(store, epoch), read_counters(store, epoch)
    if k is None:
        entry = None if epoch is None else store.last_entry(epoch)
        k = int(entry["k"]) if entry is not None else 0
    metrics = read_eval_metrics(store, epoch)
    if epoch is None:  # nothing published yet: the reader's defaults
        metrics = store.spark.createDataFrame([(0, 0, 0.0)], "exact_memory_bytes long, mg_memory_bytes long, memory_saved_percent double")
    ops_row = operational_metrics(hot, samples, counters, as_of)
    return stitch(
        memory_display(metrics, counters, k),
        ops_row,
        alerts(ops_row, counters, samples, refresh_seconds),
    )
