"""Exact baseline.

The exact table grows with the number of distinct keywords; it lives in tables
and spills, never on the driver. ``exact_unique_approx`` is the scale form of
A2 for when an exact distinct count is not needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.config import check_k


HLL_LG_K = 14  # 16,384 registers: a standard error of 0.8 %


def exact_counts(events: DataFrame, keyword_col: str = "keyword") -> DataFrame:
    """A1: ``(keyword, exact_count)`` for every keyword."""
    return events.groupBy(F.col(keyword_col).alias("keyword")).agg(F.count(F.lit(1)).alias("exact_count"))


def exact_topk(counts: DataFrame, k: int, count_col: str = "exact_count") -> DataFrame:
    """The K largest exact counts (count descending, keyword ascending on ties).

    Planned as ``TakeOrderedAndProject``: a bounded heap of K rows per task.
    """
    check_k(k)
    return (
        counts.orderBy(F.col(count_col).desc(), F.col("keyword").asc())
        .limit(k)
        .select("keyword", F.col(count_col).cast("long").alias("exact_count"))
    )


def exact_unique(events: DataFrame, keyword_col: str = "keyword") -> DataFrame:
    """A2: number of distinct admitted keywords (one row)."""
    return events.agg(F.countDistinct(keyword_col).cast("long").alias("exact_unique"))


def exact_unique_approx(events: DataFrame, keyword_col: str = "keyword", rsd: float = 0.01) -> DataFrame:
    """A2 at scale: HyperLogLog++ distinct count, one row, fixed memory per task."""
    return events.agg(F.approx_count_distinct(keyword_col, rsd).cast("long").alias("exact_unique"))


def hll_state(events: DataFrame, keyword_col: str = "keyword", lg_k: int = HLL_LG_K) -> DataFrame:
    """A2 as a mergeable state: one row ``(hll)``, a sketch of 2^lg_k registers whatever the number of keywords."""
    return events.agg(F.hll_sketch_agg(keyword_col, lg_k).alias("hll"))


def hll_merge(states: list[DataFrame]) -> DataFrame:
    """The state of all events that the states (of batches, shards, epochs) saw; repeated events count once."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    return rows.agg(F.hll_union_agg("hll").alias("hll"))


def hll_estimate(state: DataFrame, lg_k: int = HLL_LG_K) -> DataFrame:
    """One row: the estimated number of keywords, and the error that it exceeds in about 3 of 1000 streams (three standard errors)."""
    n = F.hll_sketch_estimate("hll").cast("long")
    return state.select(n.alias("unique_estimate"), F.ceil(n * F.lit(3 * 1.04 / 2 ** (lg_k / 2))).cast("long").alias("error_bound"))


def sum_counts(parts: list[DataFrame], count_col: str = "n") -> DataFrame:
    """Sum several ``(keyword, n)`` tables (e.g. a compacted base and per-epoch deltas)."""
    rows = parts[0].select("keyword", F.col(count_col).cast("long").alias("n"))
    for p in parts[1:]:
        rows = rows.unionByName(p.select("keyword", F.col(count_col).cast("long").alias("n")))
    return rows.groupBy("keyword").agg(F.sum("n").cast("long").alias("n"))
