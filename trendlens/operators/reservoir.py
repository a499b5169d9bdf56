"""Uniform reservoir sampling without a sequential pass.

Every occurrence gets the priority ``md5(seed:uid)``; the sample of size N is
the N smallest priorities (ties broken by uid). For a fixed seed each occurrence
has the same chance to be in it, as with Algorithm R, but the sample is a
bounded top-N -- mergeable across tasks, batches and epochs -- and a retried
task or replayed epoch yields the same rows (``rand()`` would not).

A state also remembers the smallest row it ever dropped (``dropped`` is true
there), and every row after that one stays out. So a state is at all times the
smallest occurrences of everything seen, and the sample stays uniform when N
grows past what the state kept: it is short at first and fills up as the stream
goes on (the reference appends unconditionally after a grow, which biases the
sample towards recent items; ours deliberately differs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.config import DEFAULT_SEED, RESERVOIR_SLOTS, check_n


def priority(uid_col: str = "uid", seed: str = DEFAULT_SEED):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(uid_col).cast("string")))


def with_priority(events: DataFrame, uid_col: str = "uid", seed: str = DEFAULT_SEED) -> DataFrame:
    """``(priority, uid, keyword)`` for every occurrence."""
    return events.select(
        priority(uid_col, seed).alias("priority"),
        F.col(uid_col).cast("string").alias("uid"),
        F.col("keyword"),
    )


def reservoir_trim(state: DataFrame, slots: int) -> DataFrame:
    """Keep the ``slots`` smallest rows before the dropped mark; the first one left out becomes the mark."""
    top = state.orderBy("priority", "dropped", "uid").limit(slots + 1)
    # at most slots + 1 rows in one partition after the limit: whole-frame windows are cheap
    at = top.withColumn("at", F.row_number().over(Window.orderBy("priority", "dropped", "uid")))
    out = at.withColumn("out", F.col("dropped") | (F.col("at") > slots))
    mark = F.min(F.when(F.col("out"), F.col("at"))).over(Window.partitionBy())
    return (
        out.withColumn("mark", mark)
        .where(F.col("mark").isNull() | (F.col("at") <= F.col("mark")))
        .select("priority", "uid", "keyword", F.col("out").alias("dropped"))
    )


def reservoir_update(
    state: DataFrame | None,
    batch: DataFrame,
    uid_col: str = "uid",
    seed: str = DEFAULT_SEED,
    n_max: int = RESERVOIR_SLOTS,
) -> DataFrame:
    """Merge a batch into the reservoir state ``(priority, uid, keyword, dropped)`` of ``n_max`` slots.

    ``TakeOrderedAndProject`` keeps a heap of ``n_max + 1`` rows per task, then
    merges ``(n_max + 1)`` × tasks rows: no shuffle of the batch.
    """
    rows = with_priority(batch, uid_col, seed).withColumn("dropped", F.lit(False))
    if state is not None:
        rows = rows.unionByName(state.select("priority", "uid", "keyword", "dropped"))
    return reservoir_trim(rows, n_max)


def reservoir_view(state: DataFrame, n: int) -> DataFrame:
    """T4 + W2: the first N slots of a state (fewer if it holds fewer), ``(sample_index, keyword)``, 0-based."""
    check_n(n)
    first = state.where(~F.col("dropped")).orderBy("priority", "uid").limit(n)
    w = Window.orderBy("priority", "uid")  # ≤ N rows in one partition after the limit
    return first.select(
        (F.row_number().over(w) - 1).cast("int").alias("sample_index"),
        "keyword",
    )


def reservoir_sample(events: DataFrame, n: int, uid_col: str = "uid", seed: str = DEFAULT_SEED) -> DataFrame:
    """K2 on a whole table: ``(sample_index, keyword)`` of N occurrences."""
    return reservoir_view(with_priority(events, uid_col, seed).withColumn("dropped", F.lit(False)), n)


def reservoir_resize(state: DataFrame, n: int) -> DataFrame:
    """T4: shrink the visible sample to its first N slots."""
    return reservoir_view(state, n)
