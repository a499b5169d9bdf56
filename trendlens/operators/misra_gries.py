"""Misra-Gries heavy hitters as DataFrame operators.

Mergeable form (Agarwal et al., "Mergeable Summaries", PODS 2012): sum the counts
of the summary and the new data per keyword, subtract the (K+1)-th largest sum
and keep what stays positive. Every prune removes ``cut`` from at least K+1
counters, so the summed cuts never exceed n/(K+1) -- the bound of the
one-at-a-time rule. The result depends only on values, so ties and row order do
not matter; like the sequential rule it does depend on batch boundaries.

Plan shape of :func:`misra_gries` on a large table: one partial hash aggregate
per task (hot keywords collapse before the shuffle), one shuffle by keyword, a
final aggregate, then ``TakeOrderedAndProject`` keeps K+1 rows per task. The cut
is taken inside those K+1 rows, so there is no second pass over the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from trendlens.config import BROADCAST_ROW_LIMIT, check_k, ship_package


def mg_prune(counts: DataFrame, k: int, count_col: str = "n", cut_seen: Observation | None = None) -> DataFrame:
    """Reduce ``(keyword, count)`` rows to a K-counter summary ``(keyword, approx_count)``.

    cut = the (K+1)-th largest count (0 if there are at most K rows); keep
    ``count - cut`` where positive. Any row above the cut ranks within the top
    K+1, so only those K+1 rows are materialised. ``cut_seen`` observes the cut
    as ``cut``: every count of the result is short by at most that much more.
    """
    check_k(k)
    top = counts.orderBy(F.col(count_col).desc(), F.col("keyword").asc()).limit(k + 1)
    # The limit leaves at most K+1 rows in one partition: a whole-frame window is cheap.
    whole = Window.partitionBy()
    cut = F.when(F.count(F.lit(1)).over(whole) > k, F.min(count_col).over(whole)).otherwise(F.lit(0))
    top = top.withColumn("_cut", cut)
    if cut_seen is not None:
        top = top.observe(cut_seen, F.max("_cut").alias("cut"))
    return (
        top
        .where(F.col(count_col) > F.col("_cut"))
        .select("keyword", (F.col(count_col) - F.col("_cut")).cast("long").alias("approx_count"))
    )


def mg_update(state: DataFrame | None, batch: DataFrame, k: int, keyword_col: str = "keyword") -> DataFrame:
    """Fold one batch of events into a summary: state ∪ batch, sum per keyword, prune.

    The state rows (≤ K) are unioned with the raw events *before* the aggregate,
    so the batch is shuffled once, after map-side partial aggregation.
    """
    rows = batch.select(F.col(keyword_col).alias("keyword"), F.lit(1).cast("long").alias("n"))
    if state is not None:
        rows = rows.unionByName(state.select("keyword", F.col("approx_count").cast("long").alias("n")))
    merged = rows.groupBy("keyword").agg(F.sum("n").cast("long").alias("n"))
    return mg_prune(merged, k)


def mg_merge_counts(state: DataFrame | None, counts: DataFrame, k: int) -> DataFrame:
    """Fold pre-aggregated batch counts ``(keyword, n)`` into a summary."""
    rows = counts.select("keyword", F.col("n").cast("long").alias("n"))
    if state is not None:
        rows = rows.unionByName(state.select("keyword", F.col("approx_count").cast("long").alias("n")))
    return mg_prune(rows.groupBy("keyword").agg(F.sum("n").cast("long").alias("n")), k)


def mg_merge(summaries: list[DataFrame], k: int) -> DataFrame:
    """Merge several summaries (e.g. from different streams or shards) into one."""
    if not summaries:
        raise ValueError("nothing to merge")
    rows = summaries[0].select("keyword", F.col("approx_count").cast("long").alias("n"))
    for other in summaries[1:]:
        rows = rows.unionByName(other.select("keyword", F.col("approx_count").cast("long").alias("n")))
    return mg_prune(rows.groupBy("keyword").agg(F.sum("n").cast("long").alias("n")), k)


def misra_gries(events: DataFrame, k: int, keyword_col: str = "keyword") -> DataFrame:
    """K1: the K-counter summary of a whole table, as one batch."""
    return mg_update(None, events, k, keyword_col)


def mg_hot_topics(summary: DataFrame) -> DataFrame:
    """All summary entries, count descending, keyword ascending on ties."""
    return summary.orderBy(F.col("approx_count").desc(), F.col("keyword").asc())


def mg_resize(state: DataFrame, k: int) -> DataFrame:
    """Shrink a summary to its K largest counters; counts are kept as they are."""
    check_k(k)
    return state.orderBy(F.col("approx_count").desc(), F.col("keyword").asc()).limit(k)


# ---------------------------------------------------------------------------
# Per-partition sketch, O(K) memory per task, no shuffle of the long tail.
# ---------------------------------------------------------------------------


SKETCH_BUDGET = 100_000  # counters a task may hold before it prunes back to K


def _prune(keys: pa.Array, counts: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
    """One MG merge step on local counters: subtract the (K+1)-th largest, keep > 0."""
    if len(counts) <= k:
        return keys, counts
    cut = np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1]
    keep = counts > cut
    return keys.filter(pa.array(keep)), counts[keep] - cut


def _partition_sketch(k: int, budget: int):
    budget = max(budget, k)

    def combine(parts: list[tuple[pa.Array, pa.Array]]) -> tuple[pa.Array, np.ndarray]:
        table = pa.table(
            {"keyword": pa.concat_arrays([p[0] for p in parts]), "n": pa.concat_arrays([p[1] for p in parts])}
        ).group_by("keyword").aggregate([("n", "sum")])
        return table.column("keyword").combine_chunks(), table.column("n_sum").to_numpy()

    def sketch(batches):
        keys, counts = pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
        pending, pending_rows = [], 0
        for batch in batches:
            vc = pc.value_counts(pc.drop_null(batch.column(0)).cast(pa.string()))  # C++ hash count
            if len(vc) == 0:
                continue
            pending.append((vc.field("values"), vc.field("counts")))
            pending_rows += len(vc)
            if pending_rows > budget:  # bounded memory: fold in, prune back to K counters
                keys, counts = _prune(*combine([(keys, pa.array(counts, pa.int64()))] + pending), k)
                pending, pending_rows = [], 0
        if pending:
            keys, counts = combine([(keys, pa.array(counts, pa.int64()))] + pending)
        keys, counts = _prune(keys, counts, k)
        if len(counts):
            yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], names=["keyword", "n"])

    return sketch


def mg_sketch(events: DataFrame, k: int, keyword_col: str = "keyword", budget: int = SKETCH_BUDGET) -> DataFrame:
    """Each task counts its Arrow batches (pyarrow ``value_counts`` / ``group_by``),
    folding them into its counters whenever more than ``budget`` rows are pending and
    pruning back to K, and emits ≤ K rows; then one merge of those summaries.

    Only ≤ K rows per task reach the shuffle, whatever the length of the tail, and
    a task's memory is bounded by the budget. Each prune is an MG merge step, so
    the result satisfies the MG bound (undercount ≤ n/(K+1), no overcount); it
    depends on the partitioning and on the budget.
    """
    check_k(k)
    ship_package(events.sparkSession)  # the per-task function runs in the executors' Python
    local = events.select(F.col(keyword_col).alias("keyword")).mapInArrow(
        _partition_sketch(k, budget), "keyword string, n long"
    )
    return mg_prune(local.groupBy("keyword").agg(F.sum("n").cast("long").alias("n")), k)


def mg_verified(events: DataFrame, k: int, keyword_col: str = "keyword") -> DataFrame:
    """The guaranteed heavy hitters -- keywords whose share exceeds 1/(K+1) -- with exact counts.

    Any MG summary with K counters holds every such keyword, so the ≤ K
    candidates of :func:`mg_sketch` are broadcast (size bounded by K) and one
    more scan counts just those, plus the total, in a single aggregate with at
    most K+1 groups. Result: ``(keyword, exact_count)``, exact and independent
    of the partitioning.
    """
    check_k(k)
    if k + 1 > BROADCAST_ROW_LIMIT:
        raise ValueError(f"k={k} is too large for the verified candidate broadcast")
    candidates = mg_sketch(events, k, keyword_col).select(F.col("keyword").alias("_cand"))
    flagged = events.select(F.col(keyword_col).alias("keyword")).join(
        F.broadcast(candidates), F.col("keyword") == F.col("_cand"), "left"
    )
    per_group = flagged.groupBy(F.col("_cand").alias("keyword")).agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy()  # ≤ K+1 groups
    with_total = per_group.withColumn("_total", F.sum("c").over(whole))
    return with_total.where(
        F.col("keyword").isNotNull() & (F.col("c") * F.lit(k + 1) > F.col("_total"))
    ).select("keyword", F.col("c").cast("long").alias("exact_count"))


def mg_certificate(summary: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Hold a K-counter summary against exact counts ``(keyword, exact_count)``, in one row.

    ``total``, the number of ``guaranteed`` keywords (share above 1/(K+1)) and how
    many of them are missing, counts that are too high (``over_counted``, keywords
    that don't occur included) or short by more than total/(K+1)
    (``under_counted``), and whether the summary fits K counters. Both tables meet
    in one aggregate by keyword; the bounds are judged on its K+1 largest rows and
    a few maxima, so the exact counts are read once.
    """
    check_k(k)
    rows = exact.select("keyword", F.col("exact_count").alias("x"), F.lit(None).cast("long").alias("a"))
    rows = rows.unionByName(summary.select("keyword", F.lit(None).cast("long").alias("x"), F.col("approx_count").alias("a")))
    x, a = F.coalesce(F.max("x"), F.lit(0)).alias("x"), F.max("a").alias("a")
    both = rows.groupBy("keyword").agg(x, a)
    whole = both.agg(
        F.coalesce(F.sum("x"), F.lit(0)).cast("long").alias("total"),
        F.count_if(F.col("a") > F.col("x")).cast("long").alias("over_counted"),
        (F.count("a") <= k).alias("fits"),
    )
    # a keyword short by more than total/(K+1) occurs so often: it is among the K largest
    largest = both.orderBy(F.col("x").desc(), "keyword").limit(k + 1).agg(F.collect_list(F.struct("x", "a")).alias("largest"))
    row = whole.unionByName(largest, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("total", "over_counted", "fits")], F.first("largest", ignorenulls=True).alias("largest"))
    often = lambda n: n * F.lit(k + 1) > F.col("total")
    return row.select(
        "total",
        F.size(F.filter("largest", lambda r: often(r["x"]))).cast("long").alias("guaranteed"),
        F.size(F.filter("largest", lambda r: often(r["x"]) & r["a"].isNull())).cast("long").alias("guaranteed_missing"),
        "over_counted",
        F.size(F.filter("largest", lambda r: often(r["x"] - F.coalesce(r["a"], F.lit(0))))).cast("long").alias("under_counted"),
        "fits",
    )
