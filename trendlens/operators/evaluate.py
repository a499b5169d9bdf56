"""Accuracy evaluation of the sketches against the exact baseline.

Inputs are small or bounded except the exact counts:
  mg      ``(keyword, approx_count)``   ≤ K rows
  sample  ``(sample_index, keyword)``   ≤ N rows
  exact   ``(keyword, exact_count)``    one row per distinct keyword (large)
  totals  one row with ``total_processed``
Joins against ``exact`` broadcast the bounded side; the big side is only
scanned. One-row results are stitched with :func:`stitch` (a union and one
global aggregate), so there is no cartesian product anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.scalar import payload_bytes, round6, safe_ratio
from trendlens.operators.exact import exact_topk


def stitch(*one_row_frames: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row (no join)."""
    cols: list[str] = []
    for f in one_row_frames:
        cols += [c for c in f.columns if c not in cols]
    u = one_row_frames[0]
    for f in one_row_frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.coalesce(1).agg(*[F.max(c).alias(c) for c in cols])  # a row of each frame: no shuffle


def eval_overlap(mg: DataFrame, exact_top: DataFrame) -> DataFrame:
    """Keywords in both the MG summary and the exact top-K."""
    return mg.select("keyword").join(F.broadcast(exact_top.select("keyword")), "keyword", "left_semi")


def eval_missed(mg: DataFrame, exact_top: DataFrame) -> DataFrame:
    """Exact top-K keywords the summary does not hold (the 1 - recall part)."""
    return exact_top.join(F.broadcast(mg.select("keyword")), "keyword", "left_anti")


def _sample_side(sample: DataFrame) -> DataFrame:
    """One row: sample size and payload bytes."""
    return sample.agg(
        F.count(F.lit(1)).cast("double").alias("_size"),
        F.coalesce(F.sum(payload_bytes("keyword")), F.lit(0)).cast("long").alias("reservoir_memory_bytes"),
    )


def _exact_side(exact: DataFrame, sample: DataFrame) -> DataFrame:
    """One pass over the exact counts: distinct keywords, payload bytes, and the exact
    counts of the ≤ N sampled keywords (broadcast join), collected as a ≤ N-element list."""
    sample_counts = sample.groupBy("keyword").agg(F.count(F.lit(1)).cast("double").alias("s"))  # ≤ N rows
    joined = exact.join(F.broadcast(sample_counts), "keyword", "left")
    hit = F.struct(F.col("exact_count").cast("double").alias("c"), F.col("s"))
    return joined.agg(
        F.count(F.lit(1)).cast("long").alias("exact_unique"),
        F.coalesce(F.sum(payload_bytes("keyword")), F.lit(0)).cast("long").alias("exact_memory_bytes"),
        F.sum(F.col("exact_count").cast("double")).alias("_exact_sum"),
        F.collect_list(F.when(F.col("s").isNotNull(), hit)).alias("_hits"),
    )


def _tvd(total: Column, size: Column, exact_rows: Column, exact_sum: Column, hits: Column) -> Column:
    """A7 from the sampled keywords only: Σ_w |p_w - q_w| = (Σ c - Σ_S c)/T + Σ_S |c/T - s/|S||,
    since every exact keyword outside the sample contributes its p_w = c/T. Σ c may differ
    from T (a baseline that doesn't cover the whole stream). Not defined -> 1.0."""
    sum_c = F.aggregate(hits, F.lit(0.0), lambda acc, h: acc + h["c"])
    sum_term = F.aggregate(hits, F.lit(0.0), lambda acc, h: acc + F.abs(h["c"] / total - h["s"] / size))
    valid = (size > 0) & (total > 0) & (exact_rows > 0)
    return F.when(valid, F.lit(0.5) * ((exact_sum - sum_c) / total + sum_term)).otherwise(F.lit(1.0))


def reservoir_tvd(exact: DataFrame, sample: DataFrame, totals: DataFrame) -> DataFrame:
    """A7 + J2: TVD = ½ Σ_w |p_w - q_w| over the exact keywords, p = exact/total, q = sample/size;
    similarity = max(0, 1 - TVD). No sample, no data or no exact counts: TVD 1, similarity 0.
    The exact table is scanned once (broadcast join with the ≤ N sample counts)."""
    row = stitch(
        _exact_side(exact, sample),
        _sample_side(sample),
        totals.agg(F.max("total_processed").cast("double").alias("_t")),
    )
    tvd = _tvd(F.col("_t"), F.col("_size"), F.col("exact_unique"), F.col("_exact_sum"), F.col("_hits"))
    return row.select(
        round6(tvd).alias("reservoir_tvd"),
        round6(F.greatest(F.lit(0.0), F.lit(1.0) - tvd)).alias("reservoir_similarity"),
    )


def state_size(mg: DataFrame, exact: DataFrame | None, sample: DataFrame) -> DataFrame:
    """Payload bytes of each state, Σ(UTF-8 length + 8), and the saving in percent.

    The reference walks CPython objects; only the formula ``(exact - mg) / exact``
    (0 when exact is 0) is kept.
    """
    parts = [
        mg.agg(F.coalesce(F.sum(payload_bytes("keyword")), F.lit(0)).cast("long").alias("mg_memory_bytes")),
        sample.agg(F.coalesce(F.sum(payload_bytes("keyword")), F.lit(0)).cast("long").alias("reservoir_memory_bytes")),
    ]
    if exact is not None:
        parts.append(
            exact.agg(F.coalesce(F.sum(payload_bytes("keyword")), F.lit(0)).cast("long").alias("exact_memory_bytes"))
        )
    out = stitch(*parts)
    if exact is None:
        out = out.withColumn("exact_memory_bytes", F.lit(0).cast("long"))
    saved = F.when(
        F.col("exact_memory_bytes") > 0,
        (F.col("exact_memory_bytes") - F.col("mg_memory_bytes")).cast("double") / F.col("exact_memory_bytes") * 100.0,
    ).otherwise(0.0)
    return out.select(
        "mg_memory_bytes",
        "exact_memory_bytes",
        "reservoir_memory_bytes",
        round6(saved).alias("memory_saved_percent"),
    )


def evaluate(
    mg: DataFrame,
    exact: DataFrame | None,
    sample: DataFrame,
    totals: DataFrame,
    k: int,
) -> DataFrame:
    """K7: the 12 published metrics in one row.

    ``exact=None`` means the exact baseline is off: recall 0, top-1 0, overlap 0,
    TVD 1, similarity 0, exact size 0. Recall divides by the size of the exact
    top-K, which may hold fewer than K keywords.
    """
    if exact is None:
        sizes = state_size(mg, None, sample)
        return stitch(
            sizes,
            mg.agg(F.count(F.lit(1)).cast("long").alias("mg_unique")),
        ).select(
            F.lit(0.0).alias("topk_recall_at_k"),
            F.lit(0).alias("top1_match"),
            F.lit(0).cast("long").alias("overlap_count"),
            F.lit(1.0).alias("reservoir_tvd"),
            F.lit(0.0).alias("reservoir_similarity"),
            "mg_unique",
            F.lit(0).cast("long").alias("exact_unique"),
            "mg_memory_bytes",
            "exact_memory_bytes",
            "reservoir_memory_bytes",
            F.lit(0.0).alias("memory_saved_percent"),
            F.lit(0).alias("exact_baseline_enabled"),
        )
    return metrics_row(mg, exact_topk(exact, k), _exact_side(exact, sample), sample, totals)


def tracked_side(tracked: DataFrame, sample: DataFrame, unique: int, size: int, total: int) -> DataFrame:
    """The exact side of the metrics from maintained figures: the exact counts of (at least) the
    sampled keywords ``(keyword, exact_count)``, and the baseline's keywords, bytes and sum."""
    pairs = (
        tracked.select("keyword", F.col("exact_count").cast("double").alias("c"))
        .unionByName(sample.select("keyword", F.lit(1.0).alias("s")), allowMissingColumns=True)
        .groupBy("keyword")
        .agg(F.max("c").alias("c"), F.sum("s").alias("s"))
    )
    hit = F.when(F.col("c").isNotNull() & F.col("s").isNotNull(), F.struct("c", "s"))
    return pairs.agg(F.collect_list(hit).alias("_hits")).select(
        F.lit(unique).cast("long").alias("exact_unique"),
        F.lit(size).cast("long").alias("exact_memory_bytes"),
        F.lit(float(total)).alias("_exact_sum"),
        "_hits",
    )


def metrics_row(mg: DataFrame, top: DataFrame, exact_side: DataFrame, sample: DataFrame, totals: DataFrame) -> DataFrame:
    """K7 from its bounded parts: summary, exact top-K, the exact side's row, sample and totals."""
    # ≤ K MG rows and ≤ K top rows, side by side per keyword (no join).
    pairs = (
        mg.select("keyword", F.col("approx_count").alias("m"), F.lit(None).cast("long").alias("x"))
        .unionByName(top.select("keyword", F.lit(None).cast("long").alias("m"), F.col("exact_count").alias("x")))
        .groupBy("keyword")
        .agg(F.max("m").alias("m"), F.max("x").alias("x"))
    )
    in_mg, in_top = F.col("m").isNotNull(), F.col("x").isNotNull()
    def first(cnt: Column) -> Column:
        """The keyword with the largest count, smallest keyword on ties (rows without a count ignored)."""
        return F.min_by("keyword", F.when(cnt.isNotNull(), F.struct(-cnt, F.col("keyword"))))

    pair_side = pairs.agg(
        F.count("m").cast("long").alias("mg_unique"),
        F.count("x").cast("long").alias("_top_size"),
        F.count_if(in_mg & in_top).cast("long").alias("overlap_count"),
        first(F.col("m")).alias("_mg_top1"),
        first(F.col("x")).alias("_exact_top1"),
        F.coalesce(F.sum(F.when(in_mg, payload_bytes("keyword"))), F.lit(0)).cast("long").alias("mg_memory_bytes"),
    )
    row = stitch(
        pair_side,
        exact_side,
        _sample_side(sample),
        totals.agg(F.max("total_processed").cast("double").alias("_t")),
    )
    tvd = _tvd(F.col("_t"), F.col("_size"), F.col("exact_unique"), F.col("_exact_sum"), F.col("_hits"))
    has_top = F.col("_top_size") > 0
    saved = F.when(
        F.col("exact_memory_bytes") > 0,
        (F.col("exact_memory_bytes") - F.col("mg_memory_bytes")).cast("double") / F.col("exact_memory_bytes") * 100.0,
    ).otherwise(0.0)
    return row.select(
        F.when(has_top, round6(safe_ratio(F.col("overlap_count"), F.col("_top_size")))).otherwise(0.0).alias(
            "topk_recall_at_k"
        ),
        F.when(has_top & (F.col("_mg_top1") == F.col("_exact_top1")), 1).otherwise(0).alias("top1_match"),
        F.when(has_top, F.col("overlap_count")).otherwise(0).cast("long").alias("overlap_count"),
        F.when(has_top, round6(tvd)).otherwise(1.0).alias("reservoir_tvd"),
        F.when(has_top, round6(F.greatest(F.lit(0.0), F.lit(1.0) - tvd))).otherwise(0.0).alias("reservoir_similarity"),
        "mg_unique",
        "exact_unique",
        "mg_memory_bytes",
        "exact_memory_bytes",
        "reservoir_memory_bytes",
        round6(saved).alias("memory_saved_percent"),
        F.lit(1).alias("exact_baseline_enabled"),
    )


def memory_display(metrics: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    """A13 + A14: the size texts shown for exact vs MG state, and the saving.

    With measured exact bytes: format them and clamp the saving to [-999, 99.99].
    Without (baseline off): estimate 20 % of messages as unique, 100 bytes per
    entry, against K × 100 bytes; the saving is capped at 99.99.
    """
    from trendlens.functions.scalar import format_bytes

    row = stitch(
        metrics.select("exact_memory_bytes", "mg_memory_bytes", "memory_saved_percent"),
        totals.select(F.col("total_processed").alias("_total")),
    )
    measured = F.col("exact_memory_bytes") > 0
    est_exact = F.col("_total").cast("double") * 0.2 * 100.0
    est_mg = F.lit(float(k) * 100.0)
    est_saved = F.when(est_exact > 0, F.least((est_exact - est_mg) / est_exact * 100.0, F.lit(99.99))).otherwise(0.0)
    return row.select(
        F.when(measured, format_bytes(F.col("exact_memory_bytes"))).otherwise(format_bytes(est_exact)).alias(
            "exact_memory_text"
        ),
        F.when(measured, format_bytes(F.col("mg_memory_bytes"))).otherwise(format_bytes(est_mg)).alias("mg_memory_text"),
        round6(
            F.when(measured, F.greatest(F.least(F.col("memory_saved_percent"), F.lit(99.99)), F.lit(-999.0))).otherwise(
                est_saved
            )
        ).alias("saved_percent"),
    )
