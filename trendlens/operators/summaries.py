"""One scan for a whole snapshot: counters of K keywords, a sample of N, totals (K1, K2, A4).

Every task turns its rows into typed rows: exact keyword counts, its N first
occurrences by priority, its newest time. One shuffle adds the counts up, every
task keeps the K+1 largest and the N first of what it got, and one window over
those few rows makes the cut and numbers the sample. So the events, and whatever
joins made them, run once, where three operators side by side run them thrice.

A snapshot is one table of typed rows (:data:`ROWS`): ``hot`` (``value`` = count
after the cut, ``at`` = rank from 1), ``sample`` (``at`` = sample index from 0) and one
``counters`` row. :func:`snapshot_rows` makes the same table of three frames.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.config import DEFAULT_SEED, check_k, check_n, ship_package
from trendlens.operators.reservoir import priority

ROWS = "kind string, keyword string, value long, at int, total_processed long, last_batch_count long, last_update_epoch long"
COUNTERS = ["total_processed", "last_batch_count", "last_update_epoch"]
BUDGET = 100_000  # keyword counts a task may hold before it hands them on

_PARTIAL = "kind string, keyword string, priority string, uid string, n long, last long"
_ARROW = pa.schema([("kind", pa.string()), ("keyword", pa.string()), ("priority", pa.string()), ("uid", pa.string()), ("n", pa.int64()), ("last", pa.int64())])
_FIRST = [("priority", "ascending", "at_start"), ("uid", "ascending", "at_start"), ("keyword", "ascending", "at_start")]


def _typed(kind: str, rows: int, **columns) -> pa.RecordBatch:
    """A batch of one kind; columns that it doesn't have are null."""
    arrays = [pa.array([kind] * rows, pa.string()) if f.name == "kind" else columns.get(f.name, pa.nulls(rows, f.type)) for f in _ARROW]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, _ARROW)], schema=_ARROW)


def _sorted(table: pa.Table, keys: list[tuple[str, str, str]]) -> pa.Table:
    """``table`` in the order of (column, direction, place of nulls) keys."""
    for name, direction, nulls in reversed(keys):  # stable, so the last sort is the first key
        table = table.take(pc.array_sort_indices(table.column(name).combine_chunks(), order=direction, null_placement=nulls)) if len(table) else table
    return table


def _summarise(n: int, budget: int):
    def added(parts: list[tuple[pa.Array, pa.Array]]) -> tuple[pa.Array, pa.Array]:
        table = pa.table({"keyword": pa.concat_arrays([k for k, _ in parts]), "n": pa.concat_arrays([c for _, c in parts])})
        table = table.group_by("keyword").aggregate([("n", "sum")])
        return table.column("keyword").combine_chunks(), table.column("n_sum").combine_chunks()

    def run(batches):
        counts, held, sample, last, seen = [], 0, None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            found = pc.value_counts(batch.column("keyword").cast(pa.string()))  # a null is a keyword of its own
            counts.append((found.field("values"), found.field("counts")))
            held += len(found)
            if held > budget:
                counts = [added(counts)]
                held = len(counts[0][0])
                if held > budget // 2:  # too many different ones: handed on, the shuffle adds them up
                    yield _typed("hot", held, keyword=counts[0][0], n=counts[0][1])
                    counts, held = [], 0
            rows = pa.Table.from_batches([batch.select(["priority", "uid", "keyword"])])
            if sample is not None and len(sample) == n:  # only what may still enter the sample is sorted
                worst = sample.column("priority")[n - 1]
                enters = pc.is_null(rows.column("priority")) if not worst.is_valid else pc.fill_null(pc.less_equal(rows.column("priority"), worst), True)
                rows = rows.filter(enters)
            sample = _sorted(rows if sample is None else pa.concat_tables([sample, rows]), _FIRST).slice(0, n)
            newest = pc.max(batch.column("timestamp")).as_py()
            last = newest if last is None else last if newest is None else max(last, newest)
        if counts:
            keys, sums = added(counts)
            yield _typed("hot", len(keys), keyword=keys, n=sums)
        if seen:
            columns = {c: sample.column(c).combine_chunks() for c in sample.column_names}
            yield _typed("sample", len(sample), n=pa.array([1] * len(sample), pa.int64()), **columns)
            yield _typed("counters", 1, last=pa.array([last], pa.int64()))

    return run


def _keep(k: int, n: int):
    """Of a task's merged rows: the K+1 largest counts, the N first occurrences (repeated ones spelt out),
    one row with the sum of its counts and the newest time."""

    def run(batches):
        hot, sample, total, last, seen = None, None, 0, None, False
        for batch in batches:
            seen = True
            kind = batch.column("kind")
            table = pa.Table.from_batches([batch])
            counts = table.filter(pc.equal(kind, "hot")).select(["keyword", "n"])
            total += pc.sum(counts.column("n")).as_py() or 0
            hot = counts if hot is None else pa.concat_tables([hot, counts])
            if len(hot) > k + 1:
                hot = _sorted(hot, [("n", "descending", "at_end"), ("keyword", "ascending", "at_start")]).slice(0, k + 1)
            drawn = table.filter(pc.equal(kind, "sample")).select(["priority", "uid", "keyword", "n"])
            times = np.minimum(drawn.column("n").to_numpy(), n)
            drawn = drawn.select(["priority", "uid", "keyword"]).take(pa.array(np.repeat(np.arange(len(drawn)), times), pa.int64()))
            sample = _sorted(drawn if sample is None else pa.concat_tables([sample, drawn]), _FIRST).slice(0, n)
            newest = pc.max(table.column("last")).as_py()
            last = newest if last is None else last if newest is None else max(last, newest)
        if seen:
            yield _typed("hot", len(hot), **{c: hot.column(c).combine_chunks() for c in hot.column_names})
            yield _typed("sample", len(sample), **{c: sample.column(c).combine_chunks() for c in sample.column_names})
            yield _typed("counters", 1, n=pa.array([total], pa.int64()), last=pa.array([last], pa.int64()))

    return run


def summarise(events: DataFrame, k: int, n: int, uid_col: str = "uid", seed: str = DEFAULT_SEED, budget: int = BUDGET) -> DataFrame:
    """The snapshot of ``(keyword, timestamp, uid)`` events as one batch, in one scan: typed rows
    (:data:`ROWS`) that equal ``misra_gries``, ``reservoir_sample`` and ``batch_counters`` of them.

    A task holds ``budget`` keyword counts, N rows of the sample and one Arrow batch.
    A keyword with a third of all rows is one row a task in the shuffle. Null keywords are
    counted as one keyword; occurrences with one id are all kept; an empty table has no
    ``hot`` and ``sample`` rows and counters of 0.
    """
    check_k(k)
    check_n(n)
    ship_package(events.sparkSession)
    rows = events.select(
        F.col("keyword").cast("string").alias("keyword"),
        F.col(uid_col).cast("string").alias("uid"),
        priority(uid_col, seed).alias("priority"),
        F.col("timestamp").cast("long").alias("timestamp"),
    )
    merged = (
        rows.mapInArrow(_summarise(n, max(budget, 1)), _PARTIAL)
        .groupBy("kind", "keyword", "priority", "uid")
        .agg(F.sum("n").cast("long").alias("n"), F.max("last").alias("last"))
        .select("kind", "keyword", "priority", "uid", "n", "last")
    )
    kept = merged.mapInArrow(_keep(k, n), _PARTIAL)
    # at most K + N + 2 rows a task from here on
    order = Window.partitionBy("kind").orderBy(F.col("n").desc_nulls_last(), "priority", "uid", "keyword")
    whole = Window.partitionBy("kind")
    hot, sample, counters = (F.col("kind") == x for x in ("hot", "sample", "counters"))
    at = kept.withColumn("place", F.row_number().over(order))
    cut = at.select(
        "*",
        F.coalesce(F.max(F.when(hot & (F.col("place") == k + 1), F.col("n"))).over(whole), F.lit(0)).alias("cut"),
        F.coalesce(F.sum(F.when(counters, F.col("n"))).over(whole), F.lit(0)).alias("total"),
        F.coalesce(F.floor(F.max("last").over(whole) / F.lit(1000)), F.lit(0)).cast("long").alias("newest"),
    )
    return cut.where((hot & (F.col("n") > F.col("cut"))) | (sample & (F.col("place") <= n)) | (counters & (F.col("place") == 1))).select(
        "kind",
        "keyword",
        F.when(hot, F.col("n") - F.col("cut")).alias("value"),
        F.when(hot, F.col("place")).when(sample, F.col("place") - 1).cast("int").alias("at"),
        F.when(counters, F.col("total")).alias("total_processed"),
        F.when(counters, F.col("total")).alias("last_batch_count"),
        F.when(counters, F.col("newest")).alias("last_update_epoch"),
    )


def snapshot_rows(hot: DataFrame, sample: DataFrame | None = None, counters: DataFrame | None = None) -> DataFrame:
    """The typed rows of a snapshot given as frames of ≤ K, ≤ N and one row."""
    rank = Window.orderBy(F.col("approx_count").desc(), F.col("keyword").asc())
    rows = hot.select(
        F.lit("hot").alias("kind"), "keyword", F.col("approx_count").cast("long").alias("value"), F.row_number().over(rank).cast("int").alias("at")
    )
    if sample is not None:
        index = F.col("sample_index").cast("int") if "sample_index" in sample.columns else F.lit(None).cast("int")
        rows = rows.unionByName(sample.select(F.lit("sample").alias("kind"), "keyword", index.alias("at")), allowMissingColumns=True)
    if counters is not None:
        typed = [F.col(c).cast("long").alias(c) for c in COUNTERS if c in counters.columns]
        rows = rows.unionByName(counters.select(F.lit("counters").alias("kind"), *typed), allowMissingColumns=True)
    for c in COUNTERS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("long"))
    return rows
