"""The micro-batch fold (K4-K6, P11, S11, S16) as a ``foreachBatch`` callable.

Per epoch e, in the reference's order -- config, reset, rows, counters, publish:

1. the newest log row ≤ e: if it is e, the epoch is already committed and a
   redelivery changes nothing; otherwise it is the previous state;
2. the newest control record, if the state hasn't applied it yet: resize (K down
   keeps the K largest counters, counts unchanged; N changes how many slots are
   shown), then reset if its token is new (sketches, exact counts and counters
   cleared; k, n kept);
3. one pass over the source folds the batch into keyword counts, in which the
   occurrences whose priority is small stay apart; its size is observed on the way.
   The reservoir comes from those few; only where they are too few for it, as in a
   small batch, the batch is read again. One aggregate by keyword brings
   together those counts, the MG counters and -- if enabled -- the exact counts
   of the batch's keywords, and gives the sketch state;
4. from that bounded state one write publishes the snapshot (one table: hot
   topics, exact top-K, samples, counters, metrics), and last the log row commits
   the epoch.

An empty batch publishes nothing and keeps the counters, but config and reset
still apply; a reset then publishes an empty snapshot that keeps the previous
counters (those keys were never cleared by a reset). An epoch with nothing to
change writes only its log row, which points at the earlier state.

Exact baseline. Counts only grow, so the new top K are among the old ones and
the batch's keywords, and so are the keywords of the sample: the state tracks
the exact counts of these, and the log row the numbers of keywords and bytes.
The counts themselves are runs: each epoch adds one, and ``compact_every`` runs
of a level become one of the next, so a count is rewritten a logarithmic number
of times. Large runs are stored in hash buckets, of which a batch reads those of
its keywords. An epoch therefore costs what its batch does, whatever the number
of keywords so far; only a larger K reads all runs once. The baseline is kept
and published only while it covers every occurrence since the start or the last
reset; otherwise the metrics are those of a stream without it.

Error bound. A prune takes its cut from every counter, and a smaller K drops
counters of at most the largest dropped count. The sum of both since the last
reset bounds how far any published count, or the 0 of a keyword without one, is
below the true count; it is in the log and with the snapshot's counters.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import astuple, dataclass, fields, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trendlens.config import BROADCAST_ROW_LIMIT, DEFAULT_K, DEFAULT_N, DEFAULT_SEED, RESERVOIR_SLOTS
from trendlens.functions.scalar import payload_bytes
from trendlens.operators import evaluate as ev
from trendlens.operators import exact as ex
from trendlens.operators import misra_gries as mg
from trendlens.operators import reservoir as rs
from trendlens.schema import BATCH_STATE, EXACT_STATE, MG_STATE, RESERVOIR_STATE, SKETCH_STATE, SNAPSHOT, STREAM_LOG
from trendlens.streaming.control import latest_control, parse_setting
from trendlens.streaming.state import EpochStore


#: Rows of a bucket of a merged run, and buckets of a run at most.
BUCKET_ROWS = 1 << 16
MAX_BUCKETS = 1 << 12
#: Priorities below this, one in 1,024, stay apart from the counts of a batch.
SMALL_PRIORITY = "004"
#: States of up to so many rows are handled and written by one task.
ONE_TASK_ROWS = 1_000_000


@dataclass(frozen=True)
class Run:
    """A stored part of the exact counts."""

    epoch: int
    level: int
    rows: int  # at most

    @property
    def buckets(self) -> int:
        return min(MAX_BUCKETS, 1 << max(0, (self.rows - 1) // BUCKET_ROWS).bit_length()) if self.level else 1


@dataclass(frozen=True)
class Meta:
    """Scalar state after an epoch (one log row)."""

    epoch: int
    batch_count: int
    k: int
    n: int
    total_processed: int = 0
    last_batch_count: int = 0
    last_update_epoch: int = 0
    reset_token: int = 0
    exact_runs: tuple[Run, ...] = ()  # levels fall
    state_epoch: int = -1  # epoch whose sketch state is current (-1: empty)
    snapshot_epoch: int = -1  # epoch whose snapshot is published (-1: none)
    exact_total: int = 0  # occurrences that the exact counts cover
    exact_unique: int = 0  # their keywords
    exact_bytes: int = 0  # payload bytes of those
    exact_k: int = 0  # how many of the largest exact counts the sketch state tracks
    mg_error_bound: int = 0  # no count is short by more
    control_version: int = 0  # the newest control record that was applied

    @property
    def exact_base_epoch(self) -> int:
        return self.exact_runs[0].epoch if self.exact_runs and self.exact_runs[0].level else -1

    @property
    def exact_epochs(self) -> tuple[int, ...]:
        return tuple(r.epoch for r in self.exact_runs if r.epoch != self.exact_base_epoch)

    def row(self) -> tuple:
        own = {f.name: getattr(self, f.name) for f in fields(self)}
        own["exact_runs"] = [astuple(r) for r in self.exact_runs]
        return tuple(own[name] for name in STREAM_LOG.fieldNames())

    @staticmethod
    def from_row(r) -> "Meta":
        own = r.asDict()
        return Meta(**own | {"exact_runs": tuple(Run(*run) for run in own["exact_runs"])})


def mg_of(sketch: DataFrame) -> DataFrame:
    return sketch.where(F.col("kind") == "mg").select("keyword", "approx_count")


def slots_of(sketch: DataFrame) -> DataFrame:
    mark = F.col("kind") == "dropped"
    return sketch.where((F.col("kind") == "slot") | mark).select("priority", "uid", "keyword", mark.alias("dropped"))


def tracked_of(sketch: DataFrame) -> DataFrame:
    return sketch.where(F.col("kind") == "exact").select("keyword", F.col("approx_count").alias("exact_count"))


def counts_of(batch: DataFrame) -> DataFrame:
    """The counts ``(keyword, n)`` of a batch, whose sum by keyword counts: an occurrence kept apart has a row of its own."""
    return batch.where(F.col("kind").isin("count", "apart")).select("keyword", "n")


def slot_rows(slots: DataFrame) -> DataFrame:
    return slots.select(F.when(F.col("dropped"), "dropped").otherwise("slot").alias("kind"), "keyword", "priority", "uid")


def as_sketch(mg_state: DataFrame, slots: DataFrame, tracked: DataFrame) -> DataFrame:
    """The typed rows of a sketch state; ``slots`` as :func:`slot_rows`."""
    rows = mg_state.select(F.lit("mg").alias("kind"), "keyword", "approx_count")
    rows = rows.unionByName(tracked.select(F.lit("exact").alias("kind"), "keyword", F.col("exact_count").alias("approx_count")))
    return rows.unionByName(slots.select("kind", "keyword", "priority", "uid"), allowMissingColumns=True)


class EpochFold:
    """``foreachBatch`` body: ``fold(batch_df, epoch_id)``.

    ``batch_df`` must already be parsed and admitted, with a ``keyword`` column
    and, where the source has one, a ``uid`` per occurrence.
    """

    def __init__(
        self,
        store: EpochStore,
        k: int = DEFAULT_K,
        n: int = DEFAULT_N,
        enable_exact: bool = True,
        seed: str = DEFAULT_SEED,
        min_slots: int = RESERVOIR_SLOTS,
        compact_every: int = 8,
        clock: Callable[[], int] | None = None,
    ):
        self.store = store
        self.k0, self.n0 = k, n
        self.enable_exact = enable_exact
        self.seed = seed
        self.min_slots = min_slots
        self.compact_every = max(2, compact_every)
        self.clock = clock or (lambda: int(time.time()))
        self._last: Meta | None = None  # the epoch that this object committed last

    # -- state access --------------------------------------------------------------

    def meta_before(self, epoch: int) -> tuple[bool, Meta]:
        """(committed?, state to start from) for epoch e -- one read of the log."""
        if self._last is not None and self._last.epoch in (int(epoch), int(epoch) - 1):
            return self._last.epoch == int(epoch), self._last
        row = self.store.last_entry(epoch)
        if row is None:
            return False, Meta(-1, 0, self.k0, self.n0)
        meta = Meta.from_row(row)
        return meta.epoch == int(epoch), meta

    def _commit(self, meta: Meta) -> None:
        self.store.commit(meta.row())
        self._last = meta

    def _run(self, run: Run) -> DataFrame:
        """The counts of one run, with ``bucket`` where it has several."""
        if run.level:
            rows = self.store.read("state/exact_base", run.epoch, EXACT_STATE)
            return rows if run.buckets > 1 else rows.select("keyword", "n")
        return counts_of(self.store.read("state/batch", run.epoch, BATCH_STATE))

    def exact_state(self, meta: Meta) -> DataFrame:
        """Cumulative exact counts ``(keyword, n)``: the sum of all runs."""
        if not meta.exact_runs:
            return self.store.spark.createDataFrame([], EXACT_STATE)
        return ex.sum_counts([self._run(r).select("keyword", "n") for r in meta.exact_runs])

    def _known(self, meta: Meta, keys: DataFrame, n_keys: int) -> list[DataFrame]:
        """Of each run the counts of ``keys``; of a bucketed run only their buckets are read."""
        hint = F.broadcast if n_keys <= BROADCAST_ROW_LIMIT else lambda frame: frame
        out = []
        plain = [self._run(r) for r in meta.exact_runs if r.buckets == 1]
        if plain:
            rows = plain[0]
            for more in plain[1:]:
                rows = rows.unionByName(more)
            out.append(rows.join(hint(keys), "keyword", "left_semi"))
        for r in meta.exact_runs:
            if r.buckets > 1:
                wanted = keys.withColumn("bucket", _bucket(r.buckets))
                out.append(self._run(r).join(hint(wanted), ["bucket", "keyword"], "left_semi").select("keyword", "n"))
        return out

    def _compacted(self, meta: Meta) -> Meta:
        """Merge the runs of the lowest levels while ``compact_every`` of one level are there; one write."""
        level, merged = 0, []
        while sum(r.level == level for r in meta.exact_runs) + (level > 0 and bool(merged)) >= self.compact_every:
            merged = [r for r in meta.exact_runs if r.level <= level]
            level += 1
        if not merged:
            return meta
        run = Run(meta.epoch, level, sum(r.rows for r in merged))
        rows = ex.sum_counts([self._run(r).select("keyword", "n") for r in merged])
        out = self.store.epoch_path("state/exact_base", meta.epoch)
        if run.buckets == 1:
            rows.sortWithinPartitions("keyword").write.mode("overwrite").parquet(out)
        else:
            rows = rows.withColumn("bucket", _bucket(run.buckets)).repartition("bucket").sortWithinPartitions("bucket", "keyword")
            rows.write.mode("overwrite").partitionBy("bucket").parquet(out)
        return replace(meta, exact_runs=tuple(r for r in meta.exact_runs if r.level >= level) + (run,))

    def sketch(self, meta: Meta) -> DataFrame:
        return self.store.read("state/sketch", meta.state_epoch, SKETCH_STATE)

    def slots_kept(self, n: int) -> int:
        return max(self.min_slots, n)

    def keeps_exact(self, meta: Meta) -> bool:
        """Whether the exact baseline is on and covers all that was processed.

        A stream that ran without it for a while can't make up for the batches it
        did not count, so the baseline stays off until a reset.
        """
        return self.enable_exact and meta.exact_total == meta.total_processed

    # -- the fold ------------------------------------------------------------------

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        store, spark, e = self.store, self.store.spark, int(epoch_id)
        committed, meta = self.meta_before(e)
        if committed:
            return
        sketch = self.sketch(meta)
        mg_state, slots, tracked = mg_of(sketch), slots_of(sketch), tracked_of(sketch)

        # 1. runtime config (S8, K5): invalid values are ignored, field by field.
        changed = reset = False
        ctl = latest_control(store, meta.control_version)
        if ctl is not None:
            meta = replace(meta, control_version=ctl.version)
            new_k = parse_setting(ctl.k, meta.k)
            if new_k != meta.k:
                if new_k < meta.k:  # the largest counter that goes bounds what its keyword loses
                    gone = mg_state.orderBy(F.col("approx_count").desc(), "keyword").offset(new_k).limit(1).first()
                    meta = replace(meta, mg_error_bound=meta.mg_error_bound + (int(gone["approx_count"]) if gone else 0))
                mg_state = mg.mg_resize(mg_state, new_k)  # K down: keep the K largest; K up: no change
                meta, changed = replace(meta, k=new_k), True
            new_n = parse_setting(ctl.n, meta.n)
            if new_n != meta.n:
                slots = rs.reservoir_trim(slots, self.slots_kept(new_n))
                meta, changed = replace(meta, n=new_n), True
            # 2. reset (K6)
            reset = ctl.reset_token > meta.reset_token
        if reset:
            mg_state = spark.createDataFrame([], MG_STATE)
            slots = spark.createDataFrame([], RESERVOIR_STATE)
            tracked = tracked.limit(0)
            meta = replace(
                meta, total_processed=0, reset_token=ctl.reset_token, exact_runs=(), exact_total=0, exact_unique=0, exact_bytes=0, exact_k=0, mg_error_bound=0,
            )
            changed = True

        # 3. the batch: its counts and the reservoir after it.
        # A message without an occurrence id (a plain {"keyword", "timestamp"}
        # payload) gets "e<epoch>:<row id>": unique across epochs, and the same when
        # the epoch is replayed over the same input splits.
        uid = F.col("uid").cast("string") if "uid" in batch.columns else F.lit(None).cast("string")
        fallback = F.concat(F.lit(f"e{e}:"), F.monotonically_increasing_id().cast("string"))
        # The rows aren't kept for a second pass: a large batch is cheaper parsed twice than held.
        rows = batch.select("keyword", F.coalesce(uid, fallback).alias("uid"))
        meta = replace(meta, epoch=e, batch_count=0)
        if rows.isEmpty():  # an observation of no rows at all may never arrive
            self._empty_epoch(meta, mg_state, slots, tracked, changed, reset)
            return
        batch_count, n_rows = self._count(meta, rows, slots)
        meta = replace(meta, batch_count=batch_count)
        exact = self.keeps_exact(meta)
        meta = self._fold(meta, mg_state, tracked, exact, n_rows)
        if exact:
            meta = self._compacted(meta)

        # 4. counters, publish (S11), commit.
        meta = replace(
            meta,
            total_processed=meta.total_processed + batch_count,
            last_batch_count=batch_count,
            last_update_epoch=int(self.clock()),
            snapshot_epoch=e,
        )
        self._publish(meta)
        self._commit(meta)

    def _count(self, meta: Meta, rows: DataFrame, slots: DataFrame) -> tuple[int, int]:
        """Write the batch's counts and the reservoir after it; its size, and its rows of counts."""
        out = self.store.epoch_path("state/batch", meta.epoch)
        kept = self.slots_kept(meta.n)
        held = slots.agg(F.min(F.when(F.col("dropped"), F.col("priority"))).alias("mark"), F.count_if(F.col("priority") < SMALL_PRIORITY).alias("small")).first()
        mark = held["mark"]  # rows after it stay out
        certain = mark is not None and mark < SMALL_PRIORITY
        small = F.col("priority") <= mark if certain else F.col("priority") < SMALL_PRIORITY
        apart = rs.with_priority(rows, "uid", self.seed).select("keyword", F.when(small, F.col("priority")).alias("priority"), F.when(small, F.col("uid")).alias("uid"))
        counts = apart.groupBy("keyword", "priority", "uid").agg(F.count(F.lit(1)).alias("n"))
        seen = Observation()
        found = F.coalesce(F.sum(F.when(F.col("uid").isNotNull(), F.col("n"))), F.lit(0)).cast("long")
        counts = counts.observe(seen, F.sum("n").alias("rows"), F.count(F.lit(1)).alias("groups"), found.alias("apart"))
        kind = F.when(F.col("uid").isNull(), "count").otherwise("apart").alias("kind")
        counts.select("keyword", "n", "priority", "uid", kind).write.mode("overwrite").partitionBy("kind").parquet(out)
        got = seen.get
        if certain or int(got["apart"]) + int(held["small"]) > kept:
            few = self.store.read("state/batch", meta.epoch, BATCH_STATE).where(F.col("kind") == "apart")
            # equal occurrences beyond those that fit can't be in a slot, nor be the mark
            copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("n"), F.lit(kept + 1).cast("long"))))
            rows = few.select("keyword", "uid", copies.alias("copy")).drop("copy")
        new_slots = slot_rows(rs.reservoir_update(slots, rows, "uid", self.seed, kept))
        new_slots = new_slots.select("keyword", F.lit(None).cast("long").alias("n"), "priority", "uid", "kind")
        new_slots.write.mode("append").partitionBy("kind").parquet(out)
        return int(got["rows"]), int(got["groups"])

    def _is_little(self, meta: Meta) -> bool:
        return 2 * meta.k + 2 * self.slots_kept(meta.n) <= ONE_TASK_ROWS

    def _narrow(self, frame: DataFrame, meta: Meta) -> DataFrame:
        """One task for what K and N bound, as long as that is little: no shuffles among a few rows."""
        return frame.coalesce(1) if self._is_little(meta) else frame

    def _gathered(self, frame: DataFrame, meta: Meta) -> DataFrame:
        """The same for a few rows picked from many: the tasks that pick them stay as they are."""
        return frame.repartition(1) if self._is_little(meta) else frame

    def _fold(self, meta: Meta, mg_state: DataFrame, tracked: DataFrame, exact: bool, n_rows: int) -> Meta:
        """Write the sketch state after the batch; the frame ``together`` has every keyword that it may concern, once.

        ``n_rows``: rows of the batch's counts, and so its keywords at most.
        """
        store, e = self.store, meta.epoch
        batch = store.read("state/batch", e, BATCH_STATE)
        counts, slots = counts_of(batch), batch.where(F.col("kind").isin("slot", "dropped"))
        parts = [counts.select("keyword", F.col("n").alias("d")), mg_state.select("keyword", F.col("approx_count").alias("m"))]
        grown = meta.k > meta.exact_k
        if exact:
            runs = [self._run(r).select("keyword", "n") for r in meta.exact_runs] if grown else self._known(meta, counts.select("keyword"), n_rows)
            parts += [r.select("keyword", F.col("n").alias("x")) for r in runs]
            parts += [tracked.select("keyword", F.col("exact_count").alias("t")), slots.select("keyword", F.lit(1).cast("long").alias("s"))]
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more, allowMissingColumns=True)
        sums = [F.sum(c).alias(c) for c in "dmx" if c in rows.columns] + [F.max(c).alias(c) for c in "ts" if c in rows.columns]
        together = rows.groupBy("keyword").agg(*sums)
        zero = F.lit(0).cast("long")
        merged = together.where("d IS NOT NULL OR m IS NOT NULL").select("keyword", (F.coalesce("d", zero) + F.coalesce("m", zero)).alias("n"))
        cut = Observation()
        new_mg = mg.mg_prune(merged, meta.k, cut_seen=cut)
        grew = None
        new_tracked = tracked.limit(0)
        if exact:
            x = F.col("x") if "x" in rows.columns else F.lit(None).cast("long")
            total = F.when(F.col("d").isNotNull() | x.isNotNull(), F.coalesce("d", zero) + F.coalesce(x, zero)).otherwise(F.col("t"))
            is_new = F.col("d").isNotNull() & x.isNull()
            own = together.select("keyword", total.alias("exact_count"), is_new.alias("is_new"), "s").where("exact_count IS NOT NULL")
            grew = Observation()
            size = F.coalesce(F.sum(F.when(F.col("is_new"), payload_bytes("keyword"))), zero).cast("long")
            top = ex.exact_topk(own.observe(grew, F.count_if("is_new").alias("keys"), size.alias("bytes")), meta.k)
            held = self._gathered(own.where("s IS NOT NULL").select("keyword", "exact_count"), meta)
            new_tracked = self._narrow(top.unionByName(held), meta).groupBy("keyword").agg(F.max("exact_count").alias("exact_count"))
        state = as_sketch(new_mg, slots, new_tracked)
        self._narrow(state, meta).write.mode("overwrite").parquet(store.epoch_path("state/sketch", e))
        meta = replace(meta, state_epoch=e, mg_error_bound=meta.mg_error_bound + int(cut.get["cut"]))
        if not exact:
            return meta
        more = grew.get
        return replace(
            meta,
            exact_runs=meta.exact_runs + (Run(e, 0, n_rows),),
            exact_total=meta.exact_total + meta.batch_count,
            exact_unique=meta.exact_unique + int(more["keys"]),
            exact_bytes=meta.exact_bytes + int(more["bytes"]),
            exact_k=meta.k,
        )

    def _empty_epoch(self, meta: Meta, mg_state: DataFrame, slots: DataFrame, tracked: DataFrame, changed: bool, reset: bool) -> None:
        """Nothing counted; persist resized / reset state, publish only on reset."""
        store, e = self.store, meta.epoch
        if changed:
            store.write("state/sketch", self._narrow(as_sketch(mg_state, slot_rows(slots), tracked), meta), e)
            meta = replace(meta, state_epoch=e)
        if reset:
            prev = store.read("snapshot", meta.snapshot_epoch, SNAPSHOT)
            kept = prev.where(F.col("record_type") == "counters")  # counters keys survive a reset
            store.write("snapshot", kept.withColumn("mg_error_bound", F.lit(0).cast("long")), e, bounded=True)
            meta = replace(meta, snapshot_epoch=e)
        self._commit(meta)

    def _publish(self, meta: Meta) -> None:
        """One snapshot table per epoch: written in one job, visible all at once."""
        store, spark, e = self.store, self.store.spark, meta.epoch
        sketch = self._narrow(store.read("state/sketch", e, SKETCH_STATE), meta)
        hot = mg_of(sketch)
        samples = rs.reservoir_view(slots_of(sketch), meta.n)
        counters = spark.range(1, numPartitions=1).select(
            F.lit(meta.total_processed).cast("long").alias("total_processed"),
            F.lit(meta.last_batch_count).cast("long").alias("last_batch_count"),
            F.lit(meta.last_update_epoch).cast("long").alias("last_update_epoch"),
        )
        parts = [
            hot.select(F.lit("hot_topic").alias("record_type"), "keyword", F.col("approx_count").alias("count")),
            samples.select(F.lit("sample").alias("record_type"), "keyword", "sample_index"),
            counters.select(F.lit("counters").alias("record_type"), "*", F.lit(meta.mg_error_bound).cast("long").alias("mg_error_bound")),
        ]
        if self.keeps_exact(meta):
            tracked = tracked_of(sketch)
            top = ex.exact_topk(tracked, meta.k)
            parts.append(top.select(F.lit("exact_topic").alias("record_type"), "keyword", F.col("exact_count").alias("count")))
            side = ev.tracked_side(tracked, samples, meta.exact_unique, meta.exact_bytes, meta.exact_total)
            metrics = ev.metrics_row(hot, top, side, samples, counters)
        else:
            metrics = ev.evaluate(hot, None, samples, counters, meta.k)
        parts.append(metrics.select(F.lit("metrics").alias("record_type"), "*"))
        snapshot = parts[0]
        for p in parts[1:]:
            snapshot = snapshot.unionByName(p, allowMissingColumns=True)
        store.write("snapshot", self._narrow(snapshot.select(*SNAPSHOT.fieldNames()), meta), e)


def _bucket(n: int):
    return F.pmod(F.xxhash64("keyword"), F.lit(n)).cast("int")
