"""Starting the streaming fold (K8) and replaying fixed micro-batches through it.

``start_stream`` wires a parsed keyword stream into ``foreachBatch`` with a
checkpoint. ``replay`` drives the same query with the file source: before each
step it writes that step's payload files (and control records), then runs the
query with ``availableNow`` -- the checkpoint remembers the files already seen,
so each step becomes exactly one micro-batch whatever the file times are. Messages
are several times as large as the table they come from: their files are compressed
and go when their micro-batch is committed, so at most one step's are there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trendlens.config import DEFAULT_K, DEFAULT_N, DEFAULT_SEED, freed_shuffles
from trendlens.operators.synth import to_payload
from trendlens.sources.keywords import source_keywords
from trendlens.streaming.control import request_reset, set_control
from trendlens.streaming.fold import EpochFold
from trendlens.streaming.state import EpochStore

#: How a replay writes its messages. A compressed file is read by one task, so files are bounded.
MESSAGE_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1 << 18}


def start_stream(
    events: DataFrame,
    store: EpochStore,
    checkpoint: str,
    k: int = DEFAULT_K,
    n: int = DEFAULT_N,
    enable_exact: bool = True,
    seed: str = DEFAULT_SEED,
    trigger: dict | None = None,
    clock: Callable[[], int] | None = None,
    compact_every: int = 8,
) -> StreamingQuery:
    """K8: append-mode ``foreachBatch`` query over a parsed keyword stream.

    ``trigger`` defaults to a 2-second processing-time trigger; pass
    ``{"availableNow": True}`` to drain what is there and stop.
    """
    fold = EpochFold(store, k, n, enable_exact, seed, compact_every=compact_every, clock=clock)
    return (
        events.writeStream.outputMode("append")
        .foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )


@dataclass
class Step:
    """One micro-batch of a replay: messages, plus control actions applied before it."""

    messages: DataFrame  # raw payload lines (column ``value``) or a stream (keyword, timestamp, uid)
    k: object = None
    n: object = None
    reset: bool = False
    enable_exact: bool | None = None  # None: as the replay


def replay(
    spark: SparkSession,
    steps: list[Step],
    root: str,
    k: int = DEFAULT_K,
    n: int = DEFAULT_N,
    enable_exact: bool = True,
    seed: str = DEFAULT_SEED,
    clock: Callable[[], int] | None = None,
    compact_every: int = 8,
) -> EpochStore:
    """Run each step as one micro-batch of the file-source stream; return the state store."""
    store = EpochStore(spark, f"{root}/store")
    source, checkpoint = f"{root}/source", f"{root}/checkpoint"
    with freed_shuffles(spark):
        for step in steps:
            if step.k is not None or step.n is not None:
                set_control(store, step.k, step.n)
            if step.reset:
                request_reset(store)
            lines = step.messages if "value" in step.messages.columns else to_payload(step.messages)
            lines.select("value").write.mode("append").options(**MESSAGE_FILES).text(source)
            query = start_stream(
                source_keywords(spark, "text", source),
                store,
                checkpoint,
                k,
                n,
                enable_exact if step.enable_exact is None else step.enable_exact,
                seed,
                trigger={"availableNow": True},
                clock=clock,
                compact_every=compact_every,
            )
            query.awaitTermination()
            if query.exception() is not None:
                raise RuntimeError(f"replay step failed: {query.exception()}")
            store.remove_folder(source)  # all of it is committed
    return store
