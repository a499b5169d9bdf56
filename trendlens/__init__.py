"""trendlens: hot-topic detection and fair stream sampling as Spark DataFrame operators.

Layout
------
- ``sources``    keyword streams (file/Kafka sources, JSON parsing, stand-in streams
                 derived from tables), published-snapshot and dataset readers
- ``operators``  Misra-Gries (mergeable, per-partition sketch, verified), reservoir
                 sampling, exact baseline, accuracy evaluation, operational metrics,
                 export records, traffic synthesis
- ``functions``  scalar column functions (byte formatting, prefix cleaning, typed
                 parsing with defaults, freshness)
- ``sinks``      JSONL dataset and metadata writers
- ``streaming``  the epoch-keyed micro-batch fold (``foreachBatch``), control table,
                 runtime resize / reset, stream start and batch replay
- ``plans``      the registered queries and their DuckDB oracle SQL

Every operator is ``DataFrame -> DataFrame``; nothing event-sized is collected.
"""

from trendlens.config import DEFAULT_K, DEFAULT_N, DEFAULT_SEED, RESERVOIR_SLOTS

__all__ = ["DEFAULT_K", "DEFAULT_N", "DEFAULT_SEED", "RESERVOIR_SLOTS"]
