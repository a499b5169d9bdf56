"""Declared schemas (no inference anywhere)."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# One search message, as carried in the JSON payload.
KEYWORD_EVENT = StructType(
    [
        StructField("keyword", StringType(), True),
        StructField("timestamp", LongType(), True),
    ]
)

# Payload schema used by the file twin of the Kafka source: the same JSON object
# plus an optional occurrence id (Kafka supplies topic/partition/offset instead).
KEYWORD_PAYLOAD = StructType(KEYWORD_EVENT.fields + [StructField("uid", StringType(), True)])

# Misra-Gries state / published hot topics.
MG_STATE = StructType(
    [
        StructField("keyword", StringType(), False),
        StructField("approx_count", LongType(), False),
    ]
)

# Reservoir state: every kept occurrence with its hash priority, and the smallest one ever dropped.
RESERVOIR_STATE = StructType(
    [
        StructField("priority", StringType(), False),
        StructField("uid", StringType(), False),
        StructField("keyword", StringType(), False),
        StructField("dropped", BooleanType(), False),
    ]
)

EXACT_TOP = StructType(
    [
        StructField("keyword", StringType(), False),
        StructField("exact_count", LongType(), False),
    ]
)

SAMPLES = StructType(
    [
        StructField("sample_index", IntegerType(), True),
        StructField("keyword", StringType(), True),
    ]
)

EXACT_STATE = StructType(
    [
        StructField("keyword", StringType(), False),
        StructField("n", LongType(), False),
    ]
)

# Control record (D8): k and n are strings so that bad values can be sent.
CONTROL = StructType(
    [
        StructField("version", LongType(), False),
        StructField("k", StringType(), True),
        StructField("n", StringType(), True),
        StructField("reset_token", LongType(), True),
    ]
)

# A stored part of the exact counts: the epoch that wrote it, its level and its rows at most.
EXACT_RUN = StructType(
    [
        StructField("epoch", LongType(), False),
        StructField("level", IntegerType(), False),
        StructField("rows", LongType(), False),
    ]
)

# Per-epoch log row (ours): the commit record of an epoch and the scalar state the
# reference kept in process globals.
STREAM_LOG = StructType(
    [
        StructField("epoch", LongType(), False),
        StructField("batch_count", LongType(), False),
        StructField("k", IntegerType(), False),
        StructField("n", IntegerType(), False),
        StructField("total_processed", LongType(), False),
        StructField("last_batch_count", LongType(), False),
        StructField("last_update_epoch", LongType(), False),
        StructField("reset_token", LongType(), False),
        StructField("exact_runs", ArrayType(EXACT_RUN, False), False),
        StructField("state_epoch", LongType(), False),
        StructField("snapshot_epoch", LongType(), False),
        StructField("exact_total", LongType(), False),
        StructField("exact_unique", LongType(), False),
        StructField("exact_bytes", LongType(), False),
        StructField("exact_k", IntegerType(), False),
        StructField("mg_error_bound", LongType(), False),
        StructField("control_version", LongType(), False),
    ]
)

# What a batch adds: its keyword counts (kind 'count', column n) and the reservoir after it.
BATCH_STATE = StructType(
    [
        StructField("keyword", StringType(), True),
        StructField("n", LongType(), True),
        StructField("priority", StringType(), True),
        StructField("uid", StringType(), True),
        StructField("kind", StringType(), True),
    ]
)

# Sketch state of one epoch: MG counters (kind 'mg'), reservoir slots (kind 'slot'),
# the smallest occurrence that the reservoir ever dropped (kind 'dropped') and, while
# the exact baseline is kept, the exact counts of its top K and of the slots' keywords
# (kind 'exact').
SKETCH_STATE = StructType(
    [
        StructField("kind", StringType(), False),
        StructField("keyword", StringType(), False),
        StructField("approx_count", LongType(), True),
        StructField("priority", StringType(), True),
        StructField("uid", StringType(), True),
    ]
)

# Fixed names: the published counters' fields must equal the reference's.
COUNTERS = StructType(
    [
        StructField("total_processed", LongType(), False),
        StructField("last_batch_count", LongType(), False),
        StructField("last_update_epoch", LongType(), False),
    ]
)

# Fixed names and defaults: the published metrics' fields must equal the reference's.
EVAL_METRICS_FIELDS = [
    ("topk_recall_at_k", DoubleType(), 0.0),
    ("top1_match", IntegerType(), 0),
    ("overlap_count", LongType(), 0),
    ("reservoir_tvd", DoubleType(), 1.0),
    ("reservoir_similarity", DoubleType(), 0.0),
    ("mg_unique", LongType(), 0),
    ("exact_unique", LongType(), 0),
    ("mg_memory_bytes", LongType(), 0),
    ("exact_memory_bytes", LongType(), 0),
    ("reservoir_memory_bytes", LongType(), 0),
    ("memory_saved_percent", DoubleType(), 0.0),
    ("exact_baseline_enabled", IntegerType(), 0),
]

EVAL_METRICS = StructType([StructField(name, dtype, True) for name, dtype, _ in EVAL_METRICS_FIELDS])

# A published snapshot, one table: record_type is hot_topic | exact_topic | sample | counters | metrics.
SNAPSHOT = StructType(
    [
        StructField("record_type", StringType(), False),
        StructField("keyword", StringType(), True),
        StructField("count", LongType(), True),
        StructField("sample_index", IntegerType(), True),
    ]
    + COUNTERS.fields
    + EVAL_METRICS.fields
    + [StructField("mg_error_bound", LongType(), True)]  # with the counters: no count is short by more
)

# Fixed names. D10: one exported record; a tagged union on record_type.
EXPORT_RECORD = StructType(
    [
        StructField("record_type", StringType(), True),
        StructField("keyword", StringType(), True),
        StructField("approx_count", LongType(), True),
        StructField("rank", IntegerType(), True),
        StructField("sample_index", IntegerType(), True),
        StructField("snapshot_total_processed", LongType(), True),
        StructField("snapshot_last_batch_count", LongType(), True),
        StructField("snapshot_last_update_epoch", LongType(), True),
        StructField("snapshot_exported_at", LongType(), True),
    ]
)

# Fixed names. D11: export metadata.
EXPORT_META = StructType(
    [
        StructField("exported_at", LongType(), True),
        StructField("total_processed", LongType(), True),
        StructField("last_batch_count", LongType(), True),
        StructField("last_update_epoch", LongType(), True),
        StructField("hot_topic_count", LongType(), True),
        StructField("sample_count", LongType(), True),
        StructField("record_count", LongType(), True),
        StructField("jsonl_file", StringType(), True),
    ]
)
