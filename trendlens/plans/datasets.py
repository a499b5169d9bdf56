"""Registered dataset queries: export records, JSONL round trip, metadata, views, readers.

The snapshot exported is the search stream's (MG K = 50, reservoir N = 20,
one-batch counters). Written datasets go to a fresh folder of the shared root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.config import DEFAULT_K, DEFAULT_N, DEFAULT_SEED, new_work_dir
from trendlens.functions.scalar import clean_prefix, stamp_text
from trendlens.operators import export as xp
from trendlens.operators.summaries import summarise
from trendlens.plans import sql as S
from trendlens.plans.operations import _SNAP, snapshot
from trendlens.plans.registry import register
from trendlens.sinks.dataset import write_dataset
from trendlens.sources.dataset import load_dataset, load_latest, load_meta
from trendlens.sources.keywords import event_type_stream, read_table
from trendlens.sources.snapshot import parse_counts

K, N, SEED = DEFAULT_K, DEFAULT_N, DEFAULT_SEED
# Fixed export times of the registered queries (repeatable results).
EXPORTED_AT = 1_735_689_600
EXPORTED_AT_EARLIER = 1_735_603_200
PREFIX = "search_snapshot"


def _records_sql(mg_cte: str, r_cte: str, cnt_cte: str, exported_at: int) -> str:
    return f"""SELECT 'hot_topic' AS record_type, keyword, approx_count,
  CAST(row_number() OVER (ORDER BY approx_count DESC, keyword) AS INTEGER) AS rank, NULL::INTEGER AS sample_index,
  total_processed AS snapshot_total_processed, last_batch_count AS snapshot_last_batch_count,
  last_update_epoch AS snapshot_last_update_epoch, CAST({exported_at} AS BIGINT) AS snapshot_exported_at
FROM {mg_cte}, {cnt_cte}
UNION ALL
SELECT 'sample', keyword, NULL::BIGINT, NULL::INTEGER, sample_index, total_processed, last_batch_count,
  last_update_epoch, CAST({exported_at} AS BIGINT) FROM {r_cte}, {cnt_cte}"""


_RECORDS = S.with_(*_SNAP, "rec AS (" + _records_sql("mg", "r", "cnt", EXPORTED_AT) + ")")


def search_records(spark: SparkSession, sf_dir: str, exported_at: int = EXPORTED_AT) -> DataFrame:
    return xp.snapshot_records(snapshot(spark, sf_dir), exported_at)


_EXPORTS: dict[tuple, tuple] = {}


def _exported(spark: SparkSession, sf_dir: str):
    """The search-stream snapshot written as a dataset; once per session and data folder,
    shared by the dataset view keys."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _EXPORTS:
        root = new_work_dir(spark, "export")
        _EXPORTS[key] = (root, write_dataset(search_records(spark, sf_dir), root, PREFIX, EXPORTED_AT))
    return _EXPORTS[key]


@register("export_records", _RECORDS + "SELECT * FROM rec")
def q_export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + U2 + W1 + W2 + J6: hot-topic and sample records of one snapshot."""
    return search_records(spark, sf_dir)


@register("dataset_roundtrip", _RECORDS + "SELECT * FROM rec")
def q_dataset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + S9: write the records as JSONL (nulls kept), read them back with the declared schema."""
    _, export = _exported(spark, sf_dir)
    return load_dataset(spark, export.jsonl_path)


@register(
    "dataset_meta",
    _RECORDS
    + f"""SELECT CAST({EXPORTED_AT} AS BIGINT) AS exported_at, max(snapshot_total_processed) AS total_processed,
  max(snapshot_last_batch_count) AS last_batch_count, max(snapshot_last_update_epoch) AS last_update_epoch,
  count(*) FILTER (WHERE record_type = 'hot_topic') AS hot_topic_count,
  count(*) FILTER (WHERE record_type = 'sample') AS sample_count, count(*) AS record_count,
  '{PREFIX}_{stamp_text(EXPORTED_AT)}.jsonl' AS jsonl_file FROM rec""",
)
def q_dataset_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S13 + A15: the metadata object written next to the records, read back."""
    _, export = _exported(spark, sf_dir)
    return load_meta(spark, export.meta_path)


@register("dataset_latest", _RECORDS + "SELECT * FROM rec")
def q_dataset_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two exports (event types earlier, search stream later) the loader picks the newest."""
    root = new_work_dir(spark, "export")
    ev = event_type_stream(read_table(spark, sf_dir, "events"))
    earlier = xp.snapshot_records(summarise(ev, K, N, "uid", SEED), EXPORTED_AT_EARLIER)
    write_dataset(earlier, root, PREFIX, EXPORTED_AT_EARLIER)
    write_dataset(search_records(spark, sf_dir), root, PREFIX, EXPORTED_AT)
    return load_latest(spark, root)


@register(
    "dataset_hot_view",
    _RECORDS + "SELECT keyword, approx_count, rank FROM rec WHERE record_type = 'hot_topic'",
)
def q_dataset_hot_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: hot-topic view of a loaded dataset."""
    _, export = _exported(spark, sf_dir)
    return xp.hot_view(load_dataset(spark, export.jsonl_path))


@register(
    "dataset_sample_view",
    _RECORDS + "SELECT keyword, sample_index FROM rec WHERE record_type = 'sample'",
)
def q_dataset_sample_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: sample view of a loaded dataset."""
    _, export = _exported(spark, sf_dir)
    return xp.sample_view(load_dataset(spark, export.jsonl_path))


@register(
    "dataset_preview",
    _RECORDS + "SELECT keyword, approx_count, rank FROM rec WHERE record_type = 'hot_topic' ORDER BY rank LIMIT 10",
)
def q_dataset_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loader's preview -- the first 10 hot topics by rank."""
    _, export = _exported(spark, sf_dir)
    return xp.preview(load_dataset(spark, export.jsonl_path), 10)


@register("training_inputs", _RECORDS + "SELECT keyword AS text FROM rec WHERE record_type = 'sample'")
def q_training_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"text": keyword}`` inputs from the sample records of a loaded dataset."""
    _, export = _exported(spark, sf_dir)
    return xp.training_inputs(load_dataset(spark, export.jsonl_path))


@register(
    "clean_prefix",
    r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(url, '[^\p{L}\p{N}_-]', '_', 'g'), '_'), ''), 'snapshot') AS prefix
FROM pages""",
)
def q_clean_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every page URL cleaned into a file-name prefix."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", clean_prefix(F.col("url")).alias("prefix"))


@register("read_hot_topics", _RECORDS + "SELECT keyword, approx_count FROM rec WHERE record_type = 'hot_topic'")
def q_read_hot_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + P4: (keyword, count) pairs of an exported snapshot read back as text; pairs whose
    count is not an integer (every sample record's) are dropped, the rest sorted by count."""
    _, export = _exported(spark, sf_dir)
    text = spark.read.schema("record_type string, keyword string, approx_count string").json(export.jsonl_path)
    return parse_counts(text.select("keyword", "approx_count"), "approx_count")
