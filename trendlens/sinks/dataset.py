"""JSONL dataset sink with metadata and an index of exports.

Layout under an export root (a folder of the shared store)::

    <prefix>_<YYYYmmdd_HHMMSS>.jsonl/       records, one JSON object per line
    <prefix>_<YYYYmmdd_HHMMSS>.meta.json/   one metadata object
    _index/                                 (jsonl_file, exported_at) per export

Nulls are written as ``null`` and non-ASCII text as is. A snapshot holds at
most K + N records, so each export is written as a single part file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.scalar import clean_prefix, stamp_text
from trendlens.operators.export import export_meta


@dataclass(frozen=True)
class Export:
    jsonl_path: str
    meta_path: str
    jsonl_file: str
    record_count: int


def write_jsonl(frame: DataFrame, path: str, single_file: bool = True) -> None:
    out = frame.repartition(1) if single_file else frame  # a shuffle boundary, not a 1-task upstream
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_dataset(records: DataFrame, root: str, prefix: str, exported_at: int) -> Export:
    """Write the records, then the metadata, then register the export in the index."""
    root = root.rstrip("/")
    spark = records.sparkSession
    cleaned = spark.range(1).select(clean_prefix(F.lit(prefix))).first()[0]
    name = f"{cleaned}_{stamp_text(exported_at)}"
    jsonl_file = f"{name}.jsonl"
    jsonl_path, meta_path = f"{root}/{jsonl_file}", f"{root}/{name}.meta.json"
    write_jsonl(records, jsonl_path)
    from trendlens.sources.dataset import load_dataset

    meta = export_meta(load_dataset(spark, jsonl_path), jsonl_file, exported_at)
    write_jsonl(meta, meta_path)
    meta_row = spark.read.json(meta_path).first()
    spark.createDataFrame([(jsonl_file, int(exported_at))], "jsonl_file string, exported_at long").write.mode(
        "append"
    ).parquet(f"{root}/_index")
    return Export(jsonl_path, meta_path, jsonl_file, int(meta_row["record_count"]))



def export_snapshot(store, root: str, prefix: str, exported_at: int) -> Export:
    """Export the stream's current published snapshot (hot topics, samples, counters of one
    committed epoch) as a JSONL dataset with its metadata; returns the paths and record count."""
    from trendlens.operators.export import export_records
    from trendlens.sources.snapshot import published_epoch, read_counters, read_hot_topics, read_samples

    epoch = published_epoch(store)  # one epoch for all three reads
    records = export_records(
        read_hot_topics(store, epoch), read_samples(store, epoch), read_counters(store, epoch), exported_at
    )
    return write_dataset(records, root, prefix, exported_at)
