"""Readers of exported datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlens.schema import EXPORT_META, EXPORT_RECORD


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Exported JSONL records with the declared schema (no inference)."""
    return spark.read.schema(EXPORT_RECORD).json(path)


def load_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXPORT_META).json(path)


def latest_export(spark: SparkSession, root: str) -> str | None:
    """The newest export by file name (names carry the time stamp), or None.

    Whoever wrote it: ``*.jsonl`` files count, and folders of that name once their
    writer has finished them. Only names are listed, no record is read.
    """
    root = root.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(root)):
        return None
    found = [s for s in fs.listStatus(path(root)) if s.getPath().getName().endswith(".jsonl")]
    done = [s.getPath().getName() for s in found if s.isFile() or fs.exists(path(s.getPath(), "_SUCCESS"))]
    return f"{root}/{max(done)}" if done else None


def load_latest(spark: SparkSession, root: str) -> DataFrame:
    path = latest_export(spark, root)
    if path is None:
        raise FileNotFoundError(f"no export under {root}")
    return load_dataset(spark, path)
