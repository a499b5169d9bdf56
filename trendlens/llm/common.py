"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.config import new_work_dir, ship_package

#: A key with more than one row in HEAVY_SHARE counts as heavy; at most that many keys can be.
HEAVY_SHARE = 1000


#: What this Python worker keeps between tasks: one operator's tables and caches, so that a worker doesn't gather those of all it ever ran.
_KEPT: dict = {}


def kept(key, make):
    """``make()``, kept by the worker under ``key`` until ``let_go`` or another key."""
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Free what earlier tasks left in this worker, and give freed memory back to the system, which an idle worker would keep."""
    import ctypes

    import pyarrow as pa

    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame under the shared folder and read it back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = new_work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make the package importable in the executors' Python workers."""
    ship_package(spark)


def unskewed_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows to a side that is unique on ``keys``, whatever share of the rows one key holds.

    ``weight`` is the right side's count of left rows per key, ``total`` their sum.
    Keys above 1/1000 of all rows are at most 1000, so that part is broadcast;
    every other key is small and goes through an ordinary shuffle join. ``how``
    is ``inner`` or ``left``.
    """
    heavy = right.where(F.col(weight) * HEAVY_SHARE > total)
    light = right.where(F.col(weight) * HEAVY_SHARE <= total)
    a = left.join(F.broadcast(heavy), keys)
    b = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys, how)
    return a.unionByName(b)
