"""Defaults, session helpers and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
DEFAULT_K = 50  # Misra-Gries counters
DEFAULT_N = 20  # reservoir slots shown
# Ours: slots a reservoir state keeps at least, so that N can grow so far without waiting for new rows.
RESERVOIR_SLOTS = 200
# Ours: the reference draws unseeded randomness; we hash with a seed so that a
# retried task or a replayed epoch produces the same sample.
DEFAULT_SEED = "42"

# Largest row count we are willing to broadcast for a side whose size is
# only known at run time (checked before the hint is applied).
BROADCAST_ROW_LIMIT = 1_000_000


def bounded_broadcast(frame: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint for a caller-supplied side, only after checking its size.

    Counting the rows is one small job on a frame that is meant to be small;
    beyond ``limit`` the frame is returned as is and Spark plans a shuffle join.
    """
    return F.broadcast(frame) if frame.limit(limit + 1).count() <= limit else frame


def session(master: str = "local[*]", app: str = "trendlens", shuffle_partitions: int = 8) -> SparkSession:
    """A session with the settings the library assumes (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: With this setting Spark removes a query's shuffle files when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries built here leave no shuffle files behind; otherwise these stay until the driver happens to collect its garbage.

    A frame that is built here and read again later computes its shuffles anew.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Written tables (stream state, exports, lineage cuts) live under it so that
    any executor can read them after a node is lost. Only when the setting is
    absent and the session is local (tests) do we create a folder and register
    it as the checkpoint dir; on a cluster a missing setting raises.
    """
    try:
        root = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - key absent
        root = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="trendlens-")
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared root for one run."""
    return f"{shared_root(spark)}/trendlens/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the executors' Python workers, once per application.

    Operators that run Python on the executors (the Arrow sketch) need it there;
    the package is zipped into the shared folder and added with ``addPyFile``.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): the server ships code
        return
    if sc.applicationId in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    target = new_work_dir(spark, "pyfiles")
    local = target[len("file:"):] if target.startswith("file:") else target
    if "://" in local:  # a remote shared store: build the zip locally, Spark uploads it
        local = tempfile.mkdtemp(prefix="trendlens-pyfiles-")
    os.makedirs(local, exist_ok=True)
    zip_path = os.path.join(local, "trendlens.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package_dir)))
    sc.addPyFile(zip_path)
    _SHIPPED.add(sc.applicationId)


def check_k(k: int) -> int:
    if not isinstance(k, int) or isinstance(k, bool) or k <= 0:
        raise ValueError(f"k must be a positive integer, got {k!r}")
    return k


def check_n(n: int) -> int:
    if not isinstance(n, int) or isinstance(n, bool) or n <= 0:
        raise ValueError(f"n must be a positive integer, got {n!r}")
    return n
