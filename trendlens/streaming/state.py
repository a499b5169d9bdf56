"""Epoch-keyed state tables on the shared store.

Layout under a stream root::

    log/epoch=e/           one row per committed epoch: the commit record *and* the
                           epoch's scalar state (counters, k, n, reset token, error
                           bound, where its sketch state and snapshot live)
    log_head/epoch=e/      all log rows up to e in one file, every LOG_HEAD epochs
    state/batch/epoch=e/   the batch's keyword counts, then the reservoir after it
    state/exact_base/epoch=e/   merged exact counts
    state/sketch/epoch=e/  MG counters, reservoir slots and tracked exact counts after epoch e
    snapshot/epoch=e/      the published snapshot (hot topics, exact top-K, samples,
                           counters, metrics), written as ONE table so that a
                           snapshot appears all at once
    control/epoch=v/       control record v (k, n, reset_token)

Epoch e of a table is the folder ``<table>/epoch=e``; a replayed epoch
overwrites its own folder and never doubles a count, and a job never overwrites
the folder it reads. The log row is written last: an epoch without a log row is
not committed and is redone from the previous committed epoch.

Folder names tell which epochs there are, so the newest row is one small file
however old the stream is. Log folders that two heads cover are removed, and
with ``expire`` whatever no kept log row points at.

A store belongs to one streaming checkpoint (epoch ids restart with a new one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendlens.schema import STREAM_LOG

#: Epochs after which the log rows so far are gathered in one file.
LOG_HEAD = 16


class EpochStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- per-epoch tables ----------------------------------------------------------

    def epoch_path(self, name: str, epoch: int) -> str:
        return f"{self.root}/{name}/epoch={int(epoch)}"

    def write(self, name: str, frame: DataFrame, epoch: int, bounded: bool = False) -> None:
        """Write ``frame`` as folder ``<name>/epoch=e`` (replacing it on a replay)."""
        # bounded (≤ a few hundred rows): one file; repartition keeps the upstream parallel
        out = frame.repartition(1) if bounded else frame
        out.write.mode("overwrite").parquet(self.epoch_path(name, epoch))

    def read(self, name: str, epoch: int | None, schema: StructType) -> DataFrame:
        """Table ``name`` as of epoch e; empty before the first epoch (e < 0).

        A folder that a log row points at and that isn't there raises: state that
        was removed must not be taken for no state.
        """
        if epoch is None or epoch < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.epoch_path(name, epoch))

    def read_epochs(self, name: str, epochs: list[int], schema: StructType) -> DataFrame:
        if not epochs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.epoch_path(name, e) for e in epochs])

    # -- folders -------------------------------------------------------------------

    def _folder(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def epochs(self, name: str) -> list[int]:
        """The epochs that table ``name`` has folders of, ascending; none if the table isn't there."""
        fs, target = self._folder(self.path(name))
        if not fs.exists(target):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(target)]
        return sorted(int(n[len("epoch="):]) for n in names if n.startswith("epoch="))

    def remove_folder(self, path: str) -> None:
        fs, target = self._folder(path)
        fs.delete(target, True)

    def remove(self, name: str, epoch: int) -> None:
        self.remove_folder(self.epoch_path(name, epoch))

    # -- the epoch log (commit protocol) -------------------------------------------

    def _head(self) -> tuple[int, DataFrame | None]:
        """The newest complete log head: its epoch (-1 if none) and its rows."""
        for e in reversed(self.epochs("log_head")):
            fs, _ = self._folder(self.root)
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.epoch_path('log_head', e)}/_SUCCESS")):
                return e, self.read("log_head", e, STREAM_LOG)
        return -1, None

    def last_entry(self, upto: int) -> Row | None:
        """The newest committed log row with epoch ≤ ``upto``: one small file, normally."""
        for e in reversed(self.epochs("log")):
            if e <= upto and (row := self.read("log", e, STREAM_LOG).first()) is not None:  # None: the write of the row was cut off
                return row
        _, head = self._head()
        return None if head is None else head.where(F.col("epoch") <= int(upto)).orderBy(F.col("epoch").desc()).first()

    def latest_entry(self) -> Row | None:
        return self.last_entry(2**62)

    def commit(self, row: tuple) -> None:
        """Write the epoch's log row; this is the commit point of the epoch."""
        epoch = int(row[0])
        frame = self.spark.createDataFrame([row], STREAM_LOG)
        frame.coalesce(1).write.mode("overwrite").parquet(self.epoch_path("log", epoch))
        if epoch % LOG_HEAD == LOG_HEAD - 1:
            self._gather(epoch)

    def _gather(self, epoch: int) -> None:
        """Write the log so far as one file; then drop what the head before it covers, which readers may still hold, no earlier."""
        before = self.epochs("log_head")
        self.write("log_head", self.log(), epoch, bounded=True)
        for e in self.epochs("log"):
            if before and e <= before[-1] and e != epoch:
                self.remove("log", e)
        for e in before[:-1]:
            self.remove("log_head", e)

    def log(self) -> DataFrame | None:
        """All committed log rows, one per epoch: the head's file and the few after it."""
        upto, head = self._head()
        tail = [e for e in self.epochs("log") if e > upto]
        if not tail:
            return head
        rows = self.read_epochs("log", tail, STREAM_LOG)
        return rows if head is None else head.unionByName(rows)

    def expire(self, keep: int) -> None:
        """Remove sketches, snapshots and exact counts that none of the last ``keep`` epochs needs (history readers see those only)."""
        if keep < 1:
            raise ValueError("the newest epoch is always kept")
        log = self.log()
        rows = [] if log is None else log.orderBy(F.col("epoch").desc()).limit(keep).collect()
        if not rows:
            return
        newest = int(rows[0]["epoch"])  # later folders belong to an epoch that isn't committed yet
        runs = {(r["level"] > 0, int(r["epoch"])) for row in rows for r in row["exact_runs"]}
        needed = {
            "state/sketch": {int(r["state_epoch"]) for r in rows},
            "snapshot": {int(r["snapshot_epoch"]) for r in rows},
            "state/batch": {e for merged, e in runs if not merged},
            "state/exact_base": {e for merged, e in runs if merged},
        }
        for name, kept in needed.items():
            for e in self.epochs(name):
                if e <= newest and e not in kept:
                    self.remove(name, e)
