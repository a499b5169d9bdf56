"""Control table: runtime resize (S14) and reset requests (S15), read once per epoch.

Each write adds record ``version`` as a folder of its own; the newest record
holds the full effective control. Folder names tell the newest version, so a
reader opens one small file, and none if it has applied that version before;
writers remove all but the last KEEP_VERSIONS. ``k`` and ``n`` are kept as text
so that bad values reach the stream and are ignored there, field by field, as a
user would send them. A reset is a new ``reset_token``; the stream remembers the
last token it applied, so replaying an epoch does not reset twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException

from trendlens.schema import CONTROL
from trendlens.streaming.state import EpochStore


@dataclass(frozen=True)
class Control:
    version: int
    k: str | None
    n: str | None
    reset_token: int


KEEP_VERSIONS = 8


def latest_control(store: EpochStore, after: int = 0) -> Control | None:
    """The newest control record (one row to the driver), or None if its version isn't above ``after``."""
    for version in reversed(store.epochs("control")):
        if version <= after:
            return None
        row = store.read("control", version, CONTROL).first()
        if row is not None:  # None: the write was cut off
            return Control(int(row["version"]), row["k"], row["n"], int(row["reset_token"] or 0))
    return None


def _append(store: EpochStore, k: str | None, n: str | None, reset_token: int) -> Control:
    """Write the next version; a writer that was faster with it makes this one fail."""
    held = store.epochs("control")
    rec = Control(held[-1] + 1 if held else 1, k, n, reset_token)
    frame = store.spark.createDataFrame([(rec.version, rec.k, rec.n, rec.reset_token)], CONTROL)
    try:
        frame.coalesce(1).write.mode("errorifexists").parquet(store.epoch_path("control", rec.version))
    except AnalysisException as taken:
        raise RuntimeError(f"control version {rec.version} was written by another; read it and send again") from taken
    for version in held[: -KEEP_VERSIONS + 1]:
        store.remove("control", version)
    return rec


def set_control(store: EpochStore, k=None, n=None) -> Control:
    """Send new k and/or n (any value; the stream ignores non-positive or non-integer ones)."""
    prev = latest_control(store)
    k_text = str(k) if k is not None else (prev.k if prev else None)
    n_text = str(n) if n is not None else (prev.n if prev else None)
    return _append(store, k_text, n_text, prev.reset_token if prev else 0)


def request_reset(store: EpochStore) -> Control:
    """Ask the stream to clear its state before its next batch; k and n are kept."""
    prev = latest_control(store)
    return _append(store, prev.k if prev else None, prev.n if prev else None, (prev.reset_token if prev else 0) + 1)


#: Settings are logged as 32-bit integers, and a limit of one more must fit too.
MAX_SETTING = 2**31 - 2


def parse_setting(text: str | None, current: int) -> int:
    """An integer > 0 that the log can hold replaces the current value; anything else is ignored."""
    if text is None:
        return current
    try:
        value = int(text)
    except (TypeError, ValueError):
        return current
    return value if 0 < value <= MAX_SETTING else current
