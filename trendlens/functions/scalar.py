"""Scalar column functions (F3-F10). All JVM-side expressions, no Python UDFs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Byte units of the size display, base 1024.
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_long(c: Column | str, default: int | None = 0) -> Column:
    """text -> bigint; unparsable or missing -> ``default``."""
    v = _col(c).try_cast("bigint")
    return v if default is None else F.coalesce(v, F.lit(default).cast("bigint"))


def parse_double(c: Column | str, default: float | None = 0.0) -> Column:
    v = _col(c).try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(default).cast("double"))


def round6(c: Column | str) -> Column:
    """six decimals, as published."""
    return F.round(_col(c).cast("double"), 6)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 or null."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def format_bytes(size: Column | str) -> Column:
    """``"%.2f <unit>"`` with base 1024 and units B..TB; null from 1024 TB up.

    Halves are rounded to even (``bround``), as a correctly rounded ``%.2f`` does
    for the exactly representable values a byte count divided by 1024^i gives.
    """
    s = _col(size).cast("double")
    out = None
    for i, unit in enumerate(BYTE_UNITS):
        scaled = s / F.lit(float(1024**i))
        text = F.format_string("%.2f " + unit, F.bround(scaled, 2))
        out = F.when(scaled < F.lit(1024.0), text) if out is None else out.when(scaled < F.lit(1024.0), text)
    return out


def clean_prefix(prefix: Column | str) -> Column:
    """characters other than letters, digits, ``-`` and ``_`` become ``_``;
    leading/trailing ``_`` are stripped; an empty result becomes ``snapshot``."""
    replaced = F.regexp_replace(_col(prefix), r"[^\p{L}\p{N}_-]", "_")
    stripped = F.btrim(replaced, F.lit("_"))
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit("snapshot"))


def stamp_text(epoch_seconds: int) -> str:
    """F8: ``YYYYmmdd_HHMMSS`` (UTC) of an epoch second, for file names."""
    return datetime.fromtimestamp(epoch_seconds, tz=timezone.utc).strftime("%Y%m%d_%H%M%S")


def stamp(epoch_seconds: Column | str) -> Column:
    """F8 as a column: ``yyyyMMdd_HHmmss`` in UTC, whatever the session time zone."""
    utc_wall_clock = F.timestamp_add("SECOND", _col(epoch_seconds), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.date_format(utc_wall_clock, "yyyyMMdd_HHmmss")


def freshness_seconds(last_update_epoch: Column | str, as_of: Column | int) -> Column:
    """max(as_of - last_update, 0); -1 when there was no update (0 or null)."""
    last = _col(last_update_epoch).cast("bigint")
    now = as_of if isinstance(as_of, Column) else F.lit(int(as_of)).cast("bigint")
    return F.when(last.isNull() | (last == 0), F.lit(-1).cast("bigint")).otherwise(
        F.greatest(now - last, F.lit(0).cast("bigint"))
    )


def epoch_millis(frame: DataFrame, column: str) -> Column:
    """milliseconds since 1970-01-01, whatever the session time zone.

    A TIMESTAMP_NTZ is read as UTC wall-clock time (whole milliseconds, rounded
    down); a TIMESTAMP is an instant already.
    """
    if isinstance(frame.schema[column].dataType, TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(column))
    return F.unix_millis(F.col(column))


def payload_bytes(keyword: Column | str) -> Column:
    """Bytes of one state entry: the keyword's UTF-8 length plus an 8-byte count/slot."""
    return F.octet_length(_col(keyword)).cast("bigint") + F.lit(8).cast("bigint")
