from trendlens.functions.scalar import (
    clean_prefix,
    format_bytes,
    freshness_seconds,
    parse_double,
    parse_long,
    payload_bytes,
    round6,
    safe_ratio,
    stamp,
    stamp_text,
)

__all__ = [
    "clean_prefix",
    "format_bytes",
    "freshness_seconds",
    "parse_double",
    "parse_long",
    "payload_bytes",
    "round6",
    "safe_ratio",
    "stamp",
    "stamp_text",
]
