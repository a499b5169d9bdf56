from trendlens.sources.keywords import (
    admit_keywords,
    doc_token_stream,
    event_type_stream,
    source_keywords,
    parse_keywords,
    props_stream,
    read_table,
    user_stream,
)

__all__ = [
    "admit_keywords",
    "doc_token_stream",
    "event_type_stream",
    "source_keywords",
    "parse_keywords",
    "props_stream",
    "read_table",
    "user_stream",
]
