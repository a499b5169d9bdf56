"""Tables of a fixed size that are folded over all rows: hash counters and membership bitmaps.

Their size is a constant, whatever the data, so the result may be collected and
broadcast. Tasks send their table in chunks; the chunks are summed as they
stream by, never gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNKS = 64
BITMAP_BITS = 25  # a bitmap of 4 MB


def chunked(table: np.ndarray) -> pd.DataFrame:
    """A task's table as (chunk, body) rows, packed: a task fills little of a large table."""
    return pd.DataFrame({"chunk": np.arange(CHUNKS, dtype=np.int32), "body": [zlib.compress(part.tobytes(), 1) for part in np.split(table, CHUNKS)]})


def add_nibbles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sums of the two counters of 4 bits in each byte; 15 stands for all from 15 on."""
    return np.minimum((a & 15) + (b & 15), 15) | (np.minimum((a >> 4) + (b >> 4), 15) << 4)


def fold(rows: DataFrame, dtype: str, join: Callable) -> np.ndarray:
    """Combine the tasks' (chunk, body) rows with ``join``; an empty array if there are none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, body in zip(b["chunk"].tolist(), b["body"]):
                part = np.frombuffer(zlib.decompress(body), dtype)
                tables[chunk] = join(tables[chunk], part) if chunk in tables else part
        if tables:
            yield pd.DataFrame({"chunk": list(tables), "body": [zlib.compress(t.tobytes(), 1) for t in tables.values()]})

    # at most 64 rows of a fixed size
    out = rows.select("chunk", "body").repartition(CHUNKS, "chunk").mapInPandas(run, "chunk int, body binary").collect()
    return np.concatenate([np.frombuffer(zlib.decompress(r["body"]), dtype) for r in sorted(out, key=lambda r: r["chunk"])] or [np.zeros(0, dtype)])


def bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of the hashes of the ids (one long column)."""
    hashed = ids.select(F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(1 << BITMAP_BITS)).alias("h"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(1 << BITMAP_BITS, bool)
        for b in batches:
            bits[b["h"].to_numpy(np.int64)] = True
        if bits.any():
            yield chunked(np.packbits(bits))

    return fold(hashed.coalesce(16).mapInPandas(run, "chunk int, body binary"), "u1", np.bitwise_or)


def narrowed(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id may be among ``ids``: all of those, and few others while the ids are few for the bitmap.

    It only spares the shuffle of the join that follows, which decides.
    """
    spark = docs.sparkSession
    bits = bitmap(ids)
    if not len(bits):
        return docs.limit(0)
    held = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = held.value
        for b in batches:
            h = b.to_numpy(np.int64)
            yield pd.Series(((bits[h >> 3] >> (7 - (h & 7))) & 1).astype(bool))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # only the bit's number goes to Python, the rows don't
    return docs.where(F.pandas_udf(run, "boolean")(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << BITMAP_BITS))))
