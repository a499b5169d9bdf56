"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks cut points, normalised around a target
size: before it a cut needs HARD zero bits, after it only EASY ones, and
MIN <= chunk <= MAX (the last chunk may be shorter). An insertion moves only the
chunks around it. The fingerprint is the sorted set of 4-byte chunk digests with
their lengths, as base64; containment of one in another is the share of its
length in chunks that both have.

Documents meet their successor in one pass: ids are cut into ranges, a range is
sorted in one task, and the first document of a range also travels to the range
before it. Defined cases: a null text is empty, a null doc_id comes first, rows
with the same doc_id are ordered by a hash of their text and follow each other,
one document is its own successor, an empty fingerprint is contained in
everything and contains nothing but itself; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import ship

MIN, TARGET, MAX = 32, 64, 256  # bytes; the gear hash looks back 32 bytes, so never across a chunk's start
HARD, EASY = 8, 4  # zero bits that a cut needs before and after TARGET
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], np.uint32)
NULL_ID = -(1 << 63)


def gear(data: bytes) -> np.ndarray:
    """The gear hash ending at each byte: five doublings of its window."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        if len(h) > k:
            more = h[:-k] << np.uint32(k)
            h = h.copy()
            h[k:] += more
    return h


def chunks(data: bytes) -> dict[int, int]:
    """Chunk digests and their lengths."""
    h = gear(data)
    easy_at = np.flatnonzero(h < (1 << (32 - EASY)))
    hard = (easy_at[h[easy_at] < (1 << (32 - HARD))] + 1).tolist()
    easy = (easy_at + 1).tolist()
    out, at, n = {}, 0, len(data)
    i = j = 0
    while at < n:
        last = min(at + MAX, n)
        i = bisect_left(hard, at + MIN, i)
        if i < len(hard) and hard[i] <= min(at + TARGET, last):
            end = hard[i]
        else:
            j = bisect_left(easy, at + TARGET, j)
            end = easy[j] if j < len(easy) and easy[j] <= last else last
        out[xxhash.xxh32_intdigest(data[at:end])] = end - at
        at = end
    return out


def written(print_: dict[int, int]) -> str:
    """A fingerprint as text."""
    keys = sorted(print_)
    out = np.zeros(len(keys), [("digest", ">u4"), ("length", ">u2")])
    out["digest"] = keys
    out["length"] = [print_[k] for k in keys]
    return base64.b64encode(out.tobytes()).decode()


def parsed(text: str) -> dict[int, int]:
    return dict(np.frombuffer(base64.b64decode(text), [("digest", ">u4"), ("length", ">u2")]).tolist())


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's length in chunks that b has too."""
    total = sum(a.values())
    return sum(a[k] for k in a.keys() & b.keys()) / total if total else 1.0 if not b else 0.0


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """The smaller of both containments, so that a short text inside a long one isn't alike."""
    return min(containment(a, b), containment(b, a))


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every whole text; no shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t or "" for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].values, "n_chars": [len(t) for t in texts], "fingerprint": [written(chunks(t.encode())) for t in texts]})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def with_successor(docs: DataFrame, ranges: int) -> DataFrame:
    """Documents dealt into sorted ranges, each followed by the next range's first document (``extra``)."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = sorted(set(rows.approxQuantile("key", [k / ranges for k in range(1, ranges)], 0.25 / ranges))) if ranges > 1 else []
    bounds = F.array(*[F.lit(int(b)) for b in bounds]).cast("array<long>")
    rows = rows.withColumn("part", F.size(F.filter(bounds, lambda b: b <= F.col("key"))))
    # a row a range: its first id, and the range before it (the last one before the first)
    first = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min("key")).collect())
    heads = F.create_map(*[F.lit(x) for k, (_, key) in enumerate(first) for x in (key, first[k - 1][0])]) if first else F.lit(None).cast("map<long,int>")
    before = F.try_element_at(heads, F.col("key"))
    spots = F.filter(F.array(F.struct(F.col("part"), F.lit(False).alias("extra")), F.struct(before.alias("part"), F.lit(True).alias("extra"))), lambda s: s["part"].isNotNull())
    rows = rows.select("key", "text", F.xxhash64("text").alias("tie"), F.explode(spots).alias("spot")).select("spot.*", "key", "text", "tie")
    return rows.repartition(ranges, "part").sortWithinPartitions("part", "extra", "key", "tie").drop("tie")


def compare_edits(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every text against its edited form (the last quarter replaced by the next document's start) and the next document."""
    spark = docs.sparkSession
    ship(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def compare(key: int, text: str, own: dict, after: str, next_: dict) -> tuple:
        quarter = len(text) // 4
        edited = (text[: len(text) - quarter] + after[:quarter]).encode()
        other = chunks(edited)
        return (None if key == NULL_ID else key, len(text), hashlib.sha256(edited).hexdigest(), written(own), written(other), likeness(own, other), likeness(own, next_))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # the document that waits for its successor
        for b in batches:
            out = []
            for part, extra, key, text in zip(b["part"], b["extra"], b["key"], b["text"]):
                if last is None and extra:
                    continue
                own = chunks(text.encode())
                if last is not None:
                    out.append(compare(*last[1:], text, own))
                last = None if extra else (part, key, text, own)
            frame = pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            yield frame.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_successor(docs, ranges).mapInPandas(run, schema)
