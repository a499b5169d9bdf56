"""Token ids in a compact binary block format.

Documents are range-partitioned and sorted by id; each task encodes its run and
writes blocks of about BLOCK_IDS ids. A block is self-contained:

    b"TKB1", n_docs u32, n_ids u64, n_ranks u32, n_data u64
    doc ids i64[n_docs], null flags u8[n_docs], ids per document u64[n_docs]
    rank table u32[n_ranks]    the block's ids, most frequent first
    control    u8[ceil(n_ids/4)]   two bits an id: bytes of its rank, less one
    data       u8[n_data]          the ranks, little-endian, 1 to 4 bytes each

A reader finds the byte counts of four ids with one lookup in a 256-row numpy
table. Blocks are rows of a Parquet data set (part, block, before, n_ids,
payload), written by Spark's committer, so a retried task leaves no half file.

Defined cases: a null text is empty (one end id), a null doc_id sorts first, rows
with the same doc_id are ordered by a hash of their text, an empty table gives
no blocks; very long texts are encoded whole; a special token's string in a text
is that token, as in the library's own call; doc_ids are integers (others fail to
cast); other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.config import new_work_dir
from trendlens.llm import words
from trendlens.llm.common import ship

BLOCK_IDS = 2_000_000
KEEP_CHUNKS = 1_200_000  # the cache starts anew beyond so many chunks
JOINED = 2000  # chunks that are encoded as one string
MAX_COUNTED = 1 << 22
HEADER = struct.Struct("<4sIQIQ")
MAGIC = b"TKB1"
#: Byte counts of the four ids that a control byte describes.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1

_TOKENIZERS: dict = {}


class _Numbers(dict):
    """Numbers its keys as they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class TokenCodes(words.ChunkCodes):
    """Chunk codes of a byte-level tokenizer of the tokenizers library.

    New chunks that start with white space, and hold none at the end, are encoded
    many to a string, as no token crosses their ends, and cut by the tokens' bytes.
    """

    def __init__(self, tokenizer):
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # a character of a token is a byte
        self.tokenizer = tokenizer
        super().__init__(self._each)

    def _clear(self) -> None:
        super()._clear()
        self.code = _Numbers()

    def _each(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def codes(self, texts: list[str]) -> list[list[int]]:
        if len(self.code) > KEEP_CHUNKS or self.used > words.KEEP_IDS:
            self._clear()
        first, get = len(self.code), self.code.__getitem__
        whole = {t for t in texts if words.OTHER_SPACE.search(t)}  # one chunk each
        out = [[get(t)] if t in whole else list(map(get, words.CHUNK.findall(t))) for t in texts]
        new = list(islice(self.code, first, None))
        if new:
            self._store(first, *self._encoded(new, whole))
        return out

    def _encoded(self, new: list[str], whole: set[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks, and the number of each."""
        plain = [c[0] in " \n" and c[-1] not in " \n" and c not in whole for c in new]
        parts, n = [], np.zeros(len(new), np.int64)
        own = np.flatnonzero(plain)
        for k in range(0, len(own), JOINED):
            some = own[k : k + JOINED]
            chunks = [new[i] for i in some.tolist()]
            ids = np.array(self._each(["".join(chunks)])[0], np.uint32)
            ends = np.cumsum(np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks)))
            at = np.cumsum(self.bytes[ids])
            cut = np.searchsorted(at, ends)
            if not (len(at) and at[-1] == ends[-1] and (at[cut] == ends).all()):
                lists = self._each(chunks)
                ids, cut = np.fromiter(chain.from_iterable(lists), np.uint32), np.cumsum(list(map(len, lists))) - 1
            n[some] = np.diff(cut, prepend=-1)
            parts.append((some, ids))
        own = np.flatnonzero(~np.array(plain, bool))
        if len(own):
            lists = self._each([new[i] for i in own.tolist()])
            n[own] = list(map(len, lists))
            parts.append((own, np.fromiter(chain.from_iterable(lists), np.uint32)))
        flat, start = np.zeros(int(n.sum()), np.uint32), np.cumsum(n) - n
        for some, ids in parts:
            size = n[some]
            flat[np.repeat(start[some] - np.cumsum(size) + size, size) + np.arange(len(ids))] = ids
        return flat, n

    def _store(self, first: int, flat: np.ndarray, n: np.ndarray) -> None:
        last, total = first + len(n), len(flat)
        self.flat = words._room(self.flat, self.used + total)
        self.start, self.length = words._room(self.start, last), words._room(self.length, last)
        self.flat[self.used : self.used + total] = flat
        self.start[first:last] = self.used + np.cumsum(n) - n
        self.length[first:last] = n
        self.used += total


def _codes(path: str) -> TokenCodes:
    """One tokenizer and chunk cache a worker."""
    if path not in _TOKENIZERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = TokenCodes(Tokenizer.from_file(path))
    return _TOKENIZERS[path]


def pack(doc_ids: list, ids: list[np.ndarray]) -> bytes:
    """One block of documents and their ids."""
    flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.uint32)
    top = int(flat.max()) + 1 if len(flat) else 0
    if top <= MAX_COUNTED:  # ids of a vocabulary are counted in an array
        counts = np.bincount(flat, minlength=top)
        values, place = np.flatnonzero(counts).astype(np.uint32), flat
        counts = counts[values]
    else:
        values, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
        place, top = place.ravel(), len(values)
    order = np.argsort(-counts, kind="stable")
    rank = np.zeros(top, np.uint32)
    rank[values[order] if place is flat else order] = np.arange(len(values), dtype=np.uint32)
    ranks = rank[place] if len(flat) else flat
    sizes = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < sizes[:, None]]
    quads = np.zeros(-(-len(sizes) // 4) * 4, np.uint8)
    quads[: len(sizes)] = sizes - 1
    control = (quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    head = HEADER.pack(MAGIC, len(doc_ids), len(flat), len(values), len(data))
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    per = np.fromiter(map(len, ids), "<u8", len(ids))
    return b"".join([head, names.tobytes(), nulls.tobytes(), per.tobytes(), values[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def unpack(block: bytes) -> tuple[list, list[np.ndarray]]:
    """The documents of a block and their ids."""
    magic, n_docs, n_ids, n_ranks, n_data = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEADER.size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(block, kind, n, at)
        at += out.nbytes
        return out

    names, nulls, per, table = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs), take("<u4", n_ranks)
    sizes = LENGTHS[take("u1", -(-n_ids // 4))].ravel()[:n_ids]
    data = np.concatenate([take("u1", n_data), np.zeros(4, np.uint8)])
    starts = np.cumsum(sizes) - sizes
    ranks = data[starts].astype(np.int64)
    for j in range(1, 4):
        long = sizes > j
        ranks[long] |= data[starts[long] + j].astype(np.int64) << (8 * j)
    flat = table[ranks]
    cuts = np.cumsum(per.astype(np.int64))[:-1]
    return [None if x else int(d) for d, x in zip(names, nulls)], np.split(flat, cuts) if n_docs else []


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Encode every whole text with the tokenizer file, append ``end_id``, write blocks in ascending doc_id order."""
    ship(docs.sparkSession)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, part = _codes(tokenizer), TaskContext.get().partitionId()
        names, ids, held, before, n = [], [], 0, 0, 0
        end = np.array([end_id], np.uint32)

        def block() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "block": [n], "before": [before], "n_ids": [held], "payload": [pack(names, ids)]})

        for batch in batches:
            known, texts = batch["known"].tolist(), batch["text"].tolist()
            keys = [k if ok else None for k, ok in zip(batch["doc_id"].tolist(), known)]
            for s in words.slices(texts):
                for key, c in zip(keys[s], codes.codes(texts[s])):
                    names.append(key)
                    ids.append(np.concatenate([codes.ids(c), end]))
                    held += len(ids[-1])
                    if held >= BLOCK_IDS:
                        yield block()
                        names, ids, before, held, n = [], [], before + held, 0, n + 1
        if names:
            yield block()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("known", "doc_id", "tie").sortWithinPartitions("known", "doc_id", "tie").drop("tie")
    rows.mapInPandas(blocks, "part int, block int, before long, n_ids long, payload binary").write.parquet(path)


def read_tokens(blocks: DataFrame) -> DataFrame:
    """Read blocks back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of the little-endian u32 ids, ids."""
    return _read(blocks, lambda ids: ids.astype("<u4").tobytes(), ", ids binary")


def _read(blocks: DataFrame, body, more: str) -> DataFrame:
    ship(blocks.sparkSession)
    # one row a partition of the writing job
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rows = blocks.join(F.broadcast(parts), "part").select((F.col("first") + F.col("before")).alias("start"), "payload")

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, payload in zip(batch["start"], batch["payload"]):
                names, ids = unpack(payload)
                n = np.fromiter(map(len, ids), np.int64, len(ids))
                out = {"doc_id": pd.array(names, "Int64"), "start": start + np.cumsum(n) - n, "n_tokens": n, "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]}
                if more:
                    out["ids"] = [body(x) for x in ids]
                yield pd.DataFrame(out)

    return rows.mapInPandas(unpacked, "doc_id long, start long, n_tokens long, ids_crc32 long" + more)


def token_digests(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the tokens of all documents under the shared folder, read the blocks back, and return them without the ids."""
    spark = docs.sparkSession
    path = new_work_dir(spark, "tokens")
    write_tokens(docs, tokenizer, end_id, path)
    return _read(spark.read.parquet(path), None, "")
