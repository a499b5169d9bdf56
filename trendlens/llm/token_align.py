"""Alignment of two tokenizers' tokens over exact-text deduplication.

Documents are shuffled by their full text, so every distinct text is tokenised
and aligned once, with its number of copies as weight. A text, led by a space,
is cut into chunks that no token of either vocabulary crosses, so a chunk's
tokens, groups and links are found once a worker. A block of texts (about
BLOCK_CHARS characters, or one longer text) is one stored row: the links of its
distinct chunks and the chunks of each text. Only the distinct id pairs of a
block travel to the corpus-wide counts and back; the texts' measures are then
sums over their chunks, and are joined to the documents by the text's digest.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a
sentencepiece model that adds the leading space itself. A link is a pair of
tokens whose byte ranges end together; such ends cut the tokens into groups.

Defined cases: null and empty texts, and texts whose joined A or B bytes aren't
the text's, have no tokens: zeros and an empty group string. Special tokens'
strings are plain text. Equal rows give equal rows, rows with null or equal ids
keep them; an empty table gives an empty result; very long texts are handled
whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm import words
from trendlens.llm.common import ship, stored, unskewed_join

BLOCK_CHARS = 4_000_000
SLICE_CHARS = 1_000_000
KEEP_CHUNKS = 600_000  # the chunks' cache starts anew beyond so many, or so many characters
KEEP_CHARS = 30_000_000
#: Runs of spaces and newlines with the characters after them; white space at the end goes with the last run.
CHUNK = re.compile(r"[ \n]*[^ \n]+(?:[ \n]+\Z)?|[ \n]+")
SPACE_MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of the byte-level alphabet: printable Latin-1 stands for itself, the others follow from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE_MARK, " ").encode()


class Aligner:
    """Both tokenizers, and the chunks met so far with their tokens aligned."""

    def __init__(self, byte_bpe: str, pieces: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes([alphabet[c] for c in t]) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.a_len = np.zeros(max(self.a_bytes, default=0) + 1, np.int64)
        self.a_len[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # a piece has its space mark in front, or is spaces only, and no newline
        self.cuts = all(SPACE_MARK not in (p := self.b.id_to_piece(i)).lstrip(SPACE_MARK) and "\n" not in p for i in range(self.b.vocab_size()))
        # a token in a group string, with the separator that follows it: inside its part, at its end
        self.names = np.array([f"{i}{end}" for ends, n in ((",|", len(self.a_len)), (",;", len(self.b_len))) for i in range(n) for end in ends], object)
        self.name_len = np.array([len(x) for x in self.names], np.int64)
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.bad: set[int] = set()  # chunks whose tokens don't spell them
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 3), np.int64)  # of each chunk: A tokens, B tokens, links
        self.links = np.zeros(0, np.int64)  # of all chunks, as a << 32 | b
        self.chars = 0

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text with its leading space."""
        text = " " + text
        return [text] if not self.cuts or words.OTHER_SPACE.search(text) else CHUNK.findall(text)

    def _encode_b(self, chunks: list[str]) -> list[list[int]]:
        """The model puts a space in front: it replaces the chunk's own, or is dropped again before a newline."""
        ids = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [x if c[0] == " " else x[1:] for c, x in zip(chunks, ids)]

    def _spelled(self, chunks: list[str], a: list[list[int]], b: list[list[int]]) -> list[bool]:
        """Whether a chunk's tokens of both kinds are its bytes."""
        sides = ((self.a_bytes, a), (self.b_bytes, b))
        return [all(b"".join(map(x.__getitem__, ids[k])) == c.encode() for x, ids in sides) for k, c in enumerate(chunks)]

    def _add(self, chunks: list[str]) -> None:
        """Tokenise and align new chunks, all of them in one run of array operations."""
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        b = self._encode_b(chunks)
        body, first = "".join(chunks).encode(), len(self.code)
        # bytes per chunk first: a part of one chunk's bytes in the next one's tokens would go unseen in the whole
        lengths = np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks))
        x, n_a = _flat(a)
        y, n_b = _flat(b)
        whole = all(
            (np.add.reduceat(np.append(size[ids], 0), np.cumsum(n) - n) * (n > 0) == lengths).all() and b"".join(map(table.__getitem__, ids.tolist())) == body
            for size, table, ids, n in ((self.a_len, self.a_bytes, x, n_a), (self.b_len, self.b_bytes, y, n_b))
        )
        if not whole:
            good = self._spelled(chunks, a, b)
            self.bad.update(first + k for k, ok in enumerate(good) if not ok)
            (x, n_a), (y, n_b) = _flat([ids if ok else [] for ids, ok in zip(a, good)]), _flat([ids if ok else [] for ids, ok in zip(b, good)])
        end_a, end_b = np.cumsum(self.a_len[x]), np.cumsum(self.b_len[y])
        marks = np.zeros((2, int(end_a[-1]) + 1 if len(end_a) else 1), bool)
        marks[0, end_a], marks[1, end_b] = True, True
        last_a, last_b = marks[1, end_a], marks[0, end_b]  # the tokens that end a group
        n_links = np.bincount(np.repeat(np.arange(len(chunks)), n_a)[last_a], minlength=len(chunks))
        names = np.concatenate([2 * x + last_a, 2 * (len(self.a_len) + y) + last_b])
        place = np.concatenate([2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1])
        names = names[np.argsort(place, kind="stable")]
        text = "".join(self.names[names].tolist())
        n = n_a + n_b
        cut = np.concatenate([[0], np.cumsum(self.name_len[names])])[np.concatenate([[0], np.cumsum(n)])].tolist()
        self.groups += [text[s : e - 1] if e > s else "" for s, e in zip(cut, cut[1:])]
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, n_links], 1)])
        self.links = np.concatenate([self.links, x[last_a] << 32 | y[last_b]])
        self.code.update(zip(chunks, range(first, first + len(chunks))))
        self.chars += len(body)

    def codes(self, texts: list[str]) -> list[np.ndarray | None]:
        """The codes of the chunks of each text; None if its tokens don't spell it."""
        split = [[] if SPACE_MARK in t else self.chunks(t) for t in texts]  # that character as a token is a space
        new = list(set().union(*split).difference(self.code))
        if new:
            self._add(new)
        get = self.code.__getitem__
        out = [list(map(get, s)) for s in split]
        return [np.array(c, np.int64) if c and (not self.bad or self.bad.isdisjoint(c)) else None for c in out]

    def full(self) -> bool:
        return len(self.code) > KEEP_CHUNKS or self.chars > KEEP_CHARS


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for x in lists for i in x), np.int64, int(n.sum())), n


_ALIGNERS: dict = {}


def aligner(byte_bpe: str, pieces: str) -> Aligner:
    if (byte_bpe, pieces) not in _ALIGNERS:
        _ALIGNERS[byte_bpe, pieces] = Aligner(byte_bpe, pieces)
    return _ALIGNERS[byte_bpe, pieces]


def block_row(name: int, both: Aligner, texts: list[tuple[bytes, int, np.ndarray]]) -> dict:
    """One stored row of texts (digest, copies, codes): pairs with their weights, links of each chunk as places among the pairs, chunks of each text."""
    n = np.array([len(c) for _, _, c in texts], np.int64)
    copies = np.array([c for _, c, _ in texts], np.int64)
    used, place = np.unique(np.concatenate([c for _, _, c in texts]), return_inverse=True)
    times = np.bincount(place, np.repeat(copies, n)).astype(np.int64)
    n_a, n_b, n_links = both.sizes[used].T
    start = (np.cumsum(both.sizes[:, 2]) - both.sizes[:, 2])[used]
    links = both.links[np.repeat(start - np.cumsum(n_links) + n_links, n_links) + np.arange(n_links.sum())]
    pairs, at = np.unique(links, return_inverse=True)
    weights = np.bincount(at, np.repeat(times, n_links)).astype(np.int64)
    groups = [both.groups[k] for k in used.tolist()]
    ends, own = np.cumsum(n).tolist(), place.tolist()
    shas = [hashlib.sha256(";".join([groups[k] for k in own[e - len(c) : e]]).encode()).hexdigest() for e, (_, _, c) in zip(ends, texts)]
    packed = {"n_chunks": n, "chunks": place, "chunk_a": n_a, "chunk_b": n_b, "chunk_links": n_links, "links": at}
    head = {"block": name, "digests": [d for d, _, _ in texts], "copies": copies.tolist(), "groups": shas}
    return head | {k: v.astype("<u4").tobytes() for k, v in packed.items()} | {"pairs": pairs.tolist(), "weights": weights.tolist()}


BLOCK_SCHEMA = "block long, digests array<binary>, copies array<long>, groups array<string>, n_chunks binary, chunks binary, chunk_a binary, chunk_b binary, chunk_links binary, links binary, pairs array<long>, weights array<long>"


def align_texts(docs: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """The stored blocks of all distinct texts of ``docs``."""
    ship(docs.sparkSession)
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    texts = texts.select("text", "copies", F.unhex(F.sha2("text", 256)).alias("digest"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, part, n, held, size = aligner(byte_bpe, pieces), TaskContext.get().partitionId(), 0, [], 0
        for frame in frames:
            texts, copies, digests = (frame[c].tolist() for c in ("text", "copies", "digest"))
            for s in words.slices(texts, SLICE_CHARS):
                held += [(d, c, codes) for d, c, codes in zip(digests[s], copies[s], both.codes(texts[s])) if codes is not None]
                size += sum(map(len, texts[s]))
                if size >= BLOCK_CHARS or both.full():
                    if held:
                        yield pd.DataFrame([block_row(part << 32 | n, both, held)])
                        n += 1
                    held, size = [], 0
                    if both.full():
                        both._clear()
        if held:
            yield pd.DataFrame([block_row(part << 32 | n, both, held)])

    return stored(texts.mapInPandas(run, BLOCK_SCHEMA), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus hold each id pair, and whether no pair of its B id has more."""
    pair = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("count"))
    pair = stored(pair.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pair-counts")
    most = pair.groupBy("b").agg(F.max("count").alias("most"))
    return pair.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def link_counts(blocks: DataFrame) -> DataFrame:
    """(a_id, b_id, count): the alignment table of the corpus."""
    return pair_counts(blocks).select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id"), "count")


def _measure(row, count: np.ndarray, best: np.ndarray) -> pd.DataFrame:
    """The measures of a block's texts, from the counts of its pairs."""
    take = lambda name: np.frombuffer(row[name], "<u4").astype(np.int64)
    n, chunks, links, at = take("n_chunks"), take("chunks"), take("chunk_links"), take("links")
    owner = np.repeat(np.arange(len(links)), links)
    per = {"n_a": take("chunk_a"), "n_b": take("chunk_b"), "n_links": links, "n_best": np.zeros(len(links), np.int64), "count_sum": np.zeros(len(links), np.int64)}
    np.add.at(per["n_best"], owner, best[at].astype(np.int64))
    np.add.at(per["count_sum"], owner, count[at])
    starts = np.cumsum(n) - n
    out = {"digest": list(row["digests"]), "copies": list(row["copies"]), "groups_sha256": list(row["groups"])}
    return pd.DataFrame(out | {k: np.add.reduceat(v[chunks], starts) for k, v in per.items()})


MEASURES = ["n_a", "n_b", "n_links", "n_best", "count_sum"]


def text_measures(blocks: DataFrame) -> DataFrame:
    """(digest, copies, groups_sha256, measures) of every distinct text with tokens."""
    wanted = blocks.select("block", F.posexplode("pairs").alias("pos", "pair"))
    told = wanted.join(pair_counts(blocks), "pair").select(F.col("block").alias("to"), "pos", "count", "best")

    def run(key, own: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        told = told.sort_values("pos")
        return _measure(own.iloc[0], told["count"].to_numpy(np.int64), told["best"].to_numpy(bool))

    schema = "digest binary, copies long, groups_sha256 string, " + ", ".join(f"{c} long" for c in MEASURES)
    own = blocks.drop("pairs", "weights")
    return own.groupBy("block").cogroup(told.groupBy("to")).applyInPandas(run, schema)


def alignments(docs: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs = docs.select("doc_id", "text")
    measures = stored(text_measures(align_texts(docs, byte_bpe, pieces)), "measures")
    rows = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    out = unskewed_join(rows, measures, ["digest"], "copies", docs.count(), "left")
    zero = F.lit(0).cast("long")
    counts = {c: F.coalesce(c, zero) for c in MEASURES}
    return out.withColumns(counts).select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
