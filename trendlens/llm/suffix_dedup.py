"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere
else. Three steps make this a Spark job:

1. Every string of LENGTH bytes has an anchor: the position of the least hash of
   KGRAM bytes in it, the first if several. Equal strings have equal anchors at
   equal offsets, so only anchors whose KGRAM bytes occur again matter. An
   anchor's surroundings are the bytes that strings around it can reach; anchors
   with equal surroundings are one class.
2. Classes with equal anchors meet in one task, in batches. A batch gets a
   suffix array: its suffixes of at least LENGTH bytes, sorted by the
   fingerprint of (anchor, offset, first LENGTH bytes), which is all the order
   that matches of that length need. It is merge-scanned against every level of
   the family; suffixes found on both sides match. Then it becomes a level, and
   levels of about equal size merge, so their sizes grow geometrically.
   Anchors with many classes are split by suffix fingerprint over tasks.
3. Matched suffixes become byte spans of each class's occurrences; a document's
   spans are united and cut out.

Matching is by 64-bit fingerprints. Defined cases: null text is empty; texts
under LENGTH bytes keep everything; a repeated row counts as another document;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm import rolling
from trendlens.llm.bounded import narrowed
from trendlens.llm.common import HEAVY_SHARE, ship, stored, unskewed_join

LENGTH = 400
KGRAM = 51
REACH = LENGTH - KGRAM + 1  # places of an anchor in a string of LENGTH bytes
PLACE_BITS = 30
SPLITS = 64  # tasks that an anchor with many classes is split over


def anchors(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and KGRAM hashes of a text's anchors."""
    n = len(sums) - 1
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - KGRAM + 1)
    hashes = rolling.spans(sums, at, at + KGRAM)
    key = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | at.astype(np.uint64)
    low = np.full(-(-len(key) // REACH) * REACH, np.iinfo(np.uint64).max, np.uint64)
    low[: len(key)] = key
    rows = low.reshape(-1, REACH)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    first = np.arange(n - LENGTH + 1)
    least = np.minimum(after[first], before[first + REACH - 1])
    place = np.unique(least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    return place, hashes[place]


class Family:
    """Suffix arrays as levels of geometric size."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.matched = np.zeros(1 << 16, bool)

    def add(self, keys: np.ndarray, first: int) -> None:
        """Scan a batch of suffixes, numbered from ``first``, against the levels and keep it."""
        n = first + len(keys)
        if n > len(self.matched):
            more = np.zeros(max(n, 2 * len(self.matched)), bool)
            more[: len(self.matched)] = self.matched
            self.matched = more
        order = np.argsort(keys)
        array, number = keys[order], first + order
        twin = array[1:] == array[:-1]
        self.matched[number[1:][twin]] = True
        self.matched[number[:-1][twin]] = True
        for level, owner in self.levels:
            at = np.minimum(np.searchsorted(level, array), len(level) - 1)
            hit = level[at] == array
            self.matched[number[hit]] = True
            self.matched[owner[at[hit]]] = True
        fresh = np.concatenate([[True], ~twin]) if len(array) else np.zeros(0, bool)
        self._push(array[fresh], number[fresh])

    def _push(self, array: np.ndarray, number: np.ndarray) -> None:
        if not len(array):
            return
        while self.levels and len(self.levels[-1][0]) <= 2 * len(array):
            other, owner = self.levels.pop()
            both, numbers = np.concatenate([other, array]), np.concatenate([owner, number])
            order = np.argsort(both, kind="stable")  # two sorted runs: a merge
            array, number = both[order], numbers[order]
            fresh = np.concatenate([[True], array[1:] != array[:-1]])
            array, number = array[fresh], number[fresh]
        self.levels.append((array, number))


SUFFIX = np.dtype([("place", "<u2"), ("key", "<u8")])


TOGETHER = 256  # classes whose suffixes are found at once


def suffixes(bodies: list[bytes], left: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of the classes' surroundings that have LENGTH bytes: how many each class has, their places and fingerprints."""
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    n = np.maximum(lengths - LENGTH + 1, 0)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = place + np.repeat(np.cumsum(lengths) - lengths, n)
    sums = rolling.prefix(np.frombuffer(b"".join(bodies), np.uint8))
    own = anchor.astype(np.int64).view(np.uint64) + left.astype(np.int64).view(np.uint64) * np.uint64(rolling.BASE)
    salt = rolling.mix(np.repeat(own, n) - place.astype(np.uint64) * np.uint64(rolling.BASE))
    return n, place, rolling.mix(rolling.spans(sums, at, at + LENGTH) + salt)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(key, spans) of rows (key, text): united [start, end) byte spans of every row that loses bytes. ``key`` is a long."""
    ship(rows.sparkSession)
    schema = "key long, place int, anchor long, shape long, reach int, size int"

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for key, text in zip(b["key"].tolist(), b["text"]):
                sums = rolling.prefix(np.frombuffer(text, np.uint8))
                place, hashes = anchors(sums)
                if not len(place):
                    continue
                start, end = np.maximum(place - REACH + 1, 0), np.minimum(place + LENGTH, len(text))
                shape = rolling.mix(rolling.spans(sums, start, end) + (place - start).astype(np.uint64))
                parts.append((np.full(len(place), key), place, hashes.view(np.int64), shape.view(np.int64), place - start, end - start))
            if parts:
                yield pd.DataFrame(dict(zip(("key", "place", "anchor", "shape", "reach", "size"), map(np.concatenate, zip(*parts)))))

    found = stored(rows.mapInPandas(find, schema), "suffix-anchors")
    total = found.count()
    classes = found.groupBy("anchor", "shape").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one"), F.first("reach").alias("reach"), F.first("size").alias("size")
    )
    classes = stored(classes, "suffix-classes")
    again = classes.groupBy("anchor").agg(F.sum("n").alias("rows"), F.count("*").alias("kinds")).where("rows > 1")
    again = stored(again, "suffix-again")
    kinds = classes.count()
    shared = stored(unskewed_join(classes, again.drop("rows"), ["anchor"], "kinds", kinds), "suffix-shared")
    whole = shared.where("n > 1").select("anchor", "shape", "n", F.array(F.struct((-F.col("reach")).alias("from"), (F.col("size") - F.col("reach")).alias("to"))).alias("spans"))
    mixed = shared.where("kinds > 1")
    wanted = mixed.groupBy(F.col("one.key").alias("key")).agg(
        F.collect_list(F.struct(F.col("one.place").alias("place"), "anchor", "shape", "n", "reach", "size", (F.col("kinds") * HEAVY_SHARE > kinds).alias("heavy"))).alias("wanted")
    )  # a document's own anchors
    wanted = stored(wanted, "suffix-wanted")

    def texts(wants: DataFrame) -> DataFrame:
        return narrowed(rows, "key", wants.select("key")).dropDuplicates(["key"]).join(wants, "key")

    def surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for text, wants in zip(b["text"], b["wanted"]):
                out = []
                for w in wants:
                    a = w["place"] - w["reach"]
                    head = (w["anchor"], w["shape"], w["n"], w["reach"])
                    n, place, key = suffixes([text[a : a + w["size"]]], np.array([w["reach"]]), np.array([w["anchor"]]))
                    s = np.zeros(len(place), SUFFIX)
                    s["place"], s["key"] = place, key
                    for k in range(SPLITS):
                        own = s[s["key"] % np.uint64(SPLITS) == k]
                        if len(own):
                            out.append((*head, k, own.tobytes(), True))
                yield pd.DataFrame(out, columns=["anchor", "shape", "n", "reach", "split", "body", "ready"])

    # a body is cut out of its text within the array: the text isn't copied for each of them
    cut = lambda w: F.substring(F.col("text"), w["place"] - w["reach"] + 1, w["size"])
    light = F.transform(
        F.filter("wanted", lambda w: ~w["heavy"]),
        lambda w: F.struct(*[w[c].alias(c) for c in ("anchor", "shape", "n", "reach")], F.lit(0).alias("split"), cut(w).alias("body"), F.lit(False).alias("ready")),
    )
    pieces = texts(wanted).select(F.explode(light).alias("p")).select("p.*")
    heavy = wanted.select("key", F.filter("wanted", lambda w: w["heavy"]).alias("wanted")).where(F.size("wanted") > 0)
    many = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not heavy.isEmpty():
        spread = texts(heavy).repartition(many, "key").select("text", "wanted")  # little to read, much to make of it
        pieces = pieces.unionByName(spread.mapInPandas(surroundings, "anchor long, shape long, n long, reach int, split int, body binary, ready boolean"))
    pieces = pieces.repartition(many, "anchor", "split")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        family, first, owners = Family(), 0, []
        for b in batches:
            keys = []
            for ready, some in b.groupby("ready"):
                for k in range(0, len(some), TOGETHER):
                    part = some.iloc[k : k + TOGETHER]
                    bodies = part["body"].tolist()
                    if ready:
                        s = np.frombuffer(b"".join(bodies), SUFFIX)
                        count, place, key = np.array([len(x) // SUFFIX.itemsize for x in bodies]), s["place"], s["key"]
                    else:
                        count, place, key = suffixes(bodies, part["reach"].to_numpy(), part["anchor"].to_numpy())
                    owners.append((part[["anchor", "shape", "n", "reach"]].to_numpy(np.int64), count, place.astype(np.uint16)))
                    keys.append(key)
            batch = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            family.add(batch, first)
            first += len(batch)
        at = 0
        for heads, count, place in owners:
            hit = np.flatnonzero(family.matched[at : at + len(place)])
            at += len(place)
            row, spot = np.repeat(np.arange(len(heads)), count)[hit], place[hit].astype(np.int64)
            own = heads[row, 2] == 1
            row, spot = row[own], spot[own]
            if not len(row):
                continue
            fresh = np.flatnonzero((np.diff(row) != 0) | (np.diff(spot) > 1)) + 1  # runs of places of one class
            begin, last = np.concatenate([[0], fresh]), np.concatenate([fresh, [len(row)]]) - 1
            spans: dict[int, list[dict[str, int]]] = {}
            for r, f, t in zip(row[begin].tolist(), (spot[begin] - heads[row[begin], 3]).tolist(), (spot[last] - heads[row[last], 3] + LENGTH).tolist()):
                spans.setdefault(r, []).append({"from": f, "to": t})
            some = heads[list(spans)]
            yield pd.DataFrame({"anchor": some[:, 0], "shape": some[:, 1], "n": some[:, 2], "spans": list(spans.values())})

    span = "array<struct<from: int, to: int>>"
    single = pieces.mapInPandas(match, f"anchor long, shape long, n long, spans {span}")
    single = single.groupBy("anchor", "shape", "n").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # at most SPLITS rows a class
    result = stored(whole.select("anchor", "shape", "n", F.col("spans").cast(span).alias("spans")).unionByName(single), "suffix-result")
    hits = unskewed_join(found.select("anchor", "shape", "key", "place"), result, ["anchor", "shape"], "n", total)
    moved = hits.select("key", F.explode("spans").alias("s"), "place").select("key", F.struct((F.col("s.from") + F.col("place")).alias("from"), (F.col("s.to") + F.col("place")).alias("to")).alias("s"))
    return moved.groupBy("key").agg(F.sort_array(F.collect_set("s")).alias("spans"))  # a document's own spans


def united(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def cut_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of documents (doc_id, text); kept is the remaining bytes."""
    return _cut(docs, lambda spans, kept: {"spans": spans, "kept": kept}, "spans array<array<int>>, kept binary")


def cut_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of documents."""
    return _cut(docs, lambda spans, kept: {"n_spans": len(spans), "kept_sha256": hashlib.sha256(kept).hexdigest()}, "n_spans long, kept_sha256 string")


def _cut(docs: DataFrame, value, schema: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), text.alias("text"))
    spans = stored(repeated_spans(rows.select("key", "text")), "suffix-spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, found in zip(b["text"], b["spans"] if "spans" in b else [()] * len(b)):
                gone = united([(s["from"], s["to"]) for s in found])
                edges = [0, *(x for g in gone for x in g), len(text)]
                kept = b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                out.append({"n_bytes": len(text), "n_removed": len(text) - len(kept)} | value(gone, kept))
            if out:
                yield pd.DataFrame({"doc_id": b["doc_id"].values, **{k: [o[k] for o in out] for k in out[0]}})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = rows.join(spans, "key", "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<from: int, to: int>>")).alias("spans"))
    return rows.mapInPandas(cut, f"doc_id {kind}, n_bytes long, n_removed long, {schema}")
