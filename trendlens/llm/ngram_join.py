"""N-gram Jaccard join with prefix filters under several global token orders.

A document's set holds the hashes of its distinct 5-word shingles. Its prefix
under a global order of the tokens is its first |x| - ceil(0.8 |x|) + 1 tokens.
Sets with Jaccard similarity of at least 0.8 share ceil(0.8 (|x| + |y|) / 1.8)
tokens or more, and of these only as many as one set has outside its prefix can
be missing from both prefixes. So under every order the prefixes share at least
the difference, which is 1 or more; a candidate must pass this for each order
before both whole sets are compared. Tokens that no other prefix holds can't be
shared, so documents with too few others don't meet under the first order. Texts are fetched only for candidates whose
sets can be that similar by their parity sketches: a bit for each hash of a
token, flipped by every token of the set, so the bits in which two sketches
differ are at most as many as the tokens in only one set. An order ranks tokens by how frequent their hash bucket is over the
whole corpus (tables of fixed size: small counts of many buckets, large ones of few),
then by a hash of the order's own. Rare tokens come first, so passages that many
documents share seldom reach a prefix. Most tokens of a large corpus are rare, so
only with many buckets are they told from those that a few documents share.

Documents that a first round proves linked need not meet again pair by pair:
equal sets are linked by their digest, and documents whose least token under a
plain hash order agrees are compared with one of them only (in large groups with a
fixed number): with the most typical, whose least tokens under several orders are other documents' too, as an unedited
original's are and those of a copy with many edits are not. The join then pairs
only documents of different components, so a group of near copies costs a few
comparisons a document, and no link between components is lost. Of the components
that a token meets, the one with most of its documents is on one side of the join only. A document and
all that it is compared with meet in one stream; a document with many partners
is copied to several. Of equal sets one document joins, so copies don't meet other documents' copies.

Within the tokens that several components hold, a document's come in a second
global order: those that many documents outside their largest component hold come
last. Two documents that share as many as similar ones do share the first of them
with all the others still to follow in both, so only meetings with enough tokens
left make a candidate. A token that a large group holds is among a document's last,
where too few are left, so its holders rarely meet there.

Components come from contracting links round by round: every document joins the
neighbour with the most links, by a hash of the round among equals, so a star is
one round and a chain about log(n).

Defined cases: words are runs of characters other than ASCII white space, A-Z
lower-cased; fewer than five words make one shingle; null or empty texts have no
shingles and link with nothing; a null doc_id links with nothing and is its own
(null) component; rows with the same doc_id are one node; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm import rolling
from trendlens.llm.bounded import CHUNKS, add_nibbles, chunked, fold, narrowed
from trendlens.llm.common import let_go, ship, stored, unskewed_join

WORDS = 5
PERCENT = 80
ORDERS = 3
STARS = 3  # hash orders of the first round
TYPICAL = 8  # hash orders by which its centers are chosen, those included
CENTERS, LARGE = 8, 64  # centers of a group that has more documents than that
FREQUENCY_BITS = 20  # buckets of the frequency table; 4 MB in all
FINE_BITS = 24  # buckets of the counts up to 14; 8 MB in all
SKETCH_BITS = 64  # of the smallest sketch
MARKS = 8  # words of 64 bits of the short sketch that postings carry
PARTNERS = 500  # a document is copied once for so many partners
HOT = 0  # postings outside its largest part from which a token comes the later, the more it has

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, shingle hash) of all texts, distinct and sorted within a text."""
    data = np.frombuffer(b"\n".join([t.encode() for t in texts]).translate(LOWER), np.uint8)
    lengths = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
    doc_start = np.cumsum(lengths + 1) - lengths - 1
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = rolling.string_hashes(data, start, end)
    doc = np.searchsorted(doc_start, start, side="right") - 1
    count = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(count) - count
    n = np.maximum(count - WORDS + 1, (count > 0).astype(np.int64))  # windows of a text
    owner = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner]
    width = np.minimum(count, WORDS)[owner]
    total = np.zeros(len(owner), np.uint64)
    for j in range(WORDS):
        own = j < width
        total[own] = total[own] * np.uint64(rolling.BASE) + word[at[own] + j]
    hashes = rolling.mix(total + width.astype(np.uint64))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])])
    return owner[fresh], hashes[fresh]


def seeded(hashes: np.ndarray, seed: int) -> np.ndarray:
    return rolling.mix(hashes ^ rolling.mix(np.array([seed + 1], np.uint64))[0])


def fine_counts(hashes: np.ndarray) -> np.ndarray:
    """Counters of 4 bits by hash bucket, two in a byte: those of the lower half of the buckets and of the upper."""
    fine = np.zeros(1 << FINE_BITS - 1, np.uint8)
    add_fine(fine, hashes)
    return fine


def add_fine(fine: np.ndarray, hashes: np.ndarray) -> None:
    bucket, n = np.unique((hashes >> np.uint64(64 - FINE_BITS)).astype(np.uint32), return_counts=True)
    n = np.minimum(n, 15).astype(np.uint8)
    upper = int(np.searchsorted(bucket, len(fine)))
    for at, more in ((bucket[:upper], n[:upper]), (bucket[upper:] - np.uint32(len(fine)), n[upper:] << 4)):
        fine[at] = add_nibbles(fine[at], more)


def ranked(hashes: np.ndarray, frequency: tuple[np.ndarray, np.ndarray], order: int) -> np.ndarray:
    """Ranks of tokens under a global order: the frequency class first, then the order's own hash."""
    coarse, fine = frequency
    bucket = (hashes >> np.uint64(64 - FINE_BITS)).astype(np.int64)
    few = (fine[bucket & (len(fine) - 1)] >> np.where(bucket < len(fine), 0, 4).astype(np.uint8)) & 15
    count = np.where(few < 15, few, coarse[bucket >> (FINE_BITS - FREQUENCY_BITS)])
    level = np.floor(2 * np.log2(np.maximum(count, 1))).astype(np.uint64)
    return (level << np.uint64(56)) | (seeded(hashes, 100 + order) >> np.uint64(8))


def prefix_size(n: np.ndarray | int):
    """|x| - ceil(t |x|) + 1."""
    return n - (PERCENT * n + 99) // 100 + 1


def overlap_needed(a, b, most):
    """Tokens that the prefixes of similar sets of a and b tokens share at least; ``most`` is the larger-of function."""
    alpha = (PERCENT * (a + b) + 99 + PERCENT) // (100 + PERCENT)
    return alpha - most(a - prefix_size(a), b - prefix_size(b))


def similar(shared: int, a: int, b: int) -> bool:
    return 100 * shared >= PERCENT * (a + b - shared)


def sketches(owner: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity sketches of n..2n bits: every token flips one bit of its text's sketch."""
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    first = np.cumsum(bits) - bits
    at = first[owner] + (seeded(hashes, 20).view(np.int64) & (bits[owner] - 1))
    packed = np.packbits(np.bincount(at, minlength=int(bits.sum())) & 1 == 1)
    return [packed[f // 8 : (f + b) // 8].tobytes() for f, b in zip(first.tolist(), bits.tolist())]


def short_sketches(owner: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """Parity sketches of 64 * MARKS bits: a row of words for each text."""
    bits = 64 * MARKS
    at = owner * bits + (seeded(hashes, 21) % np.uint64(bits)).view(np.int64)
    return np.packbits(np.bincount(at, minlength=texts * bits) & 1 == 1).view(np.int64).reshape(texts, MARKS)


def apart(x: bytes, y: bytes) -> int:
    """Tokens that are in only one of two sets, at least; the longer sketch is folded to the shorter."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        half = len(b) // 2
        b = b[:half] ^ b[half:]
    return int(np.bitwise_count(a ^ b).sum())


def batches_of(frames: Iterator[pd.DataFrame], size: int = 1_000_000) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Arrow batches cut into runs of texts of about ``size`` characters."""
    from trendlens.llm import words

    let_go()
    for frame in frames:
        texts = [t or "" for t in frame["text"]]
        for s in words.slices(texts, size):
            yield frame.iloc[s], texts[s]
    frame = texts = None
    let_go()


def summaries(docs: DataFrame) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """(doc_id, n, digest_a, digest_b, least tokens, short sketch, sketch) of every document, and the frequency tables."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, fine = np.zeros(1 << FREQUENCY_BITS, np.uint32), fine_counts(np.zeros(0, np.uint64))
        for frame, texts in batches_of(frames):
            owner, hashes = shingles(texts)
            table += np.bincount((hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64), minlength=len(table)).astype(np.uint32)
            add_fine(fine, hashes)
            n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
            full = np.flatnonzero(n)
            at = (np.cumsum(n) - n)[full]
            out = pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").mask(frame["none"]).values, "n": n})
            for k, name in enumerate(("digest_a", "digest_b")):
                sums = np.zeros(len(texts), np.uint64)
                if len(full):
                    sums[full] = np.add.reduceat(seeded(hashes, 10 + k), at)
                out[name] = sums.view(np.int64)
            for k in range(TYPICAL):
                least = np.zeros(len(texts), np.uint64)
                if len(full):
                    least[full] = np.minimum.reduceat(seeded(hashes, k), at)
                out[f"least_{k}"] = least.view(np.int64)
            for k, word in enumerate(short_sketches(owner, hashes, len(texts)).T):
                out[f"mark_{k}"] = word
            yield out.assign(sketch=sketches(owner, hashes, n), chunk=-1, body=None)
        if table.any():
            for first, part in ((0, chunked(table)), (CHUNKS, chunked(fine))):
                part["chunk"] += np.int32(first)
                yield part.assign(doc_id=pd.array([None] * len(part), "Int64"), **dict.fromkeys(ROW[1:], 0), sketch=None)[[*ROW, "sketch", "chunk", "body"]]

    schema = ", ".join(f"{c} long" for c in ROW) + ", sketch binary, chunk int, body binary"
    # without nulls, beside which pandas would hold ids as floats and round the large ones
    whole = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").cast("long").isNull().alias("none"), "text")
    rows = stored(whole.mapInPandas(run, schema), "ngram-summaries")
    tables = rows.where("chunk >= 0")
    coarse, fine = fold(tables.where(F.col("chunk") < CHUNKS), "u4", np.add), fold(tables.where(F.col("chunk") >= CHUNKS), "u1", add_nibbles)
    if not len(coarse):
        coarse, fine = np.zeros(1 << FREQUENCY_BITS, np.uint32), fine_counts(np.zeros(0, np.uint64))
    return rows.where("chunk < 0").drop("chunk", "body"), (coarse, fine)


ROW = ["doc_id", "n", "digest_a", "digest_b", *(f"least_{k}" for k in range(TYPICAL)), *(f"mark_{k}" for k in range(MARKS))]


def postings(docs: DataFrame, frequency) -> DataFrame:
    """(token, doc_id, n) of the prefixes under the first order."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = frequency.value
        for frame, texts in batches_of(frames):
            owner, hashes = shingles(texts)
            n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
            at = np.cumsum(n) - n
            order = np.lexsort((ranked(hashes, table, 0), owner))
            place = np.arange(len(owner)) - at[owner]
            own = place < prefix_size(n)[owner]
            yield pd.DataFrame({"token": hashes[order][own].view(np.int64), "doc_id": frame["doc_id"].to_numpy(np.int64)[owner[own]], "n": n[owner[own]]})

    return docs.mapInPandas(run, "token long, doc_id long, n long")


def crossing(post: DataFrame) -> DataFrame:
    """The postings of tokens that several parts share, with ``largest``, the part that holds most of a token's.

    ``rest`` numbers a document's tokens from the last: those with the most postings
    outside their largest part come last, so it is how many follow, this one included.
    """
    held = post.groupBy("token", "part").agg(F.count("*").alias("held"))
    tokens = held.groupBy("token").agg(F.sum("held").alias("holders"), F.max(F.struct("held", "part")).alias("most")).where("most.held < holders")
    tokens = stored(tokens.select("token", "holders", F.col("most.part").alias("largest"), (F.col("holders") - F.col("most.held")).alias("outside")), "ngram-tokens")
    shared = unskewed_join(post, tokens, ["token"], "holders", post.count())
    last = Window.partitionBy("doc_id", "n").orderBy(F.greatest("outside", F.lit(HOT)).desc(), "token")
    return shared.select("token", "doc_id", "n", "part", "largest", F.row_number().over(last).alias("rest"))


def ends() -> list[Column]:
    """The columns (a, b, a_n, b_n) of a pair (x, a_n), (doc_id, b_n), the smaller id first."""
    swap = F.col("x") > F.col("doc_id")
    first = lambda p, q: F.when(swap, F.col(q)).otherwise(F.col(p))
    return [first("x", "doc_id").alias("a"), first("doc_id", "x").alias("b"), first("a_n", "b_n").alias("a_n"), first("b_n", "a_n").alias("b_n")]


def near(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``pairs`` (a, b, a_n, b_n) whose sketches leave room for similar sets."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sketch = stored(narrowed(rows.select("doc_id", "n", "sketch"), "doc_id", ids), "ngram-sketches")
    for end in ("a", "b"):
        pairs = pairs.join(sketch.toDF(end, f"{end}_n", f"{end}_sketch"), [end, f"{end}_n"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            room = [(100 + PERCENT) * apart(x, y) <= (100 - PERCENT) * n for x, y, n in zip(f["a_sketch"], f["b_sketch"], (f["a_n"] + f["b_n"]).tolist())]
            yield f.loc[np.array(room, bool), ["a", "b"]]

    return pairs.select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch").mapInPandas(run, "a long, b long").distinct()


def meetings(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, spot, role, doc_id, text): ``a`` (role 0) and its partners b (role 1), to be read in the order of these columns."""
    pairs = stored(pairs.select("a", "b"), "ngram-pairs")
    groups = pairs.groupBy("a").agg(F.count("*").alias("partners")).withColumn("copies", F.floor(F.col("partners") / PARTNERS) + 1)
    groups = stored(groups, "ngram-heads")
    heads = groups.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("spot"), F.lit(0).alias("role"))
    pairs = unskewed_join(pairs, groups, ["a"], "partners", pairs.count())
    spread = F.pmod(F.xxhash64("b"), F.col("copies"))
    wants = heads.unionByName(pairs.select(F.col("b").alias("doc_id"), "a", spread.alias("spot"), F.lit(1).alias("role")))
    wants = stored(wants, "ngram-wants")
    texts = narrowed(docs, "doc_id", wants.select("doc_id").distinct())
    met = texts.join(wants, "doc_id").repartition("a", "spot").sortWithinPartitions("a", "spot", "role")
    return met.select("a", "spot", "role", "doc_id", "text")


def visits(frames: Iterator[pd.DataFrame], prepare) -> Iterator[list[tuple]]:
    """Per run of texts: (a, partner, the partner's set, what ``prepare`` made of each set of ``a``)."""
    head, spot, held = None, None, []
    for frame, texts in batches_of(frames):
        owner, hashes = shingles(texts)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        out = []
        for k, (a, s, role, doc) in enumerate(zip(frame["a"].tolist(), frame["spot"].tolist(), frame["role"].tolist(), frame["doc_id"].tolist())):
            if (a, s) != (head, spot):
                head, spot, held = a, s, []
            own = hashes[cuts[k] : cuts[k + 1]]
            if len(own) and role == 0:
                held.append(prepare(own))
            elif len(own):
                out.append((a, doc, own, list(held)))
        yield out


def linked(pairs: DataFrame, docs: DataFrame, frequency) -> DataFrame:
    """The pairs (a, b) that are similar: filtered under every order, then compared whole.

    ``a`` and its partners meet sorted, ``a`` first; only its set is held.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = frequency.value

        def prefixes(h: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
            size = prefix_size(len(h))
            return h, [h[np.argpartition(ranked(h, table, k), size - 1)[:size]] for k in range(ORDERS)]

        for met in visits(frames, prefixes):
            out = []
            for a, doc, own, held in met:
                first = None
                for other, heads in held:
                    small, large = sorted((len(own), len(other)))
                    if 100 * small < PERCENT * large:
                        continue
                    first = first or prefixes(own)[1]
                    need = overlap_needed(len(own), len(other), max)
                    if not all(np.isin(x, y).sum() >= need for x, y in zip(first, heads)):
                        continue
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    if similar(shared, len(own), len(other)):
                        out.append((a, doc))
                        break
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    return meetings(pairs, docs).mapInPandas(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component_id): of every linked document the least doc_id that links reach."""
    edges = stored(links.where("a <> b").distinct(), "links")
    maps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = stored(both.groupBy("a").agg((-F.count("*")).alias("d"), F.count("*").alias("c")), "degrees")
        # a hub's links are split: every neighbour's degree is looked up under the skew-safe join
        near = unskewed_join(both, degree.select(F.col("a").alias("b"), "d", "c"), ["b"], "c", 2 * edges.count())
        rank = lambda node: F.struct(F.col("d"), F.xxhash64(node, F.lit(len(maps))).alias("h"), F.col(node).alias("node"))
        best = near.groupBy("a").agg(F.min(rank("b")).alias("best")).join(degree, "a")
        step = stored(best.select(F.col("a").alias("node"), F.least(F.col("best"), rank("a"))["node"].alias("root")), "roots")
        maps.append(step)
        for end in ("a", "b"):
            edges = edges.join(step.select(F.col("node").alias(end), F.col("root").alias("r")), end).drop(end).withColumnRenamed("r", end)
        edges = stored(edges.where("a <> b").select("a", "b").distinct(), "links")
    if not maps:
        return edges.select(F.col("a").alias("doc_id"), F.col("b").alias("component_id"))
    whole = maps[-1]
    for step in reversed(maps[:-1]):
        after = whole.select(F.col("node").alias("root"), F.col("root").alias("r"))
        whole = stored(step.join(after, "root", "left").select("node", F.coalesce("r", "root").alias("root")), "roots")
    least = whole.groupBy("root").agg(F.min("node").alias("component_id"))
    return stored(whole.join(least, "root").select(F.col("node").alias("doc_id"), "component_id"), "components")


#: Sizes that similar sets can have, and ``overlap_needed`` in SQL.
FIT = f"a_n * 100 >= b_n * {PERCENT} AND b_n * 100 >= a_n * {PERCENT}"
NEED = f"({PERCENT} * (a_n + b_n) + {99 + PERCENT}) div {100 + PERCENT} - greatest(({PERCENT} * a_n + 99) div 100, ({PERCENT} * b_n + 99) div 100) + 1"

def together(post: DataFrame) -> DataFrame:
    """The pairs (a, b, a_n, b_n) of different parts that can share enough of the tokens of ``post``.

    Of the tokens that two documents share, the first in the common order has all the
    others after it in both. So a pair that shares enough meets there with enough
    tokens to go, and other meetings are left out. Of these, pairs whose short sketches
    (columns ``mark_*``, if there) differ in more bits than similar sets can are left out at once: in a
    group of near copies, most documents that aren't in its component meet most that are.
    """
    marks = [c for c in post.columns if c.startswith("mark_")]
    bits = " + ".join(["0", *[f"bit_count(x_{m} ^ {m})" for m in marks]])
    room = F.expr(f"{100 + PERCENT} * ({bits}) <= {100 - PERCENT} * (a_n + b_n)")
    few = post.where("part <> largest").select(F.col("token").alias("few_token"), F.col("doc_id").alias("x"), F.col("n").alias("a_n"), F.col("part").alias("x_part"), F.col("rest").alias("x_rest"), *[F.col(m).alias(f"x_{m}") for m in marks])
    once = (F.col("part") == F.col("largest")) | (F.col("x") < F.col("doc_id"))
    pairs = few.join(post.withColumnRenamed("n", "b_n"), (F.col("few_token") == F.col("token")) & (F.col("x_part") != F.col("part")) & once & F.expr(FIT) & (F.least("x_rest", "rest") >= F.expr(NEED)) & room)
    return pairs.select(*ends()).distinct()


def compared(single: DataFrame, total: int) -> DataFrame:
    """The pairs (a, b) of the first round: a document and the most typical one with the same least token under an order."""
    least = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"least_{k}").alias("token")) for k in range(TYPICAL)]))
    least = stored(single.select("doc_id", "n", least.alias("l")).select("doc_id", "n", "l.k", "l.token"), "ngram-least")
    held = stored(least.groupBy("k", "token").agg(F.count("*").alias("c")).where("c > 1"), "ngram-held")
    met = unskewed_join(least, held, ["k", "token"], "c", TYPICAL * total)
    typical = met.groupBy("doc_id", "n").agg(F.sum(F.floor(16 * F.log2("c"))).alias("typical"), F.collect_list(F.when(F.col("k") < STARS, F.struct("k", "token", "c"))).alias("own"))
    met = stored(typical.select("doc_id", "n", "typical", F.explode("own").alias("o")).select("doc_id", "n", "typical", "o.k", "o.token"), "ngram-typical")
    sizes = met.groupBy("k", "token").agg(F.count("*").alias("c"))
    share = F.when(F.col("c") > LARGE, F.pmod(F.xxhash64("doc_id"), F.lit(CENTERS))).otherwise(0)
    met = stored(unskewed_join(met, sizes, ["k", "token"], "c", STARS * total).withColumn("share", share), "ngram-stars")
    center = met.groupBy("k", "token", "share").agg(F.max(F.struct("typical", "doc_id", "n")).alias("center"))
    center = center.groupBy("k", "token").agg(F.collect_list("center").alias("centers")).join(sizes, ["k", "token"])  # CENTERS at most
    stars = unskewed_join(met.drop("c"), center, ["k", "token"], "c", STARS * total).select(F.explode("centers").alias("center"), F.col("doc_id").alias("b"), F.col("n").alias("b_n"))
    stars = stars.select(F.col("center.doc_id").alias("a"), F.col("center.n").alias("a_n"), "b", "b_n")
    return stars.where((F.col("a") != F.col("b")) & F.expr(FIT)).select("a", "b").distinct()


def find_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summaries, links of the first round and of the join, components) of documents (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    rows, counts = summaries(docs)
    frequency = spark.sparkContext.broadcast(counts)
    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    full = rows.where("n > 0 AND doc_id IS NOT NULL")

    equal, total = ["digest_a", "digest_b", "n"], rows.count()
    same = full.groupBy(*equal).agg(F.min("doc_id").alias("a"), F.count("*").alias("c")).where("c > 1")
    copies = unskewed_join(full, same, equal, "c", total).where("a <> doc_id").select("a", F.col("doc_id").alias("b"))
    stars = compared(full.groupBy(*equal).agg(F.min("doc_id").alias("doc_id"), *[F.first(f"least_{k}").alias(f"least_{k}") for k in range(TYPICAL)]), total)
    known = stored(linked(stars, named, frequency).unionByName(copies), "ngram-known")
    parts = components(known)

    # of equal sets only the least doc_id meets others: nearly all copies are left out before they are read, the rest below
    marks = [f"mark_{k}" for k in range(MARKS)]
    first = stored(full.groupBy(*equal).agg(F.min("doc_id").alias("doc_id"), *[F.first(m).alias(m) for m in marks]).select("doc_id", "n", *marks), "ngram-first")
    post = postings(narrowed(named, "doc_id", first.select("doc_id")), frequency).repartition("token").dropDuplicates()
    post = post.withColumn("many", F.count("*").over(Window.partitionBy("token"))).where("many > 1").drop("many")
    held = first.select("doc_id", "n").distinct().join(parts, "doc_id", "left").select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("part"))
    post = post.join(held, ["doc_id", "n"]).select("token", "doc_id", "n", "part")
    post = stored(crossing(stored(post, "ngram-shared")).join(first, ["doc_id", "n"]), "ngram-postings")
    found = linked(near(stored(together(post), "ngram-candidates"), full), named, frequency)
    links = stored(known.unionByName(found), "ngram-links")
    return rows, links, components(links)


def ngram_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    rows, _, parts = find_links(docs.select("doc_id", "text"))
    return rows.join(parts, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that have a smaller doc_id in their component."""
    _, _, parts = find_links(docs.select("doc_id", "text"))
    gone = parts.where("doc_id <> component_id").select(F.col("doc_id").alias("gone"))
    return docs.join(gone, docs["doc_id"] == F.col("gone"), "left_anti")
