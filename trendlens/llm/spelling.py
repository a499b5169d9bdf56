"""Spelling variant grouping by a bit-sliced position index.

The words are counted over all texts (map-side first). Two near words differ by
one inserted, deleted or replaced letter, so they agree outside the region where
that letter is. Blocks gather the words that agree outside a region: the two
halves of a word to begin with, and halves of halves again where a block holds
more than BLOCK_LETTERS letters, until a region is one letter wide and a block
is bounded by the alphabet. Every near pair has one first differing position,
hence one block.

Within a block, a bitset over its words stands for every (position, letter) of
the regions. A word is matched against all of them at once: its letters move the
set of words without an error so far, and the three sets with one error
(replaced, left out, put in), whose positions are shifted by 0, -1 and +1. The
bits are ordered by falling count, so the lowest bit of a result is the word's
form.

Defined cases: a null text has no words; a null doc_id counts as an empty one in
the deletion rule; equal rows count each; ties of a form go to the word that is
smallest in code-point order; a word without near words has n_near 0 and is its
own root; an empty table gives an empty result; very long texts and runs are
read whole; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import ship, stored, unskewed_join
from trendlens.llm.exact_dedup import UPPER, normalised

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT = 6, 5
FACTOR = 5  # a form is so many times as frequent
DELETE_EVERY = 199
BLOCK_LETTERS = 100_000


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_length`` code points and ``min_count`` occurrences.

    A run whose CRC-32 of ``<doc_id>:<run>`` is a multiple of DELETE_EVERY loses one letter.
    """
    # shorter runs give no word, and a run that is long enough is matched whole
    runs = F.regexp_extract_all(normalised(F.col("text")), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DELETE_EVERY == 0, shorter).otherwise(F.col("run"))
    counts = rows.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where((F.col("n") >= min_count) & (F.length("word") >= min_length))


def _blocked(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, lo, hi) with the hash of what their block agrees in, outside the region [lo, hi) of m letters."""
    outside = (F.substring("word", F.lit(1), F.col("lo")), F.expr("substring(word, char_length(word) - (m - hi) + 1, m - hi)"))
    return rows.withColumn("block", F.xxhash64("m", "lo", "hi", *outside))


def blocks(words: DataFrame, min_length: int = MIN_LENGTH, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(block, m, lo, hi, word, n): for pairs whose shorter word has m letters; large blocks are split by finer regions."""
    halves = "explode(flatten(transform(array(len, len - 1), m -> array(struct(m, 0 AS lo, m div 2 AS hi), struct(m, m div 2 AS lo, m AS hi)))))"
    rows = words.withColumn("len", F.length("word")).selectExpr("word", "n", f"{halves} AS r").selectExpr("word", "n", "r.m", "CAST(r.lo AS INT) AS lo", "CAST(r.hi AS INT) AS hi")
    todo, done = stored(_blocked(rows.where(F.col("m") >= min_length)), "blocks"), []
    while True:
        letters = todo.groupBy("block").agg(F.sum(F.col("hi") - F.col("lo")).alias("letters"), F.count("*").alias("c"), F.max(F.col("hi") - F.col("lo")).alias("w"))
        large = stored(letters.where((F.col("letters") > block_letters) & (F.col("w") > 1)).select("block", "c"), "large-blocks")
        if large.isEmpty():
            done.append(todo)
            break
        marked = unskewed_join(todo, large, ["block"], "c", todo.count(), "left")
        done.append(marked.where("c IS NULL").drop("c"))
        finer = "explode(array(struct(lo, (lo + hi) div 2 AS hi), struct((lo + hi) div 2 AS lo, hi)))"
        todo = marked.where("c IS NOT NULL").selectExpr("word", "n", "m", f"{finer} AS r").selectExpr("word", "n", "m", "CAST(r.lo AS INT) AS lo", "CAST(r.hi AS INT) AS hi")
        todo = stored(_blocked(todo), "blocks")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def match(middles: list[str], m: int, last: bool) -> list[int]:
    """Of each string the bitset of those that are near and whose first difference is in the region.

    The strings have m or m + 1 letters; of two of m + 1 letters none is reported.
    ``last``: the region ends with the word, so a letter may follow it.
    """
    at: dict[tuple[int, str], int] = defaultdict(int)
    short = long = 0
    for k, w in enumerate(middles):
        bit = 1 << k
        for i, letter in enumerate(w):
            at[i, letter] |= bit
        if len(w) == m:
            short |= bit
        else:
            long |= bit
    all_words, get, out = short | long, at.get, []
    for w in middles:
        same, replaced, left_out, put_in = all_words, 0, 0, 0
        for i, letter in enumerate(w):
            hit = get((i, letter), 0)
            wrong = same & ~hit if i < m or last else 0
            left_out = left_out & get((i - 1, letter), 0) | wrong
            put_in = (put_in | wrong) & get((i + 1, letter), 0)
            replaced = replaced & hit | wrong
            same &= hit
        if last:
            put_in |= same
        out.append(replaced & short | put_in & long if len(w) == m else left_out & short)
    return out


def _near(rows: list[tuple]) -> Iterator[tuple]:
    """(word, n_near, best_n, best) within the rows (m, lo, hi, word, n) of one block hash."""
    groups = defaultdict(list)
    for m, lo, hi, word, n in rows:
        end = len(word) - (m - hi)
        groups[m, lo, hi, word[:lo], word[end:]].append((-n, word, word[lo:end]))
    for (m, lo, hi, _, _), own in groups.items():
        if len(own) < 2:
            continue
        own.sort()
        for (_, word, _), near in zip(own, match([x[2] for x in own], hi - lo, hi == m)):
            if near:
                best = own[(near & -near).bit_length() - 1]
                yield word, near.bit_count(), -best[0], best[1]


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words: their number, and the most frequent one."""
    ship(words.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held = None, []
        for frame in frames:
            out = []
            for b, *row in zip(*[frame[c].tolist() for c in ("block", "m", "lo", "hi", "word", "n")]):
                if b != block:
                    if len(held) > 1:
                        out += _near(held)
                    block, held = b, []
                held.append(row)
            if out:
                yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])
        if len(held) > 1 and (out := list(_near(held))):
            yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])

    rows = blocks(words, min_length, block_letters).select("block", "m", "lo", "hi", "word", "n").repartition("block").sortWithinPartitions("block")
    found = rows.mapInPandas(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).selectExpr("word", "n_near", "-b.less AS best_n", "b.best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to. Every round doubles the steps taken."""
    up = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(up.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        up = step.select("word", "root")


def spelling_groups(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts."""
    words = stored(word_counts(docs.select("doc_id", "text"), min_length, min_count), "words")
    near = words.join(near_words(words, min_length), "word", "left")
    rare = F.col("best_n") >= factor * F.col("n")
    near = near.select("word", F.when(rare, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(rare, F.col("best_n")).alias("form_n"))
    near = stored(near, "forms")
    out = near.join(roots(near.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: CRC-32 is linear: a byte's share depends on the byte and its distance to the end alone.
ORACLE = f"""WITH RECURSIVE
bits(b, c, k) AS (SELECT b, b, 0 FROM range(256) r(b) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
t0 AS MATERIALIZED (SELECT b, c FROM bits WHERE k = 8),
found AS MATERIALIZED (
  SELECT doc_id::VARCHAR || ':' || run AS key, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
longest AS (SELECT max(octet_length(encode(key))) AS n FROM found),
share(d, b, c) AS (SELECT 0, b, c FROM t0 UNION ALL SELECT s.d + 1, s.b, xor(s.c >> 8, t0.c) FROM share s JOIN t0 ON t0.b = s.c & 255 WHERE s.d + 1 < (SELECT n FROM longest)),
start(d, c) AS (SELECT 0, 4294967295 UNION ALL SELECT s.d + 1, xor(s.c >> 8, t0.c) FROM start s JOIN t0 ON t0.b = s.c & 255 WHERE s.d < (SELECT n FROM longest)),
bytes AS (SELECT key, run, times, octet_length(encode(key)) AS n, unnest(range(octet_length(encode(key)))) AS i, hex(encode(key)) AS h FROM found),
crc AS (SELECT key, any_value(run) AS run, any_value(times) AS times, xor(xor(bit_xor(share.c), any_value(start.c)), 4294967295) AS h
  FROM bytes JOIN share ON share.d = n - 1 - i AND share.b = ('0x' || substr(bytes.h, 2 * i + 1, 2))::BIGINT JOIN start ON start.d = n GROUP BY key),
word AS (SELECT CASE WHEN h % {DELETE_EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM crc),
vocab AS MATERIALIZED (SELECT word, sum(times)::BIGINT AS n FROM word WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
cut AS MATERIALIZED (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocab)),
pairs AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN vocab b ON a.rest = b.word),
best AS (SELECT word, any_value(n) AS n, count(*) AS n_near, min((-other_n, other)) AS b FROM pairs GROUP BY word),
form AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= {FACTOR} * v.n THEN b[2] END AS form, CASE WHEN -b[1] >= {FACTOR} * v.n THEN -b[1] END AS form_n
  FROM vocab v LEFT JOIN best ON best.word = v.word),
walk(word, root) AS (SELECT word, word FROM form UNION ALL SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.root WHERE form.form IS NOT NULL)
SELECT form.word, form.form, walk.root, form.n, form.n_near, form.form_n FROM form JOIN walk ON walk.word = form.word
WHERE walk.root IN (SELECT word FROM form WHERE form IS NULL)"""
