"""Mixing sources to target weights by hash-threshold histograms.

Every row has a stable 60-bit hash of its id. Sizes are summed by source and
hash bucket; a running sum over a source's buckets finds the bucket in which
its budget ends, only that boundary bucket is split further, and so on until it
holds one hash. Rows are then taken by comparing their hash with the source's
cut: nothing is sorted, and a smaller budget takes a subset of a larger one.

Defined cases: a null size or text counts 0, a null source is a source of its
own (last in order), a null id hashes like the empty string, rows with the same
id stand or fall together, an empty table gives an empty mix. Only the named
columns are read, so extra columns can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import stored

HASH_BITS = 60
LEVEL_BITS = 12  # a histogram has 2**12 buckets a source
MAX_SOURCES = 100_000  # cuts are broadcast up to this many sources, beyond that joined


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix_hash(doc_id: Column, seed: str) -> Column:
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def repeating_weights(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Give the sources, in code point order with null last, the weights in turn.

    One row per source: this is the mixture's table of contents, not the data.
    """
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(n, F.lit(len(weights))) + 1).cast("long"))


def targets(sources: DataFrame, max_repeats: int = 3, share: float = 1.0) -> DataFrame:
    """Split ``share`` of all sizes over (source, source_size, weight) rows, at most ``max_repeats`` times a source's size.

    What a source cannot take is reshared by weight. In order of size per weight
    the sources at their limit come first, so one running sum finds them all.
    """
    cap = F.col("source_size") * max_repeats
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    s = sources.withColumns(
        {
            "left": F.floor(F.sum("source_size").over(every) * F.lit(share)) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
            "weights": F.sum("weight").over(after),
        }
    )
    fits = F.col("left") * F.col("weight") <= cap * F.col("weights")
    first = F.min(F.when(fits, F.struct(cap / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("left"), F.col("weights")).alias("f"))).over(every)
    s = s.withColumn("first", first)
    free = fits | (F.struct(cap / F.col("weight"), F.col("source").isNull(), F.col("source")) > F.struct(F.col("first.col1"), F.col("first.col2"), F.col("first.source")))
    target = F.when(free, (F.col("first.left") * F.col("weight")).cast("double") / F.col("first.weights")).otherwise(cap.cast("double"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """The hash cut of each source: (source, source_size, target, base, cut).

    ``rows`` has source, hash, size. A row is taken ``base`` times, and once more
    when its hash is at most ``cut``.
    """
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("base", base).withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
    edge = goals.where("budget > 0").select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("taken"))
    done = None
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        inside = rows.select(F.col("source").alias("s"), "hash", "size").join(
            small(edge), F.col("s").eqNullSafe(F.col("source")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix"))
        )
        bars = inside.groupBy("source", F.shiftright("hash", shift).alias("bar")).agg(
            F.first("budget").alias("budget"), F.first("taken").alias("taken"),
            F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high"),
        )
        run = Window.partitionBy("source").orderBy("bar").rowsBetween(Window.unboundedPreceding, -1)
        bars = bars.withColumn("before", F.col("taken") + F.coalesce(F.sum("size").over(run), F.lit(0)))
        bars = stored(bars.where((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("size"))), "mix-edge")
        ends = bars.where(F.col("low") == F.col("high")).select(
            "source", (F.col("high") - F.when(2 * (F.col("budget") - F.col("before")) > F.col("size"), 0).otherwise(1)).alias("cut")
        )
        done = ends if done is None else done.unionByName(ends)
        edge = bars.where(F.col("low") < F.col("high")).select("source", "budget", F.col("bar").alias("prefix"), F.col("before").alias("taken"))
        if edge.isEmpty():
            break
    done = done.select(F.col("source").alias("s"), "cut")
    out = goals.join(done, F.col("s").eqNullSafe(F.col("source")), "left")
    return stored(out.select("source", "source_size", "target", "base", F.coalesce("cut", F.lit(-1)).alias("cut")), "mix-cuts")


def small(sources: DataFrame) -> DataFrame:
    """Broadcast a per-source table after counting it; a larger one is left to a shuffle join."""
    return F.broadcast(sources) if sources.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES else sources


def plan_mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, share: float = 1.0):
    """(rows, cuts) of a mix of documents (doc_id, source, text); rows has doc_id, source, hash, size."""
    rows = stored(docs.select("doc_id", "source", mix_hash(F.col("doc_id"), seed).alias("hash"), word_count(F.col("text")).alias("size")), "mix-rows")
    per = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    return rows, cuts(rows, targets(repeating_weights(per, weights), max_repeats, share))


def copies() -> Column:
    return F.col("base") + (F.col("hash") <= F.col("cut")).cast("long")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows, plan = plan_mix(docs, **options)
    plan = plan.withColumnRenamed("source", "s")
    return rows.join(small(plan), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", copies().alias("copies"), (F.col("size") * copies()).alias("taken")
    )


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mixed documents themselves, a row for each copy taken, with the columns of ``docs``."""
    _, plan = plan_mix(docs, seed=seed, **options)
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("source").alias("src"), mix_hash(F.col("doc_id"), seed).alias("hash"))
    row = row.join(small(plan), F.col("src").eqNullSafe(F.col("source"))).where(copies() > 0)
    return row.select("row", F.explode(F.array_repeat(F.lit(0), copies().cast("int")))).select("row.*")


ORACLE = r"""WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(concat('0x', substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS c, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS w FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY 3 * c / w, source NULLS LAST) AS k FROM s),
f AS (SELECT *, CAST((SELECT sum(c) FROM s) - coalesce(sum(3 * c) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
             CAST(sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS ws FROM o),
z AS (SELECT * FROM f WHERE rest * w <= 3 * c * ws ORDER BY k LIMIT 1),
t AS (SELECT f.source, f.c, CASE WHEN f.k >= z.k THEN CAST(z.rest * f.w AS DOUBLE) / z.ws ELSE CAST(3 * f.c AS DOUBLE) END AS target FROM f, z),
b AS (SELECT *, CASE WHEN c > 0 THEN CAST(floor(target / c) AS BIGINT) ELSE 0 END AS base FROM t),
r AS (SELECT d.doc_id, d.size, b.c, b.target, b.base, b.target - b.base * b.c AS budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) - d.size AS before FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, c AS source_size, target, CAST(size * (base + CASE WHEN 2 * (budget - before) > size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r"""
