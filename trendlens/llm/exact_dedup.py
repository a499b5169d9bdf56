"""Exact dedup by skew-safe combining, on DataFrame operations only.

Digests are counted first in a narrow table, so that only texts whose digest
occurs again travel. Those are deduplicated locally (map-side aggregation),
merged in salted digest groups, and the salts' winners are combined globally.
The whole normalised text is part of every grouping and join key, so rows are
merged on equal content, never on equal digests alone.

Defined cases: a null text counts as empty, texts are equal when identical
after lower-casing A-Z only, the largest doc_id stays (a null one only if no
other is there); rows with the same doc_id and text are all marked kept, and
``dedup`` returns one of them. Empty table: empty result. Extra columns are not
looked at and ``dedup`` returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import stored, unskewed_join

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SALTS = 32


def normalised(text: Column) -> Column:
    """A-Z to a-z; on pure ASCII the cheaper ``lower`` does the same."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def salted() -> Column:
    """By doc_id, not by place, so that a task run again gives every row the same salt; rows with equal doc_ids combine locally."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")


def _digests(docs: DataFrame) -> tuple[DataFrame, int]:
    """Every row's digest and, where it occurs again, its count ``n``; and the number of rows."""
    rows = stored(docs.select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")), "dedup-digests")
    total = rows.count()
    again = rows.select("digest", salted()).groupBy("digest", "salt").agg(F.count("*").alias("n"))
    again = stored(again.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1"), "dedup-again")
    return unskewed_join(rows, again, ["digest"], "n", total, "left"), total


def _repeated(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose digest occurs again: row, doc_id, digest, norm."""
    ids = rows.where("n IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("digest").alias("d")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    row = row.join(ids, F.col("doc_id").eqNullSafe(F.col("id"))).withColumn("norm", normalised(F.col("text")))
    return row.where(F.unhex(F.sha2("norm", 256)) == F.col("d")).select("row", "doc_id", F.col("d").alias("digest"), "norm")


def _winners(repeated: DataFrame, value: Column) -> DataFrame:
    """Of each content: the value with the largest doc_id, and the number of rows."""
    part = repeated.select("digest", "norm", salted(), F.struct(F.col("doc_id"), value.alias("value")).alias("w"))
    part = part.groupBy("digest", "salt", "norm").agg(F.max("w").alias("w"), F.count("*").alias("size"))
    return part.groupBy("digest", "norm").agg(F.max("w").alias("w"), F.sum("size").alias("size"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, total = _digests(docs)
    rows = stored(rows, "dedup-rows")
    repeated = stored(_repeated(docs.select("doc_id", "text"), rows).drop("row"), "dedup-texts")
    winners = stored(_winners(repeated, F.lit(0)).select("digest", "norm", F.col("w.doc_id").alias("keep_id"), F.col("size").alias("group_size")), "dedup-winners")
    groups = unskewed_join(repeated, winners, ["digest", "norm"], "group_size", total).select("doc_id", "digest", "keep_id", "group_size")
    alone = rows.where("n IS NULL").select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return groups.unionByName(alone).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all columns of ``docs``."""
    rows, _ = _digests(docs)
    rows = stored(rows, "dedup-rows")
    repeated = _repeated(docs, rows)
    kept = _winners(repeated, F.col("row")).select("w.value.*")
    ids = rows.where("n IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("digest").alias("d")).distinct()
    alone = docs.join(ids, docs["doc_id"].eqNullSafe(F.col("id")) & (F.unhex(F.sha2(normalised(docs["text"]), 256)) == F.col("d")), "left_anti")
    return alone.unionByName(kept)


ORACLE = f"""WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)"""
