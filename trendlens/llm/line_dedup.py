"""Line dedup on DataFrame operations only.

Every text is split into lines, the normalised lines are exploded and hashed
into a narrow table (document, position, digest), and the distinct documents of
each digest are counted. Lines whose digest is in at least ``min_docs``
documents go from all of them but the largest doc_id; what is left of a text is
put together again by position. Only that last join moves texts, once.

Defined cases: a null or empty text is one empty line; lines end at ``\\n`` alone,
so a ``\\r`` before it is kept but is no part of the key; keys shorter than
``min_chars`` code points never go; a line that a document repeats counts as one
document, and all its copies stay or go together; a null doc_id is one document,
smaller than any other; rows with the same doc_id are one document, each with a
text of its own; a text all of whose lines go is empty; an empty table gives an
empty result; very long texts and lines are handled whole. Equal SHA-256 digests
are taken as equal lines. Extra columns are not looked at and ``drop_lines``
returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import stored, unskewed_join
from trendlens.llm.exact_dedup import UPPER, normalised

MIN_CHARS = 20
MIN_DOCS = 3
SPACE = " \t\n\x0b\x0c\r"


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_key(text: Column) -> Column:
    """Tells apart the texts of rows that share a doc_id."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def line_digests(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_key, pos, digest) of every line whose key has ``min_chars`` code points."""
    lines = docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), F.posexplode(_split(normalised(F.col("text")))).alias("pos", "line"))
    key = lines.withColumn("line", F.btrim("line", F.lit(SPACE))).where(F.length("line") >= min_chars)
    return key.select("doc_id", "text_key", "pos", F.unhex(F.sha2("line", 256)).alias("digest"))


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(digest, n_docs, keep_id, n_rows) of the digests that ``min_docs`` distinct documents hold."""
    each = lines.groupBy("digest", "doc_id").agg(F.count("*").alias("c"))
    found = each.groupBy("digest").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_id"), F.sum("c").alias("n_rows"))
    return found.where(F.col("n_docs") >= min_docs)


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_key, gone): the positions of the lines that go, of the texts that lose any."""
    lines = stored(line_digests(docs, min_chars), "lines")
    frequent = stored(frequent_lines(lines, min_docs), "frequent-lines")
    hits = unskewed_join(lines, frequent, ["digest"], "n_rows", lines.count()).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return hits.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("gone"))


def _cut(rows: DataFrame, docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``rows`` (with doc_id, text_key, lines) and what is left of their lines: n_lines, n_dropped, kept."""
    gone = dropped_positions(docs, min_chars, min_docs).toDF("gone_id", "gone_key", "gone")
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key"))
    rows = rows.join(gone, same, "left")
    n = F.size("lines")
    # lines is a column of the join's input, so the lambda only looks its elements up
    left = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone")), lambda i: F.get("lines", i))
    kept = F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(left, "\n"))
    dropped = F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0))
    return rows.withColumns({"n_lines": n.cast("long"), "n_dropped": dropped.cast("long"), "kept": kept})


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept (the text that is left)."""
    docs = docs.select("doc_id", "text")
    rows = docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), _split(F.col("text")).alias("lines"))
    return _cut(rows, docs, min_chars, min_docs).select("doc_id", "n_lines", "n_dropped", "kept")


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` replaced by what is left of it; all other columns as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    rows = docs.select(row, "doc_id", _text_key(F.col("text")).alias("text_key"), _split(F.col("text")).alias("lines"))
    out = _cut(rows, docs.select("doc_id", "text"), min_chars, min_docs)
    return out.select(*[F.col("kept").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


ORACLE = f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT doc_id, pos, line, coalesce(doc_id <> keep_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""
