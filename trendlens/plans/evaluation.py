"""Registered evaluation queries over the document-token stream (K = 50, N = 20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.config import DEFAULT_K, DEFAULT_N, DEFAULT_SEED, new_work_dir
from trendlens.functions.scalar import format_bytes
from trendlens.operators import evaluate as ev
from trendlens.operators import exact as ex
from trendlens.operators import misra_gries as mg
from trendlens.operators import operations as ops
from trendlens.operators import reservoir as rs
from trendlens.plans import sql as S
from trendlens.plans.catalog import doc_tokens
from trendlens.plans.registry import register
from trendlens.sources.keywords import read_table

K, N, SEED = DEFAULT_K, DEFAULT_N, DEFAULT_SEED

# Shared CTEs: stream, MG summary, exact counts and top-K, sample, totals.
def base_ctes(mg_ctes: list[str] | None = None, source: str = "doc_tok", source_ctes: list[str] | None = None) -> list[str]:
    """CTEs over a keyword stream CTE ``source`` (default: the document tokens).

    ``mg_ctes`` must define a CTE named ``mg``; default: the one-batch MG of the stream.
    """
    mg_part = mg_ctes if mg_ctes is not None else [S.counts_cte("c", source), S.mg_prune_cte("mg", "c", K)]
    return [
        *(source_ctes if source_ctes is not None else [S.DOC_TOK]),
        *mg_part,
        f"ex AS (SELECT keyword, count(*) AS exact_count FROM {source} GROUP BY keyword)",
        f"et AS (SELECT keyword, exact_count FROM ex ORDER BY exact_count DESC, keyword LIMIT {K})",
        S.reservoir_cte("r", source, N, SEED),
        f"tot AS (SELECT count(*) AS t FROM {source})",
    ]


_BASE = base_ctes()

_TVD = [
    "sc AS (SELECT keyword, count(*) AS s FROM r GROUP BY keyword)",
    "sz AS (SELECT count(*) AS z FROM r)",
    """tv AS (SELECT CASE WHEN (SELECT z FROM sz) > 0 AND (SELECT t FROM tot) > 0 AND (SELECT count(*) FROM ex) > 0
        THEN 0.5 * sum(abs(ex.exact_count::DOUBLE / (SELECT t FROM tot) - coalesce(sc.s, 0)::DOUBLE / (SELECT z FROM sz)))
        ELSE 1.0 END AS tvd
      FROM ex LEFT JOIN sc USING (keyword))""",
]

_SIZES = [
    "ms AS (SELECT CAST(coalesce(sum(strlen(keyword) + 8), 0) AS BIGINT) AS b FROM mg)",
    "es AS (SELECT CAST(coalesce(sum(strlen(keyword) + 8), 0) AS BIGINT) AS b FROM ex)",
    "rsz AS (SELECT CAST(coalesce(sum(strlen(keyword) + 8), 0) AS BIGINT) AS b FROM r)",
]

_SIZES_SELECT = """(SELECT b FROM ms) AS mg_memory_bytes, (SELECT b FROM es) AS exact_memory_bytes,
  (SELECT b FROM rsz) AS reservoir_memory_bytes,
  round(CASE WHEN (SELECT b FROM es) > 0 THEN ((SELECT b FROM es) - (SELECT b FROM ms))::DOUBLE / (SELECT b FROM es) * 100.0
        ELSE 0.0 END, 6) AS memory_saved_percent"""


def _parts(spark: SparkSession, sf_dir: str):
    """MG summary, exact counts and totals all come from ONE aggregation of the tokens,
    which is stored; the sample is the one other scan.

    The sample (≤ N rows) is read by several branches of the metric plans and a
    top-N is not a reusable exchange, so it is stored too (in the shared folder).
    """
    summary, exact = _counts(spark, sf_dir)
    path = new_work_dir(spark, "sample")
    rs.reservoir_sample(doc_tokens(spark, sf_dir), N, "uid", SEED).write.parquet(path)
    sample = spark.read.parquet(path)
    totals = exact.agg(F.sum("exact_count").cast("long").alias("total_processed"))
    return summary, exact, sample, totals


def _counts(spark: SparkSession, sf_dir: str):
    """MG summary and exact counts of the tokens, which are counted once and stored."""
    path = new_work_dir(spark, "exact-counts")
    ex.exact_counts(doc_tokens(spark, sf_dir)).write.parquet(path)
    exact = spark.read.parquet(path)
    return mg.mg_prune(exact.select("keyword", F.col("exact_count").alias("n")), K), exact


@register(
    "eval_overlap",
    S.with_(
        S.DOC_COUNTS,
        S.mg_prune_cte("mg", "c", K),
        f"et AS MATERIALIZED (SELECT keyword FROM c ORDER BY n DESC, keyword LIMIT {K})",
    )
    + "SELECT mg.keyword FROM mg JOIN et ON et.keyword = mg.keyword",
)
def q_eval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords in both the MG summary and the exact top-K."""
    summary, exact = _counts(spark, sf_dir)
    return ev.eval_overlap(summary, ex.exact_topk(exact, K))


@register(
    "eval_missed",
    S.with_(*_BASE) + "SELECT keyword, exact_count FROM et WHERE keyword NOT IN (SELECT keyword FROM mg)",
)
def q_eval_missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top-K keywords the summary missed (anti join)."""
    summary, exact = _counts(spark, sf_dir)
    return ev.eval_missed(summary, ex.exact_topk(exact, K))


@register(
    "reservoir_tvd",
    S.with_(*_BASE, *_TVD)
    + "SELECT round(tvd, 6) AS reservoir_tvd, round(greatest(0.0, 1.0 - tvd), 6) AS reservoir_similarity FROM tv",
)
def q_reservoir_tvd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + J2: total variation distance between the sample and the exact distribution."""
    _, exact, sample, totals = _parts(spark, sf_dir)
    return ev.reservoir_tvd(exact, sample, totals)


@register("state_size", S.with_(*_BASE, *_SIZES) + "SELECT " + _SIZES_SELECT)
def q_state_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload bytes of the MG, exact and reservoir states, and the saving."""
    summary, exact, sample, _ = _parts(spark, sf_dir)
    return ev.state_size(summary, exact, sample)


def eval_sql(base: list[str]) -> str:
    return (
        S.with_(*base, *_TVD, *_SIZES)
        + f"""SELECT
  CASE WHEN (SELECT count(*) FROM et) > 0
       THEN round((SELECT count(*) FROM mg WHERE keyword IN (SELECT keyword FROM et))::DOUBLE / (SELECT count(*) FROM et), 6)
       ELSE 0.0 END AS topk_recall_at_k,
  CASE WHEN (SELECT keyword FROM mg ORDER BY approx_count DESC, keyword LIMIT 1)
          = (SELECT keyword FROM et ORDER BY exact_count DESC, keyword LIMIT 1) THEN 1 ELSE 0 END AS top1_match,
  (SELECT count(*) FROM mg WHERE keyword IN (SELECT keyword FROM et)) AS overlap_count,
  (SELECT round(tvd, 6) FROM tv) AS reservoir_tvd,
  (SELECT round(greatest(0.0, 1.0 - tvd), 6) FROM tv) AS reservoir_similarity,
  (SELECT count(*) FROM mg) AS mg_unique,
  (SELECT count(*) FROM ex) AS exact_unique,
  {_SIZES_SELECT},
  1 AS exact_baseline_enabled"""
    )


_EVAL_SQL = eval_sql(_BASE)


@register("eval_metrics", _EVAL_SQL)
def q_eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the 12 published accuracy and size metrics in one row."""
    summary, exact, sample, totals = _parts(spark, sf_dir)
    return ev.evaluate(summary, exact, sample, totals, K)


@register(
    "eval_metrics_no_exact",
    S.with_(*_BASE, *_SIZES)
    + """SELECT 0.0::DOUBLE AS topk_recall_at_k, 0 AS top1_match, CAST(0 AS BIGINT) AS overlap_count,
  1.0::DOUBLE AS reservoir_tvd, 0.0::DOUBLE AS reservoir_similarity, (SELECT count(*) FROM mg) AS mg_unique, CAST(0 AS BIGINT) AS exact_unique,
  (SELECT b FROM ms) AS mg_memory_bytes, CAST(0 AS BIGINT) AS exact_memory_bytes, (SELECT b FROM rsz) AS reservoir_memory_bytes,
  0.0::DOUBLE AS memory_saved_percent, 0 AS exact_baseline_enabled""",
)
def q_eval_metrics_no_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 with the exact baseline switched off: accuracy fields take their defaults."""
    summary, _, sample, totals = _parts(spark, sf_dir)
    return ev.evaluate(summary, None, sample, totals, K)


@register(
    "memory_display",
    S.with_(*_BASE, *_SIZES)
    + f"""SELECT {S.format_bytes_sql("(SELECT b FROM es)")} AS exact_memory_text,
  {S.format_bytes_sql("(SELECT b FROM ms)")} AS mg_memory_text,
  round(greatest(least(CASE WHEN (SELECT b FROM es) > 0 THEN ((SELECT b FROM es) - (SELECT b FROM ms))::DOUBLE
        / (SELECT b FROM es) * 100.0 ELSE 0.0 END, 99.99), -999.0), 6) AS saved_percent""",
)
def q_memory_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + F6: size texts of the exact and MG states and the clamped saving."""
    summary, exact, sample, totals = _parts(spark, sf_dir)
    return ev.memory_display(ev.evaluate(summary, exact, sample, totals, K), totals, K)


@register(
    "state_size_estimate",
    S.with_(*_BASE, *_SIZES)
    + f"""SELECT {S.format_bytes_sql("(SELECT t FROM tot) * 0.2 * 100.0")} AS exact_memory_text,
  {S.format_bytes_sql(f"{K} * 100.0")} AS mg_memory_text,
  round(CASE WHEN (SELECT t FROM tot) * 0.2 * 100.0 > 0
        THEN least(((SELECT t FROM tot) * 0.2 * 100.0 - {K} * 100.0) / ((SELECT t FROM tot) * 0.2 * 100.0) * 100.0, 99.99)
        ELSE 0.0 END, 6) AS saved_percent""",
)
def q_state_size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size estimate used when the exact baseline is off."""
    summary, _, sample, totals = _parts(spark, sf_dir)
    return ev.memory_display(ev.evaluate(summary, None, sample, totals, K), totals, K)


@register(
    "mg_vs_exact_top20",
    S.with_(*_BASE)
    + """SELECT CAST(coalesce(a.rank, b.rank) AS INTEGER) AS rank, a.keyword AS mg_keyword, a.approx_count AS mg_count,
  b.keyword AS exact_keyword, b.exact_count AS exact_count
FROM (SELECT keyword, approx_count, row_number() OVER (ORDER BY approx_count DESC, keyword) AS rank FROM mg) a
FULL JOIN (SELECT keyword, exact_count, row_number() OVER (ORDER BY exact_count DESC, keyword) AS rank FROM et) b
  ON a.rank = b.rank
WHERE coalesce(a.rank, b.rank) <= 20""",
)
def q_mg_vs_exact_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 + T5: the first 20 of the MG and exact rankings side by side."""
    summary, exact, _, _ = _parts(spark, sf_dir)
    return ops.mg_vs_exact(summary, ex.exact_topk(exact, K), 20)


@register(
    "format_bytes",
    f"SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS html_bytes, "
    f"{S.format_bytes_sql('octet_length(encode(html))')} AS html_size FROM pages",
)
def q_format_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """byte-size text of every page's HTML."""
    pages = read_table(spark, sf_dir, "pages")
    size = F.octet_length("html").cast("long")
    return pages.select("page_id", size.alias("html_bytes"), format_bytes(size).alias("html_size"))
