"""Registered streaming queries: fixed micro-batch replays through the real Structured
Streaming fold (file source -> parse -> ``foreachBatch``), read back from the epoch store.

Scenarios (each replay runs once per session and data folder; several keys read it).
Batches split a table by ``doc_id % m`` or by phase: every row is in exactly one
batch, so each replay processes the whole table.

- plain:       document tokens in 3 batches (``doc_id % 3``), then a batch of junk
               messages (document lines, none valid JSON) that admits no row
- resize:      tokens in 4 batches (``doc_id % 4``); before batch 1 K=10, N=5; before
               batch 2 k="abc", n="0" (ignored); before batch 3 K=100, N=50
- reset:       tokens in 3 batches with a reset before batch 2
- reset_empty: tokens in 2 batches (``doc_id % 2``), then a reset and a junk batch
- grow:        tokens in 2 batches (``doc_id % 2``); N grows from 20 to 1000 before batch 1
- toggle:      tokens in 3 batches (``doc_id % 3``), the exact baseline off in the second
- burst:       the search stream in 8 phases (normal, normal, burst, burst, 4 × normal)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.config import DEFAULT_K, DEFAULT_N, DEFAULT_SEED, RESERVOIR_SLOTS, new_work_dir
from trendlens.operators import exact as ex
from trendlens.operators import synth
from trendlens.plans import sql as S
from trendlens.plans.catalog import doc_tokens
from trendlens.plans.evaluation import base_ctes, eval_sql
from trendlens.operators import operations as ops
from trendlens.plans.datasets import EXPORTED_AT, PREFIX, _records_sql
from trendlens.plans.operations import AS_OF, PHASE_SIZES, REFRESH_SECONDS, _phase_sql, phased_bursts
from trendlens.sinks.dataset import export_snapshot
from trendlens.sources.dataset import load_dataset
from trendlens.plans.registry import register
from trendlens.sources.keywords import read_table
from trendlens.sources.snapshot import (
    read_counters,
    read_epoch_log,
    read_error_bound,
    read_eval_metrics,
    read_exact_topics,
    read_hot_topics,
    read_mg_history,
    read_samples,
)
from trendlens.streaming.fold import EpochFold, Meta
from trendlens.streaming.query import Step, replay
from trendlens.streaming.state import EpochStore

K, N, SEED = DEFAULT_K, DEFAULT_N, DEFAULT_SEED
CLOCK = 1_700_000_000  # fixed publish time of the registered replays
COMPACT_EVERY = 2  # compact exact deltas often so the replays exercise it

_RUNS: dict[tuple, EpochStore] = {}


def _junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that all fail admission: every line of every document (prose, not JSON)."""
    return read_table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def _steps(spark: SparkSession, sf_dir: str, scenario: str) -> list[Step]:
    tok = doc_tokens(spark, sf_dir)
    if scenario == "plain":
        return [Step(tok.where(F.col("doc_id") % 3 == b)) for b in range(3)] + [Step(_junk(spark, sf_dir))]
    if scenario == "resize":
        b = [tok.where(F.col("doc_id") % 4 == i) for i in range(4)]
        return [Step(b[0]), Step(b[1], k=10, n=5), Step(b[2], k="abc", n="0"), Step(b[3], k=100, n=50)]
    if scenario == "grow":
        return [Step(tok.where(F.col("doc_id") % 2 == 0)), Step(tok.where(F.col("doc_id") % 2 == 1), n=1000)]
    if scenario == "toggle":
        return [Step(tok.where(F.col("doc_id") % 3 == b), enable_exact=b != 1) for b in range(3)]
    if scenario == "reset":
        return [Step(tok.where(F.col("doc_id") % 3 == b), reset=(b == 2)) for b in range(3)]
    if scenario == "reset_empty":
        return [Step(tok.where(F.col("doc_id") % 2 == b)) for b in range(2)] + [Step(_junk(spark, sf_dir), reset=True)]
    if scenario == "burst":
        stream = phased_bursts(spark, sf_dir)
        return [Step(stream.where(F.col("phase") == p)) for p in range(len(PHASE_SIZES))]
    raise ValueError(scenario)


def run(spark: SparkSession, sf_dir: str, scenario: str) -> EpochStore:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), scenario)
    if key not in _RUNS:
        _RUNS[key] = replay(
            spark,
            _steps(spark, sf_dir, scenario),
            new_work_dir(spark, f"replay-{scenario}"),
            K,
            N,
            clock=lambda: CLOCK,
            compact_every=COMPACT_EVERY,
        )
    return _RUNS[key]


# -- oracle SQL ----------------------------------------------------------------------


def _tok_batches(mod: int) -> list[str]:
    return [f"(SELECT keyword FROM doc_tok WHERE doc_id % {mod} = {b})" for b in range(mod)]


def _plain_mg() -> list[str]:
    ctes, final = S.mg_chain_ctes("p", _tok_batches(3), K)
    return ctes + [f"mg AS (SELECT * FROM {final})"]


def _resize_mg() -> list[str]:
    b = _tok_batches(4)
    ctes, s0 = S.mg_chain_ctes("r0", b[:1], K)
    ctes.append(f"r0t AS (SELECT * FROM {s0} ORDER BY approx_count DESC, keyword LIMIT 10)")
    more, s2 = S.mg_chain_ctes("r1", b[1:3], 10, start_state="r0t")
    ctes += more
    last, s3 = S.mg_chain_ctes("r3", b[3:], 100, start_state=s2)
    return ctes + last + [f"mg AS (SELECT * FROM {s3})"]


def _counts(src: str) -> str:
    return f"(SELECT count(*) FROM {src})"


@register("stream_snapshot", S.with_(S.DOC_TOK, *_plain_mg()) + "SELECT keyword, approx_count FROM mg")
def q_stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + S11 + S3: hot topics published by the last snapshot of the plain replay."""
    return read_hot_topics(run(spark, sf_dir, "plain"))


@register(
    "read_exact_topics",
    S.with_(S.DOC_TOK)
    + f"SELECT keyword, count(*) AS exact_count FROM doc_tok GROUP BY keyword ORDER BY exact_count DESC, keyword LIMIT {K}",
)
def q_read_exact_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + S4: the exact top-K published by the plain replay (deltas + compacted base)."""
    return read_exact_topics(run(spark, sf_dir, "plain"))


@register(
    "stream_samples",
    S.with_(S.DOC_TOK, S.reservoir_cte("r", "doc_tok", N, SEED)) + "SELECT sample_index, keyword FROM r",
)
def q_stream_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + S6: the streamed sample equals the one-batch sample for any split."""
    return read_samples(run(spark, sf_dir, "plain"))


@register(
    "stream_counters",
    S.with_(S.DOC_TOK)
    + f"""SELECT {_counts('doc_tok')} AS total_processed,
  {_counts('(SELECT * FROM doc_tok WHERE doc_id % 3 = 2)')} AS last_batch_count,
  CAST({CLOCK} AS BIGINT) AS last_update_epoch""",
)
def q_stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + A5 + P11: counters after the last non-empty batch; the junk batch changes nothing."""
    return read_counters(run(spark, sf_dir, "plain"))


@register("read_eval_metrics", eval_sql(base_ctes(_plain_mg())))
def q_read_eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 + S5: the metrics published with the last snapshot of the plain replay."""
    return read_eval_metrics(run(spark, sf_dir, "plain"))


@register(
    "stream_replay_counts",
    S.with_(S.DOC_TOK) + "SELECT keyword, count(*) AS exact_count FROM doc_tok GROUP BY keyword",
)
def q_stream_replay_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the cumulative exact state after the replay equals the one-batch exact counts."""
    store = run(spark, sf_dir, "plain")
    meta = Meta.from_row(store.latest_entry())
    return EpochFold(store).exact_state(meta).select("keyword", F.col("n").alias("exact_count"))


@register(
    "stream_epoch_log",
    S.with_(S.DOC_TOK)
    + f"""SELECT epoch, batch_count, CAST(sum(batch_count) OVER (ORDER BY epoch) AS BIGINT) AS total_processed,
  {K} AS k, {N} AS n FROM (
    SELECT doc_id % 3 AS epoch, count(*) AS batch_count FROM doc_tok GROUP BY 1
    UNION ALL SELECT 3, 0)""",
)
def q_stream_epoch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16 + A4 + A5: batch size and running total per epoch, including the empty epoch."""
    return read_epoch_log(run(spark, sf_dir, "plain"))


@register("stream_resize", S.with_(S.DOC_TOK, *_resize_mg()) + "SELECT keyword, approx_count FROM mg")
def q_stream_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + T3: K 50 -> 10 (truncate, counts kept) -> invalid (ignored) -> 100."""
    return read_hot_topics(run(spark, sf_dir, "resize"))


def _error_bound_sql() -> str:
    b = _tok_batches(4)
    first, s0 = S.mg_chain_ctes("r0", b[:1], K)
    cut_down = f"r0t AS (SELECT * FROM {s0} ORDER BY approx_count DESC, keyword LIMIT 10)"
    more, s2 = S.mg_chain_ctes("r1", b[1:3], 10, start_state="r0t")
    last, _ = S.mg_chain_ctes("r3", b[3:], 100, start_state=s2)
    dropped = f"coalesce((SELECT approx_count FROM {s0} ORDER BY approx_count DESC LIMIT 1 OFFSET 10), 0)"
    cuts = " + ".join([S.mg_cut_sql("r0_m0", K), dropped, S.mg_cut_sql("r1_m0", 10), S.mg_cut_sql("r1_m1", 10), S.mg_cut_sql("r3_m0", 100)])
    return S.with_(S.DOC_TOK, *first, cut_down, *more, *last) + f"SELECT CAST({cuts} AS BIGINT) AS mg_error_bound"


@register("stream_error_bound", _error_bound_sql())
def q_stream_error_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + T3: the bound published with the counters: the cuts of every batch and what the shrink to K = 10 dropped."""
    return read_error_bound(run(spark, sf_dir, "resize"))


@register(
    "stream_bound_holds",
    S.with_(S.DOC_COUNTS) + "SELECT 0::BIGINT AS over_counted, 0::BIGINT AS short_by_more, sum(n)::BIGINT AS total FROM c",
)
def q_stream_bound_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + T3: the published counts of the resized stream against all its tokens: none too high, none short by more than the bound."""
    store = run(spark, sf_dir, "resize")
    bound = F.lit(read_error_bound(store).first()["mg_error_bound"])  # one number
    hot = read_hot_topics(store).select("keyword", F.col("approx_count").alias("a"))
    both = ex.exact_counts(doc_tokens(spark, sf_dir)).join(F.broadcast(hot), "keyword", "left")  # at most K rows
    a, x = F.coalesce("a", F.lit(0)), F.col("exact_count")
    return both.agg(
        F.count_if(a > x).cast("long").alias("over_counted"),
        F.count_if(x - a > bound).cast("long").alias("short_by_more"),
        F.sum("exact_count").cast("long").alias("total"),
    )


@register(
    "stream_resize_samples",
    S.with_(S.DOC_TOK, S.reservoir_cte("r", "doc_tok", 50, SEED)) + "SELECT sample_index, keyword FROM r",
)
def q_stream_resize_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + T4: N 20 -> 5 -> invalid -> 50; the 200-slot state keeps the sample uniform."""
    return read_samples(run(spark, sf_dir, "resize"))


def _grown_sql() -> str:
    first = "(SELECT * FROM doc_tok WHERE doc_id % 2 = 0)"
    return S.with_(
        S.DOC_TOK,
        S.reservoir_cte("f", first, RESERVOIR_SLOTS + 1, SEED),
        f"tau AS (SELECT priority FROM f WHERE sample_index = {RESERVOIR_SLOTS})",
        f"""open AS (SELECT * FROM doc_tok
          WHERE md5('{SEED}:' || uid) < coalesce((SELECT priority FROM tau), 'g'))""",
        S.reservoir_cte("r", "open", 1000, SEED),
    )


@register("stream_grown_samples", _grown_sql() + "SELECT sample_index, keyword FROM r")
def q_stream_grown_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + K5: N 20 -> 1000, past what the state kept: the sample holds the smallest priorities of all
    tokens below the smallest one dropped before the grow."""
    return read_samples(run(spark, sf_dir, "grow"))


@register(
    "stream_toggled_exact",
    S.with_(
        S.DOC_TOK,
        *_plain_mg(),
        S.reservoir_cte("r", "doc_tok", N, SEED),
    )
    + """SELECT 0.0::DOUBLE AS topk_recall_at_k, 0::INTEGER AS top1_match, 0::BIGINT AS overlap_count,
  1.0::DOUBLE AS reservoir_tvd, 0.0::DOUBLE AS reservoir_similarity,
  (SELECT count(*) FROM mg) AS mg_unique, 0::BIGINT AS exact_unique,
  (SELECT coalesce(sum(strlen(keyword) + 8), 0)::BIGINT FROM mg) AS mg_memory_bytes,
  0::BIGINT AS exact_memory_bytes,
  (SELECT coalesce(sum(strlen(keyword) + 8), 0)::BIGINT FROM r) AS reservoir_memory_bytes,
  0.0::DOUBLE AS memory_saved_percent, 0::INTEGER AS exact_baseline_enabled""",
)
def q_stream_toggled_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + K7: exact baseline on, off, on: a baseline with a gap is never published."""
    return read_eval_metrics(run(spark, sf_dir, "toggle"))


@register(
    "control_effective",
    S.with_(S.DOC_TOK)
    + """SELECT epoch, batch_count, CAST(sum(batch_count) OVER (ORDER BY epoch) AS BIGINT) AS total_processed,
  CASE epoch WHEN 0 THEN 50 WHEN 3 THEN 100 ELSE 10 END AS k,
  CASE epoch WHEN 0 THEN 20 WHEN 3 THEN 50 ELSE 5 END AS n
FROM (SELECT doc_id % 4 AS epoch, count(*) AS batch_count FROM doc_tok GROUP BY 1)""",
)
def q_control_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S14: the k and n in force at each epoch; "abc" and "0" are ignored."""
    return read_epoch_log(run(spark, sf_dir, "resize"))


@register(
    "stream_reset",
    S.with_(S.DOC_TOK, S.counts_cte("c", "(SELECT * FROM doc_tok WHERE doc_id % 3 = 2)"), S.mg_prune_cte("mg", "c", K))
    + "SELECT keyword, approx_count FROM mg",
)
def q_stream_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: after a reset before the last batch, the hot topics hold that batch only."""
    return read_hot_topics(run(spark, sf_dir, "reset"))


@register(
    "stream_reset_counters",
    S.with_(S.DOC_TOK)
    + f"""SELECT {_counts('(SELECT * FROM doc_tok WHERE doc_id % 3 = 2)')} AS total_processed,
  {_counts('(SELECT * FROM doc_tok WHERE doc_id % 3 = 2)')} AS last_batch_count, CAST({CLOCK} AS BIGINT) AS last_update_epoch""",
)
def q_stream_reset_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: counters restart from zero at a reset."""
    return read_counters(run(spark, sf_dir, "reset"))


@register(
    "stream_reset_empty",
    S.with_(S.DOC_TOK)
    + f"""SELECT {_counts('doc_tok')} AS total_processed,
  {_counts('(SELECT * FROM doc_tok WHERE doc_id % 2 = 1)')} AS last_batch_count, CAST({CLOCK} AS BIGINT) AS last_update_epoch,
  CAST(0 AS BIGINT) AS hot_topics, CAST(0 AS BIGINT) AS samples, CAST(0 AS BIGINT) AS eval_rows""",
)
def q_stream_reset_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + P11: a reset on an empty batch empties the published topics, samples and
    metrics, while the counters keep their last values."""
    store = run(spark, sf_dir, "reset_empty")
    sizes = read_hot_topics(store).agg(F.count(F.lit(1)).cast("long").alias("hot_topics"))
    samples = read_samples(store).agg(F.count(F.lit(1)).cast("long").alias("samples"))
    metrics = read_eval_metrics(store).agg(F.count(F.lit(1)).cast("long").alias("eval_rows"))
    from trendlens.operators.evaluate import stitch

    return stitch(read_counters(store), sizes, samples, metrics)


def _burst_sql() -> str:
    batches = [f"(SELECT keyword FROM burst WHERE phase = {p})" for p in range(len(PHASE_SIZES))]
    ctes, _ = S.mg_chain_ctes("z", batches, K)
    picks = " UNION ALL ".join(
        f"SELECT CAST({p} AS BIGINT) AS epoch, CAST(coalesce((SELECT approx_count FROM z_s{p} WHERE keyword = '{synth.BURST_WORD}'), 0) AS BIGINT) AS approx_count"
        for p in range(len(PHASE_SIZES))
    )
    return S.with_(*S.search_ctes(SEED), _phase_sql(), *ctes) + picks


@register("stream_burst_decay", _burst_sql())
def q_stream_burst_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The burst word's MG count per epoch -- it rises in the burst and decays after."""
    return read_mg_history(run(spark, sf_dir, "burst"), synth.BURST_WORD)



def _burst_eval_sql() -> str:
    batches = [f"(SELECT keyword FROM burst WHERE phase = {p})" for p in range(len(PHASE_SIZES))]
    ctes, final = S.mg_chain_ctes("z", batches, K)
    sources = [*S.search_ctes(SEED), _phase_sql()]
    return eval_sql(base_ctes(ctes + [f"mg AS (SELECT * FROM {final})"], source="burst", source_ctes=sources))


@register("stream_burst_eval_metrics", _burst_eval_sql())
def q_stream_burst_eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 + K10: the metrics published after the normal -> burst -> normal replay."""
    return read_eval_metrics(run(spark, sf_dir, "burst"))


# -- the dashboard and the exporter, reading the published snapshot -----------------


def _burst_snapshot_sql() -> list[str]:
    batches = [f"(SELECT keyword FROM burst WHERE phase = {p})" for p in range(len(PHASE_SIZES))]
    ctes, final = S.mg_chain_ctes("z", batches, K)
    last = len(PHASE_SIZES) - 1
    return [
        *S.search_ctes(SEED),
        _phase_sql(),
        *ctes,
        f"mg AS (SELECT * FROM {final})",
        S.reservoir_cte("r", "burst", N, SEED),
        f"""cnt AS (SELECT count(*) AS total_processed,
          count(*) FILTER (WHERE phase = {last}) AS last_batch_count,
          CAST({CLOCK} AS BIGINT) AS last_update_epoch FROM burst)""",
    ]


def _stream_ops_sql() -> list[str]:
    return [
        *_burst_snapshot_sql(),
        f"""om AS (SELECT
  round(CASE WHEN (SELECT sum(approx_count) FROM mg) > 0
        THEN (SELECT max(approx_count) FROM mg)::DOUBLE / (SELECT sum(approx_count) FROM mg) ELSE 0.0 END, 6) AS top1_ratio,
  round(CASE WHEN (SELECT count(*) FROM r) > 0
        THEN (SELECT count(DISTINCT keyword) FROM r)::DOUBLE / (SELECT count(*) FROM r) ELSE 0.0 END, 6) AS sample_diversity,
  CAST(CASE WHEN coalesce((SELECT last_update_epoch FROM cnt), 0) = 0 THEN -1
       ELSE greatest({AS_OF} - (SELECT last_update_epoch FROM cnt), 0) END AS BIGINT) AS data_freshness_seconds)""",
    ]


def _published(spark: SparkSession, sf_dir: str, scenario: str):
    store = run(spark, sf_dir, scenario)
    return read_hot_topics(store), read_samples(store), read_counters(store)


@register("stream_operational_metrics", S.with_(*_stream_ops_sql()) + "SELECT * FROM om")
def q_stream_operational_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 as the dashboard computes it: from the snapshot published after the burst replay."""
    hot, samples, counters = _published(spark, sf_dir, "burst")
    return ops.operational_metrics(hot, samples, counters, AS_OF)


@register(
    "stream_alerts",
    S.with_(*_stream_ops_sql())
    + f"""SELECT CAST(data_freshness_seconds >= {max(6, 3 * REFRESH_SECONDS)} AS INTEGER) AS alert_freshness,
  CAST(top1_ratio >= 0.85 AND (SELECT total_processed FROM cnt) > 1000 AS INTEGER) AS alert_concentration,
  CAST(sample_diversity <= 0.35 AND (SELECT count(*) FROM r) >= 10 AS INTEGER) AS alert_diversity,
  CAST(NOT (data_freshness_seconds >= {max(6, 3 * REFRESH_SECONDS)}
            OR (top1_ratio >= 0.85 AND (SELECT total_processed FROM cnt) > 1000)
            OR (sample_diversity <= 0.35 AND (SELECT count(*) FROM r) >= 10)) AS INTEGER) AS healthy
FROM om""",
)
def q_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 from the published burst-replay snapshot."""
    hot, samples, counters = _published(spark, sf_dir, "burst")
    metrics = ops.operational_metrics(hot, samples, counters, AS_OF)
    return ops.alerts(metrics, counters, samples, REFRESH_SECONDS)


def _plain_records_sql() -> str:
    ctes = [
        S.DOC_TOK,
        *_plain_mg(),
        S.reservoir_cte("r", "doc_tok", N, SEED),
        f"""cnt AS (SELECT count(*) AS total_processed,
          count(*) FILTER (WHERE doc_id % 3 = 2) AS last_batch_count,
          CAST({CLOCK} AS BIGINT) AS last_update_epoch FROM doc_tok)""",
    ]
    return S.with_(*ctes) + _records_sql("mg", "r", "cnt", EXPORTED_AT)


@register("stream_export_records", _plain_records_sql())
def q_stream_export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + S12 + S9 as the exporter runs: the live snapshot of the plain replay, written as
    JSONL and read back."""
    store = run(spark, sf_dir, "plain")
    export = export_snapshot(store, new_work_dir(spark, "stream-export"), PREFIX, EXPORTED_AT)
    return load_dataset(spark, export.jsonl_path)


@register(
    "stream_dashboard",
    S.with_(
        *_stream_ops_sql(),
        "ms AS (SELECT CAST(coalesce(sum(strlen(keyword) + 8), 0) AS BIGINT) AS b FROM mg)",
        "es AS (SELECT CAST(coalesce(sum(strlen(keyword) + 8), 0) AS BIGINT) AS b FROM "
        "(SELECT keyword FROM burst GROUP BY keyword))",
    )
    + f"""SELECT {S.format_bytes_sql("(SELECT b FROM es)")} AS exact_memory_text,
  {S.format_bytes_sql("(SELECT b FROM ms)")} AS mg_memory_text,
  round(greatest(least(round(((SELECT b FROM es) - (SELECT b FROM ms))::DOUBLE / (SELECT b FROM es) * 100.0, 6),
        99.99), -999.0), 6) AS saved_percent,
  top1_ratio, sample_diversity, data_freshness_seconds,
  CAST(data_freshness_seconds >= {max(6, 3 * REFRESH_SECONDS)} AS INTEGER) AS alert_freshness,
  CAST(top1_ratio >= 0.85 AND (SELECT total_processed FROM cnt) > 1000 AS INTEGER) AS alert_concentration,
  CAST(sample_diversity <= 0.35 AND (SELECT count(*) FROM r) >= 10 AS INTEGER) AS alert_diversity,
  CAST(NOT (data_freshness_seconds >= {max(6, 3 * REFRESH_SECONDS)}
            OR (top1_ratio >= 0.85 AND (SELECT total_processed FROM cnt) > 1000)
            OR (sample_diversity <= 0.35 AND (SELECT count(*) FROM r) >= 10)) AS INTEGER) AS healthy
FROM om""",
)
def q_stream_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dashboard refresh (memory texts, K9 metrics, P9 alerts) over the burst replay's snapshot."""
    return ops.dashboard(run(spark, sf_dir, "burst"), AS_OF, REFRESH_SECONDS)
