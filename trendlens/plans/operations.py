"""Registered queries over the synthetic search stream: traffic synthesis and operations.

The search stream gives every event one message whose keyword is drawn from the
weighted vocabulary (uid = event_id, timestamp = event time in ms).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.config import DEFAULT_K, DEFAULT_N, DEFAULT_SEED
from trendlens.operators import misra_gries as mg
from trendlens.operators import operations as ops
from trendlens.operators import reservoir as rs
from trendlens.operators import synth
from trendlens.operators.operations import CATEGORY_MAP, DEFAULT_CATEGORY
from trendlens.operators.summaries import summarise
from trendlens.plans import sql as S
from trendlens.plans.registry import register
from trendlens.sources.keywords import parse_keywords, read_table

K, N, SEED = DEFAULT_K, DEFAULT_N, DEFAULT_SEED
# Fixed "now" of the registered metric queries (2025-01-01T00:00:00Z), so results are repeatable.
AS_OF = 1_735_689_600
REFRESH_SECONDS = 2

# Burst fixture: phases over the event-id range in proportion to the replay batch
# sizes 1500, 1500, 5000, 5000, 1500, 1500, 1500, 1500; phases 2 and 3 are bursts.
PHASE_SIZES = [1500, 1500, 5000, 5000, 1500, 1500, 1500, 1500]
BURST_PHASES = (2, 3)


_WORDS: dict[str, synth.Lookup] = {}


def words(spark: SparkSession) -> synth.Lookup:
    """The default vocabulary, made ready once a session: it follows from a rule, not from any file."""
    app = spark.sparkContext.applicationId
    if app not in _WORDS:
        _WORDS[app] = synth.lookup(synth.vocabulary(spark))
    return _WORDS[app]


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.search_stream(read_table(spark, sf_dir, "events"), words(spark), SEED)


def with_phase(stream: DataFrame, lo_id: int, hi_id: int) -> DataFrame:
    """Phase 0..7 of each message by its position in the event-id range."""
    span = sum(PHASE_SIZES)
    pos = F.floor((F.col("event_id") - F.lit(lo_id)) * F.lit(span) / F.lit(hi_id - lo_id + 1))
    phase, bound = None, 0
    for i, size in enumerate(PHASE_SIZES[:-1]):
        bound += size
        phase = F.when(pos < bound, i) if phase is None else phase.when(pos < bound, i)
    phase = phase.otherwise(len(PHASE_SIZES) - 1)
    return stream.withColumn("phase", phase.cast("int"))


def phased_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search stream with phases; 90 % of burst-phase messages become the burst word."""
    events = read_table(spark, sf_dir, "events")
    ids = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    stream = with_phase(synth.search_stream(events, words(spark), SEED), int(ids["lo"]), int(ids["hi"]))
    return synth.burst_mixture(stream, F.col("phase").isin(*BURST_PHASES), synth.BURST_WORD, synth.BURST_PERCENT, "uid", SEED)


def _phase_sql() -> str:
    span = sum(PHASE_SIZES)
    arms, bound = [], 0
    for i, size in enumerate(PHASE_SIZES[:-1]):
        bound += size
        arms.append(f"WHEN pos < {bound} THEN {i}")
    return f"""ph AS (
  SELECT *, CAST(CASE {' '.join(arms)} ELSE {len(PHASE_SIZES) - 1} END AS INTEGER) AS phase FROM (
    SELECT srch.*, floor((event_id - (SELECT min(event_id) FROM events)) * {span}
      / ((SELECT max(event_id) FROM events) - (SELECT min(event_id) FROM events) + 1)) AS pos FROM srch)),
burst AS (
  SELECT CASE WHEN phase IN {tuple(BURST_PHASES)}
               AND CAST(('0x' || substr(md5('{SEED}:burst:' || uid), 1, 13)) AS BIGINT) % 100 < {synth.BURST_PERCENT}
              THEN '{synth.BURST_WORD}' ELSE keyword END AS keyword, "timestamp", uid, event_id, phase FROM ph)"""


_SEARCH = S.search_ctes(SEED)
_SNAP = [
    *_SEARCH,
    S.counts_cte("c", "srch"),
    S.mg_prune_cte("mg", "c", K),
    S.reservoir_cte("r", "srch", N, SEED),
    S.counters_cte("cnt", "srch"),
]
_DIM = "dim AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in CATEGORY_MAP.items()) + ") d(keyword, category))"


@register("weighted_keywords", S.with_(*_SEARCH) + 'SELECT uid, keyword, "timestamp" FROM srch')
def q_weighted_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + J7: one weighted vocabulary draw per event (bucketed equi-join + range filter)."""
    return search(spark, sf_dir).select("uid", "keyword", "timestamp")


@register("burst_mixture", S.with_(*_SEARCH, _phase_sql()) + "SELECT uid, keyword, phase FROM burst")
def q_burst_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal -> burst -> normal phases; 90 % of burst messages carry the burst word."""
    return phased_bursts(spark, sf_dir).select("uid", "keyword", "phase")


@register("payload_roundtrip", S.with_(*_SEARCH) + 'SELECT keyword, "timestamp", uid FROM srch')
def q_payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 + P1: serialise every message to its JSON payload and parse it back."""
    return parse_keywords(synth.to_payload(search(spark, sf_dir)), "value")


@register(
    "category_rollup",
    S.with_(*_SNAP, _DIM)
    + f"""SELECT coalesce(dim.category, '{DEFAULT_CATEGORY}') AS category, CAST(sum(approx_count) AS BIGINT) AS count
FROM mg LEFT JOIN dim USING (keyword) GROUP BY 1""",
)
def q_category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + A11: hot-topic counts rolled up by category (broadcast 20-row dimension)."""
    hot = mg.misra_gries(search(spark, sf_dir), K)
    return ops.category_rollup(hot, ops.category_dimension(spark))


@register(
    "hot_topics_flagged",
    S.with_(*_SEARCH, _phase_sql(), S.counts_cte("bc", "burst"), S.mg_prune_cte("bmg", "bc", K))
    + f"SELECT keyword, approx_count, CAST(keyword = '{synth.BURST_WORD}' AS INTEGER) AS is_burst_target FROM bmg",
)
def q_hot_topics_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot topics of the burst traffic with the burst word flagged."""
    hot = mg.misra_gries(phased_bursts(spark, sf_dir), K)
    return ops.hot_topics_flagged(hot, synth.BURST_WORD)


_OPS_SQL = [
    *_SNAP,
    f"""om AS (SELECT
  round(CASE WHEN (SELECT sum(approx_count) FROM mg) > 0
        THEN (SELECT max(approx_count) FROM mg)::DOUBLE / (SELECT sum(approx_count) FROM mg) ELSE 0.0 END, 6) AS top1_ratio,
  round(CASE WHEN (SELECT count(*) FROM r) > 0
        THEN (SELECT count(DISTINCT keyword) FROM r)::DOUBLE / (SELECT count(*) FROM r) ELSE 0.0 END, 6) AS sample_diversity,
  CAST(CASE WHEN coalesce((SELECT last_update_epoch FROM cnt), 0) = 0 THEN -1
       ELSE greatest({AS_OF} - (SELECT last_update_epoch FROM cnt), 0) END AS BIGINT) AS data_freshness_seconds)""",
]


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search stream's snapshot as typed rows, from one scan of the events."""
    return summarise(search(spark, sf_dir), K, N, "uid", SEED)


@register("operational_metrics", S.with_(*_OPS_SQL) + "SELECT * FROM om")
def q_operational_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: concentration, sample diversity and freshness of the search-stream snapshot."""
    return ops.snapshot_metrics(snapshot(spark, sf_dir), AS_OF)


@register(
    "alerts",
    S.with_(*_OPS_SQL)
    + f"""SELECT CAST(data_freshness_seconds >= {max(6, 3 * REFRESH_SECONDS)} AS INTEGER) AS alert_freshness,
  CAST(top1_ratio >= 0.85 AND (SELECT total_processed FROM cnt) > 1000 AS INTEGER) AS alert_concentration,
  CAST(sample_diversity <= 0.35 AND (SELECT count(*) FROM r) >= 10 AS INTEGER) AS alert_diversity,
  CAST(NOT (data_freshness_seconds >= {max(6, 3 * REFRESH_SECONDS)}
            OR (top1_ratio >= 0.85 AND (SELECT total_processed FROM cnt) > 1000)
            OR (sample_diversity <= 0.35 AND (SELECT count(*) FROM r) >= 10)) AS INTEGER) AS healthy
FROM om""",
)
def q_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness, concentration and diversity alerts of the search-stream snapshot."""
    return ops.snapshot_alerts(snapshot(spark, sf_dir), AS_OF, REFRESH_SECONDS)


@register(
    "burst_alerts",
    S.with_(
        *_SEARCH,
        _phase_sql(),
        "bb AS (SELECT * FROM burst WHERE phase IN " + str(tuple(BURST_PHASES)) + ")",
        S.counts_cte("bc", "bb"),
        S.mg_prune_cte("bmg", "bc", K),
        S.reservoir_cte("br", "bb", N, SEED),
    )
    + """SELECT round(CASE WHEN (SELECT sum(approx_count) FROM bmg) > 0
        THEN (SELECT max(approx_count) FROM bmg)::DOUBLE / (SELECT sum(approx_count) FROM bmg) ELSE 0.0 END, 6) AS top1_ratio,
  round(CASE WHEN (SELECT count(*) FROM br) > 0
        THEN (SELECT count(DISTINCT keyword) FROM br)::DOUBLE / (SELECT count(*) FROM br) ELSE 0.0 END, 6) AS sample_diversity""",
)
def q_burst_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 on burst traffic only: concentration rises and diversity falls."""
    bursts = phased_bursts(spark, sf_dir).where(F.col("phase").isin(*BURST_PHASES))
    return ops.snapshot_metrics(summarise(bursts, K, N, "uid", SEED), AS_OF).select("top1_ratio", "sample_diversity")


def _search_eval_sql() -> str:
    from trendlens.plans.evaluation import base_ctes, eval_sql

    return eval_sql(base_ctes(source="srch", source_ctes=list(_SEARCH)))


@register("search_eval_metrics", _search_eval_sql())
def q_search_eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 on the search traffic model: head words are heavy hitters, the 10,000-word tail is noise.

    The MG summary and the exact counts come from one aggregation; the summary
    and the sample (both bounded) are checkpointed because several metric
    branches read them.
    """
    from trendlens.config import shared_root
    from trendlens.operators import evaluate as ev
    from trendlens.operators import exact as ex

    shared_root(spark)
    stream = search(spark, sf_dir)
    exact = ex.exact_counts(stream)
    summary = mg.mg_prune(exact.select("keyword", F.col("exact_count").alias("n")), K).checkpoint()
    sample = rs.reservoir_sample(stream, N, "uid", SEED).checkpoint()
    totals = exact.agg(F.sum("exact_count").cast("long").alias("total_processed"))
    return ev.evaluate(summary, exact, sample, totals, K)
