"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their DuckDB oracle SQL.

Every query reads the given tables (or tables Spark derives from them) whole.
Parameters follow the reference's defaults: K = 50 counters, N = 20 samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.config import DEFAULT_K, DEFAULT_N, DEFAULT_SEED, RESERVOIR_SLOTS
from trendlens.operators import exact as ex
from trendlens.operators.evaluate import stitch
from trendlens.operators import misra_gries as mg
from trendlens.operators import reservoir as rs
from trendlens.functions.scalar import epoch_millis
from trendlens.plans import sql as S
from trendlens.plans.registry import register
from trendlens.sources.keywords import (
    doc_token_stream,
    event_type_stream,
    parse_keywords,
    props_stream,
    read_table,
    user_stream,
)

K = DEFAULT_K
N = DEFAULT_N
SEED = DEFAULT_SEED


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_token_stream(read_table(spark, sf_dir, "documents"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


# ---------------------------------------------------------------------------
# 1. Minimum slice: documents -> tokens -> Misra-Gries.
# ---------------------------------------------------------------------------


@register(
    "mg_hot_topics",
    S.with_(S.DOC_COUNTS, S.mg_prune_cte("mg", "c", K))
    + "SELECT keyword, approx_count FROM mg",
)
def q_mg_hot_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + T1: the 50-counter Misra-Gries summary of all document tokens."""
    return mg.mg_hot_topics(mg.misra_gries(doc_tokens(spark, sf_dir), K))


# ---------------------------------------------------------------------------
# 2. Batch core.
# ---------------------------------------------------------------------------


@register(
    "mg_event_types",
    S.with_(S.EV_TYPE, S.counts_cte("c", "ev_type"), S.mg_prune_cte("mg", "c", K))
    + "SELECT keyword, approx_count FROM mg",
)
def q_mg_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 where distinct keywords < K: the summary equals the exact counts."""
    return mg.misra_gries(event_type_stream(events(spark, sf_dir)), K)


@register(
    "mg_props",
    S.with_(S.EV_PROPS, S.counts_cte("c", "ev_props"), S.mg_prune_cte("mg", "c", K))
    + "SELECT keyword, approx_count FROM mg",
)
def q_mg_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 over the JSON ``props.k`` values (100 distinct > K)."""
    return mg.misra_gries(props_stream(events(spark, sf_dir)), K)


@register(
    "mg_users",
    S.with_(S.EV_USER, S.counts_cte("c", "ev_user"), S.mg_prune_cte("mg", "c", K))
    + "SELECT keyword, approx_count FROM mg",
)
def q_mg_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 over a flat distribution (user ids): little survives the cut."""
    return mg.misra_gries(user_stream(events(spark, sf_dir)), K)


def _merge_batches_sql() -> str:
    batches = [f"(SELECT keyword FROM doc_tok WHERE doc_id % 3 = {b})" for b in range(3)]
    ctes, final = S.mg_chain_ctes("b", batches, K)
    return S.with_(S.DOC_TOK, *ctes) + f"SELECT keyword, approx_count FROM {final}"


@register("mg_merge_batches", _merge_batches_sql())
def q_mg_merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + J5: three batches (``doc_id % 3``) folded one after another into one summary."""
    tokens = doc_tokens(spark, sf_dir)
    state = None
    for b in range(3):
        state = mg.mg_update(state, tokens.where(F.col("doc_id") % 3 == b), K)
    return state


@register(
    "mg_verified",
    S.with_(S.DOC_TOK)
    + f"SELECT keyword, CAST(count(*) AS BIGINT) AS exact_count FROM doc_tok GROUP BY keyword "
    f"HAVING count(*) * {K + 1} > (SELECT count(*) FROM doc_tok)",
)
def q_mg_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords with share > 1/(K+1), found by the sketch and counted exactly."""
    return mg.mg_verified(doc_tokens(spark, sf_dir), K)


@register("mg_sketch")
def q_mg_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-partition Arrow sketch + merge; bound-tested (depends on partitioning)."""
    return mg.mg_sketch(doc_tokens(spark, sf_dir), K)


@register(
    "mg_sketch_certified",
    S.with_(S.DOC_COUNTS)
    + f"""SELECT sum(n)::BIGINT AS total, count(*) FILTER (WHERE n * {K + 1} > (SELECT sum(n) FROM c)) AS guaranteed,
  0::BIGINT AS guaranteed_missing, 0::BIGINT AS over_counted, 0::BIGINT AS under_counted, true AS fits FROM c""",
)
def q_mg_sketch_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-task sketch held against exact counts: no count too high, none short by more than
    n/(K+1), no guaranteed keyword missing, at most K counters."""
    tokens = doc_tokens(spark, sf_dir)
    return mg.mg_certificate(mg.mg_sketch(tokens, K), ex.exact_counts(tokens), K)


@register(
    "mg_resize",
    S.with_(S.DOC_TOK, S.counts_cte("c", "doc_tok"), S.mg_prune_cte("mg", "c", K))
    + "SELECT keyword, approx_count FROM mg ORDER BY approx_count DESC, keyword LIMIT 10",
)
def q_mg_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A K=50 summary shrunk to K=10, keeping counts."""
    return mg.mg_resize(mg.misra_gries(doc_tokens(spark, sf_dir), K), 10)


@register(
    "exact_counts",
    S.with_(S.DOC_TOK) + "SELECT keyword, count(*) AS exact_count FROM doc_tok GROUP BY keyword",
)
def q_exact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: exact count of every token."""
    return ex.exact_counts(doc_tokens(spark, sf_dir))


@register(
    "exact_unique",
    S.with_(S.DOC_TOK) + "SELECT CAST(count(DISTINCT keyword) AS BIGINT) AS exact_unique FROM doc_tok",
)
def q_exact_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: number of distinct tokens."""
    return ex.exact_unique(doc_tokens(spark, sf_dir))


@register(
    "exact_topk",
    S.with_(S.DOC_TOK)
    + f"SELECT keyword, count(*) AS exact_count FROM doc_tok GROUP BY keyword "
    f"ORDER BY exact_count DESC, keyword LIMIT {K}",
)
def q_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top-K tokens."""
    return ex.exact_topk(ex.exact_counts(doc_tokens(spark, sf_dir)), K)


@register(
    "reservoir_sample",
    S.with_(S.DOC_TOK, S.reservoir_cte("r", "doc_tok", N, SEED)) + "SELECT sample_index, keyword FROM r",
)
def q_reservoir_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: N=20 occurrences sampled uniformly from all tokens."""
    return rs.reservoir_sample(doc_tokens(spark, sf_dir), N, "uid", SEED)


@register(
    "reservoir_resize",
    S.with_(S.DOC_TOK, S.reservoir_cte("r", "doc_tok", RESERVOIR_SLOTS, SEED))
    + "SELECT sample_index, keyword FROM r WHERE sample_index < 5",
)
def q_reservoir_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: a 200-slot reservoir state shown with N shrunk to 5."""
    state = rs.reservoir_update(None, doc_tokens(spark, sf_dir), "uid", SEED, RESERVOIR_SLOTS)
    return rs.reservoir_resize(state, 5)


_PAYLOADS_SQL = """raw AS (
  SELECT CAST(to_json({'keyword': event_type, 'timestamp': (epoch_us(ts) // 1000), 'uid': CAST(event_id AS VARCHAR)}) AS VARCHAR) AS value FROM events
  UNION ALL SELECT text AS value FROM documents),
parsed AS (
  SELECT CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' THEN json_extract_string(value, '$.keyword') END AS keyword,
         CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' THEN TRY_CAST(json_extract_string(value, '$.timestamp') AS BIGINT) END AS "timestamp",
         CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' THEN json_extract_string(value, '$.uid') END AS uid
  FROM raw)"""


@register(
    "parse_keywords",
    "WITH " + _PAYLOADS_SQL + "\nSELECT keyword, \"timestamp\", uid FROM parsed WHERE keyword IS NOT NULL AND keyword <> ''",
)
def q_parse_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads (one per event) mixed with non-JSON messages (document texts)."""
    ev = events(spark, sf_dir)
    payloads = ev.select(
        F.to_json(
            F.struct(
                F.col("event_type").alias("keyword"),
                epoch_millis(ev, "ts").alias("timestamp"),
                F.col("event_id").cast("string").alias("uid"),
            )
        ).alias("value")
    )
    junk = read_table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return parse_keywords(payloads.unionByName(junk), "value")


@register("exact_unique_approx")
def q_exact_unique_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 at scale: HyperLogLog++ distinct-token count (1 % relative error); rows-only check."""
    return ex.exact_unique_approx(doc_tokens(spark, sf_dir))


@register(
    "unique_estimate_certified",
    S.with_(S.DOC_COUNTS) + "SELECT count(*) AS exact_unique, true AS within_bound FROM c",
)
def q_unique_estimate_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the distinct count from the merged states of three batches (``doc_id % 3``), held against the exact one."""
    tokens = doc_tokens(spark, sf_dir)
    merged = ex.hll_merge([ex.hll_state(tokens.where(F.col("doc_id") % 3 == b)) for b in range(3)])
    row = stitch(ex.hll_estimate(merged), ex.exact_unique(tokens))
    return row.select("exact_unique", (F.abs(F.col("unique_estimate") - F.col("exact_unique")) <= F.col("error_bound")).alias("within_bound"))
