"""DuckDB oracle SQL building blocks.

Each registered query has an equivalent SQL string that DuckDB runs over the
same parquet tables. The keyword streams below mirror the stand-in streams of
``trendlens.sources.keywords`` and ``trendlens.operators.synth``.
"""

from __future__ import annotations

DOC_TOK = """doc_tok AS (
  SELECT keyword, NULL::BIGINT AS "timestamp",
         CAST(doc_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR) AS uid, doc_id
  FROM (SELECT doc_id, unnest(l) AS keyword, generate_subscripts(l, 1) - 1 AS pos
        FROM (SELECT doc_id, string_split(lower(text), ' ') AS l FROM documents))
  WHERE keyword IS NOT NULL AND keyword <> '')"""

#: The counts of the document tokens alone, once: for queries that need neither uids nor a sample.
DOC_COUNTS = """c AS MATERIALIZED (
  SELECT keyword, count(*) AS n
  FROM (SELECT unnest(string_split(lower(text), ' ')) AS keyword FROM documents)
  WHERE keyword IS NOT NULL AND keyword <> '' GROUP BY keyword)"""

EV_TYPE = """ev_type AS (
  SELECT event_type AS keyword, (epoch_us(ts) // 1000) AS "timestamp", CAST(event_id AS VARCHAR) AS uid
  FROM events WHERE event_type IS NOT NULL AND event_type <> '')"""

EV_PROPS = """ev_props AS (
  SELECT * FROM (
    SELECT CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS keyword,
           (epoch_us(ts) // 1000) AS "timestamp", CAST(event_id AS VARCHAR) AS uid
    FROM events) WHERE keyword IS NOT NULL AND keyword <> '')"""

EV_USER = """ev_user AS (
  SELECT * FROM (
    SELECT CAST(user_id AS VARCHAR) AS keyword, (epoch_us(ts) // 1000) AS "timestamp", CAST(event_id AS VARCHAR) AS uid
    FROM events) WHERE keyword IS NOT NULL AND keyword <> '')"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def counts_cte(name: str, source: str) -> str:
    return f"{name} AS (SELECT keyword, count(*) AS n FROM {source} GROUP BY keyword)"


def mg_prune_cte(name: str, counts: str, k: int) -> str:
    """MG prune of a ``(keyword, n)`` CTE into ``(keyword, approx_count)``."""
    return (
        f"{name} AS (SELECT keyword, CAST(n - v AS BIGINT) AS approx_count FROM {counts}, "
        f"(SELECT coalesce((SELECT n FROM {counts} ORDER BY n DESC LIMIT 1 OFFSET {k}), 0) AS v) "
        f"WHERE n > v)"
    )


def mg_cut_sql(counts: str, k: int) -> str:
    """The (k+1)-th largest count of a ``(keyword, n)`` CTE, 0 if there are at most k."""
    return f"coalesce((SELECT n FROM {counts} ORDER BY n DESC LIMIT 1 OFFSET {k}), 0)"


def mg_chain_ctes(prefix: str, batch_sources: list[str], k: int, start_state: str | None = None) -> tuple[list[str], str]:
    """CTEs that fold batches one after another; returns (ctes, final state name)."""
    ctes: list[str] = []
    state = start_state
    for i, src in enumerate(batch_sources):
        parts = [f"SELECT keyword, CAST(count(*) AS BIGINT) AS n FROM {src} GROUP BY keyword"]
        if state is not None:
            parts.append(f"SELECT keyword, approx_count AS n FROM {state}")
        merged = f"{prefix}_m{i}"
        ctes.append(
            f"{merged} AS (SELECT keyword, CAST(sum(n) AS BIGINT) AS n FROM ("
            + " UNION ALL ".join(parts)
            + ") GROUP BY keyword)"
        )
        state = f"{prefix}_s{i}"
        ctes.append(mg_prune_cte(state, merged, k))
    return ctes, state


def reservoir_cte(name: str, source: str, n: int, seed: str) -> str:
    """``(sample_index, keyword, priority, uid)`` of the N smallest priorities."""
    return (
        f"{name} AS (SELECT CAST(row_number() OVER (ORDER BY priority, uid) - 1 AS INTEGER) AS sample_index, "
        f"keyword, priority, uid FROM (SELECT md5('{seed}:' || uid) AS priority, uid, keyword FROM {source} "
        f"ORDER BY priority, uid LIMIT {n}))"
    )


def search_ctes(seed: str) -> list[str]:
    """The weighted-vocabulary search stream (one message per event)."""
    from trendlens.operators.synth import HEAD_WEIGHTS, HEAD_WORDS, MID_WEIGHT, MID_WORDS, TAIL_SIZE, TAIL_WEIGHT

    named = list(zip(HEAD_WORDS, HEAD_WEIGHTS)) + [(w, MID_WEIGHT) for w in MID_WORDS]
    values = ", ".join(f"({i}, '{w}', {wt})" for i, (w, wt) in enumerate(named))
    return [
        f"""vocab AS (
  SELECT * FROM (VALUES {values}) v(ord, keyword, weight)
  UNION ALL
  SELECT {len(named)} + i AS ord, 'uuid_' || substr(md5(CAST(i AS VARCHAR)), 1, 8) AS keyword, {TAIL_WEIGHT} AS weight
  FROM range({TAIL_SIZE}) t(i))""",
        """iv AS (
  SELECT keyword,
         sum(weight) OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING) - weight AS lo,
         sum(weight) OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING) AS hi
  FROM vocab WHERE weight > 0)""",
        f"""srch AS (
  SELECT iv.keyword, d."timestamp", d.uid, d.event_id FROM (
    SELECT CAST(event_id AS VARCHAR) AS uid, (epoch_us(ts) // 1000) AS "timestamp", event_id,
           CAST(('0x' || substr(md5('{seed}:draw:' || CAST(event_id AS VARCHAR)), 1, 13)) AS BIGINT)
             % (SELECT max(hi) FROM iv) AS draw
    FROM events) d
  JOIN iv ON d.draw >= iv.lo AND d.draw < iv.hi)""",
    ]


def counters_cte(name: str, source: str) -> str:
    """One batch's counters: total, batch size and the newest message time in seconds."""
    return (
        f'{name} AS (SELECT count(*) AS total_processed, count(*) AS last_batch_count, '
        f'coalesce(max("timestamp") // 1000, 0) AS last_update_epoch FROM {source})'
    )


def format_bytes_sql(x: str) -> str:
    """F6 in DuckDB: printf rounds halves to even like the reference's formatting."""
    units = ["B", "KB", "MB", "GB", "TB"]
    arms = " ".join(
        f"WHEN ({x})::DOUBLE / {float(1024**i)} < 1024.0 THEN printf('%.2f {u}', ({x})::DOUBLE / {float(1024**i)})"
        for i, u in enumerate(units)
    )
    return f"(CASE {arms} END)"
