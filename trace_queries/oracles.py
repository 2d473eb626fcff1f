"""Independent SQL for the driver's comparison, straight from the base tables."""

from __future__ import annotations

START = 1704067200000000

BASE = f"""
base AS (
  SELECT event_id, user_id, event_type, value, props, 'u' || user_id AS session,
    {START} + (epoch_us(ts) - {START}) // 1440 AS at_us,
    CASE event_type WHEN 'click' THEN 'gpt-5' WHEN 'view' THEN 'gpt-5-mini'
      WHEN 'purchase' THEN 'claude-sonnet-4-6' WHEN 'signup' THEN 'text-embedding-3-small'
      ELSE 'gemini-pro' END AS model,
    CASE event_type WHEN 'purchase' THEN 'anthropic' WHEN 'error' THEN 'google'
      ELSE 'openai' END AS vendor,
    CAST(floor(value) AS BIGINT) AS tokens,
    CAST(floor(value / 10) AS BIGINT) AS out_tokens,
    CASE WHEN event_id % 3 = 0
      THEN 'Please classify event ' || event_id || ' as positive or negative'
      ELSE 'Summarize event ' || event_id END AS message
  FROM events)"""

# The synthetic catalog: price of one token in nano-dollars, in and out, and the alternative's.
PRICES = """
prices(model, in_nanos, out_nanos, frontier, alternative, alt_in, alt_out) AS (VALUES
  ('gpt-5', 10000, 30000, true, 'gpt-5-mini', 400, 1600),
  ('gpt-5-mini', 400, 1600, false, NULL, 0, 0),
  ('claude-opus-4-6', 15000, 75000, true, 'claude-haiku-4-5', 800, 4000),
  ('claude-sonnet-4-6', 3000, 15000, false, NULL, 0, 0),
  ('claude-haiku-4-5', 800, 4000, false, NULL, 0, 0),
  ('gemini-pro', 1250, 5000, false, NULL, 0, 0),
  ('text-embedding-3-small', 20, 0, false, NULL, 0, 0))"""

COSTED = """
costed AS (
  SELECT b.*, CAST(tokens * in_nanos + out_tokens * out_nanos AS BIGINT) AS cost,
    frontier, alternative,
    CAST(tokens * alt_in + out_tokens * alt_out AS BIGINT) AS alt_cost
  FROM base b JOIN prices USING (model))"""


def micros(nanos: str) -> str:
    """Micro-dollars, half to even."""
    return f"CAST(round_even(({nanos}) / 1000.0, 0) AS BIGINT)"


def windows(span_seconds: int, keys: str = "session, event_type", source: str = "costed") -> str:
    """Per row: rows of its key up to itself and at most ``span_seconds`` back, by self-join."""
    equal = " AND ".join(f"j.{k.strip()} = i.{k.strip()}" for k in keys.split(","))
    return f"""
wins AS (
  SELECT i.event_id, count(*) AS n, CAST(sum(j.cost) AS BIGINT) AS cost_all,
    arg_min(j.cost, (j.at_us, j.event_id)) AS cost_first
  FROM {source} i JOIN {source} j ON {equal}
    AND j.at_us >= i.at_us - {span_seconds * 1_000_000}
    AND (j.at_us < i.at_us OR (j.at_us = i.at_us AND j.event_id <= i.event_id))
  GROUP BY i.event_id)"""


def fired(name: str, min_calls: int, mode: str = "session", keys: str = "session, event_type",
          source: str = "costed", wins: str = "wins") -> str:
    """Firings among the windows, de-duplicated."""
    chosen = {
        "session": f"row_number() OVER (PARTITION BY {keys} ORDER BY at_us, event_id) = 1",
        "none": "true",
        "edge": "coalesce(pn, 0) < " + str(min_calls),
    }[mode]
    if mode == "edge":
        return f"""
{name} AS (
  SELECT * FROM (
    SELECT c.*, n, cost_all, cost_first,
      lag(n) OVER (PARTITION BY {keys} ORDER BY at_us, event_id) AS pn
    FROM {source} c JOIN {wins} USING (event_id))
  WHERE n >= {min_calls} AND {chosen})"""
    qualify = "" if mode == "none" else f"QUALIFY {chosen}"
    return f"""
{name} AS (
  SELECT c.*, n, cost_all, cost_first
  FROM {source} c JOIN {wins} USING (event_id)
  WHERE n >= {min_calls} {qualify})"""


ELEMENTS = """
elements AS (
  SELECT session, at_us, event_id, 0 AS pos, props AS item, cost,
    CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS n_items
  FROM costed WHERE event_type = 'signup'
  UNION ALL
  SELECT session, at_us, event_id, 1, 'v' || tokens, cost, 2
  FROM costed WHERE event_type = 'signup' AND event_id % 2 = 0),
repeats AS (
  SELECT *, row_number() OVER (PARTITION BY session, item ORDER BY at_us, event_id, pos) AS nth
  FROM elements)"""

MISROUTE = """
misroute AS (
  SELECT * FROM costed
  WHERE frontier AND alternative IS NOT NULL AND event_id % 3 = 0
    AND tokens <= 200 AND out_tokens <= 20)"""

# All rules over the event calls, as (type, session, at_us, event_id, burn in nano-dollars).
ALL_EVENTS = (
    "WITH" + BASE + "," + PRICES + "," + COSTED + ","
    + windows(60) + "," + fired("loops", 4) + ","
    + windows(30).replace("wins AS", "wins30 AS") + ","
    + fired("storms", 3, wins="wins30") + "," + ELEMENTS + "," + MISROUTE + """,
fired_events AS (
  SELECT 'tool_loop' AS type, session, at_us, event_id, cost_all - cost_first AS nanos,
    'call_count' || n || event_type AS k FROM loops
  UNION ALL SELECT 'retry_storm', session, at_us, event_id, cost_all - cost_first, 'x' FROM storms
  UNION ALL SELECT 'model_misroute', session, at_us, event_id, cost - alt_cost, 'x' FROM misroute
  UNION ALL SELECT 'embedding_waste', session, at_us, event_id, cost // n_items, item
    FROM repeats WHERE nth = 2),
micro_events AS (
  SELECT type, session, at_us, event_id, k, """ + micros("nanos") + """ AS burn_micros
  FROM fired_events)"""
)


def cents(micro_sum: str) -> str:
    """Whole cents, half to even, from micro-dollars."""
    return f"CAST(round_even(coalesce({micro_sum}, 0) / 10000.0, 0) AS BIGINT)"
