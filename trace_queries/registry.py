"""Queries over the given tables, each with its comparison SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trace_queries import oracles as sql
from trace_queries.views import (
    RECORDS,
    event_base,
    event_calls,
    event_pages,
    paged,
    table,
)
from tracewaste.functions.ids import derived_request_hash
from tracewaste.functions.models import method_from_model, provider_from_model
from tracewaste.functions.times import (
    elapsed_ms,
    format_iso_offset,
    format_iso_seconds,
    iso_text,
    parse_iso,
)
from tracewaste.operators.catalog import price_table, synthetic_catalog, with_cost
from tracewaste.operators.chunks import delivery_chunks, in_delivery_order, wire_json
from tracewaste.operators.firing import as_events
from tracewaste.operators.normalize import calls_of, candidate_columns, normalize_records, rejected_of
from tracewaste.operators.rules import RULES, RuleContext
from tracewaste.operators.sessions import session_count, session_profile, session_rank
from tracewaste.operators.trailing import AT, COST, FLAG, SEQ, trailing_window
from tracewaste.plans.analyze import Source, analyze, analyze_many, deliver, delivered
from tracewaste.plans.replay import replay
from tracewaste.plans.reports import firings_report, savings_report, status_report
from tracewaste.plans.summary import burn_by_type, events_by_type, total_burn, totals_by_type
from tracewaste.session import ensure_checkpoint_dir, write_table
from tracewaste.sources.landing import file_pages, read_filed_pages
from tracewaste.sources.pages import (
    page_ledger,
    parse_pages,
    repeated_pages,
    sum_responses,
    truncate_pages,
    unwrap_records,
)
from tracewaste.sources.windows import top_level_runs, within_bounds
from tracewaste.streaming.imports import stream_candidates, stream_page_table, write_candidates
from tracewaste.streaming.replay import StreamingRule

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

INGEST = datetime(2024, 6, 1, tzinfo=timezone.utc)
PROJECT = "demo"


def query(oracle: str | None = None):
    """Register a query under its function name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


def _records(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    return unwrap_records(parse_pages(event_pages(spark, sf_dir, provider), provider), provider)


def _candidates(spark: SparkSession, sf_dir: str, provider: str, *columns: str) -> DataFrame:
    """Candidate calls with the named columns, or all."""
    return normalize_records(_records(spark, sf_dir, provider), provider, INGEST, columns or None)


def _call_columns(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    unread = {"page_idx", "raw_request", "raw_response_meta"}
    read = [name for name in candidate_columns() if name not in unread]
    return calls_of(_candidates(spark, sf_dir, provider, *read)).select(
        _seq(),
        "session_id",
        F.unix_micros("timestamp").alias("at_us"),
        "provider",
        "model",
        "method",
        "prompt_tokens",
        "completion_tokens",
        F.round(F.col("latency_ms") * 1000).cast("bigint").alias("latency_us"),
        "request_hash",
        F.size("tool_calls").cast("bigint").alias("n_tools"),
        F.col("user_facing_output").cast("int").alias("user_facing"),
    )


# Arrival ordinals, as text since they go beyond 64 bits.
PAGE_SEQ = "CAST((CAST(event_id // 100 AS HUGEINT) * 2147483648 + event_id % 100) * 2147483648 AS VARCHAR)"
LANGFUSE_SEQ = """CAST((CAST(event_id // 100 + 1 AS HUGEINT) * 2147483648 + event_id % 100) * 2147483648
  + (event_id + 1) % 2 AS VARCHAR)"""


def _seq() -> Column:
    return F.col("src_seq").cast("string").alias("src_seq")


# --- normalisation -----------------------------------------------------------------

HELICONE_SESSION = """CASE WHEN event_id % 5 = 4 THEN session || '-' || event_type
  ELSE session END"""


@query(f"""WITH {sql.BASE}
SELECT {PAGE_SEQ} AS src_seq,
  {HELICONE_SESSION} AS session_id, at_us, vendor AS provider, model,
  CASE WHEN event_type = 'signup' THEN 'embeddings.create'
    WHEN vendor = 'anthropic' THEN 'messages.create' ELSE 'chat.completions.create' END AS method,
  tokens AS prompt_tokens, out_tokens AS completion_tokens,
  CAST(round(value * 1000) AS BIGINT) AS latency_us,
  session || '-' || event_type AS request_hash, CAST(0 AS BIGINT) AS n_tools, 0 AS user_facing
FROM base""")
def helicone_calls(spark, sf_dir):
    return _call_columns(spark, sf_dir, "helicone")


LANGFUSE_SESSION = """CASE event_id % 5
  WHEN 3 THEN 'langfuse-orphan-' || strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S.%fZ')
  WHEN 4 THEN 'tr-' || event_id ELSE session END"""
LANGFUSE_HASH = f"""substr(sha256(({LANGFUSE_SESSION}) || '|' ||
  CASE WHEN event_id % 7 = 0 THEN '' ELSE 'obs-' || event_id END), 1, 16)"""


@query(f"""WITH {sql.BASE}
SELECT {LANGFUSE_SEQ} AS src_seq, {LANGFUSE_SESSION} AS session_id, at_us,
  CASE WHEN event_id % 11 = 0 THEN 'vendor' WHEN event_type = 'signup' THEN 'unknown'
    ELSE vendor END AS provider,
  CASE WHEN event_id % 11 = 0 THEN 'own-' || event_type ELSE model END AS model,
  'messages.create' AS method,
  CASE WHEN event_id % 4 IN (1, 3) THEN tokens ELSE 0 END AS prompt_tokens,
  CASE WHEN event_id % 4 IN (1, 3) THEN out_tokens ELSE 0 END AS completion_tokens,
  CASE WHEN event_id % 13 = 0 THEN 0 ELSE tokens * 1000 END AS latency_us,
  {LANGFUSE_HASH} AS request_hash,
  CAST(CASE event_id % 4 WHEN 1 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS BIGINT) AS n_tools,
  1 AS user_facing
FROM base""")
def langfuse_calls(spark, sf_dir):
    return _call_columns(spark, sf_dir, "langfuse")


LANGSMITH_SESSION = """CASE event_id % 5
  WHEN 3 THEN 'langsmith-orphan-' || strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S.%fZ')
  WHEN 4 THEN 'run-' || event_id ELSE session END"""
LANGSMITH_HASH = f"""substr(sha256(({LANGSMITH_SESSION}) || '|' ||
  CASE WHEN event_id % 5 = 3 THEN '' ELSE 'run-' || event_id END), 1, 16)"""


@query(f"""WITH {sql.BASE}
SELECT {PAGE_SEQ} AS src_seq,
  {LANGSMITH_SESSION} AS session_id, at_us,
  CASE WHEN event_id % 7 = 0 THEN 'google' WHEN event_id % 7 = 1 THEN 'anthropic'
    WHEN event_id % 3 = 0 OR event_type = 'signup' THEN 'unknown' ELSE vendor END AS provider,
  CASE WHEN event_id % 3 = 0 THEN 'own-' || event_type ELSE model END AS model,
  'messages.create' AS method,
  CASE event_id % 4 WHEN 0 THEN tokens WHEN 1 THEN 0 WHEN 2 THEN tokens ELSE 7 END AS prompt_tokens,
  CASE WHEN event_id % 4 = 3 THEN 0 ELSE out_tokens END AS completion_tokens,
  tokens * 1000 AS latency_us, {LANGSMITH_HASH} AS request_hash,
  CAST(CASE WHEN event_id % 4 = 3 THEN 0 ELSE 1 END AS BIGINT) AS n_tools, 1 AS user_facing
FROM base WHERE event_id % 6 <> 5""")
def langsmith_calls(spark, sf_dir):
    return _call_columns(spark, sf_dir, "langsmith")


@query(f"""WITH {sql.BASE}
SELECT 'helicone' AS provider_src, {HELICONE_SESSION} AS session_id, count(*) AS n
FROM base GROUP BY ALL
UNION ALL SELECT 'langfuse', {LANGFUSE_SESSION}, count(*) FROM base GROUP BY ALL
UNION ALL SELECT 'langsmith', {LANGSMITH_SESSION}, count(*) FROM base
  WHERE event_id % 6 <> 5 GROUP BY ALL""")
def session_ids(spark, sf_dir):
    calls = [calls_of(_candidates(spark, sf_dir, p, "provider_src", "session_id")) for p in RECORDS]
    return (
        reduce(DataFrame.unionByName, calls)
        .groupBy("provider_src", "session_id")
        .agg(F.count("*").alias("n"))
    )


@query(f"""WITH {sql.BASE}
SELECT event_id, substr(sha256(session || '|' || event_id), 1, 16) AS with_id,
  substr(sha256(session || '|'), 1, 16) AS without_id FROM base""")
def request_hash(spark, sf_dir):
    base = event_base(spark, sf_dir)
    own = F.expr("CAST(event_id AS VARIANT)")
    none = F.expr("CAST(NULL AS VARIANT)")
    return base.select(
        "event_id",
        derived_request_hash(F.col("session"), own).alias("with_id"),
        derived_request_hash(F.col("session"), none).alias("without_id"),
    )


@query(f"""WITH {sql.BASE}
SELECT event_id,
  CASE WHEN event_type = 'signup' THEN 'embeddings.create'
    WHEN vendor = 'anthropic' THEN 'messages.create' ELSE 'chat.completions.create' END AS method,
  CASE event_type WHEN 'signup' THEN 'unknown' ELSE vendor END AS provider,
  CASE event_id % 7 WHEN 3 THEN 'mistral' WHEN 4 THEN 'mistral' WHEN 5 THEN 'meta' WHEN 6 THEN 'unknown'
    ELSE 'openai' END AS named
FROM base""")
def method_provider(spark, sf_dir):
    base = event_base(spark, sf_dir)
    return base.select(
        "event_id",
        method_from_model(F.col("vendor"), F.col("model")).alias("method"),
        provider_from_model(F.upper("model"), F.lit("unknown")).alias("provider"),
        provider_from_model(
            F.expr("""element_at(array('O1-mini', 'o3', 'next-o4', 'Mistral-large', 'open-mixtral', 'Llama-3', 'own'),
              CAST(event_id % 7 AS INT) + 1)"""),
            F.lit("unknown"),
        ).alias("named"),
    )


@query(f"""WITH {sql.BASE}
SELECT event_id % 4 AS shape, 'langfuse' AS provider_src,
  CAST(sum(CASE WHEN event_id % 4 IN (1, 3) THEN tokens ELSE 0 END) AS BIGINT) AS prompt_tokens,
  CAST(sum(CASE WHEN event_id % 4 IN (1, 3) THEN out_tokens ELSE 0 END) AS BIGINT) AS completion_tokens
FROM base GROUP BY 1
UNION ALL
SELECT event_id % 4, 'langsmith',
  CAST(sum(CASE event_id % 4 WHEN 1 THEN 0 WHEN 3 THEN 7 ELSE tokens END) AS BIGINT),
  CAST(sum(CASE WHEN event_id % 4 = 3 THEN 0 ELSE out_tokens END) AS BIGINT)
FROM base WHERE event_id % 6 <> 5 GROUP BY 1""")
def usage_units(spark, sf_dir):
    positions = {
        "langfuse": "(src_seq DIV 4611686018427387904 - 1) * 100 + src_seq DIV 2147483648 % 2147483648",
        "langsmith": "src_seq DIV 4611686018427387904 * 100 + src_seq DIV 2147483648 % 2147483648",
    }
    parts = [
        calls_of(
            _candidates(spark, sf_dir, p, "provider_src", "src_seq", "prompt_tokens", "completion_tokens")
        ).selectExpr(
            f"({e}) % 4 AS shape", "provider_src", "prompt_tokens", "completion_tokens"
        )
        for p, e in positions.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("shape", "provider_src")
        .agg(
            F.sum("prompt_tokens").alias("prompt_tokens"),
            F.sum("completion_tokens").alias("completion_tokens"),
        )
    )


@query(f"""WITH {sql.BASE}
SELECT 'langfuse' AS provider_src, {LANGFUSE_SEQ} AS src_seq, 0 AS pos, event_type AS tool,
  CASE event_id % 4 WHEN 0 THEN '{{"k":' || tokens || ',"z":1}}' WHEN 1 THEN '"s"' ELSE '{{}}' END AS arguments
FROM base WHERE event_id % 4 <> 3
UNION ALL SELECT 'langfuse', {LANGFUSE_SEQ}, 1, '', '{{}}' FROM base WHERE event_id % 4 = 1
UNION ALL
SELECT 'langsmith', {PAGE_SEQ}, 0, event_type,
  CASE event_id % 4 WHEN 0 THEN '{{"k":' || tokens || ',"z":1}}' WHEN 1 THEN '{{}}' ELSE '"s"' END
FROM base WHERE event_id % 4 <> 3 AND event_id % 6 <> 5""")
def tool_calls(spark, sf_dir):
    columns = ("provider_src", "src_seq", "tool_calls")
    calls = [calls_of(_candidates(spark, sf_dir, p, *columns)) for p in ("langfuse", "langsmith")]
    return reduce(DataFrame.unionByName, calls).select(
        "provider_src", "src_seq", F.posexplode("tool_calls").alias("pos", "tool")
    ).select("provider_src", _seq(), "pos", F.col("tool.name").alias("tool"), "tool.arguments")


def _message_json(role: bool) -> str:
    tail = ',"role":"user"' if role else ""
    return f"""'[{{"content":"' || message || '"{tail}}}]'"""


@query(f"""WITH {sql.BASE}
SELECT 'helicone' AS provider_src, {PAGE_SEQ} AS src_seq,
  {_message_json(True)} AS messages, '"' || replace(props, '"', '\\"') || '"' AS input FROM base
UNION ALL SELECT 'langfuse', {LANGFUSE_SEQ}, {_message_json(True)}, NULL FROM base
UNION ALL SELECT 'langsmith', {PAGE_SEQ},
  CASE event_id % 3 WHEN 0 THEN {_message_json(False)} WHEN 1 THEN {_message_json(True)} END,
  CASE WHEN event_id % 3 = 2 THEN '["' || session || '"]' END
FROM base WHERE event_id % 6 <> 5""")
def raw_requests(spark, sf_dir):
    columns = ("provider_src", "src_seq", "raw_request")
    calls = [calls_of(_candidates(spark, sf_dir, p, *columns)) for p in RECORDS]
    return reduce(DataFrame.unionByName, calls).select(
        "provider_src",
        _seq(),
        F.to_json("raw_request.messages").alias("messages"),
        F.to_json("raw_request.input").alias("input"),
    )


@query(f"""WITH {sql.BASE}
SELECT 'helicone' AS provider_src, {PAGE_SEQ} AS src_seq,
  CASE event_id % 4 WHEN 0 THEN 'own-' || event_id WHEN 1 THEN 'helicone-orphan-OpenAI-2024-02-03'
    WHEN 2 THEN 'helicone-orphan-unknown-0' ELSE 'req-' || event_id END AS session_id,
  CASE WHEN event_id % 4 = 1 THEN 1706918400000000 ELSE 1717200000000000 END AS at_us,
  '[]' AS messages, CAST(NULL AS VARCHAR) AS input FROM base
UNION ALL SELECT 'langfuse', CAST((CAST(event_id // 100 + 1 AS HUGEINT) * 2147483648 + event_id % 100) * 2147483648 AS VARCHAR),
  'tr-' || event_id, 1717200000000000,
  CASE event_id % 3 WHEN 0 THEN '[{{"content":"a' || event_id || '"}}]' WHEN 1 THEN '[{{"content":"b"}}]'
    ELSE '[{{"content":"s' || event_id || '","role":"user"}}]' END,
  CASE WHEN event_id % 3 = 1 THEN '"e' || event_id || '"' END FROM base""")
def fallback_records(spark, sf_dir):
    """Records without a time, without a session of their own, and observations that carry their input."""
    helicone = """CASE event_id % 4 WHEN 0 THEN concat('{"id":"own-', event_id, '"}')
      WHEN 1 THEN '{"provider":"OpenAI","created_at":"2024-02-03"}'
      WHEN 2 THEN '{"model":"m"}' ELSE concat('{"request_id":"req-', event_id, '"}') END"""
    langfuse = """concat('{"id":"tr-', event_id, '","observations":[{"type":"GENERATION","input":',
      CASE event_id % 3 WHEN 0 THEN concat('[{"content":"a', event_id, '"}]')
        WHEN 1 THEN concat('{"messages":[{"content":"b"}],"input":"e', event_id, '"}')
        ELSE concat('"s', event_id, '"') END, '}]}')"""
    parts = []
    for provider, json_text in (("helicone", helicone), ("langfuse", langfuse)):
        records = event_base(spark, sf_dir).select("event_id", F.expr(json_text).alias("json"))
        parsed = parse_pages(paged(records, provider), provider)
        parts.append(calls_of(normalize_records(unwrap_records(parsed, provider), provider, INGEST)))
    return reduce(DataFrame.unionByName, parts).select(
        "provider_src",
        _seq(),
        "session_id",
        F.unix_micros("timestamp").alias("at_us"),
        F.to_json("raw_request.messages").alias("messages"),
        F.to_json("raw_request.input").alias("input"),
    )


# A record whose token count, latency or shape cannot be read, planted by event_id.
BROKEN = """CASE event_id % 97
  WHEN 0 THEN '{"prompt_tokens":"many"}' WHEN 1 THEN '{"completion_tokens":[1]}'
  WHEN 2 THEN '{"latency":"slow"}' WHEN 3 THEN '{"usage":"text"}'
  WHEN 4 THEN concat('"', event_type, '"') WHEN 5 THEN '[1]' """


@query(f"""SELECT {PAGE_SEQ} AS src_seq,
  CASE event_id % 97 WHEN 0 THEN 'prompt_tokens_not_a_number'
    WHEN 1 THEN 'completion_tokens_not_a_number' WHEN 2 THEN 'latency_not_a_number'
    WHEN 3 THEN 'usage_not_an_object' ELSE 'record_not_an_object' END AS skip_reason
FROM events WHERE event_id % 97 < 6""")
def quarantine(spark, sf_dir):
    records = event_base(spark, sf_dir).select(
        "event_id", F.expr(f"{BROKEN} ELSE {RECORDS['helicone']} END").alias("json")
    )
    parsed = parse_pages(paged(records, "helicone"), "helicone")
    found = normalize_records(unwrap_records(parsed, "helicone"), "helicone", INGEST)
    return rejected_of(found).select(_seq(), "skip_reason")


@query(f"""WITH {sql.BASE},
bounds AS (SELECT CAST({sql.START} + 600000000 AS BIGINT) AS lo, CAST({sql.START} + 1200000000 AS BIGINT) AS hi)
SELECT 'helicone' AS provider_src, count(*) AS n, CAST(min(at_us) AS BIGINT) AS first_us
FROM base, bounds WHERE at_us >= lo + 500000
UNION ALL SELECT 'langfuse', count(*), CAST(min(at_us) AS BIGINT) FROM base, bounds WHERE at_us >= lo AND at_us < hi
UNION ALL SELECT 'langsmith', count(*), CAST(min(at_us) AS BIGINT) FROM base, bounds WHERE at_us >= lo AND at_us < hi""")
def since_until(spark, sf_dir):
    since = datetime(2024, 1, 1, 0, 10, 0, 500_000, tzinfo=timezone.utc)
    until = datetime(2024, 1, 1, 0, 20, 0, 900_000, tzinfo=timezone.utc)
    field = {"helicone": "created_at", "langfuse": "timestamp", "langsmith": "start_time"}
    parts = []
    for provider, name in field.items():
        kept = within_bounds(
            _records(spark, sf_dir, provider),
            provider,
            since,
            None if provider == "helicone" else until,
        )
        at_time = parse_iso(iso_text(F.try_variant_get("rec", f"$.{name}", "variant")))
        parts.append(kept.select("provider_src", F.unix_micros(at_time).alias("at_us")))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("provider_src")
        .agg(F.count("*").alias("n"), F.min("at_us").alias("first_us"))
    )


@query("""SELECT count(*) AS n, count(*) FILTER (event_id % 1000 = 300) AS n_untimed FROM events
WHERE event_id % 1000 = 300 OR ts >= TIMESTAMP '2024-01-20 06:00:00.5'""")
def since_on_filed_pages(spark, sf_dir):
    """Pages of a month filed by date; a bound leaves folders unread and keeps records without a time."""
    stamp = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
    record = f"""concat('{{"request_id":"', event_id, '"', CASE WHEN event_id % 1000 = 300 THEN ''
      ELSE concat(',"created_at":"', {stamp}, '"') END, '}}')"""
    records = table(spark, sf_dir, "events").select("event_id", F.expr(record).alias("json"))
    path = f"{ensure_checkpoint_dir(spark)}/filed-{uuid.uuid4().hex}"
    file_pages(paged(records, "helicone"), "helicone", path)
    since = datetime(2024, 1, 20, 6, 0, 0, 500_000, tzinfo=timezone.utc)
    pages = read_filed_pages(spark, path, since)
    kept = within_bounds(unwrap_records(parse_pages(pages, "helicone"), "helicone"), "helicone", since)
    untimed = F.try_variant_get("rec", "$.created_at", "string").isNull()
    return kept.agg(F.count("*").alias("n"), F.count_if(untimed).alias("n_untimed"))


@query(f"""WITH {sql.BASE}
SELECT {PAGE_SEQ} AS src_seq FROM base
WHERE event_id % 10 <> 7""")
def top_level(spark, sf_dir):
    order = """CASE event_id % 10 WHEN 7 THEN ',"execution_order":2}'
      WHEN 8 THEN ',"execution_order":1}' ELSE '}' END"""
    records = event_base(spark, sf_dir).select(
        "event_id", F.expr(f"""concat('{{"run":', event_id, {order})""").alias("json")
    )
    parsed = parse_pages(paged(records, "langsmith"), "langsmith")
    return top_level_runs(unwrap_records(parsed, "langsmith")).select(_seq())


# --- pages -------------------------------------------------------------------------

# Every 37th page is empty and the one before it is short.
LEDGER_ROWS = """CAST(sum(CASE WHEN event_id // 100 % 37 = 36 THEN 0
  WHEN event_id // 100 % 37 = 35 AND event_id % 100 >= 50 THEN 0 ELSE 1 END) AS BIGINT)"""
LEDGER_KEEP = """NOT (event_id DIV 100 % 37 = 36
  OR (event_id DIV 100 % 37 = 35 AND event_id % 100 >= 50))"""


def _ledger_pages(spark, sf_dir, provider):
    records = event_base(spark, sf_dir).select(
        "event_id", F.expr(RECORDS[provider]).alias("json")
    )
    return parse_pages(paged(records, provider, LEDGER_KEEP), provider)


@query(f"""WITH p AS (
  SELECT event_id // 100 AS page, {LEDGER_ROWS} AS n_rows,
    (SELECT max(event_id) // 100 FROM events) AS last_page
  FROM events GROUP BY 1)
SELECT 'helicone' AS provider_src, page AS page_idx, n_rows,
  CAST(n_rows < 100 AS INT) AS is_stop FROM p
UNION ALL SELECT 'langfuse', page + 1, n_rows, CAST(n_rows < 100 OR page = last_page AS INT) FROM p
UNION ALL SELECT 'langsmith', page, n_rows, CAST(n_rows = 0 OR page = last_page AS INT) FROM p""")
def page_ledgers(spark, sf_dir):
    return reduce(
        DataFrame.unionByName,
        [
            page_ledger(_ledger_pages(spark, sf_dir, p), p).select(
                F.lit(p).alias("provider_src"),
                "page_idx",
                "n_rows",
                F.col("is_stop").cast("int").alias("is_stop"),
            )
            for p in RECORDS
        ],
    )


@query(f"""SELECT {PAGE_SEQ} AS src_seq FROM events
WHERE event_id // 100 <= (SELECT (max(event_id) // 100) * 7 // 10 FROM events)""")
def truncated_pages(spark, sf_dir):
    """Pages end where the cursor ends, seven tenths in; later pages do not count."""
    records = event_base(spark, sf_dir).select(
        "event_id", F.expr(RECORDS["langsmith"]).alias("json")
    )
    pages = paged(records, "langsmith", stop="last_page * 7 DIV 10")
    kept = truncate_pages(parse_pages(pages, "langsmith"), "langsmith")
    return unwrap_records(kept, "langsmith").select(_seq())


ONE_RULE = {"model_misroute": RULES["model_misroute"]}


@query(f"""WITH p AS (SELECT event_id // 100 AS page, {LEDGER_ROWS} AS n_rows FROM events GROUP BY 1)
SELECT CAST(sum(n_rows) AS BIGINT) AS fetched_traces, count(*) FILTER (n_rows > 0) AS pages_fetched,
  CAST(sum(n_rows) AS BIGINT) AS n_calls FROM p""")
def short_pages_import(spark, sf_dir):
    """Short and empty pages in the middle of a landing end nothing."""
    records = event_base(spark, sf_dir).select("event_id", F.expr(RECORDS["helicone"]).alias("json"))
    pages = paged(records, "helicone", LEDGER_KEEP)
    result = analyze(
        spark, pages, "helicone", PROJECT, dry_run=True, rules=ONE_RULE, ingest_time=INGEST
    )
    n_calls = result.calls.agg(F.count("*").alias("n_calls")).scalar()
    return result.summary.select("fetched_traces", "pages_fetched", n_calls.alias("n_calls"))


@query("""WITH p AS (SELECT (max(event_id) // 100) * 7 // 10 AS stop, max(event_id) // 100 AS last FROM events)
SELECT count(*) FILTER (event_id // 100 <= stop) AS fetched_traces, any_value(stop) + 1 AS pages_fetched,
  count(*) FILTER (event_id // 100 <= stop AND event_id % 6 <> 5) AS n_calls,
  any_value(last) - any_value(stop) AS pages_beyond_stop FROM events, p""")
def truncated_import(spark, sf_dir):
    """On request an import ends where a client would have stopped paging."""
    records = event_base(spark, sf_dir).select("event_id", F.expr(RECORDS["langsmith"]).alias("json"))
    pages = paged(records, "langsmith", stop="last_page * 7 DIV 10")
    result = analyze(
        spark,
        pages,
        "langsmith",
        PROJECT,
        dry_run=True,
        rules=ONE_RULE,
        ingest_time=INGEST,
        stop_at_last_page=True,
    )
    n_calls = result.calls.agg(F.count("*").alias("n_calls")).scalar()
    return result.summary.select(
        "fetched_traces",
        "pages_fetched",
        n_calls.alias("n_calls"),
        F.lit(result.pages_beyond_stop).cast("bigint").alias("pages_beyond_stop"),
    )


@query("""SELECT CASE WHEN event_id // 100 % 5 = 3 THEN 'page_without_ordinal' ELSE 'call' END AS outcome,
  count(*) AS n FROM events GROUP BY 1""")
def unplaced_pages(spark, sf_dir):
    """Every fifth page lost its ordinal; its records are rejected with that reason."""
    lost = F.when(F.col("page_idx") % 5 != 3, F.col("page_idx"))
    pages = event_pages(spark, sf_dir, "helicone").withColumn("page_idx", lost)
    found = normalize_records(unwrap_records(parse_pages(pages, "helicone"), "helicone"), "helicone", INGEST)
    return found.groupBy(F.coalesce("skip_reason", F.lit("call")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


@query("""SELECT event_id // 100 AS page_idx, CAST(2 AS BIGINT) AS n FROM events
WHERE event_id // 100 % 4 = 1 GROUP BY 1""")
def repeated_page_keys(spark, sf_dir):
    """Every fourth page landed twice."""
    pages = event_pages(spark, sf_dir, "helicone")
    return repeated_pages(pages.unionByName(pages.filter("page_idx % 4 = 1")))


@query("""SELECT CAST(sum(event_id % 50) AS BIGINT) AS accepted,
  CAST(sum(CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 7 END) AS BIGINT) AS rejected
FROM events""")
def response_ledger(spark, sf_dir):
    return sum_responses(_responses(spark, sf_dir))


def _responses(spark, sf_dir):
    """One answer to a batch for each event."""
    return table(spark, sf_dir, "events").selectExpr(
        """concat('{"accepted":', event_id % 50,
             CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(',"rejected":"', event_id % 7, '"') END,
             '}') AS body"""
    )


# --- scalar functions --------------------------------------------------------------


@query(f"""WITH {sql.BASE}
SELECT event_id, at_us AS zulu_us, at_us AS offset_us, at_us AS naive_us,
  at_us // 60000000 * 60000000 AS minute_us, at_us // 86400000000 * 86400000000 AS day_us,
  CAST(NULL AS BIGINT) AS year_us, tokens * 1000 AS elapsed_us, CAST(0 AS BIGINT) AS backwards_us,
  strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%SZ') AS seconds_text,
  CASE WHEN at_us % 1000000 = 0 THEN strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S+00:00')
    ELSE strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS offset_text
FROM base""")
def iso_times(spark, sf_dir):
    at_time = F.timestamp_micros("at_us")
    shifted = F.timestamp_micros(F.col("at_us") - 8 * 3_600_000_000)

    def micros(text):
        return F.unix_micros(parse_iso(text))

    later = F.timestamp_micros(F.col("at_us") + F.col("tokens") * 1000)
    return event_base(spark, sf_dir).select(
        "event_id",
        micros(F.date_format(at_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("zulu_us"),
        micros(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-08:00'")).alias("offset_us"),
        micros(F.date_format(at_time, "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("naive_us"),
        micros(F.date_format(at_time, "yyyy-MM-dd'T'HH:mm'Z'")).alias("minute_us"),
        micros(F.date_format(at_time, "yyyy-MM-dd")).alias("day_us"),
        micros(F.date_format(at_time, "yyyy")).alias("year_us"),
        F.round(elapsed_ms(at_time, later) * 1000).cast("bigint").alias("elapsed_us"),
        F.round(elapsed_ms(later, at_time) * 1000).cast("bigint").alias("backwards_us"),
        format_iso_seconds(at_time).alias("seconds_text"),
        format_iso_offset(at_time).alias("offset_text"),
    )


# --- sessions ----------------------------------------------------------------------


@query(f"""WITH {sql.BASE}
SELECT session AS session_id, count(*) AS n_calls, CAST(sum(tokens) AS BIGINT) AS prompt_tokens,
  CAST(sum(out_tokens) AS BIGINT) AS completion_tokens, min(at_us) AS first_us,
  max(at_us) AS last_us, min(event_id) AS first_seq
FROM base GROUP BY 1""")
def sessions_profile(spark, sf_dir):
    return session_profile(event_calls(spark, sf_dir)).select(
        "session_id",
        "n_calls",
        "prompt_tokens",
        "completion_tokens",
        F.unix_micros("first_call").alias("first_us"),
        F.unix_micros("last_call").alias("last_us"),
        "first_seq",
    )


@query("SELECT count(DISTINCT user_id) AS inferred_sessions FROM events")
def inferred_sessions(spark, sf_dir):
    return session_count(event_calls(spark, sf_dir))


# --- trailing windows --------------------------------------------------------------


def _window_rows(spark, sf_dir, keys):
    prices = price_table(synthetic_catalog(spark))
    return with_cost(event_calls(spark, sf_dir), prices).select(
        *keys,
        F.unix_micros("timestamp").alias(AT),
        F.col("src_seq").alias(SEQ),
        F.col("cost_nanos").alias(COST),
        F.lit(0).alias(FLAG),
    )


def _window_measures(parts):
    return reduce(DataFrame.unionByName, parts).select(
        F.col(SEQ).cast("bigint").alias("event_id"),
        F.col("n_window").alias("n"),
        F.col("cost_window").alias("cost_all"),
        F.col("first_cost").alias("cost_first"),
    )


COSTED = f"WITH {sql.BASE}, {sql.PRICES}, {sql.COSTED}"


@query(f"{COSTED}, {sql.windows(60)} SELECT event_id, n, cost_all, cost_first FROM wins")
def trailing_counts(spark, sf_dir):
    rows = _window_rows(spark, sf_dir, ["session_id", "request_hash"])
    return _window_measures(
        trailing_window(rows, ["session_id", "request_hash"], 60_000_000)
    )


SKEWED = """SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 'hot' ELSE session END AS k
  FROM costed"""


@query(
    f"{COSTED}, skewed AS ({SKEWED}), {sql.windows(10, 'k', 'skewed')}"
    " SELECT event_id, n, cost_all, cost_first FROM wins"
)
def trailing_counts_skewed(spark, sf_dir):
    """Two fifths of all rows share one key, which takes the range-split path."""
    rows = _window_rows(spark, sf_dir, ["session_id", "request_hash"]).withColumn(
        "k",
        F.when(F.col("request_hash").isin("click", "view"), "hot").otherwise(F.col("session_id")),
    )
    return _window_measures(trailing_window(rows, ["k"], 10_000_000, hot_rows=1_000))


# --- rules -------------------------------------------------------------------------


def _flat(events: DataFrame, *evidence: str) -> DataFrame:
    """Events without map or decimal columns."""
    return events.select(
        "type",
        "session_id",
        F.unix_micros("raised_at").alias("at_us"),
        F.col("src_seq").cast("bigint").alias("src_seq"),
        (F.col("estimated_burn") * 1_000_000).cast("bigint").alias("burn_micros"),
        *[F.col("evidence")[e].cast("string").alias(e) for e in evidence],
    )


def _fire(spark, sf_dir, rule, calls=None, **config):
    prices = price_table(synthetic_catalog(spark))
    context = RuleContext(PROJECT, {k.replace("__", "."): v for k, v in config.items()})
    return RULES[rule](
        event_calls(spark, sf_dir) if calls is None else calls, prices, context
    )


def _loop_sql(kind: str, span: int, min_calls: int, mode: str, label: str) -> str:
    return f"""{COSTED}, {sql.windows(span)}, {sql.fired("f", min_calls, mode)}
SELECT '{kind}' AS type, session AS session_id, at_us, event_id AS src_seq,
  {sql.micros("cost_all - cost_first")} AS burn_micros, event_type AS {label},
  CAST(n AS VARCHAR) AS call_count
FROM f"""


@query(_loop_sql("tool_loop", 60, 4, "session", "tool"))
def tool_loop(spark, sf_dir):
    return _flat(_fire(spark, sf_dir, "tool_loop"), "tool", "call_count")


@query(_loop_sql("tool_loop", 60, 3, "edge", "tool"))
def tool_loop_edges(spark, sf_dir):
    events = _fire(spark, sf_dir, "tool_loop", dedup="edge", tool_loop__min_calls=3)
    return _flat(events, "tool", "call_count")


@query(_loop_sql("tool_loop", 60, 3, "none", "tool"))
def tool_loop_every_firing(spark, sf_dir):
    events = _fire(spark, sf_dir, "tool_loop", dedup="none", tool_loop__min_calls=3)
    return _flat(events, "tool", "call_count")


# Keys of a dozen rows take the path for hot keys here.
@query(_loop_sql("tool_loop", 60, 3, "session", "tool"))
def tool_loop_hot(spark, sf_dir):
    events = _fire(spark, sf_dir, "tool_loop", hot_rows=12, tool_loop__min_calls=3)
    return _flat(events, "tool", "call_count")


@query(_loop_sql("tool_loop", 60, 3, "edge", "tool"))
def tool_loop_hot_edges(spark, sf_dir):
    events = _fire(spark, sf_dir, "tool_loop", hot_rows=12, dedup="edge", tool_loop__min_calls=3)
    return _flat(events, "tool", "call_count")


@query(_loop_sql("tool_loop", 60, 3, "none", "tool"))
def tool_loop_hot_every_firing(spark, sf_dir):
    events = _fire(spark, sf_dir, "tool_loop", hot_rows=12, dedup="none", tool_loop__min_calls=3)
    return _flat(events, "tool", "call_count")


@query(f"""{COSTED}, {sql.windows(60)},
facing AS (
  SELECT i.event_id, bool_or(j.event_id % 9 = 0) AS seen
  FROM costed i JOIN costed j ON j.session = i.session AND j.event_type = i.event_type
    AND j.at_us >= i.at_us - 60000000
    AND (j.at_us < i.at_us OR (j.at_us = i.at_us AND j.event_id <= i.event_id))
  GROUP BY 1),
f AS (
  SELECT c.*, n, cost_all, cost_first FROM costed c JOIN wins USING (event_id)
  JOIN facing USING (event_id) WHERE n >= 3 AND NOT seen
  QUALIFY row_number() OVER (PARTITION BY session, event_type ORDER BY at_us, event_id) = 1)
SELECT 'tool_loop' AS type, session AS session_id, at_us, event_id AS src_seq,
  {sql.micros("cost_all - cost_first")} AS burn_micros, event_type AS tool,
  CAST(n AS VARCHAR) AS call_count FROM f""")
def tool_loop_user_facing(spark, sf_dir):
    """Every ninth call faces the user and silences its window."""
    calls = event_calls(spark, sf_dir).withColumn(
        "user_facing_output", F.col("src_seq") % 9 == 0
    )
    return _flat(
        _fire(spark, sf_dir, "tool_loop", calls, tool_loop__min_calls=3), "tool", "call_count"
    )


@query(_loop_sql("retry_storm", 30, 3, "session", "request_hash"))
def retry_storm(spark, sf_dir):
    return _flat(_fire(spark, sf_dir, "retry_storm"), "request_hash", "call_count")


@query(f"""{COSTED}, {sql.MISROUTE}
SELECT 'model_misroute' AS type, session AS session_id, at_us, event_id AS src_seq,
  {sql.micros("cost - alt_cost")} AS burn_micros, model, alternative AS recommended_alternative
FROM misroute""")
def model_misroute(spark, sf_dir):
    return _flat(_fire(spark, sf_dir, "model_misroute"), "model", "recommended_alternative")


ITEM_HASH = "sha256('text:' || item)"


@query(f"""{COSTED}, {sql.ELEMENTS}
SELECT 'embedding_waste' AS type, session AS session_id, at_us, event_id AS src_seq,
  {sql.micros("cost // n_items")} AS burn_micros, {ITEM_HASH} AS input_hash
FROM repeats WHERE nth = 2""")
def embedding_waste(spark, sf_dir):
    return _flat(_fire(spark, sf_dir, "embedding_waste"), "input_hash")


@query(f"""{COSTED}, {sql.ELEMENTS}
SELECT 'embedding_waste' AS type, session AS session_id, at_us, event_id AS src_seq,
  {sql.micros("cost // n_items")} AS burn_micros, {ITEM_HASH} AS input_hash
FROM repeats WHERE nth > 1""")
def embedding_waste_every_repeat(spark, sf_dir):
    return _flat(_fire(spark, sf_dir, "embedding_waste", dedup="none"), "input_hash")


@query(f"""WITH d AS (
  SELECT event_id, user_id, {sql.START} + event_id AS at_us,
    CASE WHEN event_id % 5 < 2 THEN 'hot' ELSE 'e' || event_id % 97 END AS item FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id % 2, item ORDER BY event_id) AS nth FROM d)
SELECT 'embedding_waste' AS type, 's' || user_id % 2 AS session_id, at_us, event_id AS src_seq,
  CAST(20 AS BIGINT) AS burn_micros, {ITEM_HASH} AS input_hash FROM r WHERE nth > 1""")
def embedding_waste_hot_element(spark, sf_dir):
    """Two fifths of all calls embed one text, and every repeat is an event."""
    calls = table(spark, sf_dir, "events").selectExpr(
        "event_id AS src_seq",
        "concat('s', user_id % 2) AS session_id",
        f"timestamp_micros({sql.START} + event_id) AS timestamp",
        "'text-embedding-3-small' AS model",
        "'embeddings.create' AS method",
        "1000L AS prompt_tokens",
        "0L AS completion_tokens",
        """named_struct('messages', CAST(NULL AS VARIANT), 'input', CAST(
             CASE WHEN event_id % 5 < 2 THEN 'hot' ELSE concat('e', event_id % 97) END AS VARIANT)) AS raw_request""",
    )
    return _flat(_fire(spark, sf_dir, "embedding_waste", calls, dedup="none"), "input_hash")


@query("""WITH d AS (
  SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS nth FROM documents)
SELECT 'embedding_waste' AS type, source AS session_id,
  1704067200000000 + doc_id * 1000000 AS at_us, doc_id AS src_seq,
  CAST(round_even((n_chars // 4 * 20) / 1000.0, 0) AS BIGINT) AS burn_micros
FROM d WHERE nth = 2""")
def embedding_waste_documents(spark, sf_dir):
    """Whole documents embedded again by the same source."""
    calls = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS src_seq",
        "source AS session_id",
        "timestamp_micros(1704067200000000 + doc_id * 1000000) AS timestamp",
        "'text-embedding-3-small' AS model",
        "'embeddings.create' AS method",
        "n_chars DIV 4 AS prompt_tokens",
        "0L AS completion_tokens",
        "named_struct('messages', CAST(NULL AS VARIANT), 'input', CAST(text AS VARIANT)) AS raw_request",
    )
    return _flat(_fire(spark, sf_dir, "embedding_waste", calls))


@query("""SELECT 'model_misroute' AS type, 'c' || conv_id AS session_id,
  1704067200000000 + conv_id * 1000000 + turn AS at_us, conv_id * 1024 + turn AS src_seq,
  CAST(round_even((length(text) // 4) * (10000 - 400) / 1000.0, 0) AS BIGINT) AS burn_micros,
  'gpt-5' AS model, 'gpt-5-mini' AS recommended_alternative
FROM conversations
WHERE length(text) // 4 <= 200
  AND (contains(lower(text), 'queue') OR contains(lower(text), 'tion de') OR contains(lower(text), 'the'))""")
def model_misroute_conversations(spark, sf_dir):
    """Conversation turns as calls, scanned whole for the configured keywords."""
    calls = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id * 1024 + turn AS src_seq",
        "concat('c', conv_id) AS session_id",
        "timestamp_micros(1704067200000000 + conv_id * 1000000 + turn) AS timestamp",
        "'gpt-5' AS model",
        "length(text) DIV 4 AS prompt_tokens",
        "0L AS completion_tokens",
        """named_struct('messages', to_variant_object(array(named_struct('content', text))),
             'input', CAST(NULL AS VARIANT)) AS raw_request""",
    ).withColumn("prompt_tokens", F.col("prompt_tokens").cast("bigint"))
    events = _fire(
        spark,
        sf_dir,
        "model_misroute",
        calls,
        model_misroute__keywords=["queue", "tion de", "the"],
    )
    return _flat(events, "model", "recommended_alternative")


def _expensive_call(calls, prices, context):
    """A user's own rule: any single call above a price."""
    limit = context.get("expensive_call.min_dollars")
    priced = with_cost(calls, prices).filter(F.col("cost_nanos") >= int(limit * 10**9))
    return as_events(
        priced,
        type="expensive_call",
        rule="own.expensive_call",
        confidence=1.0,
        action="review",
        project=context.project,
        evidence={"model": F.col("model")},
        burn_nanos=F.col("cost_nanos"),
        raised_at=F.col("timestamp"),
        src_seq=F.col("src_seq"),
    )


@query(f"""{COSTED}, {sql.MISROUTE}
SELECT 'expensive_call' AS type, session AS session_id, at_us, event_id AS src_seq,
  {sql.micros("cost")} AS burn_micros FROM costed WHERE cost >= 2000000
UNION ALL SELECT 'model_misroute', session, at_us, event_id, {sql.micros("cost - alt_cost")}
FROM misroute""")
def custom_rule(spark, sf_dir):
    rules = {"model_misroute": RULES["model_misroute"], "expensive_call": _expensive_call}
    config = {"expensive_call.min_dollars": 0.002}
    calls = event_calls(spark, sf_dir)
    return _flat(replay(calls, synthetic_catalog(spark), PROJECT, config, rules))


@query(f"""{COSTED} SELECT event_id AS src_seq, {sql.micros("cost")} AS cost_micros FROM costed""")
def call_costs(spark, sf_dir):
    prices = price_table(synthetic_catalog(spark))
    return with_cost(event_calls(spark, sf_dir), prices).select(
        F.col("src_seq").cast("bigint").alias("src_seq"),
        F.bround(F.col("cost_nanos").cast("decimal(20,0)") / 1000, 0)
        .cast("bigint")
        .alias("cost_micros"),
    )


# --- summary and reports -----------------------------------------------------------


def _replayed(spark, sf_dir):
    return replay(event_calls(spark, sf_dir), synthetic_catalog(spark), PROJECT)


@query(f"""{sql.ALL_EVENTS}
SELECT type, session AS session_id, at_us, event_id AS src_seq, burn_micros FROM micro_events""")
def replayed_events(spark, sf_dir):
    return _flat(_replayed(spark, sf_dir))


@query(f"""{sql.ALL_EVENTS}
SELECT coalesce(type, 'total') AS type, count(*) AS n, CAST(sum(burn_micros) AS BIGINT) AS burn_micros
FROM micro_events GROUP BY ROLLUP (type)""")
def summary(spark, sf_dir):
    return totals_by_type(_replayed(spark, sf_dir)).select(
        F.coalesce("type", F.lit("total")).alias("type"),
        "n",
        (F.col("burn") * 1_000_000).cast("bigint").alias("burn_micros"),
    )


@query(f"""{sql.ALL_EVENTS}
SELECT type, count(*) AS n, {sql.cents("sum(burn_micros)")} AS burn_cents,
  (SELECT {sql.cents("sum(burn_micros)")} FROM micro_events) AS total_cents
FROM micro_events GROUP BY 1""")
def rounded_burn(spark, sf_dir):
    events = _replayed(spark, sf_dir)
    total = total_burn(events).select((F.col("estimated_burn_total_usd") * 100).cast("bigint"))
    return (
        events_by_type(events)
        .join(burn_by_type(events), "type")
        .select(
            "type",
            "n",
            (F.col("burn") * 100).cast("bigint").alias("burn_cents"),
            total.scalar().alias("total_cents"),
        )
    )


@query(f"""{sql.ALL_EVENTS},
t AS (SELECT type, {sql.cents("sum(burn_micros)")} AS savings_cents FROM micro_events GROUP BY 1)
SELECT type, savings_cents FROM t WHERE savings_cents > 0
UNION ALL SELECT 'total', {sql.cents("sum(burn_micros)")} FROM micro_events""")
def savings(spark, sf_dir):
    return savings_report(_replayed(spark, sf_dir)).select(
        "type", (F.col("savings") * 100).cast("bigint").alias("savings_cents")
    )


@query(f"""{sql.ALL_EVENTS},
t AS (
  SELECT CASE type WHEN 'retry_storm' THEN 'own_storm' ELSE type END AS type, count(*) AS firings
  FROM micro_events GROUP BY 1)
SELECT type, firings FROM t
UNION ALL SELECT '(others)', CAST(sum(firings) AS BIGINT) FROM t
WHERE type NOT IN ('tool_loop', 'retry_storm', 'model_misroute', 'embedding_waste') HAVING sum(firings) > 0""")
def firings(spark, sf_dir):
    events = _replayed(spark, sf_dir).withColumn(
        "type", F.when(F.col("type") == "retry_storm", "own_storm").otherwise(F.col("type"))
    )
    return firings_report(events)


# --- delivery ----------------------------------------------------------------------


def _delivered(spark, sf_dir):
    """Events to deliver, and the rank of their sessions."""
    calls = event_calls(spark, sf_dir)
    config = {"dedup": "none", "tool_loop.min_calls": 3}
    return replay(calls, synthetic_catalog(spark), PROJECT, config), session_rank(calls)


ORDERED = f"""{COSTED}, {sql.windows(60)}, {sql.fired("f", 3, "none")}, {sql.MISROUTE},
{sql.windows(30).replace("wins AS", "wins30 AS")}, {sql.fired("storms", 3, "none", wins="wins30")}, {sql.ELEMENTS},
ranks AS (SELECT session, min(event_id) AS session_rank FROM base GROUP BY 1),
e AS (
  SELECT 'tool_loop' AS type, session, at_us, event_id, '' AS k FROM f
  UNION ALL SELECT 'model_misroute', session, at_us, event_id, '' FROM misroute
  UNION ALL SELECT 'retry_storm', session, at_us, event_id, '' FROM storms
  UNION ALL SELECT 'embedding_waste', session, at_us, event_id, sha256('text:' || item) FROM repeats WHERE nth > 1),
ordered AS (
  SELECT e.*, row_number() OVER (ORDER BY session_rank, at_us, event_id, type, k) - 1 AS ordinal
  FROM e JOIN ranks USING (session))"""


@query(f"""{ORDERED}
SELECT ordinal, type, session AS session_id, at_us, event_id AS src_seq FROM ordered""")
def event_order(spark, sf_dir):
    events, ranks = _delivered(spark, sf_dir)
    keyed = events.withColumn("evidence_key", F.to_json("evidence"))
    return in_delivery_order(keyed, ranks).select(
        "ordinal", "type", "session_id", F.unix_micros("raised_at").alias("at_us"),
        F.col("src_seq").cast("bigint").alias("src_seq")
    )


@query(f"""{ORDERED}
SELECT ordinal // 50 AS chunk_id, 'demo' AS project, count(*) AS n, count(*) AS n_in_body,
  arg_min(session, ordinal) AS first_session, arg_max(session, ordinal) AS last_session
FROM ordered GROUP BY 1""")
def chunks(spark, sf_dir):
    events, ranks = _delivered(spark, sf_dir)
    body = F.parse_json("body")
    return (
        delivery_chunks(events, ranks, PROJECT)
        .withColumn(
            "sent", F.variant_get(body, "$.events", "array<struct<session_id: string>>")
        )
        .select(
            "chunk_id",
            F.variant_get(body, "$.project", "string").alias("project"),
            "n",
            F.size("sent").cast("bigint").alias("n_in_body"),
            F.col("sent")[0]["session_id"].alias("first_session"),
            F.element_at("sent", -1)["session_id"].alias("last_session"),
        )
    )


@query(f"""{COSTED}, {sql.MISROUTE}
SELECT event_id AS src_seq, 'model_misroute' AS type, 'demo' AS project, session AS session_id,
  'v0.model_misroute' AS rule, '0.5.0' AS sdk_version, model AS evidence_model,
  CASE WHEN at_us % 1000000 = 0 THEN strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S+00:00')
    ELSE strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS raised_at,
  {sql.micros("cost - alt_cost")} AS burn_micros
FROM misroute""")
def wire_events(spark, sf_dir):
    doc = F.parse_json("wire")

    def text(path):
        return F.variant_get(doc, path, "string")

    sent = wire_json(_fire(spark, sf_dir, "model_misroute"))
    burn = F.round(F.variant_get(doc, "$.estimated_burn", "double") * 1_000_000)
    return sent.select(
        F.col("src_seq").cast("bigint").alias("src_seq"),
        text("$.type").alias("type"),
        text("$.project").alias("project"),
        text("$.session_id").alias("session_id"),
        text("$.rule").alias("rule"),
        text("$.sdk_version").alias("sdk_version"),
        text("$.evidence.model").alias("evidence_model"),
        text("$.raised_at").alias("raised_at"),
        burn.cast("bigint").alias("burn_micros"),
    )


SENT_AT = """CASE WHEN at_us % 1000000 = 0 THEN strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S+00:00')
    ELSE strftime(make_timestamp(at_us), '%Y-%m-%dT%H:%M:%S.%f+00:00') END"""


@query(f"""{ORDERED}
SELECT ordinal // 50 AS chunk_id, ordinal % 50 AS place, type, session AS session_id, {SENT_AT} AS raised_at
FROM ordered""")
def delivered_batches(spark, sf_dir):
    """Batches of all of a project's runs, read back from the shared folder.

    One run is delivered twice, at first with events of one rule only, and another again without any;
    another project's run lies beside them.
    """
    events, ranks = _delivered(spark, sf_dir)
    out = f"{ensure_checkpoint_dir(spark)}/delivered-{uuid.uuid4().hex}"
    events, ranks = write_table(events, "to-deliver"), write_table(ranks, "ranks")
    some = delivery_chunks(events.filter("type = 'retry_storm'"), ranks, PROJECT)
    for run, batches in (
        ("run", some),
        ("taken-back", some),
        ("run", delivery_chunks(events, ranks, PROJECT)),
        ("taken-back", some.limit(0)),
    ):
        deliver(batches, out, PROJECT, run)
    deliver(delivery_chunks(events.limit(3), ranks, "other"), out, "other", "run")
    mine = delivered(spark, out, PROJECT)
    sent = F.from_json("body", "project STRING, events ARRAY<STRUCT<type: STRING, session_id: STRING, raised_at: STRING>>")
    return mine.select("chunk_id", F.posexplode(sent["events"]).alias("place", "event")).select(
        "chunk_id", F.col("place").cast("bigint").alias("place"), "event.type", "event.session_id", "event.raised_at"
    )


@query(f"""{COSTED}, {sql.windows(60)}, {sql.fired("loops", 4)},
{sql.windows(30).replace("wins AS", "wins30 AS")}, {sql.fired("storms", 3, wins="wins30")}, {sql.MISROUTE}, {sql.ELEMENTS}
SELECT 'tool_loop' AS type, session AS session_id, event_id AS src_seq, event_type AS said, n AS call_count,
  'BIGINT' AS count_type FROM loops
UNION ALL SELECT 'retry_storm', session, event_id, event_type, n, 'BIGINT' FROM storms
UNION ALL SELECT 'model_misroute', session, event_id, model, NULL, NULL FROM misroute
UNION ALL SELECT 'embedding_waste', session, event_id, {ITEM_HASH}, NULL, NULL FROM repeats WHERE nth = 2""")
def wire_evidence(spark, sf_dir):
    """Numbers in the evidence of any rule are numbers on the wire."""
    events = replay(event_calls(spark, sf_dir), synthetic_catalog(spark), PROJECT)
    doc = F.parse_json("wire")

    def text(path):
        return F.try_variant_get(doc, f"$.evidence.{path}", "string")

    count = F.try_variant_get(doc, "$.evidence.call_count", "variant")
    return wire_json(events).select(
        "type",
        "session_id",
        F.col("src_seq").cast("bigint").alias("src_seq"),
        F.coalesce(*(text(x) for x in ("tool", "request_hash", "model", "input_hash"))).alias("said"),
        F.try_variant_get(doc, "$.evidence.call_count", "bigint").alias("call_count"),
        F.when(count.isNotNull(), F.schema_of_variant(count)).alias("count_type"),
    )


# --- arrival without bounds ----------------------------------------------------------


@query("""WITH t AS (SELECT event_id, r FROM events, (SELECT unnest(range(7)) AS r))
SELECT 'langfuse' AS provider_src, 20240101120000 + event_id // 10000 AS page_idx, count(*) AS n,
  CAST(sum(CAST(((CAST(20240101120000 + event_id // 10000 AS HUGEINT) * 2147483648
    + (event_id % 10000) * 7 + r) * 2147483648) * 2 AS HUGEINT) % 1000003) AS BIGINT) AS checksum
FROM t GROUP BY ALL
UNION ALL
SELECT 'langsmith', 1704110400000000000 + event_id // 100, count(*),
  CAST(sum(CAST(((CAST(1704110400000000000 + event_id // 100 AS HUGEINT) * 2147483648
    + event_id % 100) * 2147483648) * 2 + 1 AS HUGEINT) % 1000003) AS BIGINT)
FROM events GROUP BY ALL""")
def unbounded_ordinals(spark, sf_dir):
    """Pages numbered by clock times down to nanoseconds, 70,000 traces in a page, two sources: none is rejected."""
    base = event_base(spark, sf_dir)

    def pages(rows: DataFrame, ordinal: str, envelope: str) -> DataFrame:
        body = F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda i: i["json"]), ",")
        grouped = rows.groupBy(F.expr(ordinal).alias("page_idx")).agg(body.alias("rows"))
        return grouped.select("page_idx", F.expr(envelope).alias("body"))

    traces = base.select("event_id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("r")).select(
        "event_id",
        F.struct("event_id", "r", F.lit('{"id":"t","observations":[{"type":"GENERATION"}]}').alias("json")).alias("item"),
    )
    runs = base.select(
        "event_id", F.struct("event_id", F.lit('{"id":"r","run_type":"llm"}').alias("json")).alias("item")
    )
    langfuse = pages(traces, "20240101120000 + event_id DIV 10000", "concat('{\"data\":[', rows, ']}')")
    langsmith = pages(runs, "1704110400000000000 + event_id DIV 100", "concat('{\"runs\":[', rows, ']}')")
    result = analyze_many(
        spark,
        [Source(langfuse, "langfuse"), Source(langsmith, "langsmith")],
        PROJECT,
        rules=ONE_RULE,
        dry_run=True,
        ingest_time=INGEST,
    )
    # Two sources share the ordinals, so a page has twice 2**62 of them.
    return result.calls.groupBy(
        "provider_src", F.expr("src_seq DIV CAST(9223372036854775808 AS DECIMAL(38,0))").alias("page_idx")
    ).agg(F.count("*").alias("n"), F.sum(F.expr("CAST(src_seq % 1000003 AS BIGINT)")).alias("checksum"))


# --- streams ------------------------------------------------------------------------


@query(f"""WITH {sql.BASE}
SELECT {HELICONE_SESSION} AS session_id, count(*) AS n, CAST(sum(tokens) AS BIGINT) AS prompt_tokens
FROM base GROUP BY 1""")
def streamed_calls(spark, sf_dir):
    """Landed pages through a stream that takes all that is there, a few files a batch."""
    folder = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    event_pages(spark, sf_dir, "helicone").repartition(8).write.parquet(f"{folder}/pages")
    pages = stream_page_table(spark, f"{folder}/pages", files_per_batch=4)
    candidates = stream_candidates(pages, "helicone", INGEST)
    write_candidates(candidates, f"{folder}/calls", f"{folder}/checkpoint").awaitTermination()
    calls = calls_of(spark.read.parquet(f"{folder}/calls"))
    return calls.groupBy("session_id").agg(
        F.count("*").alias("n"), F.sum("prompt_tokens").alias("prompt_tokens")
    )


@query(_loop_sql("retry_storm", 30, 3, "session", "request_hash"))
def streamed_retry_storm(spark, sf_dir):
    """The rule over a stream of calls on Spark's state; one last call far ahead moves the mark past all."""
    folder = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    calls = event_calls(spark, sf_dir)
    last = calls.limit(1).withColumns(
        {"timestamp": F.lit(INGEST), "session_id": F.lit("last"), "src_seq": F.lit(-1).cast("decimal(38,0)")}
    )
    calls.unionByName(last).write.parquet(f"{folder}/calls")
    landed = spark.readStream.schema(spark.read.parquet(f"{folder}/calls").schema).parquet(f"{folder}/calls")
    storm = StreamingRule(RULES["retry_storm"], folder, synthetic_catalog(spark), PROJECT, 60)
    storm.start(landed).awaitTermination()
    return _flat(storm.events(spark), "request_hash", "call_count")


# --- whole imports -----------------------------------------------------------------


def _summary_columns(row: DataFrame) -> DataFrame:
    """The summary without map or decimal columns."""

    def of(name, kind):
        return F.coalesce(F.col("events_by_type")[kind], F.lit(0)).alias(name)

    return row.select(
        "fetched_traces",
        "pages_fetched",
        "inferred_sessions",
        "fired_events",
        of("n_retry_storm", "retry_storm"),
        of("n_model_misroute", "model_misroute"),
        of("n_tool_loop", "tool_loop"),
        (F.col("estimated_burn_total_usd") * 100).cast("bigint").alias("burn_cents"),
        *[
            F.coalesce((F.col("burn_by_type")[kind] * 100).cast("bigint"), F.lit(0)).alias(f"{kind}_cents")
            for kind in ("retry_storm", "model_misroute", "tool_loop")
        ],
        "backfill_accepted",
        "backfill_rejected",
        F.col("dry_run").cast("int").alias("dry_run"),
    )


# Helicone sessions differ for every fifth event, and all carry an embedding-shaped input.
HELICONE_IMPORT = f"""WITH {sql.BASE.replace("'u' || user_id AS session,",
  "CASE WHEN event_id % 5 = 4 THEN 'u' || user_id || '-' || event_type ELSE 'u' || user_id END AS session,")},
{sql.PRICES}, {sql.COSTED}, {sql.windows(30)}, {sql.fired("storms", 3)}, {sql.MISROUTE},
repeats AS (
  SELECT *, row_number() OVER (PARTITION BY session, props ORDER BY at_us, event_id) AS nth
  FROM costed WHERE event_type = 'signup'),
fired_events AS (
  SELECT 'retry_storm' AS type, cost_all - cost_first AS nanos FROM storms
  UNION ALL SELECT 'model_misroute', cost - alt_cost FROM misroute
  UNION ALL SELECT 'embedding_waste', cost FROM repeats WHERE nth = 2),
m AS (SELECT type, {sql.micros("nanos")} AS burn_micros FROM fired_events)"""


@query(f"""{HELICONE_IMPORT}
SELECT (SELECT count(*) FROM events) AS fetched_traces,
  (SELECT count(DISTINCT event_id // 100) FROM events) AS pages_fetched,
  (SELECT count(DISTINCT session) FROM base) AS inferred_sessions,
  count(*) AS fired_events,
  count(*) FILTER (type = 'retry_storm') AS n_retry_storm,
  count(*) FILTER (type = 'model_misroute') AS n_model_misroute,
  CAST(0 AS BIGINT) AS n_tool_loop, {sql.cents("sum(burn_micros)")} AS burn_cents,
  {sql.cents("sum(burn_micros) FILTER (type = 'retry_storm')")} AS retry_storm_cents,
  {sql.cents("sum(burn_micros) FILTER (type = 'model_misroute')")} AS model_misroute_cents,
  CAST(0 AS BIGINT) AS tool_loop_cents,
  (SELECT CAST(sum(event_id % 50) AS BIGINT) FROM events) AS backfill_accepted,
  (SELECT CAST(sum(event_id % 7) AS BIGINT) FROM events WHERE event_id % 3 <> 0) AS backfill_rejected, 1 AS dry_run
FROM m""")
def helicone_import(spark, sf_dir):
    """Pages to summary: the flagship path, with a log of answers to batches."""
    pages = event_pages(spark, sf_dir, "helicone")
    answers = _responses(spark, sf_dir)
    result = analyze(
        spark, pages, "helicone", PROJECT, dry_run=True, ingest_time=INGEST, responses=answers
    )
    return _summary_columns(result.summary)


@query(f"""{HELICONE_IMPORT}
SELECT CASE WHEN count(*) > 0 THEN 'leaks' ELSE 'clean' END AS status, count(*) AS fired_events,
  1 AS dry_run FROM m
UNION ALL SELECT CASE WHEN count(*) > 0 THEN 'clean' ELSE 'no_traces' END, 0, 1 FROM events
UNION ALL SELECT 'no_traces', 0, 1""")
def status(spark, sf_dir):
    """An import with leaks, one whose only rule has nothing to look for, and one of no pages."""
    pages = event_pages(spark, sf_dir, "helicone")
    silent = {"config": {"model_misroute.keywords": []}, "rules": ONE_RULE}
    results = [
        analyze(spark, some, "helicone", PROJECT, dry_run=True, ingest_time=INGEST, **options)
        for some, options in ((pages, {}), (pages, silent), (pages.filter("page_idx < 0"), silent))
    ]
    reports = [status_report(result.summary) for result in results]
    return reduce(DataFrame.unionByName, reports).withColumn("dry_run", F.col("dry_run").cast("int"))


@query(f"""WITH {sql.BASE},
calls AS (
  SELECT {LANGFUSE_SESSION} AS session_id, event_type AS tool, at_us,
    CASE event_id % 4 WHEN 0 THEN 'k' || tokens WHEN 1 THEN 's' ELSE 'none' END AS arguments,
    event_id * 2 AS seq
  FROM base WHERE event_id % 4 <> 3
  UNION ALL SELECT {LANGFUSE_SESSION}, '', at_us, 'none', event_id * 2 FROM base WHERE event_id % 4 = 1
  UNION ALL SELECT {LANGSMITH_SESSION}, event_type, at_us,
    CASE event_id % 4 WHEN 0 THEN 'k' || tokens WHEN 1 THEN 'none' ELSE 's' END, event_id * 2 + 1
  FROM base WHERE event_id % 4 <> 3 AND event_id % 6 <> 5),
wins AS (
  SELECT i.session_id, i.tool, i.arguments, i.at_us, i.seq, count(*) AS n
  FROM calls i JOIN calls j USING (session_id, tool, arguments)
  WHERE j.at_us >= i.at_us - 60000000
    AND (j.at_us < i.at_us OR (j.at_us = i.at_us AND j.seq <= i.seq))
  GROUP BY ALL),
f AS (
  SELECT * FROM wins WHERE n >= 3
  QUALIFY row_number() OVER (PARTITION BY session_id, tool, arguments ORDER BY at_us, n) = 1)
SELECT session_id, at_us, tool, CAST(n AS VARCHAR) AS call_count FROM f""")
def merged_tool_loop(spark, sf_dir):
    """Two providers' pages through one replay, user-facing calls included."""
    sources = [
        Source(event_pages(spark, sf_dir, p), p) for p in ("langfuse", "langsmith")
    ]
    result = analyze_many(
        spark,
        sources,
        PROJECT,
        config={"tool_loop.respect_user_facing": False, "tool_loop.min_calls": 3},
        rules={"tool_loop": RULES["tool_loop"]},
        dry_run=True,
        ingest_time=INGEST,
    )
    return result.events.select(
        "session_id",
        F.unix_micros("raised_at").alias("at_us"),
        F.col("evidence")["tool"].cast("string").alias("tool"),
        F.col("evidence")["call_count"].cast("string").alias("call_count"),
    )
