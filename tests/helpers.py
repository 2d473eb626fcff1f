"""Builders for pages and calls used across the tests."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracewaste.operators.normalize import calls_of, normalize_records, rejected_of
from tracewaste.schemas import CALLS, PAGES
from tracewaste.sources.pages import parse_pages, unwrap_records

INGEST = datetime(2026, 5, 1, tzinfo=timezone.utc)


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def pages_of(spark, *bodies, first=0):
    rows = [
        (first + i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, PAGES)


def candidates(spark, provider, *records, bodies=None):
    envelope = {
        "helicone": lambda r: r,
        "langfuse": lambda r: {"data": r, "meta": {}},
        "langsmith": lambda r: {"runs": r, "cursors": {}},
    }[provider]
    pages = pages_of(spark, *(bodies or [envelope(list(records))]))
    return normalize_records(
        unwrap_records(parse_pages(pages, provider), provider), provider, INGEST
    )


def call_rows(spark, provider, *records):
    found = calls_of(candidates(spark, provider, *records))
    return (
        found.withColumn("messages", F.to_json("raw_request.messages"))
        .withColumn("input", F.to_json("raw_request.input"))
        .drop("raw_request")
        .orderBy("src_seq")
        .collect()
    )


def reject_rows(spark, provider, *records):
    return rejected_of(candidates(spark, provider, *records)).orderBy("src_seq").collect()


def calls_frame(spark, rows):
    """Calls from dicts; ``at`` is seconds (may be fractional), the rest has defaults."""
    data = []
    for i, r in enumerate(rows):
        data.append(
            (
                r.get("provider_src", "test"),
                r.get("src_seq", i),
                r.get("session_id", "s1"),
                int(round(r["at"] * 1_000_000)),
                r.get("provider", "openai"),
                r.get("model", "gpt-5"),
                r.get("method", "chat.completions.create"),
                r.get("prompt_tokens", 1000),
                r.get("completion_tokens", 100),
                r.get("request_hash", f"h{i}"),
                [(t["name"], json.dumps(t["arguments"], sort_keys=True)) for t in r.get("tools", [])],
                r.get("user_facing", False),
                json.dumps(r["messages"]) if "messages" in r else None,
                json.dumps(r["input"]) if "input" in r else None,
            )
        )
    flat = spark.createDataFrame(
        data,
        "provider_src STRING, src_seq BIGINT, session_id STRING, at_us BIGINT, provider STRING, "
        "model STRING, method STRING, prompt_tokens BIGINT, completion_tokens BIGINT, "
        "request_hash STRING, tool_calls ARRAY<STRUCT<name: STRING, arguments: STRING>>, "
        "user_facing_output BOOLEAN, messages STRING, input STRING",
    )
    return flat.selectExpr(
        "provider_src", "src_seq", "session_id", "timestamp_micros(at_us) AS timestamp",
        "provider", "model", "method", "prompt_tokens", "completion_tokens",
        "CAST(0 AS DOUBLE) AS latency_ms", "request_hash", "tool_calls", "user_facing_output",
        "named_struct('messages', parse_json(messages), 'input', parse_json(input)) AS raw_request",
        "CAST(map() AS MAP<STRING, STRING>) AS raw_response_meta",
    ).to(StructType.fromDDL(CALLS))
