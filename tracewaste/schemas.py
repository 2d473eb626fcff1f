"""Column layouts shared by every stage."""

from __future__ import annotations

from pyspark.sql.types import StructType

# One landed API response. ``body`` is the raw JSON text.
PAGES = "page_idx BIGINT, body STRING"

# One element of a page.
RECORDS = "provider_src STRING, page_idx BIGINT, src_seq DECIMAL(38,0), rec VARIANT"

# One normalised model call.
CALLS = (
    "provider_src STRING, src_seq DECIMAL(38,0), session_id STRING, timestamp TIMESTAMP, provider STRING, "
    "model STRING, method STRING, prompt_tokens BIGINT, completion_tokens BIGINT, latency_ms DOUBLE, "
    "request_hash STRING, tool_calls ARRAY<STRUCT<name: STRING, arguments: STRING>>, "
    "user_facing_output BOOLEAN, raw_request STRUCT<messages: VARIANT, input: VARIANT>, "
    "raw_response_meta MAP<STRING, STRING>"
)

# One record or observation that could not become a call.
REJECTED = "provider_src STRING, src_seq DECIMAL(38,0), session_id STRING, skip_reason STRING"

# One firing of a rule.
EVENTS = (
    "type STRING, confidence DOUBLE, project STRING, session_id STRING, rule STRING, "
    "evidence MAP<STRING, VARIANT>, estimated_burn DECIMAL(18,6), suggested_action STRING, "
    "raised_at TIMESTAMP, src_seq DECIMAL(38,0), sdk_version STRING"
)

# Prices and routing advice per model, supplied by the user.
MODEL_CATALOG = (
    "model STRING, price_in_per_1k DECIMAL(18,6), price_out_per_1k DECIMAL(18,6), "
    "is_frontier BOOLEAN, alternative STRING"
)


def column_names(layout: str) -> list[str]:
    """Top-level column names of one of the layouts above, in order."""
    return StructType.fromDDL(layout).fieldNames()
