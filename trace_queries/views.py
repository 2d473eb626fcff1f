"""Trace data derived from the given tables.

The tables hold no traces, so every event becomes one model call. Times are
compressed 1440-fold, which turns the thirty days into thirty minutes and lets
the 30 s and 60 s windows hold several calls of one user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracewaste.schemas import CALLS
from tracewaste.session import prepare_session

PAGE = 100

BASE = [
    "event_id",
    "user_id",
    "event_type",
    "value",
    "props",
    "concat('u', user_id) AS session",
    "1704067200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) DIV 1440 AS at_us",
    """CASE event_type WHEN 'click' THEN 'gpt-5' WHEN 'view' THEN 'gpt-5-mini'
       WHEN 'purchase' THEN 'claude-sonnet-4-6' WHEN 'signup' THEN 'text-embedding-3-small'
       ELSE 'gemini-pro' END AS model""",
    """CASE event_type WHEN 'purchase' THEN 'anthropic' WHEN 'error' THEN 'google'
       ELSE 'openai' END AS vendor""",
    "CAST(floor(value) AS BIGINT) AS tokens",
    "CAST(floor(value / 10) AS BIGINT) AS out_tokens",
    """CASE WHEN event_id % 3 = 0
       THEN concat('Please classify event ', event_id, ' as positive or negative')
       ELSE concat('Summarize event ', event_id) END AS message""",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns every derived trace is made of."""
    return table(spark, sf_dir, "events").selectExpr(*BASE)


def event_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls: the tool and the request hash are the event type."""
    calls = event_base(spark, sf_dir).selectExpr(
        "'events' AS provider_src",
        "event_id AS src_seq",
        "session AS session_id",
        "timestamp_micros(at_us) AS timestamp",
        "vendor AS provider",
        "model",
        """CASE WHEN event_type = 'signup' THEN 'embeddings.create'
           ELSE 'chat.completions.create' END AS method""",
        "tokens AS prompt_tokens",
        "out_tokens AS completion_tokens",
        "value AS latency_ms",
        "event_type AS request_hash",
        "array(named_struct('name', event_type, 'arguments', '{}')) AS tool_calls",
        "false AS user_facing_output",
        """named_struct(
             'messages', to_variant_object(array(named_struct('role', 'user', 'content', message))),
             'input', CASE WHEN event_type = 'signup' AND event_id % 2 = 0
                           THEN to_variant_object(array(props, concat('v', tokens)))
                           WHEN event_type = 'signup' THEN CAST(props AS VARIANT) END
           ) AS raw_request""",
        "CAST(map() AS MAP<STRING, STRING>) AS raw_response_meta",
    )
    return calls.to(StructType.fromDDL(CALLS))


# Each record leaves out, retypes or moves fields by event_id, so that every fallback is taken.
HELICONE_RECORD = """concat(
  '{"request_id":"', session, '-', event_type, '","provider":"', initcap(vendor),
  '","model":"', model, '","body":{"input":"', replace(props, '"', '\\\\"'), '"},"prompt":"', message, '"',
  CASE event_id % 4 WHEN 0 THEN concat(',"prompt_tokens":0,"usage":{"prompt_tokens":', tokens, '}')
                    WHEN 1 THEN concat(',"prompt_tokens":"', tokens, '"')
                    WHEN 2 THEN concat(',"usage":{"input_tokens":', tokens, ',"output_tokens":', out_tokens, '}')
                    ELSE concat(',"prompt_tokens":', tokens) END,
  CASE WHEN event_id % 4 = 2 THEN '' ELSE concat(',"completion_tokens":', out_tokens) END,
  CASE WHEN event_id % 2 = 0 THEN concat(',"latency_ms":', value) ELSE concat(',"latency":"', value, '"') END,
  ',"created_at":"', CASE event_id % 3
     WHEN 0 THEN date_format(timestamp_micros(at_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
     WHEN 1 THEN date_format(timestamp_micros(at_us + 19800000000), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'")
     ELSE date_format(timestamp_micros(at_us), "yyyy-MM-dd HH:mm:ss.SSSSSS") END, '"',
  CASE event_id % 5 WHEN 3 THEN concat(',"properties":{"session_id":"', session, '"}')
                    WHEN 4 THEN ',"properties":{"Helicone-Session-Id":""}'
                    ELSE concat(',"properties":{"Helicone-Session-Id":"', session, '","session_id":"x"}') END,
  '}')"""

LANGFUSE_RECORD = """concat(
  '{"timestamp":"', date_format(timestamp_micros(at_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"',
  CASE event_id % 5 WHEN 3 THEN '' WHEN 4 THEN ',"sessionId":null' ELSE concat(',"sessionId":"', session, '"') END,
  CASE WHEN event_id % 5 = 3 THEN '' ELSE concat(',"id":"tr-', event_id, '"') END,
  ',"input":"', message, '","observations":[',
  CASE WHEN event_id % 2 = 0 THEN '{"type":"SPAN","id":"skip"},' ELSE '' END,
  '{"type":"generation"',
  CASE WHEN event_id % 7 = 0 THEN '' ELSE concat(',"id":"obs-', event_id, '"') END,
  CASE WHEN event_id % 11 = 0 THEN concat(',"model":"own-', event_type, '","modelParameters":{"provider":"Vendor"}')
       ELSE concat(',"model":"', model, '"') END,
  ',"startTime":"', date_format(timestamp_micros(at_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"',
  CASE WHEN event_id % 13 = 0 THEN '' ELSE concat(',"endTime":"',
       date_format(timestamp_micros(at_us + tokens * 1000), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"') END,
  ',"usage":{"input":', tokens, ',"output":"', out_tokens, '"',
  CASE event_id % 4 WHEN 0 THEN ',"unit":"CHARACTERS"' WHEN 1 THEN ',"unit":"tokens"'
                    WHEN 2 THEN ',"unit":null' ELSE '' END, '}',
  ',"output":', CASE event_id % 4
     WHEN 0 THEN concat('{"content":[{"type":"text"},{"type":"tool_use","name":"', event_type, '","input":{"z":1,"k":', tokens, '}}]}')
     WHEN 1 THEN concat('{"content":[],"tool_calls":[{"function":{"name":"', event_type, '","arguments":"s"}},{"function":{}}]}')
     WHEN 2 THEN concat('{"function_call":{"name":"', event_type, '"}}')
     ELSE '"text"' END,
  '}]}')"""

LANGSMITH_RECORD = """concat(
  '{"run_type":"', CASE WHEN event_id % 6 = 5 THEN 'chain' ELSE 'LLM' END, '","name":"own-', event_type, '"',
  CASE event_id % 5 WHEN 3 THEN '' WHEN 4 THEN ',"session_id":""' ELSE concat(',"session_id":"', session, '"') END,
  CASE WHEN event_id % 5 = 3 THEN '' ELSE concat(',"id":"run-', event_id, '"') END,
  ',"start_time":"', date_format(timestamp_micros(at_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"',
  ',"end_time":"', date_format(timestamp_micros(at_us + tokens * 1000), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"',
  CASE event_id % 4 WHEN 0 THEN concat(',"prompt_tokens":', tokens, ',"completion_tokens":', out_tokens)
                    WHEN 1 THEN concat(',"prompt_tokens":null,"completion_tokens":"', out_tokens, '"')
                    ELSE '' END,
  ',"extra":{"invocation_params":{',
  CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('"model":"', model, '",') END,
  CASE event_id % 7 WHEN 0 THEN '"_type":"chat-vertexai",' WHEN 1 THEN '"_type":"Anthropic-chat",' ELSE '' END,
  CASE WHEN event_id % 4 = 2 THEN concat('"usage":{"prompt_tokens":0,"input_tokens":', tokens, ',"output":', out_tokens, '}')
       ELSE '"usage":{"input":7,"output":"x"}' END, '}}',
  ',"inputs":', CASE event_id % 3 WHEN 0 THEN concat('{"messages":[{"content":"', message, '"}],"input":"x"}')
                                  WHEN 1 THEN concat('{"input":"', message, '"}')
                                  ELSE concat('{"input":["', session, '"]}') END,
  ',"outputs":', CASE event_id % 4
     WHEN 0 THEN concat('{"generations":[[{"message":{"tool_calls":[{"name":"', event_type, '","args":{"z":1,"k":', tokens, '}}]}}]]}')
     WHEN 1 THEN concat('{"generations":[[{"content":[{"type":"tool_use","name":"', event_type, '"}]}]]}')
     WHEN 2 THEN concat('{"tool_calls":[{"function":{"name":"', event_type, '","arguments":"s"}}]}')
     ELSE concat('{"function_call":{"name":"', event_type, '"}}') END,
  '}')"""

RECORDS = {
    "helicone": HELICONE_RECORD,
    "langfuse": LANGFUSE_RECORD,
    "langsmith": LANGSMITH_RECORD,
}

ENVELOPES = {
    "helicone": "CASE WHEN page % 2 = 0 THEN concat('[', rows, ']') ELSE concat('{\"data\":[', rows, ']}') END",
    "langfuse": "concat('{\"data\":[', rows, '],\"meta\":{\"totalPages\":', last_page + 1, '}}')",
    "langsmith": """concat('{"runs":[', rows, '],"cursors":{"next":',
        CASE WHEN page = last_page THEN 'null' ELSE concat('"c', page + 1, '"') END, '}}')""",
}


def paged(records: DataFrame, provider: str, keep: str = "true", stop: str = "last_page") -> DataFrame:
    """Responses of up to 100 records each, from ``(event_id, json)``.

    ``keep`` drops records to make short pages. Pages are numbered from 0, or
    from 1 for the format that numbers them on the wire.
    """
    rows = (
        records.groupBy(F.expr(f"event_id DIV {PAGE}").alias("page"))
        .agg(
            # At most one page's hundred records.
            F.array_sort(
                F.collect_list(F.when(F.expr(keep), F.struct("event_id", "json")))
            ).alias("items")
        )
        .select(
            "page",
            F.concat_ws(",", F.transform("items", lambda i: i["json"])).alias("rows"),
        )
    )
    last = records.agg(F.expr(f"max(event_id) DIV {PAGE}")).scalar()
    first = 1 if provider == "langfuse" else 0
    return (
        rows.withColumn("total_pages", last)
        .withColumn("last_page", F.expr(stop.replace("last_page", "total_pages")))
        .select(
            (F.col("page") + first).cast("bigint").alias("page_idx"),
            F.expr(ENVELOPES[provider]).alias("body"),
        )
    )


def event_pages(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    """Landed pages of one provider, one record per event."""
    records = event_base(spark, sf_dir).select(
        "event_id", F.expr(RECORDS[provider]).alias("json")
    )
    return paged(records, provider)
