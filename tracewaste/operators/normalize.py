"""Records of each provider to the common call layout.

Each function returns one row per candidate call with a ``skip_reason`` that is
NULL for good rows, so that calls and rejects come from a single pass. The work
goes in steps: look the fields up, pick the non-empty candidates, derive. A
consumer that names its columns gets only what those, and the reasons, are made of.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewaste.functions import ids, models, requests, tools, usage
from tracewaste.functions.times import elapsed_ms, iso_text, moment_literal, parse_iso
from tracewaste.functions.values import (
    at,
    display_text,
    display_text_or,
    elements,
    evaluated_once,
    first_truthy,
    is_filled_object,
    is_object,
    is_present,
    is_truthy,
    real_number,
    text_at,
    whole_number,
)
from tracewaste.operators.derive import derived, inputs_of, paths
from tracewaste.schemas import CALLS, REJECTED, column_names
from tracewaste.sources.pages import nested_ordinal

NO_META = "CAST(map() AS MAP<STRING, STRING>)"


def candidate_columns() -> list[str]:
    """What a candidate call can be asked for: its page, the call, and why it is none."""
    source, *call = column_names(CALLS)
    return [source, "page_idx", *call, "skip_reason"]


def _zero_if_absent(value: Column, reader, kind: str) -> Column:
    """NULL only when a non-empty value is not a number."""
    return F.when(value.isNull(), F.lit(0).cast(kind)).otherwise(reader(value))


def _time_or(text: Column, ingest_time: datetime) -> Column:
    return F.coalesce(parse_iso(text), moment_literal(ingest_time))


def helicone_candidates(records: DataFrame, ingest_time: datetime, wanted: Sequence[str]) -> DataFrame:
    fields = paths(
        "rec",
        {
            "v_provider": "$.provider",
            "v_model": "$.model",
            "v_prompt_tokens": "$.prompt_tokens",
            "v_completion_tokens": "$.completion_tokens",
            "v_usage": "$.usage",
            "v_usage_prompt": "$.usage.prompt_tokens",
            "v_usage_input": "$.usage.input_tokens",
            "v_usage_completion": "$.usage.completion_tokens",
            "v_usage_output": "$.usage.output_tokens",
            "v_latency_ms": "$.latency_ms",
            "v_latency": "$.latency",
            "v_created": "$.created_at",
            # The property name is case-sensitive.
            "v_session": '$.properties["Helicone-Session-Id"]',
            "v_own_session": "$.properties.session_id",
            "v_request_id": "$.request_id",
            "v_id": "$.id",
            "v_messages": "$.body.messages",
            "v_prompt": "$.prompt",
            "v_body_prompt": "$.body.prompt",
            "v_body_input": "$.body.input",
            "v_input": "$.input",
        },
    ) | {"is_record": lambda rec: is_object(rec)}
    chosen = {
        "c_prompt_tokens": lambda v_prompt_tokens, v_usage_prompt, v_usage_input: first_truthy(
            v_prompt_tokens, v_usage_prompt, v_usage_input
        ),
        "c_completion_tokens": lambda v_completion_tokens, v_usage_completion, v_usage_output: first_truthy(
            v_completion_tokens, v_usage_completion, v_usage_output
        ),
        "c_request_id": lambda v_request_id, v_id: first_truthy(v_request_id, v_id),
    }
    picked = {
        "c_latency": lambda v_latency_ms, v_latency: first_truthy(v_latency_ms, v_latency),
        "c_session": lambda v_session, v_own_session, c_request_id: F.coalesce(
            first_truthy(v_session, v_own_session), c_request_id
        ),
        "t_created": lambda v_created: iso_text(v_created),
        "c_prompt": lambda v_prompt, v_body_prompt: F.when(is_present(v_prompt), v_prompt).otherwise(
            v_body_prompt
        ),
        # An empty usage value counts as no usage; any other non-object breaks the
        # record as soon as it has to be consulted.
        "broken_usage": lambda v_usage, v_prompt_tokens, v_completion_tokens: ~is_object(v_usage)
        & is_truthy(v_usage)
        & ~(is_truthy(v_prompt_tokens) & is_truthy(v_completion_tokens)),
    }
    values = {
        "raw_request": lambda v_messages, c_prompt, v_body_input, v_input: requests.helicone_request(
            v_messages, c_prompt, v_body_input, v_input
        ),
        "session_id": lambda c_session, v_provider, v_created: ids.session_id(
            c_session, ids.orphan_id("helicone", (v_provider, "unknown"), (v_created, "0"))
        ),
        "timestamp": lambda t_created: _time_or(t_created, ingest_time),
        "provider": lambda v_provider: F.lower(display_text_or(v_provider, "unknown")),
        "model": lambda v_model: display_text_or(v_model, "unknown"),
        "prompt_tokens": lambda c_prompt_tokens: _zero_if_absent(c_prompt_tokens, whole_number, "bigint"),
        "completion_tokens": lambda c_completion_tokens: _zero_if_absent(
            c_completion_tokens, whole_number, "bigint"
        ),
        "latency_ms": lambda c_latency: _zero_if_absent(c_latency, real_number, "double"),
    }
    last = {
        "method": lambda provider, model: models.method_from_model(provider, model),
        "request_hash": lambda c_request_id, session_id: F.coalesce(display_text(c_request_id), session_id),
        "tool_calls": lambda: F.expr(tools.NO_TOOL_CALLS),
        "user_facing_output": lambda: F.lit(False),
        "raw_response_meta": lambda: F.expr(NO_META),
        "skip_reason": lambda is_record, broken_usage, prompt_tokens, completion_tokens, latency_ms: (
            F.when(~is_record, F.lit("record_not_an_object"))
            .when(broken_usage, F.lit("usage_not_an_object"))
            .when(prompt_tokens.isNull(), F.lit("prompt_tokens_not_a_number"))
            .when(completion_tokens.isNull(), F.lit("completion_tokens_not_a_number"))
            .when(latency_ms.isNull(), F.lit("latency_not_a_number"))
        ),
    }
    return derived(records, [fields, chosen, picked, values, last], wanted)


def langfuse_candidates(records: DataFrame, ingest_time: datetime, wanted: Sequence[str]) -> DataFrame:
    fields = paths(
        "obs",
        {
            "v_id": "$.id",
            "v_model": "$.model",
            "v_explicit": "$.modelParameters.provider",
            "v_usage": "$.usage",
            "v_unit": "$.usage.unit",
            "v_usage_input": "$.usage.input",
            "v_usage_output": "$.usage.output",
            "v_start": "$.startTime",
            "v_end": "$.endTime",
            "v_input": "$.input",
            "v_messages": "$.input.messages",
            "v_nested_input": "$.input.input",
            "v_content": "$.output.content",
            "v_functions": "$.output.tool_calls",
            "v_legacy": "$.output.function_call",
        },
    )
    chosen = {
        "c_model": lambda v_model: first_truthy(v_model),
        "c_id": lambda v_id: first_truthy(v_id),
    }
    picked = {
        "t_start": lambda v_start: iso_text(v_start),
        "t_end": lambda v_end: iso_text(v_end),
        "blocks": lambda v_content: tools.tool_use_blocks(v_content),
        "functions": lambda v_functions: tools.tool_entries(v_functions),
    }
    values = {
        "model": lambda c_model: F.coalesce(display_text(c_model), F.lit("unknown")),
        "timestamp": lambda t_start: _time_or(t_start, ingest_time),
        "end_time": lambda t_end: parse_iso(t_end),
        "countable": lambda v_usage, v_unit: is_object(v_usage) & usage.counted_in_tokens(v_unit),
        "src_seq": lambda src_seq, obs_pos: nested_ordinal(src_seq, obs_pos),
    }

    def tokens(countable: Column, value: Column) -> Column:
        return usage.zero_unless(countable, usage.or_zero(value))

    last = {
        "provider": lambda model, v_explicit: models.provider_from_model(
            model, models.provider_from_parameters(v_explicit)
        ),
        "method": lambda: F.lit("messages.create"),
        "prompt_tokens": lambda countable, v_usage_input: tokens(countable, v_usage_input),
        "completion_tokens": lambda countable, v_usage_output: tokens(countable, v_usage_output),
        "latency_ms": lambda timestamp, end_time: elapsed_ms(timestamp, end_time),
        "request_hash": lambda session_id, c_id: ids.derived_request_hash(session_id, c_id),
        "tool_calls": lambda blocks, functions, v_legacy: tools.observation_tool_calls(
            blocks, functions, v_legacy
        ),
        "user_facing_output": lambda: F.lit(True),
        "raw_request": lambda v_input, v_messages, v_nested_input, v_outer: requests.langfuse_request(
            v_input, v_messages, v_nested_input, v_outer
        ),
        "raw_response_meta": lambda: F.expr(NO_META),
    }
    steps = [fields, chosen, picked, values, last]

    trace_steps = [
        paths(
            "rec",
            {
                "v_observations": "$.observations",
                "v_session": "$.sessionId",
                "v_trace_id": "$.id",
                "v_time": "$.timestamp",
                "v_outer": "$.input",
            },
        )
        | {"is_record": lambda rec: is_object(rec)},
        {
            "listed": lambda v_observations: elements(v_observations),
            "c_session": lambda v_session, v_trace_id: first_truthy(v_session, v_trace_id),
        },
        {
            "trace_reason": lambda is_record, listed, v_observations: F.when(
                ~is_record, F.lit("record_not_an_object")
            ).when(listed.isNull() & is_truthy(v_observations), F.lit("observations_not_a_list")),
            "session_id": lambda c_session, v_time: ids.session_id(
                c_session, ids.orphan_id("langfuse", (v_time, "0"))
            ),
        },
    ]
    carried = inputs_of(steps, wanted) - {"obs", "obs_pos", "skip_reason"}
    traces = derived(records, trace_steps, carried | {"listed", "trace_reason"})
    observations = (
        traces.select(
            *(name for name in traces.columns if name in carried),
            "trace_reason",
            # A rejected trace keeps one empty observation, so that its reason is reported.
            F.posexplode(
                F.when(
                    F.col("trace_reason").isNotNull(), F.expr("array(CAST(NULL AS VARIANT))")
                ).otherwise(F.col("listed"))
            ).alias("obs_pos", "obs"),
        )
        .withColumn(
            "skip_reason",
            F.coalesce(
                F.col("trace_reason"),
                F.when(~is_object(F.col("obs")), F.lit("observation_not_an_object")),
            ),
        )
        .filter(
            F.col("skip_reason").isNotNull()
            | (F.upper(text_at(F.col("obs"), "$.type")) == "GENERATION")
        )
    )
    return derived(observations, steps, wanted)


def langsmith_candidates(records: DataFrame, ingest_time: datetime, wanted: Sequence[str]) -> DataFrame:
    skip_reason = F.when(~is_object(F.col("rec")), F.lit("record_not_an_object"))
    kept = records.withColumn("skip_reason", skip_reason).filter(
        F.col("skip_reason").isNotNull() | (F.lower(text_at(F.col("rec"), "$.run_type")) == "llm")
    )
    fields = paths(
        "rec",
        {
            "v_session": "$.session_id",
            "v_id": "$.id",
            "v_name": "$.name",
            "v_start": "$.start_time",
            "v_end": "$.end_time",
            "v_prompt_tokens": "$.prompt_tokens",
            "v_completion_tokens": "$.completion_tokens",
            "v_model": "$.extra.invocation_params.model",
            "v_type": "$.extra.invocation_params._type",
            "v_usage_prompt": "$.extra.invocation_params.usage.prompt_tokens",
            "v_usage_input_tokens": "$.extra.invocation_params.usage.input_tokens",
            "v_usage_input": "$.extra.invocation_params.usage.input",
            "v_usage_completion": "$.extra.invocation_params.usage.completion_tokens",
            "v_usage_output_tokens": "$.extra.invocation_params.usage.output_tokens",
            "v_usage_output": "$.extra.invocation_params.usage.output",
            "v_messages": "$.inputs.messages",
            "v_input": "$.inputs.input",
            "v_generation": "$.outputs.generations[0][0]",
            "v_message": "$.outputs.generations[0][0].message",
            "v_functions": "$.outputs.tool_calls",
        },
    )
    chosen = {
        "c_id": lambda v_id: first_truthy(v_id),
        "c_prompt": lambda v_usage_prompt, v_usage_input_tokens, v_usage_input: first_truthy(
            v_usage_prompt, v_usage_input_tokens, v_usage_input
        ),
        "c_completion": lambda v_usage_completion, v_usage_output_tokens, v_usage_output: first_truthy(
            v_usage_completion, v_usage_output_tokens, v_usage_output
        ),
    }
    picked = {
        "c_model": lambda v_model, v_name: first_truthy(v_model, v_name),
        "c_session": lambda v_session, c_id: F.coalesce(first_truthy(v_session), c_id),
        "t_start": lambda v_start: iso_text(v_start),
        "t_end": lambda v_end: iso_text(v_end),
        # A message that is empty leaves the generation itself as the message.
        "c_message": lambda v_message, v_generation: F.when(
            is_filled_object(v_message) | (~is_object(v_message) & is_truthy(v_message)), v_message
        ).otherwise(v_generation),
    }
    values = {
        "message_tools": lambda c_message: tools.tool_entries(at(c_message, "$.tool_calls")),
        "blocks": lambda c_message: tools.tool_use_blocks(at(c_message, "$.content")),
        "functions": lambda v_functions: tools.tool_entries(v_functions),
        "session_id": lambda c_session, v_start: ids.session_id(
            c_session, ids.orphan_id("langsmith", (v_start, "0"))
        ),
        "model": lambda c_model: F.coalesce(display_text(c_model), F.lit("unknown")),
        "timestamp": lambda t_start: _time_or(t_start, ingest_time),
        "end_time": lambda t_end: parse_iso(t_end),
    }
    last = {
        "provider": lambda v_type, model: models.provider_from_client_type(v_type, model),
        "method": lambda: F.lit("messages.create"),
        "prompt_tokens": lambda v_prompt_tokens, v_completion_tokens, c_prompt: usage.run_tokens(
            v_prompt_tokens, v_completion_tokens, v_prompt_tokens, c_prompt
        ),
        "completion_tokens": lambda v_prompt_tokens, v_completion_tokens, c_completion: usage.run_tokens(
            v_prompt_tokens, v_completion_tokens, v_completion_tokens, c_completion
        ),
        "latency_ms": lambda timestamp, end_time: elapsed_ms(timestamp, end_time),
        "request_hash": lambda session_id, c_id: ids.derived_request_hash(session_id, c_id),
        "tool_calls": lambda message_tools, blocks, functions: tools.run_tool_calls(
            message_tools, blocks, functions
        ),
        "user_facing_output": lambda: F.lit(True),
        "raw_request": lambda v_messages, v_input: requests.langsmith_request(v_messages, v_input),
        "raw_response_meta": lambda: F.expr(NO_META),
    }
    return derived(kept, [fields, chosen, picked, values, last], wanted)


CANDIDATES = {
    "helicone": helicone_candidates,
    "langfuse": langfuse_candidates,
    "langsmith": langsmith_candidates,
}


def normalize_records(
    records: DataFrame, provider: str, ingest_time: datetime, columns: Sequence[str] | None = None
) -> DataFrame:
    """Candidate calls of one provider's records; rejected records carry no session.

    ``columns`` are those of ``candidate_columns`` that will be read, by default all. Nothing else is
    derived but the ``skip_reason``, which tells calls from rejects.
    """
    known = candidate_columns()
    asked = set(known if columns is None else columns) | {"skip_reason"}
    if unknown := asked - set(known):
        raise ValueError(f"no such columns of a candidate call: {sorted(unknown)}")
    found = CANDIDATES[provider](records, ingest_time, [*asked, "page_idx"])
    unplaced = F.when(F.col("page_idx").isNull(), F.lit("page_without_ordinal"))
    found = found.withColumn("skip_reason", F.coalesce(unplaced, "skip_reason"))
    if "session_id" in asked:
        no_session = F.coalesce(
            F.col("skip_reason").isin("record_not_an_object", "page_without_ordinal"), F.lit(False)
        )
        found = found.withColumn("session_id", F.when(~no_session, F.col("session_id")))
    return evaluated_once(found.select(*(name for name in known if name in asked)))


def _present(candidates: DataFrame, layout: str) -> list[str]:
    return [name for name in column_names(layout) if name in candidates.columns]


def calls_of(candidates: DataFrame) -> DataFrame:
    """The calls among the candidates, with those columns that were asked for."""
    return candidates.filter("skip_reason IS NULL").select(*_present(candidates, CALLS))


def rejected_of(candidates: DataFrame) -> DataFrame:
    return candidates.filter("skip_reason IS NOT NULL").select(*_present(candidates, REJECTED))
