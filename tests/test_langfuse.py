from helpers import INGEST, call_rows, pages_of, reject_rows, utc

from tracewaste import analyze_langfuse
from tracewaste.sources.pages import page_ledger, parse_pages, unwrap_records
from tracewaste.sources.windows import within_bounds


def observation(**changes):
    base = {
        "id": "obs_tr_1",
        "type": "GENERATION",
        "model": "claude-sonnet-4-6",
        "startTime": "2026-04-09T12:00:00Z",
        "endTime": "2026-04-09T12:00:01Z",
        "usage": {"unit": "TOKENS", "input": 80, "output": 12},
        "output": {"content": []},
    }
    return {k: v for k, v in {**base, **changes}.items() if v is not Ellipsis}


def trace(*observations, **changes):
    base = {
        "id": "tr_1",
        "sessionId": "sess_a",
        "timestamp": "2026-04-09T12:00:00Z",
        "observations": list(observations),
    }
    return {k: v for k, v in {**base, **changes}.items() if v is not Ellipsis}


def many(spark, changes):
    return call_rows(spark, "langfuse", trace(*[observation(**c) for c in changes]))


def field(spark, name, cases):
    got = [c[name] for c in many(spark, [c for c, _ in cases])]
    assert got == [expected for _, expected in cases]


def test_empty_source(spark):
    body = {"data": [], "meta": {"totalItems": 0, "totalPages": 0, "page": 1, "limit": 100}}
    summary = analyze_langfuse(spark, pages_of(spark, body, first=1), "demo", dry_run=True)
    row = summary.summary.first()
    assert row["fetched_traces"] == row["inferred_sessions"] == row["fired_events"] == 0
    assert row["pages_fetched"] == 0 and row["burn_by_type"] == {}


def test_one_generation(spark):
    body = {"data": [trace(observation())], "meta": {"totalPages": 1}}
    result = analyze_langfuse(spark, pages_of(spark, body, first=1), "demo", dry_run=True)
    row = result.summary.first()
    assert (row["fetched_traces"], row["inferred_sessions"], row["pages_fetched"]) == (1, 1, 1)
    call = result.calls.first()
    assert call["provider"] == "anthropic" and call["method"] == "messages.create"
    assert call["latency_ms"] == 1000.0
    assert call["request_hash"] == "bfc0f5af3b8c5712"
    assert (call["prompt_tokens"], call["completion_tokens"]) == (80, 12)
    assert call["user_facing_output"] is True and call["tool_calls"] == []
    assert call["timestamp"].isoformat() == "2026-04-09T12:00:00"


def test_only_generations_become_calls(spark):
    rows = call_rows(
        spark,
        "langfuse",
        trace(
            observation(id="a", type="generation"),
            observation(id="b", type="SPAN"),
            observation(id="c", type="EVENT"),
            observation(id="d", type=...),
            observation(id="e", type=5),
            observation(id="f"),
        ),
        trace(observation(type="SPAN"), sessionId="no_calls"),
    )
    assert [int(r["src_seq"]) % 2**31 for r in rows] == [0, 5]
    assert {r["session_id"] for r in rows} == {"sess_a"}


def test_page_shapes_and_ledger(spark):
    bodies = [
        {"data": [1, 2], "meta": {"totalPages": 9}},
        {"data": [1, 2], "meta": {"totalPages": "2"}},
        {"data": [1, 2], "meta": []},
        {"data": {"a": 1}},
        [1, 2],
        {"data": None},
        {"data": [1], "meta": {}},
    ]
    parsed = parse_pages(pages_of(spark, *bodies, first=1), "langfuse")
    ledger = page_ledger(parsed, "langfuse", page_size=2).orderBy("page_idx").collect()
    assert [r["n_rows"] for r in ledger] == [2, 2, 2, 0, 0, 0, 1]
    assert [r["is_stop"] for r in ledger] == [False, True, False, True, True, True, True]


def test_quarantine(spark):
    rows = reject_rows(
        spark,
        "langfuse",
        5,
        trace(observations="text"),
        trace(observations={"a": 1}),
        trace(observations=None),
        trace(observations=""),
        trace(7, None, "x", observation()),
    )
    assert [r["skip_reason"] for r in rows] == [
        "record_not_an_object",
        "observations_not_a_list",
        "observations_not_a_list",
        "observation_not_an_object",
        "observation_not_an_object",
        "observation_not_an_object",
    ]
    assert rows[0]["session_id"] is None and rows[1]["session_id"] == "sess_a"


def test_session_ids(spark):
    rows = call_rows(
        spark,
        "langfuse",
        trace(observation()),
        trace(observation(), sessionId=None),
        trace(observation(), sessionId="", id=12),
        trace(observation(), sessionId=..., id=...),
        trace(observation(), sessionId=..., id="", timestamp=...),
        trace(observation(), sessionId=..., id="", timestamp=None),
    )
    assert [r["session_id"] for r in rows] == [
        "sess_a",
        "tr_1",
        "12",
        "langfuse-orphan-2026-04-09T12:00:00Z",
        "langfuse-orphan-0",
        "langfuse-orphan-None",
    ]


def test_request_hash(spark):
    field(
        spark,
        "request_hash",
        [
            ({}, "bfc0f5af3b8c5712"),
            ({"id": ...}, "cf622a0a2df92e21"),
            ({"id": None}, "cf622a0a2df92e21"),
            ({"id": ""}, "cf622a0a2df92e21"),
        ],
    )


def test_provider(spark):
    field(
        spark,
        "provider",
        [
            ({"model": "Claude-3"}, "anthropic"),
            ({"model": "gpt-4o"}, "openai"),
            ({"model": "o1-mini"}, "openai"),
            ({"model": "o3"}, "openai"),
            ({"model": "gemini-o4"}, "openai"),
            ({"model": "gemini-pro"}, "google"),
            ({"model": "mixtral-8x7b"}, "mistral"),
            ({"model": "mistral-large"}, "mistral"),
            ({"model": "llama-3"}, "meta"),
            ({"model": "own"}, "unknown"),
            ({"model": "own", "modelParameters": {"provider": "Bedrock"}}, "bedrock"),
            ({"model": "own", "modelParameters": {"provider": ""}}, "unknown"),
            ({"model": "own", "modelParameters": {"provider": 5}}, "unknown"),
            ({"model": "own", "modelParameters": "x"}, "unknown"),
            ({"model": "gpt-5", "modelParameters": {"provider": "Azure"}}, "openai"),
        ],
    )


def test_model(spark):
    field(
        spark,
        "model",
        [({}, "claude-sonnet-4-6"), ({"model": ""}, "unknown"), ({"model": None}, "unknown"),
         ({"model": ...}, "unknown")],
    )


def test_usage(spark):
    cases = [
        ({"unit": "tokens", "input": 1, "output": 2}, (1, 2)),
        ({"unit": "", "input": 1, "output": 2}, (1, 2)),
        ({"input": 1, "output": 2}, (1, 2)),
        ({"unit": "CHARACTERS", "input": 1, "output": 2}, (0, 0)),
        ({"unit": None, "input": 1, "output": 2}, (0, 0)),
        ({"input": "12", "output": "1.5"}, (12, 0)),
        ({"input": 1.9, "output": True}, (1, 1)),
        ({"input": [1], "output": {"a": 1}}, (0, 0)),
        ("text", (0, 0)),
        (None, (0, 0)),
    ]
    rows = many(spark, [{"usage": u} for u, _ in cases])
    assert [(r["prompt_tokens"], r["completion_tokens"]) for r in rows] == [e for _, e in cases]


def test_latency(spark):
    field(
        spark,
        "latency_ms",
        [
            ({"endTime": "2026-04-09T12:00:00.1234Z"}, 0.1234 * 1000.0),
            ({"endTime": "2026-04-09T11:00:00Z"}, 0.0),
            ({"endTime": ...}, 0.0),
            ({"startTime": ...}, 0.0),
        ],
    )


def test_tool_calls(spark):
    use = {"type": "tool_use", "name": "search", "input": {"b": 1, "a": [2]}}
    function = {"function": {"name": "search", "arguments": '{"q": 1}'}}
    cases = [
        ({"content": [use, {"type": "text"}, 5]}, [("search", '{"a":[2],"b":1}')]),
        ({"content": [{"type": "tool_use"}]}, [("", "{}")]),
        ({"content": [{"type": "tool_use", "name": None, "input": []}]}, [("None", "{}")]),
        ({"content": [{"type": "text"}], "tool_calls": [function]},
         [("search", '"{\\"q\\": 1}"')]),
        ({"tool_calls": [7, {"function": "x"}, {}]}, [("", "{}"), ("", "{}")]),
        ({"tool_calls": [], "function_call": {"name": "f", "arguments": {"x": 1}}},
         [("f", '{"x":1}')]),
        ({"function_call": "x"}, []),
        ({"content": "text"}, []),
        ([use], []),
        ("text", []),
        (None, []),
    ]
    rows = many(spark, [{"output": o} for o, _ in cases])
    got = [[(t["name"], t["arguments"]) for t in r["tool_calls"]] for r in rows]
    assert got == [e for _, e in cases]


def test_raw_request(spark):
    wrapped = '[{"content":"hi","role":"user"}]'
    cases = [
        ({"input": [1]}, "[1]", None),
        ({"input": {"messages": [2], "input": "e"}}, "[2]", '"e"'),
        ({"input": {"messages": "x", "input": None}}, None, "null"),
        ({"input": "hi"}, wrapped, None),
        ({"input": ""}, None, None),
        ({}, None, None),
    ]
    rows = many(spark, [c for c, _, _ in cases])
    assert [(r["messages"], r["input"]) for r in rows] == [(m, i) for _, m, i in cases]


def test_trace_input_is_the_second_choice(spark):
    rows = call_rows(
        spark,
        "langfuse",
        trace(observation(input=""), input="hi"),
        trace(observation(), input=[3]),
        trace(observation(), input={"messages": [1]}),
        trace(observation(input=[1]), input=[3]),
        trace(observation(input={"input": "e"}), input="hi"),
    )
    wrapped = '[{"content":"hi","role":"user"}]'
    assert [r["messages"] for r in rows] == [wrapped, "[3]", None, "[1]", wrapped]
    assert rows[4]["input"] == '"e"'


def test_window_is_half_open_in_whole_seconds(spark):
    times = [
        "2026-04-08T23:59:59.999Z", "2026-04-09T00:00:00Z", "2026-04-09T23:59:59.999Z",
        "2026-04-10T00:00:00Z", "soon",
    ]
    body = {"data": [trace(observation(), id=str(i), timestamp=t) for i, t in enumerate(times)]}
    records = unwrap_records(parse_pages(pages_of(spark, body), "langfuse"), "langfuse")
    kept = within_bounds(
        records, "langfuse", utc(2026, 4, 9, 0, 0, 0, 900_000), utc(2026, 4, 10, 0, 0, 0, 5)
    )
    got = kept.selectExpr("try_variant_get(rec, '$.id', 'string') AS id").orderBy("id").collect()
    assert [r["id"] for r in got] == ["1", "2"]
    assert INGEST.tzinfo is not None
