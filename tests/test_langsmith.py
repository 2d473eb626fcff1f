from helpers import call_rows, pages_of, reject_rows

from tracewaste import analyze_langsmith
from tracewaste.sources.pages import page_ledger, parse_pages, unwrap_records
from tracewaste.sources.windows import top_level_runs


def run(**changes):
    base = {
        "id": "run_1",
        "run_type": "llm",
        "session_id": "sess_a",
        "name": "ChatOpenAI",
        "start_time": "2026-04-09T12:00:00Z",
        "end_time": "2026-04-09T12:00:00.5Z",
        "prompt_tokens": 30,
        "completion_tokens": 4,
        "extra": {"invocation_params": {"model": "gpt-5", "_type": "openai-chat"}},
        "outputs": {"generations": [[{"message": {"content": "plain text"}}]]},
    }
    return {k: v for k, v in {**base, **changes}.items() if v is not Ellipsis}


def many(spark, changes):
    return call_rows(spark, "langsmith", *[run(**c) for c in changes])


def field(spark, name, cases):
    got = [c[name] for c in many(spark, [c for c, _ in cases])]
    assert got == [expected for _, expected in cases]


def test_empty_source(spark):
    body = {"runs": [], "cursors": {"next": None}}
    row = analyze_langsmith(spark, pages_of(spark, body), "demo", dry_run=True).summary.first()
    assert row["fetched_traces"] == row["inferred_sessions"] == row["pages_fetched"] == 0


def test_only_llm_runs_become_calls(spark):
    runs = [run(id="1"), run(id="2", run_type="chain", session_id="sess_b"),
            run(id="3", run_type="LLM")]
    body = {"runs": runs, "cursors": {"next": None}}
    result = analyze_langsmith(spark, pages_of(spark, body), "demo", dry_run=True)
    row = result.summary.first()
    assert (row["fetched_traces"], row["inferred_sessions"]) == (3, 1)
    assert {c["session_id"] for c in result.calls.collect()} == {"sess_a"}


def test_cursor_pages(spark):
    bodies = [
        {"runs": [run(id="1")], "cursors": {"next": "abc"}},
        {"runs": [run(id="2")], "cursors": {"next": None}},
        {"runs": [run(id="3")], "cursors": {"next": "late"}},
    ]
    for options, wanted in (({}, (3, 3)), ({"stop_at_last_page": True}, (2, 2))):
        result = analyze_langsmith(spark, pages_of(spark, *bodies), "demo", dry_run=True, **options)
        row = result.summary.first()
        assert (row["fetched_traces"], row["pages_fetched"]) == wanted


def test_ledger_shapes(spark):
    bodies = [
        {"runs": [1], "cursors": {"next": "a"}},
        {"runs": [], "cursors": {"next": "a"}},
        {"runs": [1], "cursors": {"next": ""}},
        {"runs": [1], "cursors": {"next": 5}},
        {"runs": [1], "cursors": "x"},
        {"runs": {"a": 1}},
        [1],
    ]
    parsed = parse_pages(pages_of(spark, *bodies), "langsmith")
    ledger = page_ledger(parsed, "langsmith").orderBy("page_idx").collect()
    assert [r["is_stop"] for r in ledger] == [False] + [True] * 6
    assert [r["n_rows"] for r in ledger] == [1, 0, 1, 1, 1, 0, 0]


def test_call_fields(spark):
    call = many(spark, [{}])[0]
    assert call["provider"] == "openai" and call["model"] == "gpt-5"
    assert call["method"] == "messages.create" and call["user_facing_output"] is True
    assert call["latency_ms"] == 500.0 and call["tool_calls"] == []


def test_quarantine(spark):
    rows = reject_rows(spark, "langsmith", 5, None, "x", [1], run(), run(run_type="tool"))
    assert [r["skip_reason"] for r in rows] == ["record_not_an_object"] * 4


def test_session_ids(spark):
    field(
        spark,
        "session_id",
        [
            ({}, "sess_a"),
            ({"session_id": None}, "run_1"),
            ({"session_id": 0, "id": True}, "True"),
            ({"session_id": "", "id": ...}, "langsmith-orphan-2026-04-09T12:00:00Z"),
            ({"session_id": "", "id": "", "start_time": ...}, "langsmith-orphan-0"),
        ],
    )


def test_model(spark):
    field(
        spark,
        "model",
        [
            ({}, "gpt-5"),
            ({"extra": {"invocation_params": {"model": ""}}}, "ChatOpenAI"),
            ({"extra": "x"}, "ChatOpenAI"),
            ({"extra": ..., "name": None}, "unknown"),
        ],
    )


def test_provider(spark):
    def params(kind, model="own"):
        return {"extra": {"invocation_params": {"_type": kind, "model": model}}}

    field(
        spark,
        "provider",
        [
            (params("anthropic-chat", "gpt-5"), "anthropic"),
            (params("Chat-OpenAI"), "openai"),
            (params("chat-google-vertexai"), "google"),
            (params("vertexai"), "google"),
            (params("chat-mistralai"), "mistral"),
            (params("cohere"), "cohere"),
            (params("together-ai"), "together"),
            (params("my-openai"), "unknown"),
            (params("my-openai", "claude-3"), "anthropic"),
            (params(5, "llama"), "meta"),
            ({"extra": {"invocation_params": {"model": "gemini"}}}, "google"),
        ],
    )


def test_usage(spark):
    def nested(**usage):
        return {
            "prompt_tokens": ...,
            "completion_tokens": None,
            "extra": {"invocation_params": {"usage": usage}},
        }

    cases = [
        ({}, (30, 4)),
        ({"prompt_tokens": None}, (0, 4)),
        ({"prompt_tokens": 0, "completion_tokens": ...,
          "extra": {"invocation_params": {"usage": {"input": 9}}}}, (0, 0)),
        ({"prompt_tokens": "x", "completion_tokens": "7"}, (0, 7)),
        (nested(prompt_tokens=1, completion_tokens=2), (1, 2)),
        (nested(prompt_tokens=0, input_tokens=3, output_tokens=4), (3, 4)),
        (nested(input=5, output="6"), (5, 6)),
        (nested(input="x"), (0, 0)),
        ({"prompt_tokens": ..., "completion_tokens": ...}, (0, 0)),
    ]
    rows = many(spark, [c for c, _ in cases])
    assert [(r["prompt_tokens"], r["completion_tokens"]) for r in rows] == [e for _, e in cases]


def test_tool_calls(spark):
    def generation(message):
        return {"generations": [[{"message": message}]]}

    use = {"type": "tool_use", "name": "w", "input": {"q": 1}}
    cases = [
        (generation({"tool_calls": [{"name": "w", "args": {"b": 1, "a": 2}}]}),
         [("w", '{"a":2,"b":1}')]),
        (generation({"tool_calls": [{"name": "w", "args": {}, "arguments": "s"}, 5]}),
         [("w", '"s"')]),
        (generation({"tool_calls": [], "content": [use, 3]}), [("w", '{"q":1}')]),
        ({"generations": [[{"tool_calls": [{"name": "direct"}]}]]}, [("direct", "{}")]),
        ({"generations": [[{"message": {}, "content": [use]}]]}, [("w", '{"q":1}')]),
        ({"generations": [[{"message": "x", "content": [use]}]]}, []),
        ({"generations": [], "tool_calls": [{"function": {"name": "f", "arguments": "{}"}}]},
         [("f", '"{}"')]),
        ({**generation({"content": "text"}), "tool_calls": [{"function": {"name": "f"}}]},
         [("f", "{}")]),
        ({"function_call": {"name": "f"}}, []),
        ({"generations": [{"message": {"tool_calls": [{"name": "x"}]}}]}, []),
        ([use], []),
        (None, []),
    ]
    rows = many(spark, [{"outputs": o} for o, _ in cases])
    got = [[(t["name"], t["arguments"]) for t in r["tool_calls"]] for r in rows]
    assert got == [e for _, e in cases]


def test_raw_request(spark):
    cases = [
        ({"messages": [1], "input": "x"}, "[1]", None),
        ({"messages": "m", "input": "hi"}, '[{"content":"hi","role":"user"}]', None),
        ({"input": ""}, '[{"content":"","role":"user"}]', None),
        ({"input": ["a", "b"]}, None, '["a","b"]'),
        ({"input": None}, None, "null"),
        ({}, None, None),
        ("text", None, None),
    ]
    rows = many(spark, [{"inputs": i} for i, _, _ in cases])
    assert [(r["messages"], r["input"]) for r in rows] == [(m, i) for _, m, i in cases]


def test_top_level_runs(spark):
    runs = [run(id="1", execution_order=1), run(id="2", execution_order=2), run(id="3")]
    records = unwrap_records(parse_pages(pages_of(spark, {"runs": runs}), "langsmith"), "langsmith")
    assert top_level_runs(records).count() == 2
