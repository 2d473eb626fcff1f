import json
import random

import oracle
import pytest
from helpers import calls_frame
from pyspark.sql import functions as F

from tracewaste.operators.catalog import price_table, synthetic_catalog, with_cost
from tracewaste.operators.rules import RULES, RuleContext
from tracewaste.plans.replay import replay
from tracewaste.schemas import EVENTS, column_names

SECONDS = {"tool_loop": 60, "retry_storm": 30}


def fire(spark, rule, calls, **config):
    prices = price_table(synthetic_catalog(spark))
    context = RuleContext("demo", {k.replace("__", "."): v for k, v in config.items()})
    events = RULES[rule](calls, prices, context)
    assert events.columns == column_names(EVENTS)
    return events.orderBy("session_id", "raised_at", "src_seq").collect()


def search(query="x"):
    return [{"name": "web_search", "arguments": {"query": query}}]


def test_five_equal_tool_calls(spark):
    calls = calls_frame(spark, [{"at": 100 + 5 * i, "tools": search()} for i in range(5)])
    (event,) = fire(spark, "tool_loop", calls)
    assert {k: v.toPython() for k, v in event["evidence"].items()} == {"tool": "web_search", "call_count": 4}
    assert (event["rule"], event["confidence"]) == ("v0.tool_loop", 0.85)
    assert event["suggested_action"] == "pause_for_human_review"
    assert event["raised_at"].timestamp() == 115 and event["src_seq"] == 3
    # Three calls beyond the first, 1000 tokens in and 100 out of the frontier model each.
    assert float(event["estimated_burn"]) == pytest.approx(3 * 0.013)
    assert event["project"] == "demo" and event["sdk_version"] == "0.5.0"


def test_tool_loop_needs_equal_arguments_and_one_session(spark):
    rows = [{"at": i, "tools": search(str(i))} for i in range(6)]
    rows += [{"at": i, "session_id": f"s{i}", "tools": search()} for i in range(6)]
    assert fire(spark, "tool_loop", calls_frame(spark, rows)) == []


def test_tool_loop_counts_a_call_once(spark):
    calls = calls_frame(spark, [{"at": i, "tools": search() * 5} for i in range(3)])
    assert fire(spark, "tool_loop", calls) == []
    assert len(fire(spark, "tool_loop", calls, tool_loop__min_calls=3)) == 1


@pytest.mark.parametrize("last, fires", [(60, 1), (60.000001, 0), (59.999999, 1)])
def test_window_border(spark, last, fires):
    rows = [{"at": t, "tools": search()} for t in (0, 1, 2, last)]
    rows += [{"at": 0, "request_hash": "r"}, {"at": 1, "request_hash": "r"},
             {"at": last - 30, "request_hash": "r"}]
    calls = calls_frame(spark, rows)
    assert len(fire(spark, "tool_loop", calls)) == fires
    assert len(fire(spark, "retry_storm", calls)) == fires


def test_user_facing_calls_silence_the_loop(spark):
    rows = [{"at": i, "tools": search(), "user_facing": True} for i in range(5)]
    calls = calls_frame(spark, rows)
    assert fire(spark, "tool_loop", calls) == []
    assert len(fire(spark, "tool_loop", calls, tool_loop__respect_user_facing=False)) == 1


def random_calls(seed, n):
    rng, at = random.Random(seed), 0
    rows = []
    for i in range(n):
        at += rng.choice([0, 0, 1, 10**6, 3 * 10**6, 30 * 10**6, 30 * 10**6 + 1, 60 * 10**6])
        rows.append(
            {
                "src_seq": i,
                "at": at / 10**6,
                "at_us": at,
                "session_id": f"s{rng.randrange(2)}",
                "request_hash": f"h{rng.randrange(3)}",
                "tools": search(str(rng.randrange(2))) if rng.random() < 0.8 else [],
                "user_facing": rng.random() < 0.05,
                "prompt_tokens": rng.randrange(1, 5000),
                "completion_tokens": rng.randrange(1, 500),
            }
        )
    return rows


@pytest.mark.parametrize("rule", ["tool_loop", "retry_storm"])
@pytest.mark.parametrize("mode, hot_rows", [("session", 10**9), ("none", 50), ("edge", 10**9)])
def test_windowed_rules_match_a_sequential_replay(spark, rule, mode, hot_rows):
    rows = random_calls(len(rule) * 7 + len(mode), 400)
    got = fire(
        spark, rule, calls_frame(spark, rows).repartition(7), dedup=mode, hot_rows=hot_rows
    )
    flat = [
        {
            "at": r["at_us"],
            "seq": r["src_seq"],
            "session": r["session_id"],
            "key": json.dumps(r["tools"]) if rule == "tool_loop" else r["request_hash"],
            "cost": r["prompt_tokens"] * 10_000 + r["completion_tokens"] * 30_000,
            "flag": rule == "tool_loop" and r["user_facing"],
        }
        for r in rows
        if rule == "retry_storm" or r["tools"]
    ]
    want = [
        (row["session"], row["at"], row["seq"], count, oracle.dollars(burn))
        for group in oracle.by_key(flat, lambda r: (r["session"], r["key"])).values()
        for row, count, burn in oracle.firings(
            group,
            SECONDS[rule] * oracle.SECOND,
            {"tool_loop": 4, "retry_storm": 3}[rule],
            mode,
            suppressed=True,
        )
    ]
    seen = [
        (
            e["session_id"],
            round(e["raised_at"].timestamp() * 10**6),
            e["src_seq"],
            e["evidence"]["call_count"].toPython(),
            e["estimated_burn"],
        )
        for e in got
    ]
    assert want and sorted(seen) == sorted(want)


def test_unknown_mode_is_an_error(spark):
    with pytest.raises(ValueError, match="dedup mode"):
        fire(spark, "tool_loop", calls_frame(spark, [{"at": 0}]), dedup="sometimes")


def said(text):
    return [{"role": "user", "content": text}]


def test_model_misroute(spark):
    small = {"at": 1, "prompt_tokens": 40, "completion_tokens": 5}
    wanted = "Please classify this sentence as positive or negative."
    rows = [
        {**small, "messages": said(wanted)},
        {**small, "messages": said(wanted.upper()), "at": 2},
        {**small, "messages": said("Write a poem")},
        {**small, "messages": said(wanted), "model": "gpt-5-mini"},
        {**small, "messages": said(wanted), "model": "unheard-of"},
        {**small, "messages": said(wanted), "prompt_tokens": 201},
        {**small, "messages": said(wanted), "completion_tokens": 21},
        {**small, "messages": []},
        small,
    ]
    events = fire(spark, "model_misroute", calls_frame(spark, rows))
    assert [e["src_seq"] for e in events] == [0, 1]
    assert {k: v.toPython() for k, v in events[0]["evidence"].items()} == {
        "model": "gpt-5", "recommended_alternative": "gpt-5-mini"
    }
    saved = 40 * (10_000 - 400) + 5 * (30_000 - 1_600)
    assert events[0]["estimated_burn"] == oracle.dollars(saved)


def embed(at, given, **more):
    return {
        "at": at,
        "input": given,
        "model": "text-embedding-3-small",
        "method": "embeddings.create",
        "prompt_tokens": 1000,
        "completion_tokens": 0,
        **more,
    }


def test_embedding_waste(spark):
    rows = [
        embed(1, ["a", "b"]),
        embed(2, "a"),
        embed(3, "a"),
        embed(4, ["b", "c", "c", "d"]),
        embed(5, "a", session_id="s2"),
        embed(6, {"k": 1}),
        embed(7, {"k": 1}),
        embed(8, None),
        embed(9, None),
        embed(10, [], session_id="s3"),
        {**embed(11, "a"), "method": "messages.create"},
    ]
    calls = calls_frame(spark, rows)
    events = fire(spark, "embedding_waste", calls)
    # One event per repeated element, at its second occurrence.
    assert sorted(e["src_seq"] for e in events) == [1, 3, 3, 6]
    burns = sorted(e["estimated_burn"] for e in events)
    assert burns == sorted(oracle.dollars(n) for n in (20_000, 5_000, 5_000, 20_000))
    every = fire(spark, "embedding_waste", calls, dedup="none")
    assert sorted(e["src_seq"] for e in every) == [1, 2, 3, 3, 6]


def test_custom_rules_join_the_replay(spark):
    def slow(calls, prices, context):
        events = RULES["retry_storm"](calls, prices, context)
        return events.withColumn("type", F.lit("own"))

    calls = calls_frame(spark, [{"at": i, "request_hash": "r"} for i in range(3)])
    events = replay(
        calls, synthetic_catalog(spark), "demo", rules={**RULES, "own": slow}
    )
    assert sorted(e["type"] for e in events.collect()) == ["own", "retry_storm"]
    with pytest.raises(ValueError):
        replay(calls, synthetic_catalog(spark), "demo", rules={})


def test_costs(spark):
    prices = price_table(synthetic_catalog(spark))
    rows = [{"at": 0}, {"at": 0, "model": "unheard-of"}]
    priced = with_cost(calls_frame(spark, rows), prices).orderBy("src_seq").collect()
    assert [r["cost_nanos"] for r in priced] == [13_000_000, 0]


def test_a_catalog_naming_a_model_twice_is_an_error(spark):
    twice = synthetic_catalog(spark).unionAll(synthetic_catalog(spark))
    with pytest.raises(ValueError, match="twice"):
        price_table(twice)


def test_small_catalogs_are_broadcast_and_large_ones_are_not(spark):
    calls = calls_frame(spark, [{"at": 0}])
    catalog = synthetic_catalog(spark)

    def hints(prices):
        plan = with_cost(calls, prices)._jdf.queryExecution().analyzed().toString()
        return "strategy=broadcast" in plan

    assert hints(price_table(catalog))
    assert not hints(price_table(catalog, max_rows=2))
