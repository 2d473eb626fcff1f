import json
import random
from decimal import Decimal

import pyarrow as pa
import pytest
from helpers import INGEST, calls_frame, pages_of, utc

from tracewaste.operators.catalog import synthetic_catalog
from tracewaste.operators.normalize import calls_of, normalize_records
from tracewaste.operators.rules import RULES
from tracewaste.plans.replay import replay
from tracewaste.sources.pages import parse_pages, unwrap_records
from tracewaste.streaming.imports import (
    stream_candidates,
    stream_page_files,
    stream_page_table,
    write_candidates,
)
from tracewaste.streaming import replay as streamed
from tracewaste.streaming.replay import StreamingRule


def records(page):
    return [
        {"request_id": f"r{page}-{i}", "provider": "openai", "model": "gpt-5",
         "prompt_tokens": i if i % 3 else "bad", "created_at": "2026-04-09T12:00:00Z"}
        for i in range(5)
    ]


def test_streamed_pages_give_the_batch_candidates(spark, tmp_path):
    files = tmp_path / "pages"
    files.mkdir()
    for page in range(4):
        (files / f"p{page}.json").write_text(json.dumps(records(page)))
    out = str(tmp_path / "out")
    stream = stream_candidates(stream_page_files(spark, str(files)), "helicone", INGEST)
    write_candidates(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
    batch = normalize_records(
        unwrap_records(
            parse_pages(pages_of(spark, *[records(p) for p in range(4)]), "helicone"), "helicone"
        ),
        "helicone",
        INGEST,
    )
    columns = ["src_seq", "session_id", "prompt_tokens", "skip_reason"]
    got = spark.read.parquet(out).select(*columns).orderBy("src_seq").collect()
    assert got == batch.select(*columns).orderBy("src_seq").collect()
    assert calls_of(spark.read.parquet(out)).count() == 4 * 3

    # Pages that land later are the only ones read again.
    (files / "p4.json").write_text(json.dumps(records(4)))
    stream = stream_candidates(stream_page_files(spark, str(files)), "helicone", INGEST)
    write_candidates(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(out).count() == 25


def test_page_tables_stream_too(spark, tmp_path):
    table = str(tmp_path / "table")
    pages_of(spark, records(0), records(1)).write.parquet(table)
    out = str(tmp_path / "out")
    stream = stream_candidates(stream_page_table(spark, table), "helicone", INGEST)
    write_candidates(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(out).count() == 10


def random_rows(seed, n):
    # The first mark is 1970, and what is not after it is late.
    rng, at = random.Random(seed), 10**9
    rows = []
    for i in range(n):
        at += rng.choice([0, 0, 1, 2_000_000, 9_000_000, 30_000_000])
        rows.append(
            {
                "src_seq": i,
                "at": at / 10**6,
                "session_id": f"s{rng.randrange(2)}",
                "request_hash": f"h{rng.randrange(2)}",
                "tools": [{"name": "t", "arguments": {"q": rng.randrange(2)}}],
                "user_facing": rng.random() < 0.05,
                "prompt_tokens": rng.randrange(1, 900),
            }
        )
    return rows


def as_set(events):
    return {
        (e["type"], e["session_id"], e["raised_at"], e["src_seq"], e["estimated_burn"],
         e["evidence"]["call_count"].toPython())
        for e in events.collect()
    }


WINDOWED = ("tool_loop", "retry_storm")
#: A call of its own session long after all others moves the mark past them.
LAST = {"at": 10**6, "session_id": "last", "request_hash": "last", "src_seq": 10**6,
        "tools": [{"name": "last", "arguments": {}}]}


class Landing:
    """A folder of calls read as a stream, one file a batch, and the rules over it."""

    def __init__(self, spark, folder, delay, config=None, ingest_time=None):
        self.spark, self.source = spark, str(folder / "calls")
        spark.conf.set("spark.sql.shuffle.partitions", 2)
        calls_frame(spark, [LAST]).limit(0).write.parquet(self.source)
        self.rules = [
            StreamingRule(RULES[name], str(folder), synthetic_catalog(spark), "demo", delay, config or {}, ingest_time)
            for name in WINDOWED
        ]

    def land(self, rows):
        calls_frame(self.spark, rows).coalesce(1).write.mode("append").parquet(self.source)

    def run(self):
        schema = self.spark.read.parquet(self.source).schema
        calls = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.source)
        for rule in self.rules:
            rule.start(calls).awaitTermination()

    def calls(self):
        return self.spark.read.parquet(self.source)

    def union(self, method, *args):
        first, second = (getattr(rule, method)(*args) for rule in self.rules)
        return first.unionByName(second)


@pytest.mark.parametrize("mode", ["session", "none"])
def test_stream_equals_batch(spark, tmp_path, mode):
    rows = random_rows(len(mode), 160)
    config = {"dedup": mode}
    landing = Landing(spark, tmp_path, 20, config)
    # Arrivals are out of order, but never by more than the allowed delay.
    rng = random.Random(5)
    arrival = sorted(rows, key=lambda r: r["at"] + rng.random() * 19)
    for part in range(2):
        landing.land(arrival[part * 80 : part * 80 + 80])
        landing.run()
    windowed = {k: RULES[k] for k in WINDOWED}
    batch = replay(calls_frame(spark, rows), synthetic_catalog(spark), "demo", config, windowed)
    want = as_set(batch)
    # Before the end some calls wait; the batch rules over the written calls add what they would fire.
    assert want and as_set(landing.union("corrected_events", landing.calls())) == want
    landing.land([LAST])
    landing.run()
    assert as_set(landing.union("events", spark)) == want
    assert all(rule.corrections(landing.calls()).isEmpty() for rule in landing.rules)


def test_late_calls_are_corrected_from_the_written_calls(spark, tmp_path):
    rows = random_rows(3, 120)
    landing = Landing(spark, tmp_path, 0, {"dedup": "none"})
    early, late = [r for i, r in enumerate(rows) if i % 5], [r for i, r in enumerate(rows) if i % 5 == 0]
    for part in (early, [LAST], late):
        landing.land(part)
        landing.run()
    storm = landing.rules[1]
    changes = {r["change"] for r in storm.corrections(landing.calls()).collect()}
    assert changes == {"add", "drop"}
    windowed = {k: RULES[k] for k in WINDOWED}
    everything = calls_frame(spark, [*rows, LAST])
    want = as_set(replay(everything, synthetic_catalog(spark), "demo", {"dedup": "none"}, windowed))
    assert as_set(landing.union("corrected_events", landing.calls())) == want
    assert as_set(landing.union("events", spark)) != want


def test_state_is_bounded_by_the_slices_ahead_of_the_mark(spark, tmp_path):
    landing = Landing(spark, tmp_path, 0)
    for start in (1_000, 10_000, 20_000):
        landing.land([{"at": start + i, "request_hash": "r", "src_seq": start + i} for i in range(50)])
        landing.run()
    landing.land([LAST])
    storm = landing.rules[1]
    calls = spark.readStream.schema(landing.calls().schema).parquet(landing.source)
    query = storm.start(calls)
    query.awaitTermination()
    rows = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    assert rows and storm.firings(spark).count() == 3 * 48
    left = spark.read.format("statestore").option("stateVarName", "rows").load(f"{tmp_path}/checkpoint-retry_storm")
    assert left.count() <= 1


def test_calls_without_a_time_do_not_move_the_mark(spark, tmp_path):
    landing = Landing(spark, tmp_path, 0, {"tool_loop.min_calls": 99}, ingest_time=utc(1970, 1, 3))
    untimed = {"at": 2 * 86_400, "request_hash": "x", "src_seq": 7}
    landing.land([{"at": 100, "request_hash": "r", "src_seq": 0}, untimed])
    landing.run()
    landing.land([{"at": 100 + i, "request_hash": "r", "src_seq": i} for i in (1, 2)])
    landing.land([LAST])
    landing.run()
    assert [e["src_seq"] for e in landing.union("events", spark).collect()] == [2]


def test_edges_need_the_whole_history(spark, tmp_path):
    with pytest.raises(ValueError, match="stream"):
        StreamingRule(RULES["tool_loop"], str(tmp_path), synthetic_catalog(spark), "demo", 0, {"dedup": "edge"})


def test_state_grows_by_parts_of_the_keys_not_by_keys(spark, tmp_path, monkeypatch):
    """Three calls of each of 400 keys in one slice: a state call and a timer for each key took all the time."""
    monkeypatch.setattr(streamed, "BUCKETS", 8)
    rows = [{"at": 1_000 + i / 50, "request_hash": f"h{i % 400}", "src_seq": i} for i in range(1_200)]
    landing = Landing(spark, tmp_path, 0)
    landing.land(rows)
    landing.run()
    held = spark.read.format("statestore").option("stateVarName", "rows").load(f"{tmp_path}/checkpoint-retry_storm")
    assert 0 < held.count() <= 8 * 2
    landing.land([LAST])
    landing.run()
    windowed = {k: RULES[k] for k in WINDOWED}
    want = as_set(replay(calls_frame(spark, rows), synthetic_catalog(spark), "demo", {}, windowed))
    assert len(want) == 400 and as_set(landing.union("events", spark)) == want


def test_windows_of_many_keys_against_a_loop():
    rng = random.Random(8)
    span, wide = 20, 10**30
    rows = [
        {"session_id": rng.choice(["a", "b", None]), "request_hash": rng.choice(["x", None]),
         "at_us": rng.randrange(-60, 60), "seq": Decimal(rng.choice([-wide, 0, wide]) + i),
         "cost_nanos": rng.choice([None, 0, rng.randrange(10**17)]), "flag": rng.randrange(2), "own": True}
        for i in range(300)
    ]
    keys = ["session_id", "request_hash"]
    for some in (rows, rows[:1], [{**r, "cost_nanos": None} for r in rows[:40]]):
        got = streamed.window_measures(pa.Table.from_pylist(some, streamed.stored_schema(keys)), keys, span)
        want = {}
        for r in some:
            window = sorted(
                (q["at_us"], q["seq"], q["flag"], q["cost_nanos"])
                for q in some
                if [q[k] for k in keys] == [r[k] for k in keys]
                and r["at_us"] - span <= q["at_us"]
                and (q["at_us"], q["seq"]) <= (r["at_us"], r["seq"])
            )
            costs = [q[3] for q in window if q[3] is not None]
            want[r["seq"]] = (len(window), sum(costs) if costs else None, sum(q[2] for q in window), costs[0] if costs else None)
        assert {r["seq"]: tuple(r[m] for m in streamed.MEASURES) for r in got.to_pylist()} == want


def test_calls_without_a_cost_stay(spark, tmp_path):
    """A null cost ended the stream with an error; it adds nothing, and such calls still count."""
    landing = Landing(spark, tmp_path, 0)
    tokens = [None, 1_000, None, 500]
    landing.land([{"at": 1_000 + i, "request_hash": "r", "src_seq": i, "prompt_tokens": n, "completion_tokens": n and 0} for i, n in enumerate(tokens)])
    landing.land([{"at": 5_000 + i, "request_hash": "r", "src_seq": 10 + i, "prompt_tokens": None} for i in range(3)])
    landing.land([LAST])
    landing.run()
    found = {r["seq"]: (r["n_window"], r["cost_window"], r["first_cost"]) for r in landing.rules[1].firings(spark).collect()}
    one = 10_000 * 1_000
    assert found == {2: (3, one, one), 3: (4, one + one // 2, one), 12: (3, None, None)}
