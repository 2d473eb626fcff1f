import json
from datetime import datetime
from decimal import Decimal

import pytest
from helpers import INGEST, calls_frame, pages_of, utc
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, VariantVal

from tracewaste import Source, analyze, analyze_many
from tracewaste.functions.times import parse_bound
from tracewaste.operators.chunks import delivery_chunks, wire_json
from tracewaste.operators.rules import RULES
from tracewaste.operators.sessions import session_profile, session_rank
from tracewaste.plans import analyze as analyze_module
from tracewaste.plans.analyze import delivered
from tracewaste.plans.reports import firings_report, savings_report, status_report
from tracewaste.plans.summary import summary_row, totals_by_type
from tracewaste.schemas import EVENTS
from tracewaste.session import ensure_checkpoint_dir
from tracewaste.sources.pages import (
    read_page_files,
    read_page_lines,
    read_page_table,
    sum_responses,
)

COUNTS = {"fetched_traces": 247, "pages_fetched": 3}


def events_frame(spark, rows):
    data = [
        (
            r["type"],
            0.85,
            "demo",
            r.get("session_id", "s1"),
            f"v0.{r['type']}",
            {"tool": VariantVal.parseJson('"web_search"'), "call_count": VariantVal.parseJson("5")},
            Decimal(r.get("burn", "0.1")),
            "pause_for_human_review",
            r.get("raised_at", datetime(2026, 4, 9, 14, 30)),
            Decimal(r.get("src_seq", i)),
            "0.5.0",
        )
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, StructType.fromDDL(EVENTS))


def sample(spark):
    rows = [{"type": "tool_loop", "burn": b} for b in ("0.40", "0.40", "0.03")]
    rows += [{"type": "retry_storm", "burn": "0.21"}]
    rows += [{"type": "model_misroute", "burn": "0.5525"}] * 8
    return events_frame(spark, rows)


def one_row(spark, **values):
    fields = ", ".join(f"{v} AS {k}" for k, v in values.items())
    return spark.sql(f"SELECT {fields}")


def test_summary_and_reports(spark):
    events = sample(spark)
    row = summary_row(events, one_row(spark, inferred_sessions="12L"), COUNTS, True).first()
    assert row["events_by_type"] == {"tool_loop": 3, "retry_storm": 1, "model_misroute": 8}
    assert row["burn_by_type"] == {
        "tool_loop": Decimal("0.83"),
        "retry_storm": Decimal("0.21"),
        "model_misroute": Decimal("4.42"),
    }
    assert row["estimated_burn_total_usd"] == Decimal("5.46")
    assert (row["fetched_traces"], row["inferred_sessions"], row["fired_events"]) == (247, 12, 12)
    assert [tuple(r) for r in savings_report(events).collect()] == [
        ("model_misroute", Decimal("4.42")),
        ("tool_loop", Decimal("0.83")),
        ("retry_storm", Decimal("0.21")),
        ("total", Decimal("5.46")),
    ]
    assert [tuple(r) for r in firings_report(events).collect()] == [
        ("model_misroute", 8), ("retry_storm", 1), ("tool_loop", 3),
    ]


def test_total_is_rounded_once(spark):
    events = events_frame(spark, [{"type": t, "burn": "0.004"} for t in "abc"])
    row = summary_row(events, one_row(spark, inferred_sessions="1L"), COUNTS, True).first()
    assert set(row["burn_by_type"].values()) == {Decimal("0.00")}
    assert row["estimated_burn_total_usd"] == Decimal("0.01")
    assert [tuple(r) for r in savings_report(events).collect()] == [("total", Decimal("0.01"))]
    assert totals_by_type(events).filter("type IS NULL").first()["n"] == 3


def test_others_row_counts_unnamed_types_again(spark):
    events = events_frame(spark, [{"type": t} for t in ("zebra", "own", "own", "tool_loop")])
    assert [tuple(r) for r in firings_report(events).collect()] == [
        ("own", 2), ("tool_loop", 1), ("zebra", 1), ("(others)", 3),
    ]


@pytest.mark.parametrize(
    "rows, fetched, status",
    [([], 0, "no_traces"), ([], 5, "clean"), ([{"type": "tool_loop"}], 5, "leaks")],
)
def test_status(spark, rows, fetched, status):
    counts = {"fetched_traces": fetched, "pages_fetched": 1}
    delivered = one_row(spark, accepted="4L", rejected="1L")
    summary = summary_row(
        events_frame(spark, rows), one_row(spark, inferred_sessions="0L"), counts, False, delivered
    )
    assert status_report(summary).first()["status"] == status
    row = summary.first()
    assert (row["backfill_accepted"], row["backfill_rejected"]) == (4, 1)


def test_wire_format(spark):
    rows = [
        {"type": "tool_loop"},
        {"type": "tool_loop", "raised_at": datetime(2026, 4, 9, 14, 30, 0, 120)},
    ]
    first, second = [
        json.loads(r["wire"])
        for r in wire_json(events_frame(spark, rows)).orderBy("src_seq").collect()
    ]
    assert first == {
        "type": "tool_loop",
        "confidence": 0.85,
        "project": "demo",
        "session_id": "s1",
        "rule": "v0.tool_loop",
        "evidence": {"tool": "web_search", "call_count": 5},
        "estimated_burn": 0.1,
        "suggested_action": "pause_for_human_review",
        "raised_at": "2026-04-09T14:30:00+00:00",
        "sdk_version": "0.5.0",
    }
    assert second["raised_at"] == "2026-04-09T14:30:00.000120+00:00"


@pytest.mark.parametrize("n, sizes", [(0, []), (1, [1]), (50, [50]), (51, [50, 1]), (130, [50, 50, 30])])
def test_chunk_sizes(spark, n, sizes):
    events = events_frame(spark, [{"type": "tool_loop", "src_seq": i} for i in range(n)])
    ranks = spark.createDataFrame([("s1", 0)], "session_id STRING, session_rank BIGINT")
    rows = delivery_chunks(events, ranks, 'de"mo').orderBy("chunk_id").collect()
    assert [r["n"] for r in rows] == sizes
    for row in rows:
        body = json.loads(row["body"])
        assert body["project"] == 'de"mo' and len(body["events"]) == row["n"]


def test_delivery_order(spark):
    rows = [
        {"type": "b", "session_id": "late", "src_seq": 1, "raised_at": datetime(2026, 1, 1)},
        {"type": "b", "session_id": "early", "src_seq": 9, "raised_at": datetime(2026, 1, 3)},
        {"type": "z", "session_id": "early", "src_seq": 4, "raised_at": datetime(2026, 1, 2)},
        {"type": "a", "session_id": "early", "src_seq": 4, "raised_at": datetime(2026, 1, 2)},
        {"type": "c", "session_id": "early", "src_seq": 3, "raised_at": datetime(2026, 1, 2)},
    ]
    ranks = spark.createDataFrame([("late", 7), ("early", 2)], "session_id STRING, session_rank BIGINT")
    chunks = delivery_chunks(events_frame(spark, rows), ranks, "demo", 2).orderBy("chunk_id")
    order = [
        (e["session_id"], e["type"])
        for row in chunks.collect()
        for e in json.loads(row["body"])["events"]
    ]
    assert order == [
        ("early", "c"), ("early", "a"), ("early", "z"), ("early", "b"), ("late", "b"),
    ]


def test_chunk_size_must_be_positive(spark):
    ranks = spark.createDataFrame([], "session_id STRING, session_rank BIGINT")
    with pytest.raises(ValueError):
        delivery_chunks(events_frame(spark, []), ranks, "demo", 0)


def storm(prefix, n, **more):
    return [
        {
            "request_id": f"{prefix}-same",
            "model": "gpt-5",
            "provider": "openai",
            "prompt_tokens": 1000,
            "created_at": f"2026-04-09T12:00:{i:02d}Z",
            **more,
        }
        for i in range(n)
    ]


def test_delivery_writes_batches_and_a_dry_run_does_not(spark, tmp_path):
    pages = pages_of(spark, storm("a", 5) + storm("b", 3))
    out = str(tmp_path / "out")
    result = analyze(spark, pages, "helicone", "demo", out=out, chunk_size=1)
    assert result.summary.first()["events_by_type"] == {"retry_storm": 2}
    written = spark.read.json(out).orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in written] == [0, 1]
    assert json.loads(written[0]["body"])["events"][0]["session_id"] == "a-same"
    assert result.payloads.count() == 2
    dry = str(tmp_path / "dry")
    analyze(spark, pages, "helicone", "demo", out=dry, dry_run=True)
    assert not (tmp_path / "dry").exists()


def test_delivery_needs_a_path(spark):
    with pytest.raises(ValueError, match="output path"):
        analyze(spark, pages_of(spark, []), "helicone", "demo")


def test_unknown_provider(spark):
    with pytest.raises(ValueError, match="unknown provider"):
        analyze(spark, pages_of(spark, []), "other", "demo", dry_run=True)


def test_several_sources_share_one_replay(spark):
    trace = {
        "id": "x", "sessionId": "a-same",
        "observations": [{"id": "o", "type": "GENERATION", "model": "claude"}],
    }
    result = analyze_many(
        spark,
        [
            Source(pages_of(spark, storm("a", 2)), "helicone"),
            Source(pages_of(spark, storm("a", 2)), "helicone"),
            Source(pages_of(spark, {"data": [trace]}, first=1), "langfuse"),
        ],
        "demo",
        dry_run=True,
        ingest_time=INGEST,
    )
    row = result.summary.first()
    assert (row["fetched_traces"], row["inferred_sessions"], row["pages_fetched"]) == (5, 1, 3)
    assert row["events_by_type"] == {"retry_storm": 1}
    seqs = [r["src_seq"] for r in result.calls.select("src_seq").collect()]
    assert len(set(seqs)) == 5


def test_one_source_without_an_upper_bound(spark):
    with pytest.raises(ValueError, match="upper"):
        analyze(
            spark, pages_of(spark, []), "helicone", "demo", until=utc(2026, 1, 1), dry_run=True
        )


def test_rules_read_only_their_columns(spark):
    pages = pages_of(spark, storm("a", 3))
    result = analyze(
        spark, pages, "helicone", "demo", dry_run=True, rules={"retry_storm": RULES["retry_storm"]}
    )
    narrow = result.calls.select("session_id", "request_hash")
    plan = spark._jvm.PythonSQLUtils.explainString(narrow._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<session_id:string,request_hash:string,skip_reason:string>" in plan
    assert "PushedFilters: [IsNull(skip_reason)]" in plan


def test_page_readers(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    for i in (2, 10):
        (files / f"page-{i:03d}.json").write_text(json.dumps([{"request_id": i}], indent=1))
    got = read_page_files(spark, str(files)).orderBy("page_idx").collect()
    assert [r["page_idx"] for r in got] == [2, 10]
    assert json.loads(got[1]["body"]) == [{"request_id": 10}]

    lines = tmp_path / "lines.jsonl"
    lines.write_text(
        json.dumps({"page_idx": 1, "body": [{"a": 1}]}) + "\n"
        + json.dumps({"page_idx": 0, "body": '[{"b": 2}]'}) + "\n"
    )
    got = read_page_lines(spark, str(lines)).orderBy("page_idx").collect()
    assert [json.loads(r["body"]) for r in got] == [[{"b": 2}], [{"a": 1}]]

    table = str(tmp_path / "table")
    pages_of(spark, [1], [2]).write.parquet(table)
    assert read_page_table(spark, table).count() == 2

    (files / "notes.json").write_text("[]")
    lines.write_text("\n" + json.dumps({"body": [{"a": 1}]}) + "\n{broken\n" + json.dumps(
        {"page_idx": 0, "body": [{"request_id": "r"}]}
    ) + "\n")
    for pages, n_bad in ((read_page_files(spark, str(files)), 1), (read_page_lines(spark, str(lines)), 3)):
        result = analyze(spark, pages, "helicone", "demo", dry_run=True, since=utc(2020, 1, 1))
        assert {r["skip_reason"] for r in result.rejected.collect()} == {"page_without_ordinal"}
        assert result.rejected.count() == n_bad
        good = result.summary.first()
        assert good["fetched_traces"] == good["pages_fetched"] == result.calls.count()


def test_repeated_pages(spark):
    from tracewaste.sources.pages import repeated_pages

    pages = pages_of(spark, storm("a", 2), storm("b", 3))
    twice = pages.unionByName(pages.filter("page_idx = 1"))
    assert [tuple(r) for r in repeated_pages(twice).collect()] == [(1, 2)]
    kept = analyze(spark, twice, "helicone", "demo", dry_run=True, drop_repeated_pages=True)
    assert kept.calls.count() == 5
    assert analyze(spark, twice, "helicone", "demo", dry_run=True).calls.count() == 8


def test_delivery_keeps_other_projects_and_runs(spark, tmp_path):
    out = str(tmp_path / "out")
    pages = pages_of(spark, storm("a", 5) + storm("b", 3))
    answers = spark.createDataFrame([('{"accepted": 2, "rejected": 1}',)], "body STRING")
    first = analyze(spark, pages, "helicone", "one/1", out=out, chunk_size=1, run_id="r1", responses=answers)
    row = first.summary.first()
    assert (row["backfill_accepted"], row["backfill_rejected"]) == (2, 1)
    for project, run in (("two", "r1"), ("one/1", "r2"), ("one/1", "r2")):
        again = analyze(spark, pages, "helicone", project, out=out, chunk_size=1, run_id=run)
        assert again.payloads.count() == 2
    found = delivered(spark, out).groupBy("project", "run").count().collect()
    assert sorted(map(tuple, found)) == [("one/1", "r1", 2), ("one/1", "r2", 2), ("two", "r1", 2)]


def test_a_run_is_replaced_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")

    def chunks(n):
        rows = [(i, "demo", 1, f"body{n}-{i}") for i in range(n)]
        return spark.createDataFrame(rows, "chunk_id BIGINT, project STRING, n BIGINT, body STRING")

    def bodies(*where):
        return sorted(r["body"] for r in analyze_module.delivered(spark, out, *where).collect())

    for n in (3, 1, 0, 2):
        got = analyze_module.deliver(chunks(n), out, "demo", "r")
        assert got.count() == n and bodies("demo", "r") == [f"body{n}-{i}" for i in range(n)]
    analyze_module.deliver(chunks(4), out, "other", "r")

    def crash(*args):
        raise RuntimeError("lost between files and marker")

    with monkeypatch.context() as patch:
        patch.setattr(analyze_module, "_commit", crash)
        with pytest.raises(RuntimeError):
            analyze_module.deliver(chunks(5), out, "demo", "r")
        with pytest.raises(RuntimeError):
            analyze_module.deliver(chunks(5), out, "demo", "never")
    assert bodies("demo") == ["body2-0", "body2-1"] and len(bodies()) == 6
    assert bodies("demo", "never") == []


def test_response_totals(spark):
    bodies = ['{"accepted": 1, "rejected": 0}', '{"accepted": "4"}', "{}", "broken", "[1]"]
    responses = spark.createDataFrame([(b,) for b in bodies], "body STRING")
    assert tuple(sum_responses(responses).first()) == (5, 0)
    assert tuple(sum_responses(responses.limit(0)).first()) == (0, 0)


def test_sessions(spark):
    rows = [
        {"at": 5, "session_id": "a", "src_seq": 7},
        {"at": 3, "session_id": "a", "src_seq": 9},
        {"at": 4, "session_id": "b", "src_seq": 8},
    ]
    calls = calls_frame(spark, rows)
    profile = {r["session_id"]: r for r in session_profile(calls).collect()}
    assert profile["a"]["n_calls"] == 2 and profile["a"]["prompt_tokens"] == 2000
    assert profile["a"]["first_call"].timestamp() == 3 and profile["a"]["last_call"].timestamp() == 5
    ranks = {r["session_id"]: r["session_rank"] for r in session_rank(calls).collect()}
    assert ranks == {"a": 7, "b": 8}


def test_bounds():
    assert parse_bound("2026-04-09") == utc(2026, 4, 9)
    assert parse_bound(" 2026-04-09T01:02:03Z ") == utc(2026, 4, 9, 1, 2, 3)
    assert parse_bound("2026-04-09T05:30:00+05:30") == utc(2026, 4, 9)
    assert parse_bound("2026-04-09T01:02:03") == utc(2026, 4, 9, 1, 2, 3)
    with pytest.raises(ValueError, match="ISO-8601"):
        parse_bound("yesterday")


def test_checkpoints_go_to_the_configured_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir") in ensure_checkpoint_dir(spark)


def test_ordinals_have_no_bounds(spark):
    """Any page number, position and nested position gives an ordinal of its own, in that order."""
    from tracewaste.sources.pages import arrival_ordinal, interleaved, nested_ordinal

    top = 2**31 - 1
    pages = (0, 1, 20_240_101_120_000, 1_704_110_400_000_000_000, 2**63 - 1)
    places = [(a, p, n) for a in pages for p in (0, 99, 70_000, top) for n in (0, 1, 65_536, top)]
    frame = spark.createDataFrame(places, "page BIGINT, p INT, n INT")
    seq = nested_ordinal(arrival_ordinal(F.col("page"), F.col("p")), F.col("n"))
    two = [interleaved(seq, 2, number).alias(f"of{number}") for number in (0, 1)]
    rows = sorted(frame.select("page", "p", "n", seq.alias("seq"), *two).collect())
    seqs = [int(r["seq"]) for r in rows]
    assert seqs == sorted(seqs) == [((r["page"] << 31) + r["p"] << 31) + r["n"] for r in rows]
    assert [(int(r["of0"]), int(r["of1"])) for r in rows] == [(2 * s, 2 * s + 1) for s in seqs]
    many = frame.select(interleaved(seq, 50, 3).alias("s")).collect()
    assert sum(r["s"] is None for r in many) == 32  # only those of the last two pages


def test_a_trace_of_many_observations(spark):
    trace = {
        "id": "x", "sessionId": "s", "timestamp": "2026-04-09T12:00:00Z",
        "observations": [{"id": str(i), "type": "GENERATION", "model": "m"} for i in range(65_540)],
    }
    result = analyze(
        spark, pages_of(spark, {"data": [trace, {**trace, "observations": trace["observations"][:3]}]}, first=1),
        "langfuse", "demo", dry_run=True, rules={"model_misroute": RULES["model_misroute"]},
    )
    assert result.calls.count() == result.calls.select("src_seq").distinct().count() == 65_543
    assert result.rejected.count() == 0


def test_an_empty_keyword_list_fires_nothing(spark):
    pages = pages_of(spark, storm("a", 2, body={"messages": [{"content": "classify"}]}))
    result = analyze(spark, pages, "helicone", "demo", dry_run=True, config={"model_misroute.keywords": []},
                     rules={"model_misroute": RULES["model_misroute"]})
    assert result.events.count() == 0
