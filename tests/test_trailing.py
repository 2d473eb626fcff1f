import random

import oracle
import pytest
from pyspark.sql import functions as F

from tracewaste.operators.firing import deduplicate
from tracewaste.operators.trailing import MEASURES, hot_key_hashes, trailing_window

SPAN = 60 * oracle.SECOND


def random_rows(seed, n, keys=4, tight=True):
    """Rows with many equal times, exact window gaps and one microsecond around them."""
    rng = random.Random(seed)
    rows, at = [], 0
    gaps = [0, 0, 0, 1, 10 * oracle.SECOND, SPAN - 1, SPAN, SPAN + 1]
    for seq in range(n):
        at += rng.choice(gaps if tight else [0, 1])
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(keys)}"
        rows.append(
            {
                "session_id": "s",
                "key": key,
                "at": at,
                "seq": seq,
                "cost": rng.randrange(1, 10**6),
                "flag": int(rng.random() < 0.1),
            }
        )
    rng.shuffle(rows)
    return rows


def frame(spark, rows, partitions=5):
    return (
        spark.createDataFrame(
            [(r["session_id"], r["key"], r["at"], r["seq"], r["cost"], r["flag"]) for r in rows],
            "session_id STRING, key STRING, at_us BIGINT, seq BIGINT, cost_nanos BIGINT, flag INT",
        )
        .repartition(partitions)
    )


def expected(rows):
    out = {}
    for group in oracle.by_key(rows, lambda r: r["key"]).values():
        for i, row in enumerate(group):
            inside = oracle.window(group, i, SPAN)
            out[row["seq"]] = (
                i + 1,
                len(inside),
                sum(r["cost"] for r in inside),
                sum(r["flag"] for r in inside),
                inside[0]["cost"],
            )
    return out


def measured(parts):
    out = {}
    for part in parts:
        for row in part.collect():
            assert row["seq"] not in out
            out[row["seq"]] = tuple(row[m] for m in MEASURES)
    return out


@pytest.mark.parametrize("hot_rows, paths", [(10**9, 1), (200, 2), (1, 2)])
def test_every_row_matches_the_sequential_count(spark, hot_rows, paths):
    rows = random_rows(hot_rows % 97, 600)
    parts = trailing_window(
        frame(spark, rows), ["session_id", "key"], SPAN, hot_rows=hot_rows
    )
    assert len(parts) == paths
    assert measured(parts) == expected(rows)


def test_one_key_at_one_instant_spreads_over_partitions(spark):
    rows = [
        {"session_id": "s", "key": "hot", "at": 7, "seq": i, "cost": i + 1, "flag": 0}
        for i in range(3000)
    ]
    parts = trailing_window(frame(spark, rows), ["session_id", "key"], SPAN, hot_rows=500)
    assert len(parts) == 2
    got = measured(parts)
    assert got == {i: (i + 1, i + 1, (i + 1) * (i + 2) // 2, 0, 1) for i in range(3000)}


def test_hot_keys_are_found_across_tasks(spark):
    rows = random_rows(3, 2000, keys=50)
    hot = hot_key_hashes(frame(spark, rows, 16), ["session_id", "key"], 500)
    n = sum(r["key"] == "hot" for r in rows)
    assert [r["n"] for r in hot.collect()] == [n]
    assert hot_key_hashes(frame(spark, rows).limit(0), ["session_id", "key"], 1).collect() == []


@pytest.mark.parametrize("mode", ["session", "edge", "none"])
@pytest.mark.parametrize("hot_rows", [10**9, 100])
def test_dedup_modes(spark, mode, hot_rows):
    rows = random_rows(11, 500)
    keys = ["session_id", "key"]
    parts = trailing_window(frame(spark, rows), keys, SPAN, 4, hot_rows)
    got = []
    for part in parts:
        firing = part.filter("flagged_window = 0")
        for r in deduplicate(firing, keys, ["at_us", "seq"], "ordinal", mode).collect():
            got.append((r["seq"], r["n_window"], r["cost_window"] - r["first_cost"]))
    want = [
        (row["seq"], count, burn)
        for group in oracle.by_key(rows, lambda r: r["key"]).values()
        for row, count, burn in oracle.firings(group, SPAN, 4, mode, suppressed=True)
    ]
    assert want and sorted(got) == sorted(want)


def test_ordinary_keys_take_one_shuffle(spark):
    parts = trailing_window(
        frame(spark, random_rows(1, 200)), ["session_id", "key"], SPAN, 4, 10**9
    )
    first = deduplicate(parts[0], ["session_id", "key"], ["at_us", "seq"], "ordinal", "session")
    plan = spark._jvm.PythonSQLUtils.explainString(first._jdf.queryExecution(), "simple")
    # One exchange spreads the test rows over tasks, one groups them by key.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan and "rangeframe" not in plan.lower()
    assert first.select(F.count("*")).first()[0] > 0
