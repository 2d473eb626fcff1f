import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewaste.llm import topk


def brute_force(values, ids, query, own, k):
    """The best of all rows but that with number ``own``."""
    listed = enumerate(zip(values, ids, strict=True))
    scored = [(-int(sum(int(a) * int(b) for a, b in zip(v, query, strict=True))), i) for n, (v, i) in listed if n != own]
    return [(i, -s) for s, i in sorted(scored)[:k]]


@pytest.mark.parametrize("spread", [2, 20, 2**40])
def test_block_against_brute_force(spread):
    rng = np.random.default_rng(spread % 97)
    values = rng.integers(-spread, spread, (300, 12))
    values[50:120] = values[50]  # a common vector
    ids = rng.permutation(300)
    ids[100] = ids[3]  # another row with a query's id is a candidate
    rows = np.arange(300)
    queries, own = values[:25], rows[:25]
    which, at, scores = topk.best_in_block(values, ids, rows, queries, own, 20)
    for q in range(25):
        got = [(int(ids[i]), int(s)) for w, i, s in zip(which, at, scores, strict=True) if w == q]
        assert got == brute_force(values.tolist(), ids.tolist(), queries[q].tolist(), own[q], 20)


def test_few_rows_are_resolved_early():
    """Lists are left before their end when one direction stands out."""
    rng = np.random.default_rng(1)
    values = rng.integers(-3, 3, (2000, 4))
    values[:20] = 500
    rows, seen = np.arange(2000), {}
    which, at, _ = topk.best_in_block(values, rows, rows, np.full((1, 4), 7), np.array([-1]), 20, seen)
    assert sorted(at.tolist()) == list(range(20)) and seen["resolved"] < 200


def test_bounds_close_rows_of_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    values = np.floor(64 * np.array([r["embedding"] for r in table], np.float64)).astype(np.int64)
    rows, seen = np.arange(len(table)), {}
    ids = np.array([r["vec_id"] for r in table])
    asked = np.flatnonzero(ids % 20 == 0)
    which, at, scores = topk.best_in_block(values, ids, rows, values[asked], rows[asked], 20, seen)
    full = values[asked] @ values.T
    full[np.arange(len(asked)), asked] = -(2**60)
    for q in range(len(asked)):
        assert [(ids[i], s) for i, s in zip(at[which == q], scores[which == q], strict=True)] == [
            (ids[i], full[q, i]) for i in np.lexsort((ids, -full[q]))[:20]
        ]
    assert seen["closed"] > seen["resolved"]


def test_table_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 1, 2) for i in range(90)]
    rows[7] = (7, None, 1, 2)
    rows[8] = (8, [1.0, None, 2.0], 1, 2)
    rows[9] = (9, [1.0, math.nan], 1, 2)
    rows[10] = (10, [math.inf] * 6, 1, 2)
    rows[11] = (11, [], 1, 2)
    rows[12] = (12, [5.0, 1.0], 1, 2)
    rows[13] = (None, [1.0] * 6, 1, 2)
    rows += rows[20:22] + rows[40:60]  # repeated rows, queries among them
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int, b int")
    got = topk.nearest(table, F.col("vec_id") % 20 == 0).collect()
    good = [
        (i, [math.floor(64 * float(np.float32(x))) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = max(len(v) for _, v in good)
    good = [(i, v + [0] * (width - len(v))) for i, v in good]
    wanted = []
    for n, (i, v) in enumerate(good):
        if i % 20 == 0:
            best = brute_force([x for _, x in good], [j for j, _ in good], v, n, 20)
            wanted += [(i, r + 1, j, s) for r, (j, s) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.nearest(table, F.col("vec_id") % 20 == 0).collect() == []
