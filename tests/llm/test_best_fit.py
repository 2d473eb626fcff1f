import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import texts
from test_packing import ODD, WORD_MODEL, ids_of

from tracewaste.llm import best_fit as b


def slow_rooms(lengths, capacity):
    """Room left in each sequence by best-fit decreasing, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if not fits:
            rooms.append(capacity)
            fits = [len(rooms) - 1]
        rooms[min(fits, key=rooms.__getitem__)] -= n
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 30, 100, 4096])
    top = rng.choice([capacity, max(1, capacity // 3)])
    lengths = [rng.randint(1, top) for _ in range(rng.choice([0, 1, 5, 60, 500]))]
    lengths += [rng.randint(1, top)] * rng.choice([0, 200])
    counts = Counter(lengths)
    runs = b.best_fit_decreasing(dict(counts), capacity)
    size = np.array([n for n, c in counts.items() for _ in range(c)], np.int64)
    rank = np.array([i for c in counts.values() for i in range(c)], np.int64)
    assert len(runs.length) <= 4 * capacity * (2 * capacity) ** 0.5 + 4
    if not len(size):
        assert runs.sequences == 0
        return
    sequence, offset = runs.places(size, rank)
    held = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), size.tolist(), strict=True):
        held[s].append((o, n))
    for parts in held.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    rooms = sorted(capacity - sum(n for _, n in parts) for parts in held.values())
    assert rooms == slow_rooms(lengths, capacity) and len(held) == runs.sequences


def test_tightest_room_against_a_scan():
    rng = random.Random(3)
    tree, open_ = b.OpenRooms(50), Counter()
    for _ in range(2000):
        room = rng.randint(0, 50)
        n = rng.choice([1, 2, -1])
        if open_[room] + n >= 0:
            tree.add(room, n)
            open_[room] += n
        need = rng.randint(0, 50)
        assert tree.tightest(need) == min((r for r, c in open_.items() if c and r >= need), default=None)


def check(got, rows, capacity):
    pieces = sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    wanted = []
    for doc_id, text, *_ in rows:
        ids = [*ids_of(text)[:-1], 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            wanted.append((str(doc_id), piece, start, len(part), zlib.crc32(part.tobytes())))
    assert pieces == sorted(wanted)
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = sorted(capacity - sum(n for _, n in parts) for parts in held.values())
    assert rooms == slow_rooms([p[3] for p in wanted], capacity)


@pytest.mark.parametrize("capacity", [5, 64])
def test_documents(make, capacity):
    docs, rows = make(texts(80) + ODD)
    check(b.packed(b.cut_documents(docs, WORD_MODEL, 1, capacity), capacity).collect(), rows, capacity)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = b.best_fit_documents(docs, WORD_MODEL).collect()
    check(got, [(r["doc_id"], r["text"]) for r in docs.collect()], 4096)


def test_many_equal_documents(spark):
    """A length that holds all rows is ranked over many tasks."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text").repartition(16)
    got = b.best_fit_documents(docs, WORD_MODEL).groupBy("sequence_id").count().collect()
    assert sorted(r["count"] for r in got) == [20_000 % 4096, 4096, 4096, 4096, 4096]


def test_empty_table(empty):
    assert b.best_fit_documents(empty, WORD_MODEL).collect() == []
