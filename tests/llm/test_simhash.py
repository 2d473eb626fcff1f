import random

import numpy as np
import pytest
import xxhash
from conftest import texts

from tracewaste.llm import simhash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(prints):
    """Root of each print, by comparing all pairs."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    items = sorted(root)
    for i, a in enumerate(items):
        for b in items[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in items}


def near_prints(seed=3):
    """Chains, clouds and pairs at each distance up to five."""
    rng = random.Random(seed)
    out = {0, 1, (1 << 64) - 1}
    for _ in range(60):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            out.add(p)
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << bit
    for part in range(4):  # three bits within one part, and one in each of three
        p = rng.getrandbits(64)
        out |= {p, p ^ (0b10101 << part * 16), p ^ (1 << 63) ^ (1 << 20) ^ (1 << 5)}
    centre = rng.getrandbits(64)
    out |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)}
    return sorted(out)


def test_links_connect_exactly_what_all_pairs_do(spark):
    prints = near_prints()
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    table = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(5)
    links = simhash.links_of(table)
    for r in links.collect():
        a, b = (int(np.int64(r[x]).view(np.uint64)) for x in "uv")
        assert 0 < (a ^ b).bit_count() <= 3
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    slow = slow_components(prints)
    groups, wanted = {}, {}
    for p, s in zip(prints, signed, strict=True):
        groups.setdefault(got.get(s, s), set()).add(p)
        wanted.setdefault(slow[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


@pytest.mark.parametrize("rows", [1, 7, 500_000])
def test_groups_are_not_cut(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "RUN_ROWS", rows)
    table = spark.createDataFrame([(i,) for i in range(8)], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links_of(table)).collect()}
    assert got == dict.fromkeys(range(8), 0)


def test_long_chain(spark):
    nodes = list(range(200))
    random.Random(1).shuffle(nodes)
    links = [(max(a, b), min(a, b)) for a, b in zip(nodes, nodes[1:], strict=False)]
    got = simhash.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert sorted((r["node"], r["root"]) for r in got) == [(i, 0) for i in range(200)]


def test_documents(make):
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 20
    values = texts(60) + [base, base + "1", base.upper(), base + "1 2", "0 " + base]
    docs, rows = make(values)
    got = simhash.near_duplicate_digests(docs).collect()
    prints = {r[0]: slow_fingerprint(r[1]) for r in rows}
    roots = slow_components(set(prints.values()))
    least = {}
    for doc_id, p in prints.items():
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    wanted = [(r[0], f"{prints[r[0]]:016x}", least.get(roots[prints[r[0]]])) for r in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_empty_table(empty):
    assert simhash.near_duplicate_digests(empty).collect() == []
