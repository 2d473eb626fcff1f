import zlib
from collections import Counter
from math import comb

from conftest import texts
from pyspark.sql import functions as F

from tracewaste.llm import sharding


def test_sizes_slots_and_columns(make):
    docs, rows = make(texts(300))
    got = sharding.sharded_documents(docs, 7).collect()
    sizes = Counter(r["shard"] for r in got)
    assert sum(sizes.values()) == len(rows) and set(sizes) == set(range(7))
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    wanted = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == wanted
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_buckets_keep_slots_gapless(make, monkeypatch):
    docs, rows = make(texts(200))
    got = sharding.shard_rows(docs.select("doc_id", "text"), 3, bucket_rows=5).collect()
    for shard in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len(got) == len(rows)


def test_fewer_rows_than_shards(spark):
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = sharding.sharded_documents(docs).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(i, 0) for i in range(5)]


def test_empty_table(empty):
    assert sharding.sharded_documents(empty).collect() == []


def test_matrix_margins(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FAN", 4)
    sizes = [(i, n) for i, n in enumerate([5, 1000, 1, 300, 77, 2, 64, 900, 13, 41, 8, 500, 3, 3, 3, 3, 90, 12])]
    matrix = sharding.communication_matrix(spark.createDataFrame(sizes, "node long, n long"), 5).collect()
    total = sum(n for _, n in sizes)
    assert {r["node"]: sum(r["places"]) for r in matrix} == dict(sizes)
    columns = [sum(r["places"][j] for r in matrix) for j in range(5)]
    assert columns == [total // 5 + (j < total % 5) for j in range(5)]
    assert all(x >= 0 for r in matrix for x in r["places"])


def test_draws_have_the_hypergeometric_law(spark):
    good, total, draws, n = 9, 30, 12, 20_000
    u = (F.col("id") + 0.5) / n
    long = lambda x: F.lit(x).cast("long")
    drawn = spark.range(n).select(sharding.hypergeometric(long(good), long(total), long(draws), u).alias("x"))
    seen = Counter(r["x"] for r in drawn.collect())
    for x in range(good + 1):
        p = comb(good, x) * comb(total - good, draws - x) / comb(total, draws)
        assert abs(seen[x] / n - p) <= 1.01 / n


def test_large_draws(spark):
    u = (F.col("id") + 0.5) / 200
    long = lambda x: F.lit(x).cast("long")
    drawn = [r[0] for r in spark.range(200).select(
        sharding.hypergeometric(long(10**9), long(24 * 10**9), long(10**6), u)).collect()]
    mean = 10**6 / 24
    spread = (mean * (1 - 1 / 24)) ** 0.5
    assert abs(sum(drawn) / 200 - mean) < spread / 10
    assert 0.9 < (sum((x - mean) ** 2 for x in drawn) / 200) ** 0.5 / spread < 1.1


def test_every_arrangement_is_as_likely(spark, monkeypatch):
    """Over many seeds, each row falls on each slot about equally often."""
    docs = spark.range(0, 8, 1, 3).select(F.col("id").alias("doc_id"))
    seen = Counter()
    for seed in range(30):
        monkeypatch.setattr(sharding, "SEED", seed)
        for r in sharding.shard_rows(docs, 2).collect():
            seen[r["doc_id"], r["shard"]] += 1
    assert all(4 <= seen[d, s] <= 26 for d in range(8) for s in range(2))
