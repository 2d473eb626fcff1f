import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from conftest import texts
from pyspark.sql import functions as F

from tracewaste.llm import chains, hmm


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def tokens(text):
    return (text or "").encode().lower().split() + [hmm.END]


def test_base_score_and_counts(make):
    docs, rows = make(texts(60))
    got = hmm.hmm_scores(docs, iterations=2).collect()
    train = Counter(t for r in rows if crc(r[0]) % 7 != 2 for t in tokens(r[1]))
    total, distinct = sum(train.values()), len(train)
    wanted = sorted(
        (
            -1 if r[0] is None else r[0],
            crc(r[0]) % 7 == 2,
            len(tokens(r[1])),
            sum(train[t] > 0 for t in tokens(r[1])),
            total,
            round(sum(math.log10((train[t] + 1) / (total + distinct + 1)) for t in tokens(r[1])), 6),
        )
        for r in rows
    )
    assert wanted == sorted(
        (-1 if r[0] is None else r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got
    )
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def brute_force(first, trans, unary):
    k = len(first)
    total = 0.0
    for path in product(range(k), repeat=len(unary)):
        p = first[path[0]] * unary[0][path[0]]
        for t in range(1, len(unary)):
            p *= trans[path[t - 1]][path[t]] * unary[t][path[t]]
        total += p
    return total


def test_chain_recursions_against_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([5, 1, 4, 0, 3])
    first, trans = rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3)
    unary = rng.random((lengths.sum(), 3))
    starts = np.concatenate([[0], np.cumsum(lengths)])[:5]
    for chosen in chains.batches(lengths):
        at, begin = chains.gather(starts[chosen], lengths[chosen])
        own, size = unary[at], lengths[chosen]
        alpha, scale = chains.forward(own, begin, size, first, trans)
        beta, ahead = chains.backward(own, scale, begin, size, trans)
        assert np.allclose((alpha * beta).sum(axis=1), 1)
        moves = chains.expected_transitions(alpha, ahead, begin, size, trans)
        assert moves.sum() == pytest.approx((size - 1).sum())
        for b, n in zip(begin, size, strict=True):
            assert np.prod(scale[b : b + n]) == pytest.approx(brute_force(first, trans, own[b : b + n]))


def test_score_is_the_likelihood_over_all_paths(make):
    docs, rows = make(["a b a", "b", "c a b", "a a", None, "", "b c d", "e"])
    blocks = hmm.blocks_of(docs, hmm.F.col("doc_id") == 6)
    counts = hmm.count_words(blocks)
    corpus = hmm.corpus_of(counts)
    model = hmm.train(blocks, corpus, states=3, iterations=2)
    words = blocks.filter("word IS NOT NULL").withColumnRenamed("block", "of_block")
    count = {bytes(r["word"]): r["c"] for r in counts.join(words, ["of_block", "number"]).collect()}

    def emission(token):
        c = hmm.word_class(token)
        return model.emit[:, c] * (count.get(token, 0) + 1) / corpus.class_mass[c]

    for r in hmm.score(blocks, counts, model, corpus).filter("doc_id IS NOT NULL").collect():
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        p = brute_force(model.first, model.trans, [emission(t) for t in tokens(text)])
        assert r["score"] == pytest.approx(math.log10(p), abs=1e-4)


def test_training_raises_the_likelihood(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

    def total(iterations):
        return hmm.hmm_scores(docs, iterations=iterations).filter("held_out").agg(
            F.sum("score"), F.sum("base_score")
        ).first()

    once, more = total(1), total(5)
    assert more[0] > once[0] and more[0] > more[1]


def test_blocks_do_not_change_scores(make, monkeypatch):
    docs, _ = make(texts(40))
    held = F.col("doc_id") % 7 == 2
    base = {}
    for size in (4_000_000, 50):
        blocks = docs.select(F.col("doc_id").cast("long"), held.alias("h"), hmm.binary_text(F.col("text")).alias("text"))
        monkeypatch.setattr(hmm, "BLOCK_TOKENS", size)
        encoded = hmm.written(blocks.mapInArrow(hmm._encode, hmm._BLOCKS_DDL), "t")
        counts = hmm.count_words(encoded)
        corpus = hmm.corpus_of(counts)
        rows = hmm.score(encoded, counts, hmm.start_model(corpus), corpus).collect()
        base[size] = sorted((r["doc_id"] or -1, round(r["base_score"], 6), round(r["score"], 3)) for r in rows)
    assert base[50] == base[4_000_000]


def test_empty_table(empty):
    assert hmm.hmm_scores(empty, iterations=1).collect() == []


@pytest.mark.parametrize("n", [1, 9, 10, 11, 57])
def test_long_texts_in_segments(monkeypatch, n):
    """A sequence cut into segments has the likelihood and the expected counts of the whole one."""
    rng = np.random.default_rng(n)
    unary = rng.random((n, 3)) + 0.01
    first, trans = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3)
    starts, lengths = np.zeros(1, np.int64), np.array([n])
    alpha, scale = chains.forward(unary, starts, lengths, first, trans)
    beta, ahead = chains.backward(unary, scale, starts, lengths, trans)
    moves = chains.expected_transitions(alpha, ahead, starts, lengths, trans)
    monkeypatch.setattr(chains, "BATCH_TOKENS", 10)
    scales = [s for _, _, s in chains.forward_segments(lambda part: unary[part], n, first, trans)]
    assert np.allclose(np.concatenate(scales), scale)
    state, moved = np.zeros((n, 3)), np.zeros((3, 3))
    for part, own, some in chains.expected_segments(lambda part: unary[part], n, first, trans):
        state[part] = own
        moved += some
    assert np.allclose(state, alpha * beta) and np.allclose(moved, moves)


def test_scores_do_not_depend_on_segments(make, monkeypatch):
    docs, _ = make(texts(40))
    whole = sorted(map(str, hmm.hmm_scores(docs).select("doc_id", "n_tokens", F.round("score", 2)).collect()))
    monkeypatch.setattr(chains, "BATCH_TOKENS", 16)
    block = hmm.blocks_of(docs, F.lit(False))
    row = block.filter("word IS NULL").select("held_out", "lengths", "ids", "class_of", "number").first()
    counts = hmm.corpus_of(hmm.count_words(block))
    expect = hmm._expect(hmm.start_model(counts))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([row.asDict()])
    (small,) = expect([batch])
    monkeypatch.setattr(chains, "BATCH_TOKENS", 10**6)
    (large,) = expect([batch])
    assert small.column(0) == large.column(0)
    assert all(np.allclose(small.column(i), large.column(i), rtol=1e-3, atol=1e-3) for i in range(1, 9))
    assert len(whole) == docs.count()
