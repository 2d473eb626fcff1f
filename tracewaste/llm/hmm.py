"""Language-model scores from a hidden Markov model trained by Baum-Welch over all partitions.

A state emits a word class, and the class emits the word: P(word | state) = P(class | state) *
P(word | class). Classes are tied emission rows, a fixed number of them (``CLASSES``): a word of up to
six bytes falls into a class by its bytes, a longer one by its first two and last three. P(word | class)
comes from the counts of all training words, a table that grows with the corpus and is only ever
joined, never broadcast.

The corpus is read once and written as blocks of at most ``BLOCK_TOKENS`` tokens or ``BLOCK_WORDS``
distinct words. A block's documents are arrays of word numbers of the block's own dictionary, so a
frequent word is shuffled once per block instead of once per occurrence.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewaste.llm import chains
from tracewaste.llm.tables import binary_text, by_bytes, give_back, id_crc, ragged, row_number, written

STATES = 8
CLASSES = 1 << 14
ITERATIONS = 5
STICKINESS = 0.9
SPREAD = 1.0
BLOCK_TOKENS = 4_000_000
BLOCK_WORDS = 400_000
#: Stands for the end of a text; no word holds a line break.
END = b"\n"

_BLOCKS_DDL = (
    "block long, doc_ids array<long>, held_out array<boolean>, lengths binary, ids binary, class_of binary, "
    "number int, word binary, seen long"
)
SCORES_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def word_class(word: bytes) -> int:
    if word == END:
        return CLASSES
    return zlib.crc32(word if len(word) <= 6 else word[:2] + word[-3:]) % CLASSES


def _squeeze(values: np.ndarray) -> bytes:
    """An integer array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unsqueeze(data: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(dtype).reshape(-1)


def _encode(batches):
    numbers = row_number(TaskContext.get().partitionId())
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("held_out", pa.list_(pa.bool_())),
            ("lengths", pa.binary()),
            ("ids", pa.binary()),
            ("class_of", pa.binary()),
            ("number", pa.int32()),
            ("word", pa.binary()),
            ("seen", pa.int64()),
        ]
    )
    words: dict[bytes, int] = {END: 0}
    docs: list[tuple] = []
    tokens = 0

    def block():
        number, m = next(numbers), len(words)
        class_of = np.fromiter(map(word_class, words), np.uint16, m)
        ids, lengths = ragged([d[2] for d in docs], np.int32)
        train = np.repeat(np.array([not d[1] for d in docs], bool), lengths)
        seen = np.bincount(ids[train], minlength=m)
        texts = [[number], [[d[0] for d in docs]], [[d[1] for d in docs]], [lengths.astype(np.int32).tobytes()]]
        texts += [[_squeeze(ids)], [_squeeze(class_of)], [m], [None], [None]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(texts, schema, strict=True)], schema=schema
        )
        listed = [np.full(m, number), *[[None] * m] * 5, np.arange(m, dtype=np.int32), list(words), seen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(listed, schema, strict=True)], schema=schema
        )

    for batch in batches:
        for at, n in by_bytes(batch.column(2)):
            some = batch.slice(at, n)
            for doc_id, held_out, text in zip(*(c.to_pylist() for c in some.columns), strict=True):
                found = text.lower().split()
                ids = np.empty(len(found) + 1, np.int32)
                ids[:-1] = [words.setdefault(w, len(words)) for w in found]
                ids[-1] = 0
                docs.append((doc_id, held_out, ids))
                tokens += len(ids)
                if tokens >= BLOCK_TOKENS or len(words) >= BLOCK_WORDS:
                    yield from block()
                    words, docs, tokens = {END: 0}, [], 0
    if docs:
        yield from block()
    del words, docs
    give_back()


def blocks_of(docs: DataFrame, held_out) -> DataFrame:
    """One row per block with its documents as word numbers, and one for each word of its dictionary.

    In a block's own row, ``number`` is how many words it has.

    One pass over the texts; ``seen`` counts a word in the block's training documents.
    """
    slim = docs.select(
        F.col("doc_id").cast("long"), held_out.alias("held_out"), binary_text(F.col("text")).alias("text")
    )
    return written(slim.mapInArrow(_encode, _BLOCKS_DDL), "hmm-blocks")


@dataclass(frozen=True)
class Block:
    """The documents of a block: lengths, which are held out, and the class of each token."""

    lengths: np.ndarray
    held_out: np.ndarray
    ids: np.ndarray
    class_of: np.ndarray


def _block(held_out, lengths: bytes, ids: bytes, class_of: bytes, words: int) -> Block:
    size = np.frombuffer(lengths, np.int32).astype(np.int64)
    return Block(size, np.array(held_out, bool), _unsqueeze(ids, size.sum(), np.int32), _unsqueeze(class_of, words, np.uint16))


@dataclass(frozen=True)
class Corpus:
    """Training tokens, distinct training words, and both per class."""

    tokens: int
    words: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def class_mass(self) -> np.ndarray:
        """Each class's tokens with one more for each word and one for all unknown words."""
        return self.class_tokens + self.class_words + 1.0


def count_words(blocks: DataFrame) -> DataFrame:
    """(of_block, number, c, first) of every word of every block: its count in all training documents.

    ``first`` marks one row of each word. A word's rows meet in one shuffle, one row a block.
    """
    listed = blocks.filter("word IS NOT NULL").select(F.col("block").alias("of_block"), "number", "word", "seen")
    every = Window.partitionBy("word")
    counted = listed.select(
        "of_block",
        "number",
        F.sum("seen").over(every).alias("c"),
        F.lag("of_block").over(every.orderBy("of_block")).isNull().alias("first"),
        F.when(F.col("word") == F.lit(END), CLASSES).otherwise(_class_column(F.col("word"))).cast("int").alias("class"),
    )
    return written(counted, "hmm-words")


def _class_column(word: Column) -> Column:
    ends = F.concat(F.substring(word, 1, 2), F.substring(word, -3, 3))
    return F.crc32(F.when(F.octet_length(word) <= 6, word).otherwise(ends)) % CLASSES


def corpus_of(counts: DataFrame) -> Corpus:
    """At most CLASSES + 1 sums reach the driver."""
    tokens, words = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
    known = counts.filter("first AND c > 0").groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    for r in known.collect():
        tokens[r["class"]], words[r["class"]] = r["n"], r["v"]
    return Corpus(int(tokens.sum()), int(words.sum()), tokens, words)


@dataclass(frozen=True)
class Model:
    first: np.ndarray
    trans: np.ndarray
    emit: np.ndarray

    def unary(self, classes: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.emit.T, np.float32)[classes]


def start_model(corpus: Corpus, states: int = STATES, seed: int = 7) -> Model:
    """Near-uniform sticky states whose emissions are the corpus's, each disturbed in its own way."""
    noise = np.random.default_rng(seed).normal(0.0, SPREAD, (states, CLASSES + 1))
    emit = corpus.class_mass * np.exp(noise)
    trans = np.full((states, states), (1 - STICKINESS) / max(1, states - 1))
    np.fill_diagonal(trans, STICKINESS if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), trans, emit / emit.sum(axis=1, keepdims=True))


def _class_batches(block: Block, chosen: np.ndarray):
    """Per recursion batch of the chosen documents: their numbers, classes, starts and lengths."""
    starts = np.concatenate([[0], np.cumsum(block.lengths)])[:-1][chosen]
    lengths = block.lengths[chosen]
    for some in chains.batches(lengths):
        at, first = chains.gather(starts[some], lengths[some])
        yield chosen[some], block.class_of[block.ids[at]], first, lengths[some]


def _long_classes(block: Block, chosen: np.ndarray):
    """The classes of each chosen document's tokens."""
    ends = np.cumsum(block.lengths)
    for i in chosen:
        yield block.class_of[block.ids[ends[i] - block.lengths[i] : ends[i]]]


def _unaries(model: Model, classes: np.ndarray):
    return lambda part: model.unary(classes[part])


def _expect(model: Model):
    def run(batches):
        k = len(model.first)
        first, trans = model.first.astype(np.float32), model.trans.astype(np.float32)
        rows = np.zeros((CLASSES + 1 + k + 1, k))
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = _block(*row)
                train = np.flatnonzero(~block.held_out)
                short = block.lengths[train] <= chains.BATCH_TOKENS
                for classes in _long_classes(block, train[~short]):
                    unary_of = _unaries(model, classes)
                    for part, state, moves in chains.expected_segments(unary_of, len(classes), first, trans):
                        rows[CLASSES + 1 : -1] += moves
                        for s in range(k):
                            rows[: CLASSES + 1, s] += np.bincount(classes[part], state[:, s], CLASSES + 1)
                        rows[-1] += state[0] if part.start == 0 else 0
                for _, classes, starts, lengths in _class_batches(block, train[short]):
                    unary = model.unary(classes)
                    alpha, scale = chains.forward(unary, starts, lengths, first, trans)
                    beta, ahead = chains.backward(unary, scale, starts, lengths, trans)
                    rows[CLASSES + 1 : -1] += chains.expected_transitions(alpha, ahead, starts, lengths, trans)
                    alpha *= beta
                    for s in range(k):
                        rows[: CLASSES + 1, s] += np.bincount(classes, alpha[:, s], CLASSES + 1)
                    rows[-1] += alpha[starts].sum(axis=0)
        give_back()
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *(pa.array(rows[some, s]) for s in range(k))],
            names=["row", *(f"s{s}" for s in range(k))],
        )

    return run


def train(blocks: DataFrame, corpus: Corpus, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over every training document.

    Each task sums its expected counts, Spark adds the tasks' up by row, and CLASSES + states + 2 rows
    reach the driver. Emissions are smoothed towards the corpus's class shares, so that no class is
    impossible in a state.
    """
    model = start_model(corpus, states)
    texts = blocks.filter("word IS NULL").select("held_out", "lengths", "ids", "class_of", "number")
    names = [f"s{s}" for s in range(states)]
    ddl = ", ".join(["row int", *(f"{n} double" for n in names)])
    prior = corpus.class_mass / corpus.class_mass.sum()
    for _ in range(iterations):
        summed = texts.mapInArrow(_expect(model), ddl).groupBy("row").agg(*(F.sum(n).alias(n) for n in names))
        rows = np.zeros((CLASSES + 1 + states + 1, states))
        for r in summed.collect():
            rows[r["row"]] = r[1:]
        emit = rows[: CLASSES + 1].T + prior * CLASSES
        trans = rows[CLASSES + 1 : -1] + 1.0
        first = rows[-1] + 1.0
        model = Model(
            first / first.sum(),
            trans / trans.sum(axis=1, keepdims=True),
            emit / emit.sum(axis=1, keepdims=True),
        )
    return model


def _score(model: Model, corpus: Corpus):
    first, trans = model.first.astype(np.float32), model.trans.astype(np.float32)
    base_norm = np.log10(corpus.tokens + corpus.words + 1)
    class_norm = np.log10(corpus.class_mass)

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        counts = np.zeros(words.num_rows, np.int64)
        counts[words["number"].to_numpy()] = words["c"].to_numpy()
        logs = np.log10(counts + 1.0)
        parts = []
        for doc_ids, *row in zip(*(docs[n].to_pylist() for n in _TEXTS), strict=True):
            block = _block(*row, words.num_rows)
            starts = np.concatenate([[0], np.cumsum(block.lengths)])[:-1]
            in_class = logs - class_norm[block.class_of]
            base = np.add.reduceat(logs[block.ids], starts) - block.lengths * base_norm
            score = np.add.reduceat(in_class[block.ids], starts)
            short = block.lengths <= chains.BATCH_TOKENS
            for i in np.flatnonzero(~short):
                (classes,) = _long_classes(block, [i])
                for _, _, scale in chains.forward_segments(_unaries(model, classes), len(classes), first, trans):
                    score[i] += np.log10(scale.astype(np.float64)).sum()
            for chosen, classes, first_of, lengths in _class_batches(block, np.flatnonzero(short)):
                _, scale = chains.forward(model.unary(classes), first_of, lengths, first, trans)
                score[chosen] += np.add.reduceat(np.log10(scale.astype(np.float64)), first_of)
            parts.append(
                pa.table(
                    {
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "held_out": block.held_out,
                        "n_tokens": block.lengths,
                        "n_known": np.add.reduceat((counts > 0)[block.ids].astype(np.int64), starts),
                        "train_tokens": np.full(len(starts), corpus.tokens),
                        "base_score": base,
                        "score": score,
                    }
                )
            )
        give_back()
        return pa.concat_tables(parts)

    return run


_TEXTS = ("doc_ids", "held_out", "lengths", "ids", "class_of")


def score(blocks: DataFrame, counts: DataFrame, model: Model, corpus: Corpus) -> DataFrame:
    """Exact log10 likelihood of each document by the scaled forward recursion, and the base score."""
    texts = blocks.filter("word IS NULL").select("block", *_TEXTS)
    return (
        texts.groupBy("block")
        .cogroup(counts.select("of_block", "number", "c").groupBy("of_block"))
        .applyInArrow(_score(model, corpus), SCORES_DDL)
    )


def hmm_scores(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Scores every document with a model learned from those not held out.

    Documents with crc32(doc_id as text) mod 7 = 2 are held out; a null id counts as the empty text.
    A null or empty text is the end token alone. Repeated rows are scored each, and counted each if they
    train. A text of any length is scored whole, a long one in segments that carry the state over. Without
    training documents every class is equally likely. Further columns play no part.
    """
    blocks = blocks_of(docs, id_crc(F.col("doc_id")) % 7 == 2)
    counts = count_words(blocks)
    corpus = corpus_of(counts)
    return score(blocks, counts, train(blocks, corpus, states, iterations), corpus)
