"""Language of each word and text by a linear-chain conditional random field.

A word's features are its character trigrams, its first and last three bytes, and which languages'
lexicons hold it. Learned transitions tie neighbouring words, so that a label changes where the text
switches and not at every borrowed word. Forward-backward gives each word's label probabilities; a
text's language is the one with the largest mean over its words.

The field is fitted on a bounded sample of the labelled rows: every labelled language has an equal share
of ``SAMPLE_TOTAL`` rows, at most ``SAMPLE_ROWS``, with one window of ``SAMPLE_BYTES`` of each. Prediction
reads whole texts.

What is of no learned language shows by its words: a word is familiar if all its trigrams were seen in
several windows of one language, the one that the field gives the word or the one it gives the text; a trigram
with a digit or sign is of no language, so it may be seen in windows of any. A text whose share of familiar words, by bytes, is under
half of what held-out windows of its words' languages have is foreign, be it another language, one that lies
between learned ones, random letters or encoded data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewaste.llm import chains
from tracewaste.llm.tables import appended, binary_text, by_bytes, give_back

SAMPLE_TOTAL = 25_600
SAMPLE_ROWS = 400
SAMPLE_BYTES = 1_500
LEXICON = 2_000
BUCKETS = 1 << 16
SEQUENCE_WORDS = 48
SEGMENT_WORDS = 12
EPOCHS = 6
BATCH_SEQUENCES = 256
RATE = 0.3
#: Bytes of text whose features are looked up at a time, for one language.
FEATURE_BYTES = 2_000_000
UNDETERMINED = "und"
#: Windows that make a trigram known, and bytes a text is granted, so that one or two odd words do not decide.
SEEN_WINDOWS, GRANTED_BYTES = 2, 16
#: Bytes that a word counts for at most in that share, so that one key or number does not outweigh a text.
WORD_BYTES = 24
PREDICTIONS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("n_words", pa.int64()),
        ("n_switches", pa.int64()),
    ]
)
PREDICTIONS_DDL = (
    "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long"
)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POWERS = np.uint64(0x9E3779B97F4A7C15) ** np.arange(64, dtype=np.uint64)


@dataclass(frozen=True)
class Words:
    """The words with a letter of a batch of texts: hashed features, and the words of each text."""

    trigrams: np.ndarray  # bucket of each byte of a word
    starts: np.ndarray  # of each word among the trigrams
    affixes: np.ndarray  # two buckets of each word
    hashes: np.ndarray  # of each word
    lengths: np.ndarray  # words of each text
    marked: np.ndarray  # which trigrams have a byte that is neither a letter nor space


def _bucket(code: np.ndarray, salt: int) -> np.ndarray:
    mixed = (code + np.uint64(salt << 24)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.int32) % BUCKETS


def words_of(texts: list[bytes]) -> Words:
    data = np.frombuffer(bytearray(b" " + b" ".join(t.lower() for t in texts) + b" "), np.uint8)
    # Capitals from U+00C0 to U+00DE, two bytes each.
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    data[second] += 0x20
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    first, last = edge[::2], edge[1::2]  # a word is data[first:last]
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    keep = letters[last] > letters[first]
    first, last = first[keep], last[keep]
    ends = np.cumsum([len(t) + 1 for t in texts])
    lengths = np.diff(np.searchsorted(first, ends + 1), prepend=0) if len(texts) else np.zeros(0, np.int64)
    at, starts = chains.gather(first, last - first) if len(first) else (np.zeros(0, np.int64),) * 2
    plain = np.where(space, np.uint8(32), data).astype(np.uint64)
    code = plain[at - 1] | plain[at] << np.uint64(8) | plain[at + 1] << np.uint64(16) if len(at) else plain[:0]
    inside = np.arange(len(at)) - np.repeat(starts, last - first)
    powered = (plain[at] + np.uint64(1)) * _POWERS[inside % 64] if len(at) else plain[:0]
    hashes = np.add.reduceat(powered, starts) if len(at) else plain[:0]

    def affix(pick):
        code = np.zeros(len(first), np.uint64)
        for i in range(3):
            p = pick(i)
            code |= np.where((p >= first) & (p < last), plain[np.clip(p, 0, len(plain) - 1)], 0).astype(
                np.uint64
            ) << np.uint64(8 * i)
        return code

    affixes = np.stack(
        [_bucket(affix(lambda i: first + i), 1), _bucket(affix(lambda i: last - 1 - i), 2)], axis=1
    )
    plain = _LETTER[data] | space
    marked = ~(plain[at - 1] & plain[at] & plain[at + 1]) if len(at) else np.zeros(0, bool)
    return Words(_bucket(code, 0), starts, affixes, hashes, lengths, marked)


@dataclass(frozen=True)
class Field:
    languages: list[str]
    weights: np.ndarray  # bucket x language
    lexicon: np.ndarray  # sorted word hashes
    holds: np.ndarray  # lexicon word x language
    lexical: np.ndarray  # language of the lexicon x language
    trans: np.ndarray  # language x language, as logarithms
    seen: np.ndarray  # bucket x language, which trigrams are known
    least: np.ndarray  # of each language, share of familiar words below which a text is foreign

    def native(self, words: Words, label: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether each text has the share of familiar words that its words' languages ask for; so without words.

        ``label`` is the language of each word, ``best`` that of each text.
        """
        whole = familiar_words(self.seen, words, label)
        whole |= familiar_words(self.seen, words, np.repeat(best, words.lengths))
        return granted_shares(words, whole) >= text_means(words, self.least[label])

    def scores(self, words: Words) -> np.ndarray:
        """(word, language) sums of weights."""
        if not len(words.starts):
            return np.zeros((0, len(self.languages)), np.float32)
        out = np.add.reduceat(self.weights[words.trigrams], words.starts, axis=0)
        out += self.weights[words.affixes[:, 0]] + self.weights[words.affixes[:, 1]]
        found, at = self.look_up(words.hashes)
        out[found] += (self.holds @ self.lexical)[at]
        return out

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words the lexicons hold, and their rows."""
        if not len(self.lexicon):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        found = np.flatnonzero(self.lexicon[at] == hashes)
        return found, at[found]


def word_sizes(words: Words) -> np.ndarray:
    """Bytes that each word counts for."""
    return np.minimum(np.diff(np.append(words.starts, len(words.trigrams))), WORD_BYTES)


def text_sums(words: Words, values: np.ndarray) -> np.ndarray:
    """Sums over each text of its words' values."""
    out = np.zeros(len(words.lengths))
    some = np.flatnonzero(words.lengths)
    if len(some):
        starts = np.concatenate([[0], np.cumsum(words.lengths)])[:-1][some]
        out[some] = np.add.reduceat(values, starts)
    return out


def text_means(words: Words, values: np.ndarray) -> np.ndarray:
    """Means over each text's words, by bytes; 0 without words."""
    sizes = word_sizes(words)
    return text_sums(words, sizes * values) / np.maximum(1, text_sums(words, sizes))


def familiar_words(seen: np.ndarray, words: Words, label: np.ndarray | None = None) -> np.ndarray:
    """Which words have known trigrams alone.

    ``seen`` has a flag of each bucket, or with the words' labels of each bucket and language.
    """
    if not len(words.starts):
        return np.zeros(0, bool)
    at = words.trigrams
    if label is not None:
        counts = np.diff(np.append(words.starts, len(words.trigrams)))
        at = at.astype(np.int64) * seen.shape[1] + np.repeat(label, counts)
    return np.logical_and.reduceat(seen.ravel()[at], words.starts)


def granted_shares(words: Words, chosen: np.ndarray) -> np.ndarray:
    """Share of each text's bytes in words that is in chosen ones, GRANTED_BYTES more counted as such."""
    sizes = word_sizes(words)
    return (text_sums(words, sizes * chosen) + GRANTED_BYTES) / (text_sums(words, sizes) + GRANTED_BYTES)


def familiar_shares(seen: np.ndarray, words: Words, label: np.ndarray | None = None) -> np.ndarray:
    """Share of each text's bytes in words that is in familiar ones; see familiar_words."""
    return granted_shares(words, familiar_words(seen, words, label))


def known_trigrams(words: Words, windows: np.ndarray, labels: np.ndarray | None = None, k: int = 1) -> np.ndarray:
    """Which buckets SEEN_WINDOWS of the chosen windows hold, or one if there are no more windows than that.

    With a label of each window, (bucket, language) by the windows of each of ``k`` languages, but by all of
    them for trigrams with a digit or sign.
    """
    owner = np.repeat(np.repeat(np.arange(len(words.lengths)), words.lengths), np.diff(np.append(words.starts, len(words.trigrams))))

    def held(chosen: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
        pairs = np.unique(owner[chosen] * BUCKETS + words.trigrams[chosen])
        own = of[pairs // BUCKETS]
        parts = np.split(pairs[np.argsort(own, kind="stable")] % BUCKETS, np.cumsum(np.bincount(own, minlength=k))[:-1])
        sizes = np.bincount(of[windows], minlength=k).tolist()
        least = [SEEN_WINDOWS if n > SEEN_WINDOWS else 1 for n in sizes]
        return np.stack([np.bincount(p, minlength=BUCKETS) >= n for p, n in zip(parts, least, strict=True)], axis=1)

    one, chosen = np.zeros(len(words.lengths), np.int64), windows[owner]
    if labels is None:
        return held(chosen, one, 1)[:, 0]
    return held(chosen & ~words.marked, labels, k) | held(chosen & words.marked, one, 1)


def least_familiar(words: Words, labels: np.ndarray, k: int) -> np.ndarray:
    """Of each language, half the median share of familiar words that half of its windows has by the other half's.

    A language of too few windows to tell gets the median of the others'; 0, so that nothing is foreign, if none tells.
    """
    filled = np.flatnonzero(words.lengths)
    filled = filled[np.argsort(labels[filled], kind="stable")]
    counts = np.bincount(labels[filled], minlength=k)
    nth = np.zeros(len(words.lengths), np.int64)
    nth[filled] = np.arange(len(filled)) - np.repeat(np.cumsum(counts) - counts, counts)
    held_out = (words.lengths > 0) & (nth % 2 == 1)
    shares = familiar_shares(known_trigrams(words, ~held_out & (words.lengths > 0), labels, k), words, np.repeat(labels, words.lengths))
    told = counts > SEEN_WINDOWS
    least = np.zeros(k)
    for language in np.flatnonzero(told):
        least[language] = np.median(shares[held_out & (labels == language)]) / 2
    if told.any():
        least[~told] = np.median(least[told])
    return least


def label_probabilities(field: Field, words: Words, scores: np.ndarray | None = None):
    """Forward-backward: (probability of each label of each word, expected transitions)."""
    k = len(field.languages)
    scores = field.scores(words) if scores is None else scores
    unary = np.exp(scores - scores.max(axis=1, keepdims=True, initial=-np.inf)).astype(np.float32) + 1e-9
    trans = np.exp(field.trans).astype(np.float32)
    out = np.empty_like(unary)
    counts = np.zeros((k, k))
    starts = np.concatenate([[0], np.cumsum(words.lengths)])[: len(words.lengths)]
    for chosen in chains.batches(words.lengths):
        at, first = chains.gather(starts[chosen], words.lengths[chosen])
        own, lengths = unary[at], words.lengths[chosen]
        alpha, scale = chains.forward(own, first, lengths, np.full(k, 1 / k, np.float32), trans)
        beta, ahead = chains.backward(own, scale, first, lengths, trans)
        counts += chains.expected_transitions(alpha, ahead, first, lengths, trans)
        alpha *= beta
        out[at] = alpha / alpha.sum(axis=1, keepdims=True)
    return out, counts


def _mixed_sequences(lengths: np.ndarray, labels: np.ndarray, rng) -> list[tuple[np.ndarray, np.ndarray]]:
    """Code-switched training sequences: (word numbers, labels), cut from several texts in turn."""
    starts = np.concatenate([[0], np.cumsum(lengths)])[: len(lengths)]
    pieces = []
    for start, length, label in zip(starts, lengths, labels, strict=True):
        cut = 0
        while cut < length:
            size = int(rng.integers(SEGMENT_WORDS // 2, SEGMENT_WORDS * 4))
            pieces.append((np.arange(start + cut, start + min(length, cut + size)), label))
            cut += size
    out, words, tags = [], [], []
    for i in rng.permutation(len(pieces)):
        words.append(pieces[i][0])
        tags.append(np.full(len(pieces[i][0]), pieces[i][1]))
        if sum(map(len, words)) >= SEQUENCE_WORDS:
            out.append((np.concatenate(words), np.concatenate(tags)))
            words, tags = [], []
    return out + ([(np.concatenate(words), np.concatenate(tags))] if words else [])


def _lexicons(hashes: np.ndarray, tags: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words of each language's sample, and which languages' they are."""
    listed = []
    for language in range(k):
        own, count = np.unique(hashes[tags == language], return_counts=True)
        listed.append(own[np.lexsort((own, -count))[:LEXICON]])
    lexicon = np.unique(np.concatenate(listed))
    return lexicon, np.stack([np.isin(lexicon, own) for own in listed], axis=1).astype(np.float32)


def fit(texts: list[bytes], langs: list[str], seed: int = 5) -> Field | None:
    """A field fitted by AdaGrad on the likelihood of code-switched sequences; None without labelled words."""
    words = words_of(texts)
    languages = sorted(set(langs))
    if not len(words.starts):
        return None
    k = len(languages)
    labels = np.searchsorted(languages, langs)
    tags = np.repeat(labels, words.lengths)
    rng = np.random.default_rng(seed)
    lexicon, holds = _lexicons(words.hashes, tags, k)
    field = Field(
        languages,
        np.zeros((BUCKETS, k), np.float32),
        lexicon,
        holds,
        np.eye(k, dtype=np.float32),
        np.log(np.where(np.eye(k, dtype=bool), 0.9, 0.1 / max(1, k - 1))),
        known_trigrams(words, words.lengths > 0, labels, k),
        least_familiar(words, labels, k),
    )
    squares = [np.full_like(x, 1e-3) for x in (field.weights, field.lexical, field.trans)]
    sizes = np.diff(np.append(words.starts, len(words.trigrams)))
    for _ in range(EPOCHS):
        sequences = _mixed_sequences(words.lengths, labels, rng)
        for b in range(0, len(sequences), BATCH_SEQUENCES):
            batch = sequences[b : b + BATCH_SEQUENCES]
            pick, gold = (np.concatenate([s[i] for s in batch]) for i in (0, 1))
            at, starts = chains.gather(words.starts[pick], sizes[pick])
            part = Words(
                words.trigrams[at], starts, words.affixes[pick], words.hashes[pick],
                np.array([len(s[0]) for s in batch]), words.marked[at],
            )
            guess, moves = label_probabilities(field, part)
            error = -guess
            error[np.arange(len(pick)), gold] += 1
            same = np.ones(len(pick), bool)
            same[np.cumsum(part.lengths) - 1] = False
            seen = np.flatnonzero(same)
            true_moves = np.zeros((k, k))
            np.add.at(true_moves, (gold[seen], gold[seen + 1]), 1)
            spread = np.repeat(np.arange(len(pick)), sizes[pick])
            slot = np.concatenate([part.trigrams, part.affixes[:, 0], part.affixes[:, 1]])
            owner = np.concatenate([spread, np.arange(len(pick)), np.arange(len(pick))])
            up = np.stack([np.bincount(slot, error[owner, j], BUCKETS) for j in range(k)], axis=1)
            found, row = field.look_up(part.hashes)
            steps = (up, holds[row].T @ error[found], true_moves - moves)
            for value, square, step in zip((field.weights, field.lexical, field.trans), squares, steps, strict=True):
                step = step / len(batch)
                square += step**2
                value += RATE * step / np.sqrt(square)
    return field


def training_sample(docs: DataFrame) -> tuple[list[bytes], list[str]]:
    """A bounded sample of the labelled rows on the driver: rows by hash, one window of each text.

    ``docs`` has key, text (binary) and lang. At most SAMPLE_TOTAL windows are collected, or one for each
    language if there are more of those. Rows are drawn by a hash of the id and the text, so rows with
    null or equal ids are drawn one by one; equal rows are drawn together, up to the bound.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {
        r["lang"]: r["n"]
        for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    }
    if not counts:
        return [], []
    rows_each = max(1, min(SAMPLE_ROWS, SAMPLE_TOTAL // len(counts)))
    share = F.create_map(*(x for lang, n in counts.items() for x in (F.lit(lang), F.lit(2.0 * rows_each / n))))
    u = F.shiftrightunsigned(F.xxhash64(F.lit("crf"), "key", F.substr("text", F.lit(1), F.lit(SAMPLE_BYTES))), 11).cast("double") * 2.0**-53
    room = F.greatest(F.lit(1), F.length("text") - SAMPLE_BYTES)
    window = F.substr("text", 1 + F.pmod(F.xxhash64("key"), room).cast("int"), F.lit(SAMPLE_BYTES))
    order = Window.partitionBy("lang").orderBy("u", "window")
    rows = (
        labelled.withColumn("u", u)
        .filter(F.col("u") < F.coalesce(F.element_at(share, F.col("lang")), F.lit(-1.0)))
        .select("lang", "u", window.alias("window"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= rows_each)
        .select("lang", "window")
        .collect()
    )
    rows.sort(key=lambda r: (r["lang"], bytes(r["window"])))
    return [bytes(r["window"]) for r in rows], [r["lang"] for r in rows]


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def label_texts(field: Field | None, texts: list[bytes]):
    """(language or `und`, score, number of words, number of switches) arrays of a batch of texts."""
    return _labelled(field, texts)[:4]


def _labelled(field: Field | None, texts: list[bytes]):
    """label_texts, and whether each text has a letter and is not foreign; without a field none is foreign."""
    n = len(texts)
    pred = np.full(n, UNDETERMINED, object)
    score, count, switches = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    words = words_of(texts)
    count[:] = words.lengths
    for i in np.flatnonzero(count):
        if not re.search(rb"[A-Za-z]", texts[i]) and not _has_letter(texts[i]):
            count[i] = 0
    native = count > 0
    if field is not None and len(words.starts):
        probability, _ = label_probabilities(field, words)
        some = np.flatnonzero(words.lengths)
        starts = np.concatenate([[0], np.cumsum(words.lengths)])[:-1][some]
        mean = np.add.reduceat(probability.astype(np.float64), starts, axis=0) / words.lengths[some, None]
        best = mean.argmax(axis=1)
        label = probability.argmax(axis=1)
        changed = np.concatenate([[False], label[1:] != label[:-1]])
        changed[starts] = False
        switches[some] = np.add.reduceat(changed.astype(np.int64), starts)
        pred[some] = np.array(field.languages, object)[best]
        score[some] = np.minimum(1.0, mean[np.arange(len(some)), best])
        of_text = np.zeros(n, np.int64)
        of_text[some] = best
        native &= field.native(words, label, of_text)
        blank = count == 0
        pred[blank], score[blank], switches[blank] = UNDETERMINED, 0.0, 0
    return pred, score, count, switches, native


def _groups(field: Field | None, texts: list[bytes]) -> list[np.ndarray]:
    """Numbers of neighbouring texts whose features are held at a time."""
    size = FEATURE_BYTES // max(1, len(field.languages) if field else 1)
    ends = np.cumsum([len(t) for t in texts]) // size
    return np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1) if texts else []


def _predict(field: Field | None):
    def run(batches):
        for batch in batches:
            size = FEATURE_BYTES // max(1, len(field.languages) if field else 1)
            for at, n in by_bytes(batch.column(2), size):
                pred, score, count, switches = label_texts(field, batch.column(2).slice(at, n).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(pred, pa.string()),
                     pa.array(score), pa.array(count), pa.array(switches)],
                    schema=PREDICTIONS,
                )
        give_back()

    return run


def _append_languages(field: Field | None):
    def make():
        def run(texts: list[bytes]):
            parts = [_labelled(field, [texts[i] for i in rows]) for rows in _groups(field, texts)]
            pred, score, native = ([x for p in parts for x in p[i]] for i in (0, 1, 4))
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(native, pa.bool_())]

        return run

    return make


def with_languages(docs: DataFrame) -> DataFrame:
    """(row, lang_pred, score, native): whole rows of ``docs`` as a struct; every labelled row may train.

    ``native`` does not ask for one language: it holds for a text whose words are of the learned languages
    that the field labels them or the text with, one or several. It does not for a text without a letter, null and empty ones included, nor for a
    foreign one; if no labelled row can train, it holds for every text with a letter. Each row is
    answered, repeated ones too, texts are read whole, and the struct keeps clashing names apart.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("key"),
        binary_text(F.col("text")).alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    types = "lang_pred string, score double, native boolean"
    return appended(docs, "text", _append_languages(fit(*training_sample(slim))), types)


def predict_languages(docs: DataFrame, held_out: Column) -> DataFrame:
    """Language of each whole text of ``docs`` (doc_id, text, lang); rows held out do not train.

    A null text, an empty one and one without a letter give `und` with score 0, as does every text if no
    labelled row can train. The score is the mean probability of the language over the text's words with
    a letter. A null language does not train; ties go to the first language in order. Repeated rows are
    answered each, texts of any length are read whole, and further columns play no part. The id takes no part in a prediction; it only
    decides by hash which rows are in the sample.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        binary_text(F.col("text")).alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    train = slim.filter(~F.col("held_out")).select(F.col("doc_id").alias("key"), "text", "lang")
    field = fit(*training_sample(train))
    return slim.select("doc_id", "held_out", "text").mapInArrow(_predict(field), PREDICTIONS_DDL)
