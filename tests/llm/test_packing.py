import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import texts
from tokenizers import Tokenizer

from tracewaste.llm import packing
from tracewaste.llm.queries import WORD_MODEL


def slow_first_fit(lengths, capacity):
    room, out = [], []
    for n in lengths:
        at = next((i for i, r in enumerate(room) if r >= n), len(room))
        if at == len(room):
            room.append(capacity)
        out.append((at, capacity - room[at]))
        room[at] -= n
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 257])
def test_tournament_tree_against_a_loop(n):
    rng = random.Random(n)
    lengths = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
    assert list(zip(*packing.first_fit_decreasing(lengths, 100), strict=True)) == slow_first_fit(lengths, 100)


def ids_of(text):
    return Tokenizer.from_file(WORD_MODEL).encode(text or "", add_special_tokens=False).ids + [2]


ODD = ["<|endoftext|> x<|startoftext|>y", "it's I'LL ‘s", "é ́", "ΣΑΣ İ", "12 3.4", "a b c", "\x1c\x1d", "🙂x", "~ a~b ~~ c", "\u3000~\u3000 x"]


def test_word_by_word_is_the_whole_text():
    encoder = packing.WordEncoder(WORD_MODEL)
    for text in texts(60) + ODD:
        got = np.frombuffer(encoder.encode([(text or "").encode()])[0], "<u4").tolist()
        assert got == ids_of(text)[:-1], text


def test_only_different_words_are_looked_up(monkeypatch):
    encoder, asked = packing.WordEncoder(WORD_MODEL), []
    of = encoder.known.of
    monkeypatch.setattr(encoder.known, "of", lambda lists, new: asked.extend(w for some in lists for w in some) or of(lists, new))
    got = encoder.encode([b"rain, Rain rain. sun"] * 50)
    assert sorted(asked) == [b",", b".", b"rain", b"sun"]
    assert np.frombuffer(b"".join(got), "<u4").tolist() == ids_of("rain, Rain rain. sun")[:-1] * 50


def test_small_latin_words_go_without_normalising_and_marks(monkeypatch):
    encoder, seen = packing.WordEncoder(WORD_MODEL), []
    whole = encoder.tokenizer

    class Spy:
        def encode_batch_fast(self, some, **options):
            seen.extend(" ".join(some).split())
            return whole.encode_batch_fast(some, **options)

    monkeypatch.setattr(encoder, "tokenizer", Spy())
    text = "rain straße été a÷b Été don't"
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == ids_of(text)[:-1]
    assert sorted(set(seen)) == sorted([encoder.MARK, "a÷b", "Été", "don't"])


@pytest.mark.parametrize("seed", range(5))
def test_random_texts_are_encoded_as_the_library_does(seed):
    rng = random.Random(seed)
    encoder, library = packing.WordEncoder(WORD_MODEL), Tokenizer.from_file(WORD_MODEL)
    signs = [*"abcxyzABZ'.,!?~<>|  \n\t\r\x0b\x0c\x00\x1c\x85\xa0éÉßöÖ÷×ÿŸñÇ019£‘日\u3000\u0301\u0308İΣς🙂\ufffd"]
    signs += ["<|endoftext|>", "<|", "'s", "'LL", "é.", "É,", "ß!", "÷.", "×.", "a.", "..."]
    made = ["".join(rng.choices(signs, k=rng.choice([0, 1, 2, 5, 20, 60]))) for _ in range(400)]
    for i in range(0, 400, 40):
        for text, got in zip(made[i : i + 40], encoder.encode([t.encode() for t in made[i : i + 40]]), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    broken = [bytes(rng.choices(b"ab .,\xc3\xa0\xb7\x9f\xe9\xff~'\n", k=30)) for _ in range(200)]
    for text, got in zip(broken, encoder.encode(broken), strict=True):
        wanted = library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == wanted, text


def check(got, rows, capacity):
    pieces = sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    wanted = []
    for doc_id, text, *_ in rows:
        ids = ids_of(text)
        for start in range(0, len(ids), capacity):
            part = np.array(ids[start : start + capacity], "<u4")
            wanted.append((str(doc_id), start, len(part), zlib.crc32(part.tobytes()), len(ids)))
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
    return len(held)


@pytest.mark.parametrize("group", [7, 4096])
def test_documents(make, group):
    docs, rows = make(texts(80) + ODD)
    pieces = packing.written(packing.pieces_of(docs, WORD_MODEL, 2, 64), "t")
    got = packing.pack(pieces, 64, group).collect()
    used = check(got, rows, 64)
    if group == 4096:
        assert used <= 1.25 * sum(r["length"] for r in got) / 64 + 1


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.packed_documents(docs, WORD_MODEL).collect()
    sequences = len({r["sequence_id"] for r in got})
    assert sum(r["length"] for r in got) / (4096 * sequences) > 0.98


def test_empty_table(empty):
    assert packing.packed_documents(empty, WORD_MODEL).collect() == []
