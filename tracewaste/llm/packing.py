"""Packing of documents into sequences: first-fit decreasing over a tournament tree.

A document is cut into full sequences and one rest. Full ones are sequences of their own. The rests fall
at random into groups of about ``GROUP_DOCUMENTS`` documents, and each group is packed by itself: its
pieces by falling length, each into the first sequence with room for it, which a tournament tree over the
sequences' room finds in logarithmic time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewaste.llm.tables import Remembered, binary_text, by_bytes, give_back, once_per_worker, row_number, written

SEQUENCE_TOKENS = 4_096
GROUP_DOCUMENTS = 4_096
#: Bytes of words and their ids held by a worker.
REMEMBERED_BYTES = 160 << 20
PIECES_DDL = (
    "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
)
PACKED_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item; items must come by falling length."""
    size = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * size)
    bins, offsets = [], []
    for length in lengths:
        at = 1
        while at < size:
            at *= 2
            if room[at] < length:
                at += 1
        bins.append(at - size)
        offsets.append(capacity - room[at])
        room[at] -= length
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
    return bins, offsets


class WordEncoder:
    """Ids of whole texts, word by word: no token of these vocabularies spans white space.

    ASCII capitals are lowered first, and signs behind a Latin letter that end a word are set apart, as the
    tokenizer does itself, so that a word is learned once whatever its capitals and signs. The words of
    all texts are cut and told apart as arrays of bytes; only different ones become Python objects. New
    words are encoded together. Such of small Latin letters alone need no normalising and are one run of
    the tokenizer's each, which the last token's mark ends; between others a word of one token marks their
    borders. What is remembered is bounded in bytes; a word too long to keep is encoded anew.
    """

    MARK = "~"
    BLANK, SIGN, LETTER, SECOND = 1, 2, 4, 8
    #: What a byte is; SECOND of a Latin letter of two bytes, the first being C3.
    KIND = np.zeros(256, np.uint8)
    KIND[list(b" \t\n\r\x0b\x0c")] = BLANK
    KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = SIGN
    KIND[0x61:0x7B] = LETTER
    KIND[[*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)]] = SECOND
    #: Bytes of words of small Latin letters: a to z, the sharp s, and E0 to FF but for the sign in between.
    SMALL = bytes([*range(0x61, 0x7B), 0xC3, 0x9F, *range(0xA0, 0xB7), *range(0xB8, 0xC0)])

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Remembered(REMEMBERED_BYTES)
        (self.mark,) = self._ids(self.MARK)
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, text: str, letters: bool = False) -> np.ndarray:
        tokenizer = self.letters if letters else self.tokenizer
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        mark, out = self.MARK.encode(), {}

        def cut(some: list[bytes], ids: np.ndarray, ends: np.ndarray, skip: int) -> None:
            data = ids.tobytes()
            ends = (ends * 4).tolist()
            starts = [0, *(end + skip for end in ends)]
            for word, start, end in zip(some, starts, ends, strict=False):
                out[word] = data[start:end]

        small, rest = [], []
        for word in words:
            (rest if word.translate(None, self.SMALL) else small).append(word)
        for i in range(0, len(small), 10_000):
            some = small[i : i + 10_000]
            text = b" ".join(some).decode("utf-8", "replace")
            ids = self._ids(text, letters=True)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some) and "\ufffd" not in text:
                cut(some, ids, ends, 0)
            else:
                rest += some
        odd = [w for w in rest if mark in w]
        rest = [w for w in rest if mark not in w]
        for word in odd:
            out[word] = self._ids(word.decode("utf-8", "replace")).tobytes()
        for i in range(0, len(rest), 10_000):
            some = rest[i : i + 10_000]
            ids = self._ids(f" {self.MARK} ".join([*(w.decode("utf-8", "replace") for w in some), ""]))
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(some):
                raise ValueError("a word holds the mark between words")
            cut(some, ids, ends, 4)
        return out

    def _words(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and how many come before each text and in all."""
        # The strings of special tokens are known as they are written only.
        raw = np.array([b"<|" in t for t in texts], bool)
        joined = b"\n".join([b"", *(t if r else t.lower() for t, r in zip(texts, raw, strict=True)), b""])
        at = 1 + np.cumsum([0, *(len(t) + 1 for t in texts)])
        data = np.frombuffer(joined, np.uint8)
        kind = self.KIND[data]
        inside = kind != self.BLANK
        sign = kind == self.SIGN
        starts = np.empty(len(data), bool)
        starts[0] = False
        np.greater(inside[1:], inside[:-1], out=starts[1:])
        first, past = (np.flatnonzero(sign[1:] != sign[:-1]) + 1).reshape(-1, 2).T
        letter = kind[first - 1]
        apart = (letter == self.LETTER) | ((letter == self.SECOND) & (data[first - 2] == 0xC3))
        apart &= ~inside[past]
        if raw.any():
            apart &= ~raw[np.searchsorted(at, first, side="right") - 1]
        starts[first[apart]] = True
        places = np.flatnonzero(starts)
        number = np.int32 if len(data) < 1 << 31 else np.int64
        offsets = np.append(np.cumsum(inside, dtype=number)[places] - 1, np.count_nonzero(inside))
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])]
        return pa.Array.from_buffers(pa.large_binary(), len(places), buffers), np.searchsorted(places, at)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        words, before = self._words(texts)
        if not len(words):
            return [b""] * len(texts)
        told = words.dictionary_encode()
        which = told.indices.to_numpy()
        _, offsets, data = told.dictionary.buffers()
        offsets, data = np.frombuffer(offsets, np.int64, len(told.dictionary) + 1).tolist(), data.to_pybytes()
        different = [data[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        each = list(map(self.known.new.get, different))
        missing = [i for i, found in enumerate(each) if found is None]
        known = self.known.of([[different[i] for i in missing]], self._encoded)
        for i in missing:
            each[i] = known[different[i]]
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        ids = np.frombuffer(b"".join(each), "<u4")
        # Every word's ids in its place: where they lie among the different words' ids.
        length = size[which]
        ends = np.cumsum(length)
        number = np.int32 if max(ends[-1], len(ids)) < 1 << 31 else np.int64
        place = np.repeat(((np.cumsum(size) - size)[which] - (ends - length)).astype(number), length)
        place += np.arange(len(place), dtype=number)
        data = ids[place].tobytes()
        border = (4 * np.append(0, ends)[before]).tolist()
        return [data[a:b] for a, b in zip(border, border[1:], strict=False)]


def _pieces(tokenizer_path: str, end: int, capacity: int):
    closing = np.array([end], "<u4").tobytes()

    def run(batches):
        encoder = once_per_worker(f"words {tokenizer_path}", lambda: WordEncoder(tokenizer_path))
        numbers = row_number(TaskContext.get().partitionId())
        for batch in batches:
            rows = []
            for at, n in by_bytes(batch.column(1)):
                ids, texts = (batch.column(i).slice(at, n).to_pylist() for i in (0, 1))
                for doc_id, encoded in zip(ids, encoder.encode(texts), strict=True):
                    encoded += closing
                    total = len(encoded) // 4
                    for start in range(0, total, capacity):
                        part = encoded[4 * start : 4 * (start + capacity)]
                        rows.append((next(numbers), doc_id, start, len(part) // 4, zlib.crc32(part), total))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
        give_back()

    return run


def _pack(capacity: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("piece", "ascending")])
        bins, offsets = first_fit_decreasing(group["length"].to_pylist(), capacity)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return pa.table(
            {
                **{n: group[n] for n in names},
                "sequence_id": pa.array((key[0].as_py() << 32) + np.array(bins, np.int64)),
                "offset": pa.array(offsets, pa.int64()),
            }
        )

    return run


def pieces_of(docs: DataFrame, tokenizer_path: str, end: int = 2, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Each document's ids, an end id last, cut at multiples of ``capacity``; counted and summed, not kept."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text(F.col("text")).alias("text"))
    return slim.mapInArrow(_pieces(tokenizer_path, end, capacity), PIECES_DDL)


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, group_documents: int = GROUP_DOCUMENTS) -> DataFrame:
    """``pieces`` with sequence_id and offset; a sequence holds ``capacity`` tokens at most.

    Offsets run without gaps from 0. Groups are drawn by a hash of the piece's own number, so that equal
    or null ids do not meet more often than others. Every piece is kept, repeated ones too.
    """
    rests = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group_documents))
    full = pieces.filter(F.col("length") >= capacity).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.lit(1 << 62) + F.col("piece")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    grouped = rests.withColumn("g", F.pmod(F.xxhash64(F.lit("pack"), "piece"), F.lit(groups)))
    return grouped.groupBy("g").applyInArrow(_pack(capacity), PACKED_DDL).unionByName(full)


def packed_documents(docs: DataFrame, tokenizer_path: str, end: int = 2) -> DataFrame:
    """Packs all documents; a null text is an empty one and has the end id alone. Further columns are left out."""
    return pack(written(pieces_of(docs, tokenizer_path, end), "pack-pieces"))
